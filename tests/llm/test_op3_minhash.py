"""Components against all pairs, on families of copies, near copies, templates and chains; odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from snapmetrics.llm.components import components
from snapmetrics.llm.op3_minhash import minhash_components, shingle_set

RNG = random.Random(11)


def text(n):
    return [f"w{RNG.randrange(400)}" for _ in range(n)]


def edited(words, k):
    out = list(words)
    for i in RNG.sample(range(len(out)), k):
        out[i] = f"e{RNG.randrange(10**6)}"
    return out


def family_texts():
    found = []
    for n in (20, 80, 200):
        base = text(n)
        found += [base] + [list(base) for _ in range(15)]  # exact copies
        found += [edited(base, 1 + i % max(2, n // 25)) for i in range(70)]  # near copies, some beyond the limit
        chain = list(base)
        for _ in range(12):  # each close to the one before, the ends far apart
            chain = edited(chain, max(1, n // 60))
            found.append(chain)
        found += [base[: n * 9 // 10], base[n // 10 :], base + base[: n // 20]]
    template = text(150)
    found += [edited(template, 9) for _ in range(60)]  # alike, but not near enough to each other
    return found + [text(RNG.randrange(1, 120)) for _ in range(60)] + [["one"], ["one"], ["Two", "three"], ["tWO", "THREE"]]


def brute(texts, words=4, percent=80):
    sets = [shingle_set(t, words) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(np.intersect1d(x, sets[j], assume_unique=True))
            if shared and 100 * shared >= percent * (len(x) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def test_components_equal_all_pairs(spark):
    texts = [" ".join(w) for w in family_texts()]
    RNG.shuffle(texts)
    want, sizes = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: r for r in minhash_components(df).collect()}
    assert len(got) == len(texts)
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_odd_rows(spark):
    same = " ".join(text(50))
    rows = [(5, same), (5, same), (3, same), (None, same), (7, None), (8, ""), (9, " \n\t"), (None, None), (None, "only nameless words here now"), (11, "Ab c\nd e"), (12, "aB c d\te"), (13, "É b c d"), (14, "é b c d"), (15, "x " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("digest", F.lit("x"))
    got = minhash_components(df).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert len(got) == len(rows)
    assert sum(r["doc_id"] == 5 and r["component_id"] == 3 and not r["kept"] for r in got) == 2
    by = {(r["doc_id"], r["n_shingles"]): r for r in got}
    assert by[None, 47]["component_id"] == 3 and not by[None, 47]["kept"]
    assert by[None, 0]["kept"] and by[None, 2]["kept"] and all(by[i, 0]["component_id"] == i and by[i, 0]["kept"] for i in (7, 8, 9))
    assert by[12, 1]["component_id"] == 11 and by[14, 1]["component_id"] == 14 and by[15, 1]["kept"]
    assert minhash_components(df.limit(0)).collect() == []


def test_alternating_stars_on_random_graphs(spark):
    for n, m in ((60, 40), (60, 80), (200, 190)):
        edges = [(RNG.randrange(n), RNG.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n, n + 40)] + [(None, 1), (3, 3)]
        root = {}

        def find(i):
            while root.setdefault(i, i) != i:
                i = root[i]
            return i

        for a, b in edges:
            if a is not None and a != b:
                x, y = sorted((find(a), find(b)))
                root[y] = x
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {i: find(i) for i in list(root)}


def test_one_id_with_several_texts_and_near_copies_without_id(spark):
    rng = random.Random(5)
    near = lambda ws, i: " ".join([*ws[:i], f"e{i}", *ws[i + 1 :]])
    a, b, c, d = ([f"{x}{rng.randrange(10**6)}" for _ in range(200)] for x in "abcd")
    rows = [(5, near(a, 0)), (7, " ".join(a)), (7, " ".join(b))]  # b is clean, whatever the other text of its id is near to
    rows += [(None, " ".join(c)), (None, near(c, 199)), (None, near(c, 0)), (None, near(c, 0))]  # near copies, no id at all
    rows += [(9, " ".join(d)), (9, near(d, 0)), (9, " ".join(d).upper()), (None, near(d, 199))]  # near copies of one id
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_key", F.xxhash64("text"))
    keys = [r["text_key"] for r in df.collect()]
    got = minhash_components(df).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["text_key"]): (r["component_id"], r["kept"]) for r in got}
    assert [by[rows[i][0], keys[i]] for i in range(3)] == [(5, True), (5, False), (7, True)]
    assert {by[None, keys[i]][0] for i in range(3, 7)} == {None} and sum(by[None, keys[i]][1] for i in (3, 4, 5)) == 1
    assert by[None, keys[10]] == (9, False) and sorted(by[9, keys[i]] for i in (7, 8, 9)) == [(9, False), (9, False), (9, True)]
