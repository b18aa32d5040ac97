"""Runs against all starts and periods; the query's rule; odd rows; long texts."""

import hashlib
import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmetrics.llm.op11_runs import LEAST, kept_words, op11_runs, periodic_runs, planted, runs_of, suffix_order

SMALL = "/root/testdata/sf0.001"


def brute(words, least=LEAST):
    """Every period: maximal stretches in which words q apart are equal, unless a smaller period spans the same words."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=70), min_size=1, max_size=4), st.sampled_from([2, 3, 7, 12]))
def test_runs_of_two_words_equal_brute_force(texts, least):
    assert runs_of(texts, least) == [brute(t, least) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=5), st.integers(1, 9)), max_size=12))
def test_runs_of_repeated_blocks_equal_brute_force(blocks):
    words = [w for block, n in blocks for w in block * n]
    assert runs_of([words, words[::-1], []]) == [brute(words), brute(words[::-1]), []]


def test_self_similar_words():
    a, b = ["a"], ["a", "b"]
    thue = ["a"]
    for _ in range(9):
        a, b = b, b + a
        thue = thue + ["b" if x == "a" else "a" for x in thue]
    assert runs_of([b, thue]) == [brute(b), brute(thue)] and len(runs_of([b])[0]) > 5


def test_suffix_order_sorts_suffixes():
    import numpy as np

    rng = random.Random(3)
    words = [rng.randrange(3) for _ in range(200)] + [9]
    order, _ = suffix_order(np.array(words))
    assert order.tolist() == sorted(range(len(words)), key=lambda i: words[i:])


def test_long_repetitive_texts_take_seconds():
    rng = random.Random(1)
    lines = [[f"w{rng.randrange(50)}" for _ in range(9)] for _ in range(40)]
    texts = [["x"] * 150_000, ["x", "y", "z"] * 50_000, [w for _ in range(15_000) for w in (f"n{rng.random()}", *rng.choice(lines))]]
    start = time.perf_counter()
    got = [runs_of([t])[0] for t in texts]
    assert got[0] == [(0, 150_000, 1)] and got[1] == [(0, 150_000, 3)] and got[2] == []
    assert time.perf_counter() - start < 60


def test_kept_words_drop_all_but_a_runs_first_period():
    assert kept_words(6, [(1, 4, 2)]).tolist() == [True, True, True, False, False, True]


def test_rule_of_the_query():
    words = [f"w{i}" for i in range(100)]
    changed = [i for i in range(400) if planted(i, words) != words]
    assert 20 < len(changed) < 60 and planted(None, words) == words and planted(changed[0], []) == []
    assert any(runs_of([planted(i, words)])[0] for i in changed)


def test_odd_rows(spark):
    line = "one two three "
    rows = [(1, None), (2, ""), (None, line * 6), (3, "  \t\n"), (4, line * 6 + "end"), (4, line * 6 + "end"), (5, "é\x85x " * 12), (6, "a " * 200_000), (7, " ".join(["a"] * 20))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_runs", F.lit("clash")).withColumn("runs", F.lit(1))
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(df).collect()]
    four = (4, 19, [(0, 18, 3)], "one two three end")
    assert sorted(got, key=str) == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 18, [(0, 18, 3)], "one two three"), four, four,
         (5, 12, [(0, 12, 1)], "é\x85x"), (6, 200_000, [(0, 200_000, 1)], "a"), (7, 1, [], " ".join(["a"] * 20))], key=str)
    assert periodic_runs(df.limit(0)).collect() == []


def test_query_equals_brute_force_over_the_whole_table(spark):
    got = {r["doc_id"]: r for r in op11_runs(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    some = 0
    for d in docs:
        words = planted(d["doc_id"], [w.decode() for w in (d["text"] or "").encode().split()])
        if len(words) > 4_000:
            continue  # the plain count takes the square of the words; longer texts are in the tests above
        runs, r = brute(words), got[d["doc_id"]]
        some += len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *want)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in dropped))
    assert some > 10
