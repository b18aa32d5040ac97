"""Variants against all pairs; edits against their definition; the query's rule; odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from snapmetrics.llm import op13_spelling as op
from snapmetrics.llm.common import prepare, stored

SMALL = "/root/testdata/sf0.001"


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    """All pairs of words of about the same length."""
    by_size, out = {}, {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    for w, n in counts.items():
        close = [x for d in (-1, 0, 1) for x in by_size.get(len(w) + d, []) if near(w, x)]
        top = min(close, key=lambda x: (-counts[x], x), default=None)
        out[w] = (n, len(close), top if top is not None and counts[top] >= 2 * n else None)
    rows = []
    for w, (n, n_near, form) in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        rows.append((w, form, root, n, n_near, counts[form] if form else None))
    return sorted(rows)


def got_of(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def vocab_of(spark, counts):
    prepare(spark)
    return stored(spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(3), "vocab-test")


def test_variants_equal_all_pairs(spark):
    rng = random.Random(5)
    counts = {}
    for _ in range(700):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(5, 8)))
        counts[w] = rng.choice([3, 4, 6, 8, 13, 30, 100])
    assert got_of(op.spelling_variants(vocab_of(spark, counts))) == brute(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "bbbbbb": 192, "bbbbbbb": 383}
    counts |= {"color": 10, "colour": 20, "colors": 20, "zebra": 7, "x" * 70 + "y": 5, "x" * 70: 11, "x" * 69: 3}
    got = got_of(op.spelling_variants(vocab_of(spark, counts)))
    assert got == brute(counts)
    by = {r[0]: r for r in got}
    assert by["aaaaa"][2] == "bbbbbb" and by["color"][1] == "colors" and by["zebra"] == ("zebra", None, "zebra", 7, 0, None)


def test_positive_edits_hold_every_near_word_once():
    rng = random.Random(2)
    texts = sorted({"".join(rng.choice("abcÀÿ") for _ in range(rng.randrange(5, 9))) for _ in range(600)} | {"q" * 60, "q" * 59 + "r", "q" * 59})
    filters, powers = op.Filters(Counter(min(len(t), op.LENGTHS + 1) for t in texts)), op.Powers()
    s = op.Spelled(texts, powers)
    at, bits = filters.places(s.hash, s.size)
    np.bitwise_or.at(filters.lanes, at, bits)
    alphabet = np.array(sorted({ord(c) for t in texts for c in t}), np.uint32)
    made = [(texts[i], e) for i, e in op.positive_edits(texts, filters, alphabet, powers)]
    assert len(made) == len(set(made)) and all(near(*m) for m in made)
    known = set(texts)
    true = [m for m in made if m[1] in known]
    want = {(a, b) for a in texts for b in texts if near(a, b) and (len(b) < len(a) or len(a) == len(b) and a < b)}
    assert set(true) == want and len(made) - len(true) < 0.01 * len(alphabet) * len(s.codes)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(op, "FILTER_BYTES", 8)
    monkeypatch.setattr(op, "LEAST_LANES", 1)
    rng = random.Random(8)
    counts = {"".join(rng.choice("ab") for _ in range(7)): rng.randrange(3, 40) for _ in range(100)}
    assert got_of(op.spelling_variants(vocab_of(spark, counts))) == brute(counts)


def counted(rows):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def test_odd_rows(spark):
    prepare(spark)
    rows = [(1, None), (2, ""), (None, "Hello hello HELLO ÀBCDÉ Àbcdé àbcdé"), (3, "hello world"), (3, "hello world"), (4, "123 !!"), (5, "abcdefgh " * 50_000)]
    rows += [(6, "z" * 100_000 + " ") for _ in range(3)] + [(i, "Straße straÿe hallo") for i in range(7, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("clash"))
    counts = counted(rows)
    assert {r["word"]: r["n"] for r in op.vocabulary(op.with_slips(df)).collect()} == counts and "z" * 100_000 in counts
    assert got_of(op.spelling_variants(stored(op.vocabulary(op.with_slips(df)), "vocab-test"))) == brute(counts)
    assert got_of(op.spelling_variants(stored(op.vocabulary(op.with_slips(df.limit(0))), "vocab-test"))) == []


def test_query_equals_all_pairs_over_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = got_of(op.op13_spelling(spark, SMALL))
    assert got == brute(counted(rows)) and any(r[1] for r in got)
