"""Planted overlaps: whole, substituted, partial, across case and punctuation; clean texts and odd tables stay."""

import random

import numpy as np
from pyspark.sql import functions as F

from snapmetrics.llm import op2_decontaminate as op2
from snapmetrics.llm.op2_decontaminate import LEAST_WORDS, benchmark_overlaps, best_stretch, needed, overlap, same_seeds, tokens

RNG = random.Random(3)
VOCABULARY = [f"{a}{b}{c}" for a in "bdklmn" for b in "aeiou" for c in "rstx"]


def words(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


ITEMS = {i: words(n) for i, n in enumerate([14, 20, 40, 60, 9, 5, 3])}


def planted(item, change=lambda w: w, before=60, after=60):
    return " ".join([*words(before), *change(list(item)), *words(after)])


def substituted(every):
    return lambda w: [x if i % every else "zzz" for i, x in enumerate(w)]


def test_planted_overlaps_are_found_and_clean_texts_are_not(spark):
    docs = {i: planted(ITEMS[i]) for i in range(6)}
    docs |= {10: planted(ITEMS[2], substituted(6)), 11: planted(ITEMS[3], lambda w: w[20:45]), 12: planted(ITEMS[1]).title().replace(" ", ", "), 13: " ".join(ITEMS[0])}
    docs |= {20 + i: " ".join(words(300)) for i in range(40)} | {70: planted(ITEMS[6]), 71: planted(ITEMS[3], lambda w: w[:6]), 72: None, 73: ""}
    rows = [*docs.items(), (0, docs[0]), (None, docs[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("matched", F.lit("clash"))
    items = spark.createDataFrame([*((i, " ".join(w)) for i, w in ITEMS.items()), (0, " ".join(ITEMS[0])), (8, None), (9, "")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = benchmark_overlaps(df, items).collect()
    found = sorted(((r["doc_id"], r["item_id"]) for r in got), key=str)
    want = [(i, i) for i in range(6)] + [(0, 0), (None, 1), (10, 2), (11, 3), (12, 1), (13, 0)]
    assert found == sorted(want, key=str)
    by = {(r["doc_id"], r["item_id"]): r for r in got}
    assert by[2, 2]["matched"] == 40 and by[2, 2]["at_word"] == 60 and by[11, 3]["matched"] == 25 and by[10, 2]["words"] > by[10, 2]["matched"] > 30
    assert benchmark_overlaps(df.limit(0), items).collect() == [] and benchmark_overlaps(df, items.limit(0)).collect() == []


def test_best_stretch_and_overlap():
    assert best_stretch(np.array([1, 1, 0, 1, 1, 1, 0, 0, 0, 1], bool)) == (5, 0, 6)
    assert best_stretch(np.array([0, 0], bool))[0] == 0
    doc, item = tokens("x a b c d e f g h i y"), tokens("a b c d e f g h i")
    assert overlap(doc, item, [1]) == (9, 9, 1) and overlap(doc, item, [0]) is None and needed(9) == 6 and needed(100) == 12 and needed(5) == 5


def test_any_changed_word_of_a_short_item_is_found(spark):
    """Items of 6 to 14 words laid into other words with each of their words changed in turn: found exactly when the
    definition (all diagonals) finds them."""
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(4, 15)]
    docs, texts = [], {}
    for n, text in items:
        for k in range(-1, n):
            words = text.split()
            if k >= 0:
                words[k] = "other"
            texts[100 * n + k + 1] = " ".join(["so", "far", *words, "and", "on"])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["matched"]) for r in benchmark_overlaps(docs, spark.createDataFrame(items, "item_id int, text string")).collect()}
    want = set()
    for i, text in texts.items():
        for n, item in items:
            if n >= LEAST_WORDS and (m := overlap(tokens(text), tokens(item), list(range(-n, 40)))):
                want.add((i, n, m[0]))
    assert got == want and len(want) > 80


def test_long_texts_and_ties(spark):
    item = " ".join(f"q{k}" for k in range(20))
    rows = [(1, "filler " * 200_000 + item), (2, f"{item} {item}"), (3, f"{item} x {item}"), (3, f"{item} x {item}")]
    found = benchmark_overlaps(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id int, text string")).collect()
    assert sorted((r["doc_id"], r["matched"], r["at_word"]) for r in found) == [(1, 20, 200_000), (2, 20, 0), (3, 20, 0), (3, 20, 0)]


def test_frequent_seeds_meet_in_parts_and_lose_no_match(spark, monkeypatch):
    """Seeds held by many texts, many items, both or few, and more frequent ones than are dealt: the rows of the plain join."""
    rng = random.Random(11)
    hits = [(s, t, t % 5) for s in range(6) for t in range([1, 2, 40, 3, 25, 9][s])] + [(2, 0, 17), (99, 1, 1)]
    of = [(s, 1000 + i, i % 4) for s in range(6) for i in range([2, 30, 35, 1, 1, 8][s])] + [(98, 1, 1)]
    rng.shuffle(hits)
    x = spark.createDataFrame(hits, "seed long, text_key long, at int")
    y = spark.createDataFrame(of, "seed long, item_key long, item_at int")
    want = sorted((s, t, at, i, item_at) for s, t, at in hits for s2, i, item_at in of if s == s2)
    for part, hot in ((1000, 10), (4, 10), (4, 1), (1, 3)):
        monkeypatch.setattr(op2, "PART", part)
        monkeypatch.setattr(op2, "HOT", hot)
        got = sorted(tuple(r) for r in same_seeds(x, y).select("seed", "text_key", "at", "item_key", "item_at").collect())
        assert got == want
    assert same_seeds(x, y.limit(0)).count() == same_seeds(x.limit(0), y).count() == 0


def test_a_phrase_of_many_items_and_texts_is_one_overlap_a_pair(spark, monkeypatch):
    monkeypatch.setattr(op2, "PART", 5)
    phrase = [f"shared{k}" for k in range(16)]
    items = [(i, " ".join([*phrase, f"own{i}", f"end{i}"])) for i in range(12)]
    docs = [(i, " ".join([*words(30), *phrase, *words(30)])) for i in range(20)] + [(100 + i, " ".join(words(80))) for i in range(10)]
    docs.append((200, " ".join([*phrase, *words(5)] * 300)))  # a very long text that repeats the phrase
    got = benchmark_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted((d, i) for d in [*range(20), 200] for i in range(12))
    assert {r["matched"] for r in got} == {16}
