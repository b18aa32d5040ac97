"""Held-out accuracy on planted words, neutral mentions of groups, odd tables."""

import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from snapmetrics.llm.op4_toxicity import IDENTITY_GROUPS, PARTS, changes, damped, features, learn, products, swapped, toxicity

RNG = random.Random(8)
PLAIN = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "su", "ta", "re") for b in ("nd", "rt", "ll", "sk", "mp", "gen")]
BAD = ["vilex", "grubbish", "snarlot", "mukker"]


def sentence(bad=0, term=None):
    words = [RNG.choice(PLAIN) for _ in range(RNG.randrange(6, 14))]
    for _ in range(bad):
        words.insert(RNG.randrange(len(words)), RNG.choice(BAD))
    if term:
        words.insert(RNG.randrange(len(words)), term)
    return " ".join(words).capitalize() + "."


def corpus(spark):
    docs, labels = [], []
    for i in range(1200):
        toxic = i % 6 == 0
        # one group is mentioned mostly in toxic texts: a classifier without the penalty holds the term against neutral ones
        term = "muslim" if toxic and i % 4 == 0 or not toxic and i % 97 == 0 else "christian" if i % 5 == 0 else None
        docs.append((i, " ".join(sentence(2 if toxic and k < 2 else 0, term if k == 1 else None) for k in range(RNG.randrange(3, 9)))))
        labels.append((i, int(toxic), 1))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_held_out_accuracy_and_neutral_mentions(spark):
    docs, labels = corpus(spark)
    got = toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 300 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert sum(r["predicted"] == r["toxic"] for r in got) / len(got) > 0.97
    plain = [sentence() for _ in range(40)]
    terms = [t for g in ("belief", "origin") for t in IDENTITY_GROUPS[g]]
    rows = [(i * 100 + j, f"{s} {t} {s}") for i, s in enumerate(plain) for j, t in enumerate(["", *terms])]
    probe = spark.createDataFrame(rows, "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity(docs.unionByName(probe.withColumn("doc_id", F.col("doc_id") + 10**6)), labels).filter("doc_id >= 1000000").collect()}
    assert max(scores.values()) < 0.5  # no group's mention alone makes a text toxic
    assert max(abs(scores[10**6 + i * 100 + j] - scores[10**6 + i * 100]) for i in range(40) for j in range(1, len(terms) + 1)) < 0.2


def test_swapped_sentences():
    pairs = swapped("A muslim man came. Nothing here. The woman left! " * 50)
    assert len(pairs) == 150 and all(a in s.lower() and a != b for s, a, b in pairs)
    ((s, a, b),) = swapped("No group is named")
    assert a != b and s == f"{a} No group is named" and swapped("") == []


def test_changes_and_their_products_equal_full_descriptions():
    """Each swap's change against features of the sentence written with the other term; products against dense vectors."""
    text = "The old woman saw an old man and a german. A black cat! A jewish and a muslim boy, old old."
    picked = sorted({f for t in ("old", "woman", "german", "muslim", "cat") for f in features(t)[0]})
    column, k = {f: i for i, f in enumerate(picked)}, len(picked)

    def vector(sentence):
        counts, n = features(sentence)
        return np.array([float(counts.get(f, 0) > 0) for f in picked] + [damped(counts.get(f, 0), n) for f in picked])

    dense = []
    for s, a, b in swapped(text):
        at = re.search(rf"\b{a}\b", s, re.I)
        dense.append(vector(s) - vector(s[: at.start()] + b + s[at.end() :]))
    n, at, sums = products(column, text)
    want = sum(np.outer(d, d) for d in dense)
    got = np.zeros(4 * k * k)
    got[at] = np.array(sums) / PARTS
    assert n == sum(bool(np.abs(d).sum()) for d in dense) and n >= 3 and np.abs(got.reshape(2 * k, 2 * k) - want).max() < 1e-5


def test_a_long_sentence_is_swapped_in_seconds():
    start = time.perf_counter()
    assert len(changes("old man and german woman " * 100_000)) == 4 and time.perf_counter() - start < 20


def test_odd_tables(spark):
    docs, labels = corpus(spark)
    odd = spark.createDataFrame([(None, "x"), (5000, None), (5001, ""), (1, "again"), (1, "again"), (5002, "wort " * 200_000)], "doc_id long, text string")
    more = labels.unionByName(spark.createDataFrame([(2, None, 1), (3, 1, 0), (None, 1, 1), (9_999, 1, 1)], "doc_id long, toxic int, quality int"))
    got = toxicity(docs.unionByName(odd).withColumn("score", F.lit("clash")).withColumn("predicted", F.lit(7)), more).collect()
    assert len(got) == 1206 and all(r["score"] is not None for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {True}
    assert len({r["score"] for r in got if r["doc_id"] in (5000, 5001)}) == 1
    assert toxicity(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r["score"] for r in toxicity(docs, labels.filter("toxic = 1")).collect()} == {1.0}
    assert learn(docs.select(F.col("doc_id").alias("id"), "text"), labels.select(F.col("doc_id").alias("id"), F.lit(0).alias("label")))["share"] == 0
