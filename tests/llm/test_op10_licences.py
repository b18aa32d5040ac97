"""Own licences against a plain Python cosine; inheritance by path; odd tables."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

import pytest

from snapmetrics.llm import op10_licences as op
from snapmetrics.llm.op10_licences import CUT, LEAST, TEMPLATES, TRIGGER, licences, terms_of

ROWS = [
    (1, "repo/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    (2, "repo/src/a.py", "print(1)"),
    (3, "repo/src/deep/b.py", "# Licensed under the Apache License, Version 2.0.\ncode of many words that goes on and on, longer than its header is"),
    (4, "repo/src/deep/c.py", None),
    (5, "repo/src/deep/sub/COPYING", "This work is licensed under the GNU General Public License, version 3"),
    (6, "repo/src/deep/sub/x/y/z.c", "int main;"),
    (7, "other/file.txt", "nothing here but a licence without any name in a sentence of its own that is about apples"),
    (8, None, "Released under the MIT License."),
    (9, None, ""),
    (2, "repo/src/a.py", "print(1)"),
    (10, "top.txt", "no place above"),
]


def brute(rows):
    def heads(text):
        if not text or not re.search(TRIGGER, text):
            return []
        lines = [x for x in re.split(CUT, text) if re.search(TRIGGER, x)]
        return [u for u in map(terms_of, lines + (["\n".join(lines)] if len(lines) > 1 else [])) if u]

    texts = [terms_of(t) for ts in TEMPLATES.values() for t in ts]
    units = [u for r in rows for u in heads(r[2])]
    n = len(units) + len(texts)
    held = Counter(t for u in units + texts for t in u)
    weigh = lambda u: {t: c * (math.log((1 + n) / (1 + held[t])) + 1) for t, c in u.items()}
    found = []
    for _, _, text in rows:
        best = None
        for u in map(weigh, heads(text)):
            for name, ts in TEMPLATES.items():
                for t in (weigh(terms_of(x)) for x in ts):
                    dot = sum(w * t.get(x, 0) for x, w in u.items())
                    cos = dot / math.sqrt(sum(w * w for w in u.values()) * sum(w * w for w in t.values()))
                    best = max(best or (0, ""), (round(cos, 6), name))
        found.append(best if best and best[0] >= LEAST else None)
    return found


def test_own_and_inherited(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, path string, text string").withColumn("licence", F.lit("clash")).withColumn("best", F.lit(1))
    got = licences(df, path=F.col("path")).collect()
    assert len(got) == len(ROWS)
    want = dict(zip([r[0] for r in ROWS], brute(ROWS), strict=True))
    for r in got:
        own = want[r["doc_id"]]
        assert (r["origin"] == "own") == (own is not None)
        if own:
            assert r["licence"] == own[1] and abs(r["similarity"] - own[0]) < 2e-6
    by = {r["doc_id"]: r for r in got}
    assert by[1]["licence"] == "MIT" and by[1]["is_licence_file"] and by[3]["licence"] == "Apache-2.0" and not by[3]["is_licence_file"]
    assert (by[2]["licence"], by[2]["from_directory"]) == ("MIT", "repo") and (by[4]["licence"], by[4]["origin"]) == ("MIT", "inherited")
    assert (by[6]["licence"], by[6]["from_directory"]) == ("GPL-3.0", "repo/src/deep/sub")
    assert by[7]["origin"] == by[9]["origin"] == by[10]["origin"] == "none" and by[8]["licence"] == "MIT"
    assert licences(df.limit(0), path=F.col("path")).collect() == []


@pytest.mark.parametrize("common", [1, 1000])
def test_all_terms_weigh_by_count_and_frequency(spark, monkeypatch, common):
    """Rare, repeated, very long and frequent words beside a licence's name; frequent ones broadcast or not; a very long text."""
    monkeypatch.setattr(op, "COMMON", common)
    words = ["zebra", "the", "the", "license", "x" * 100, "Müller", "MIT", "2.0", "GNU"]
    rows = [(i, None, f"Licensed under the Apache License, Version 2.0 by {' '.join(words[: i % 10])}.\nReleased under the MIT License. {words[i % 9] * (i % 3)}") for i in range(40)]
    rows += [(50, None, "license " * 5000 + "MIT"), (51, None, "licence ü ö"), (52, None, "word " * 100_000 + "\nReleased under the MIT License."), (53, None, "ß licence\n" * 3)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["similarity"], r["licence"]) if r["origin"] == "own" else None for r in licences(df, path=F.col("path")).collect()}
    for (i, _, _), want in zip(rows, brute(rows), strict=True):
        assert (got[i] is None) == (want is None), i
        assert want is None or (got[i][1] == want[1] and abs(got[i][0] - want[0]) < 2e-6), (i, got[i], want)
    assert got[52][1] == "MIT"
