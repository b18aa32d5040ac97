"""Measures against a plain count; odd texts."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmetrics.llm.op1_quality import NGRAM_LIMITS, SCHEMA, measure, repetition_quality

NAMES = [f.name for f in SCHEMA.fields]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]

    def inside(n):  # three words: every occurrence; more: the later ones
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        many = Counter(grams)
        return {i + k for i, g in enumerate(grams) if (many[g] > 1 if n == 3 else grams.index(g) < i) for k in range(n)}

    dup = [x for i, x in enumerate(lines) if x in lines[:i]]
    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(dup),
        "n_repeat_words": len(inside(3)), "n_lines": len(lines), "dup_line_chars": sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in dup),
    }
    return out | {f"dup{n}_chars": sum(len(words[i]) for i in inside(n)) for n in NGRAM_LIMITS}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "c#", "é\x1f", "\U0001f600", " ", "\x85x"]), max_size=40), st.lists(st.sampled_from([" ", "\n", "\t", "\x0b", "\r\n", "  "]), min_size=40, max_size=40))
def test_measures_equal_a_plain_count(words, gaps):
    text = "".join(w + g for w, g in zip(words, gaps, strict=False))
    assert dict(zip(NAMES, measure(text), strict=True)) == brute(text)


def test_verdicts_and_odd_rows(spark):
    clean = " ".join(f"w{i}" for i in range(120))
    rows = [(1, clean), (1, clean), (2, None), (3, ""), (None, clean), (4, " ".join(["same five words come again"] * 40)), (5, clean + " " + " ".join(f"v{i % 12}" for i in range(72)))]
    rows += [(6, "\n".join(["one line of some words here"] * 3 + [f"x{i} y{i}" for i in range(80)])), (7, " ".join(f"w{i}#" for i in range(100))), (8, "ab " * 300_000), (9, f"same head\n{clean}\nsame head")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(1))
    got = {(r["doc_id"], r["n_words"]): r for r in repetition_quality(df).collect()}
    assert len(got) == len(rows) - 1
    assert got[1, 120]["kept"] and got[None, 120]["kept"] and got[2, 0]["base_failed"] and got[3, 0]["reason"] == "base"
    assert got[4, 200]["base_failed"] and got[8, 300_000]["base_failed"] and got[7, 100]["reason"] == "symbols"
    assert got[5, 192]["reason"] == "5 words" and not got[5, 192]["base_failed"] and got[6, 178]["kept"] and got[9, 124]["kept"]
    assert repetition_quality(df.limit(0)).collect() == []
