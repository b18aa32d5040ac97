"""Held-out accuracy on the small tables; plain compression as brute force; ties; odd texts."""

import zlib
from collections import Counter

import regex
import xxhash
import zstandard
from pyspark.sql import functions as F

from snapmetrics.llm.op9_language import ALL_DICT_BYTES, BLOCK, DICT_BYTES, LEVEL, NARROW, PIECE, SAMPLE_DOCS, compression_language

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    got = compression_language(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 250 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.96
    sure = [r for r in got if not r["rejected"]]
    assert sum(r["lang"] == r["lang_pred"] for r in sure) / len(sure) > 0.98 and all(0 <= r["score"] <= 1 for r in got)


def test_odd_texts(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", "text", "lang")
    some = docs.filter("lang = 'fr' and length(text) > 2000").limit(3)
    odd = spark.createDataFrame([(10**6, None, "en"), (10**6 + 1, "", None), (10**6 + 2, "12 % ##\n", "fr"), (None, "le la de", "fr"), (10**6 + 3, "the of and " * 100_000, None)], "doc_id long, text string, lang string")
    got = compression_language(docs.unionByName(odd).unionByName(some).withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit(1))).collect()
    assert len(got) == 1008
    by = {r["doc_id"]: r for r in got}
    assert all(by[10**6 + i]["lang_pred"] == "und" and by[10**6 + i]["score"] == 0 for i in range(3))
    assert by[10**6 + 3]["lang_pred"] == "en" and by[None]["held_out"] and by[None]["lang_pred"] in ("en", "de", "fr", "es")
    assert compression_language(docs.limit(0)).collect() == []
    assert {r["lang_pred"] for r in compression_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def brute(rows):
    """(language, score, rejected) of every (id, text, lang) from the definition; texts to learn from are short and few enough
    for all of them to be learned whole."""
    learned = [(t, lang) for i, t, lang in rows if t is not None and lang is not None and i is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    counts = Counter(lang for _, lang in learned)
    assert max(counts.values()) <= SAMPLE_DOCS and all(len(t) <= PIECE for t, _ in learned)
    letters = lambda t: " ".join(regex.findall(r"[\p{L}\p{M}--\p{M}]+", t.lower(), flags=regex.V1)).encode()
    order = sorted({(t, lang) for t, lang in learned}, key=lambda x: ((xxhash.xxh64_intdigest(x[0], seed=42) + (1 << 63)) % (1 << 64), x[0]))
    limit = min(DICT_BYTES, ALL_DICT_BYTES // len(counts))

    def size(lang, data):
        content = b"\n".join(letters(t) for t, of in order if of == lang)[:limit]
        total = 0
        for i in range(0, len(data), BLOCK):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            total += len(c.compress(data[i : i + BLOCK]))
        return total

    for _, t, _ in rows:
        data = letters(t or "")
        ranked = sorted((size(lang, data), -n, lang) for lang, n in counts.items()) if data else []
        margin = 1 - ranked[0][0] / ranked[1][0] if data else 0.0
        yield (ranked[0][2], margin, margin < NARROW) if data else ("und", 0.0, True)


def test_equals_plain_compression_and_ties(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", F.substring("text", 1, 700).alias("text"), "lang").filter("doc_id < 90")
    rows = [tuple(r) for r in docs.collect()]
    # two languages of the same texts tie: the one with more documents is named; a long text counts all its blocks
    same = [(200 + i, f"uno due tre quattro {i // 2 % 4} cinque", "xa" if i % 2 else "xb") for i in range(24)] + [(300, "uno due tre quattro 0 cinque", "xb"), (302, "uno due tre quattro 0 cinque", "xb")]
    rows += same + [(400, "uno due tre quattro cinque", None), (401, None, "de"), (402, "12 34", None), (403, "der die das und " * 3000, None), (None, "the of and", "en")]
    got = compression_language(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)
    have = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in got}
    for (i, _, _), want in zip(rows, brute(rows), strict=True):
        assert have[i][0] == want[0] and abs(have[i][1] - want[1]) < 1e-12 and have[i][2] == want[2], (i, have[i], want)
