"""Language by compression: the language whose sample, given to zstandard as a raw-content dictionary, lets a text
compress best.

Each language's dictionary is filled with pieces of a bounded sample of its learned documents (``SAMPLE_DOCS`` a
language, one piece of ``PIECE`` characters at a place drawn by hash, equal pieces once, ``DICT_BYTES`` at most and
``ALL_DICT_BYTES`` over all languages). The whole text (its lower-cased runs of letters) is compressed in blocks of
``BLOCK`` bytes, so that a long text is judged by the dictionaries rather than by itself, and the sizes are added up. The smallest sum names the
language; a relative margin under ``NARROW`` marks the answer as rejected (the best language is still named).

Defined results: a null text or one without a letter is `und` with score 0 and counts as rejected; with nothing to
learn from, every text is `und`; ties go to the language with more learned documents, then by name; a null id is never
learned from and counts as held out; repeated rows repeat their result; a very long text is compressed whole, block by
block; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import held_out, map_rows, table

SAMPLE_DOCS, PIECE = 400, 1_000
DICT_BYTES, ALL_DICT_BYTES = 112_000, 16_000_000
BLOCK = 2_048
LEVEL = 5
NARROW = 0.02
LETTERS = re.compile(r"[^\W\d_]+")
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def letters(text: str) -> bytes:
    return " ".join(LETTERS.findall(text.lower())).encode()


def learn(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, bytes]]:
    """(language, dictionary) by falling number of learned documents. One row a language comes to the driver, then
    the bounded sample."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter(~held_out(F.col("id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    limit = min(DICT_BYTES, ALL_DICT_BYTES // len(sizes))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, SAMPLE_DOCS / n))])
    start = F.pmod(F.xxhash64(F.lit("piece"), "id"), F.greatest(F.length("text") - PIECE, F.lit(0)) + 1) + 1
    pieces = rows.filter(draw < share[F.col("lang")]).select("lang", F.substring(F.col("text"), start, F.lit(PIECE)).alias("piece"))
    pieces = pieces.distinct().orderBy(F.xxhash64("piece"), "piece").collect()
    found = []
    for lang in sorted(sizes, key=lambda x: (-sizes[x], x)):
        found.append((lang, b"\n".join(letters(p["piece"]) for p in pieces if p["lang"] == lang)[:limit]))
    return found


def compressors(dictionaries: list[tuple[str, bytes]]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for lang, content in dictionaries:
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if content:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            made.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, **options)))
        else:
            made.append((lang, zstandard.ZstdCompressor(level=LEVEL, **options)))
    return made


def judge(models: list[tuple[str, zstandard.ZstdCompressor]], text: str | None) -> tuple[str, float, bool]:
    data = letters(text or "")
    if not models or not data:
        return "und", 0.0, True
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in models]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    second = min((s for i, s in enumerate(sizes) if i != best), default=2 * sizes[best])
    margin = 1 - sizes[best] / second
    return models[best][0], margin, margin < NARROW


def compression_language(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id_col, held_out, lang_pred, score (relative margin to the second language), rejected: one row per row."""
    models = df.sparkSession.sparkContext.broadcast(learn(df, id_col, text_col, lang_col))
    found = map_rows(df, judge, [text_col], RESULT, [id_col], setup=lambda: compressors(models.value))
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score", "rejected")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return compression_language(table(spark, sf_dir, "documents"))


QUERIES = {"op9_language": op9_language}
ORACLE: dict[str, str] = {}
