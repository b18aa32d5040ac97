"""From raw documents to a mixed training corpus: toxic documents go, one document of each group of near copies stays,
documents that hold benchmark passages go, personal data is redacted, and the sources are interleaved by weight.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's documents. ``run``
applies them in order and writes each stage's result to the shared folder before the next one reads it. Every stage works
on all that its predecessor kept, extra columns of ``documents`` pass through whatever their names, and a row without an
id is told apart by its text. Null and empty texts pass all stages; rows that repeat an id and a text become one row in
the second stage; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.common import ID_KEY, ROW, TEXT_KEY, id_key, packed, prepare, row_keys, stored, table, unpacked
from snapmetrics.llm.op2_decontaminate import benchmark_overlaps
from snapmetrics.llm.op3_minhash import minhash_components
from snapmetrics.llm.op4_toxicity import toxicity
from snapmetrics.llm.op7_pii import redacted
from snapmetrics.llm.op8_mixing import pfair_mix


#: What the last stage adds to a document (in place of columns of these names, if there are any).
PLACE = ("block", "release", "deadline", "slot", "place", "in_mix")


def _key_columns() -> list[Column]:
    """Row keys from an operator's id and text_key."""
    return [id_key(), F.col("text_key").alias(TEXT_KEY)]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    prepare(spark)
    scored = toxicity(packed(docs), table(spark, sf_dir, "labels"), keep=["text", ROW])
    return unpacked(scored.filter("predicted = 0"), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each component (five-word shingles, similarity of 0.8 or more)."""
    prepare(spark)
    kept = minhash_components(docs, words=5, percent=80).filter("kept").select(*_key_columns()).distinct()
    rows = docs.select("*", *row_keys()).join(kept, [ID_KEY, TEXT_KEY])
    return rows.dropDuplicates([ID_KEY, TEXT_KEY]).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    prepare(spark)
    leaks = benchmark_overlaps(docs, table(spark, sf_dir, "benchmark")).select(*_key_columns()).distinct()
    rows = docs.select("*", *row_keys()).join(leaks, [ID_KEY, TEXT_KEY], "left_anti")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the new text."""
    prepare(spark)
    done = redacted(packed(docs), keep=[ROW])
    size = F.when(F.col("n_spans") > 0, F.length("text").cast("long")).otherwise(F.col(ROW).getField("n_chars"))
    return done.select(*[F.col("text") if c == "text" else size.alias(c) if c == "n_chars" else F.col(ROW).getField(c).alias(c) for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix: slot and place give the order, in_mix the part at target weights."""
    prepare(spark)
    plan = pfair_mix(docs)
    plan = plan.select(*_key_columns(), F.struct(*PLACE).alias("__plan")).dropDuplicates([ID_KEY, TEXT_KEY])
    rows = docs.select("*", *row_keys()).join(plan, [ID_KEY, TEXT_KEY])
    own = [F.col(f"`{c}`") for c in docs.columns if c not in PLACE]
    return rows.select(*own, *[F.col("__plan").getField(c).alias(c) for c in PLACE])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
]

#: Learned scores, minima of hashes and span classifiers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
