"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in an order drawn by hash, fill blocks of ``block_chars`` characters. A source of weight w gives
its j-th block the release time floor(j / w) and the deadline ceil((j + 1) / w) (j from 0, in slots of one block), and
earliest-deadline-first picks the next block among the released ones. Since the weights add up to one, every block
is placed inside its window, so after any number of slots t each source has had between w * t - 1 and w * t + 1 blocks.

Weights are exact (``exact_parts``: integers over a common sum, no rounding), so the bound holds against the weights as given, however
long the mix. The driver runs through the blocks once, in order, and keeps the state (slot, blocks had by source) of every
``RANGE`` blocks only; Spark tasks schedule the ranges again from these states, and documents join their block's slot. The driver's
pass takes time by the number of blocks (not documents), its memory is one number a source and range.

Numbering the documents of a source never puts the source in one task: the hash range is cut into chunks of about
``CHUNK_ROWS`` rows, sizes are summed by (source, chunk), and the sums before a chunk are added to the running sum inside it.

The mix holds up to the slot at which the first source of positive weight runs out (``in_mix``); later blocks follow, each still
inside its window: they compete for the slots of the sources that ran out, and a slot without a released block stays empty. No document is dropped. A source's weight must be set by
``weights`` (relative numbers; a source not listed, or listed with 0, has no window: its documents come after all
others, slot null); without ``weights`` a source's weight is its share of characters to the power ``tempering``.

Defined results: a null source is a source of its own; a null or empty text has size 0 and falls into the block of its place; a
null id takes part like any other and ties of hash and id are rows that differ in nothing that matters here; repeated rows
are placed separately; a text longer than a block begins in the block of its place and fills the next ones, which no other
document begins; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import map_rows, stored, table

#: Blocks that one Spark task row schedules.
RANGE = 20_000
CHUNK_ROWS = 2_000
BLOCK_CHARS = 100_000
TEMPERING = 0.5

PLAN = T.StructType([T.StructField("of", T.ArrayType(T.StringType())), *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("of_block", "release", "deadline", "slot"))])
LAST = (1 << 63) - 1


def exact_parts(weights: dict) -> tuple[dict, int]:
    """Weights as integers over their sum: source s has the weight parts[s] / period, without rounding."""
    live = {s: Fraction(w) for s, w in weights.items() if w and w > 0}
    common = math.lcm(*(w.denominator for w in live.values()))
    parts = {s: int(w * common) for s, w in live.items()}
    shared = math.gcd(*parts.values()) or 1
    parts = {s: p // shared for s, p in parts.items()}
    return parts, sum(parts.values())


def picks(parts: dict, period: int, blocks: dict, slot: int = 0, had: dict | None = None) -> Iterator[tuple]:
    """(source, turn, slot): earliest deadline first over the released blocks, from a slot at which the sources have ``had``
    their blocks up to the last of ``blocks``. Equal deadlines go to the source with more parts, then by name."""
    had = had or {}
    heap = [(had.get(s, 0) * period // p, s is None, str(s), had.get(s, 0), s) for s, p in parts.items() if had.get(s, 0) < blocks[s]]
    ready: list[tuple] = []
    heapq.heapify(heap)
    while heap or ready:
        if not ready and heap[0][0] > slot:
            slot = heap[0][0]  # nothing is released before
        while heap and heap[0][0] <= slot:
            _, unnamed, name, turn, s = heapq.heappop(heap)
            heapq.heappush(ready, (-(-(turn + 1) * period // parts[s]), -parts[s], unnamed, name, turn, s))
        _, _, unnamed, name, turn, s = heapq.heappop(ready)
        yield s, turn, slot
        if turn + 1 < blocks[s]:
            heapq.heappush(heap, ((turn + 1) * period // parts[s], unnamed, name, turn + 1, s))
        slot += 1


def range_starts(parts: dict, period: int, blocks: dict, step: int) -> list[tuple]:
    """(slot, blocks had by source) before every ``step``-th block."""
    had, starts = dict.fromkeys(parts, 0), []
    for i, (s, turn, slot) in enumerate(picks(parts, period, blocks)):
        if i % step == 0:
            starts.append((min(slot, LAST), list(had.values())))
        had[s] = turn + 1
    return starts


def slots(spark: SparkSession, parts: dict, period: int, blocks: dict) -> DataFrame:
    """of (source), of_block, release, deadline, slot of every block, ranges of blocks scheduled by Spark tasks."""
    step = max(RANGE, len(parts))
    starts = spark.createDataFrame(range_starts(parts, period, blocks, step), "first long, had array<long>")

    def run(first: int, had: list) -> tuple:
        got = list(islice(picks(parts, period, blocks, first, dict(zip(parts, had, strict=True))), step))
        release = [min(turn * period // parts[s], LAST) for s, turn, _ in got]
        deadline = [min(-(-(turn + 1) * period // parts[s]), LAST) for s, turn, _ in got]
        return [s for s, _, _ in got], [turn for _, turn, _ in got], release, deadline, [min(slot, LAST) for _, _, slot in got]

    made = map_rows(starts, run, ["first", "had"], PLAN)
    return stored(made.select(F.inline(F.arrays_zip(*PLAN.names))), "slots")


def numbered(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (id, source, size, key) with ``before``: the size of the rows of the source in front, by (key, id)."""
    chunks = max(1, -(-total // CHUNK_ROWS))
    # keys are uniform over 2^40, so a chunk of the range holds about CHUNK_ROWS rows, whatever the source
    rows = rows.withColumn("chunk", F.floor(F.col("key") / F.lit((1 << 40) / chunks)).cast("long"))
    sums = rows.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of"), F.col("chunk").alias("in_chunk"), F.coalesce(F.sum("chunk_size").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "chunk").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("here", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = rows.join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("in_chunk")))
    return joined.withColumn("before", F.col("base") + F.col("here")).drop("of", "in_chunk", "base", "here", "chunk")


def pfair_mix(
    df: DataFrame, weights: dict | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    block_chars: int = BLOCK_CHARS, tempering: float = TEMPERING, seed: int = 17,
) -> DataFrame:
    """id_col, text_key (xxhash64 of the text), source_col, size, block, release, deadline, slot, place (in the slot), in_mix: one row per row of ``df``.
    Sorting by (slot, place), nulls last, gives the mix."""
    size = F.coalesce(F.length(text_col), F.lit(0)).cast("long")
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    rows = stored(rows.withColumn("key", F.pmod(F.xxhash64(F.lit(seed), "id", "source", "text"), F.lit(1 << 40))).drop("text"), "sizes")
    totals = {r["source"]: (r["n"], r["chars"]) for r in rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("chars")).collect()}
    if weights is None:
        weights = {s: max(c or 0, 1) ** tempering for s, (_, c) in totals.items()}
    parts, period = exact_parts({s: w for s, w in weights.items() if s in totals})
    # a last block of empty texts may begin where the source ends
    plan = slots(df.sparkSession, parts, period, {s: (totals[s][1] or 0) // block_chars + 1 for s in parts})

    placed = numbered(rows, sum(n for n, _ in totals.values()))
    placed = placed.withColumn("block", F.floor(F.col("before") / block_chars).cast("long"))
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block")), "left")
    # the mix holds until a source of positive weight has placed its last block
    ends = [-(-max(1, -(-totals[s][1] // block_chars)) * period // p) for s, p in parts.items() if totals[s][1]]
    horizon = min(min(ends, default=0), LAST)
    return placed.select(
        F.col("id").alias(id_col), "text_key", F.col("source").alias(source_col), "size", "block", "release", "deadline",
        "slot", (F.col("before") - F.col("block") * block_chars).alias("place"), F.coalesce(F.col("slot") < horizon, F.lit(False)).alias("in_mix"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in the mix of the sources, weights by the root of their characters."""
    return pfair_mix(table(spark, sf_dir, "documents")).drop("text_key")


QUERIES = {"op8_mixing": op8_mixing}
ORACLE: dict[str, str] = {}
