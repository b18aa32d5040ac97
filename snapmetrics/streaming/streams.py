"""Structured Streaming twins of the batch operators (PIPE-36..39, STM-1..4) over landing files.

Each job reads a folder with ``readStream``, runs under ``trigger(availableNow=True)`` with a checkpoint in the shared
folder (a lost executor or a restarted driver resumes from the last committed batch) and costs what its batch holds, not
what is stored: what has to be remembered is in Spark's state store, bounded by the watermark, or in partitions that a
batch prunes by its keys. Batches write their own ``batch_id=`` or ``version=`` partition with overwrite. Jobs that read each
other's output run one after the other, so a replayed batch is replaced before anything reads it.

No row is dropped: what is later than a watermark, or has no readable time, goes to a second table (``route``, or the
``late`` rows of ``stream_deltas``) and is merged by key from there (``merge_aside``, ``apply_late``, ``corrections``).
"""

from __future__ import annotations

import pickle
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from snapmetrics.operators.joins import insert_if_absent
from snapmetrics.session import scratch_path

WATERMARK = "1 day"
BATCH, VERSION, BUCKET = "batch_id", "version", "bucket"
#: Versions between two batches, for the corrections of late rows.
VERSIONS = 1_000


def _run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")


def land(df: DataFrame, path: str, order: list[str]) -> None:
    """Append landing files in one distributed write, each holding a range of ``order`` (null days included)."""
    df.repartitionByRange(*[F.col(c) for c in order]).write.mode("append").parquet(path)


def stamp(c: str) -> Column:
    """Visit time as TIMESTAMP; null when it can't be read."""
    return F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss"))


def _landing(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _run(stream: DataFrame, checkpoint: str, batch, mode: str = "append") -> None:
    q = stream.writeStream.foreachBatch(batch).outputMode(mode).option("checkpointLocation", checkpoint)
    q.trigger(availableNow=True).start().awaitTermination()


def _create(spark: SparkSession, *paths: str) -> None:
    """The folders of empty tables, so that the first batch reads them (with their schema) like any other."""
    for path in paths:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jpath)


def _write(df: DataFrame, path: str, by: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _with(schema: T.StructType, **fields: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields.items())])


# ---------------------------------------------------------------- on time or aside


def route(stream: DataFrame, time_col: str, delay: str, out: str, checkpoint: str) -> None:
    """Write a stream's rows to ``out/way=on_time|aside/batch_id=``: aside is what has no time or is more than ``delay`` behind the
    newest time of this and all earlier batches. A watermark of ``delay`` over the rows on time therefore drops none.
    The newest time is one value a batch, kept beside the rows."""
    spark = stream.sparkSession
    mark = lambda batch_id: f"{out}-newest/{BATCH}={batch_id}"
    _create(spark, f"{out}/way=on_time", f"{out}/way=aside")

    def batch(df: DataFrame, batch_id: int) -> None:
        newest = df.agg(F.max(time_col).alias("t"))
        if batch_id:
            newest = newest.unionByName(spark.read.schema("t timestamp").parquet(mark(batch_id - 1))).agg(F.max("t").alias("t"))
        newest.coalesce(1).write.mode("overwrite").parquet(mark(batch_id))
        at = spark.read.schema("t timestamp").parquet(mark(batch_id)).select(F.col("t").alias("_newest"))
        on_time = F.coalesce(F.col(time_col) >= F.col("_newest") - F.expr(f"INTERVAL {delay}"), F.lit(False))
        way = F.when(on_time, "on_time").otherwise("aside")
        # one row: no cross join in size
        routed = df.join(F.broadcast(at), F.lit(True), "left").withColumn("way", way).drop("_newest")
        _write(routed.withColumn(BATCH, F.lit(batch_id).cast("long")), out, ["way", BATCH])

    _run(stream, checkpoint, batch)


def _routed(spark: SparkSession, out: str, way: str, schema: T.StructType) -> DataFrame:
    return _landing(spark, f"{out}/way={way}", _with(schema, **{BATCH: T.LongType()}))


# ---------------------------------------------------------------- STM-1

KEY = ["link", "visited_timestamp"]


def stream_snapshots(spark: SparkSession, landing: str, schema: T.StructType, tables: str, checkpoint: str,
                     delay: str = WATERMARK, files_per_trigger: int | None = None) -> None:
    """STM-1: landing files -> ``tables/sink``, once each (link, visit time). Rows are routed first; copies among the rows on
    time are found in the state store within the watermark. Rows aside wait in ``tables/routed/way=aside`` for
    ``merge_aside``; sink and merged rows together are the landed rows less copies, in whatever order they arrive."""
    landed = _landing(spark, landing, schema, files_per_trigger).withColumn("_visit", stamp("visited_timestamp"))
    route(landed, "_visit", delay, f"{tables}/routed", f"{checkpoint}/route")
    kept = _routed(spark, f"{tables}/routed", "on_time", landed.schema).withWatermark("_visit", delay).dropDuplicatesWithinWatermark(KEY)
    day = F.date_format("_visit", "yyyy-MM-dd")
    q = kept.withColumn("visit_day", day).drop("_visit", BATCH).writeStream.format("parquet").partitionBy("visit_day")
    q = q.option("path", f"{tables}/sink").option("checkpointLocation", f"{checkpoint}/sink")
    q.trigger(availableNow=True).start().awaitTermination()


def merge_aside(spark: SparkSession, tables: str, schema: T.StructType) -> None:
    """Rows aside that neither the sink nor an earlier merge holds -> ``tables/merged/version=``, once each key. Of the sink only
    the days of these rows are read."""
    merged = f"{tables}/merged"
    _create(spark, merged)
    aside = spark.read.schema(_with(schema, _visit=T.TimestampType())).parquet(f"{tables}/routed/way=aside")
    before = spark.read.schema(_with(schema, **{VERSION: T.LongType()})).parquet(merged)
    version = (before.agg(F.max(VERSION)).first()[0] or 0) + 1
    aside = aside.withColumn("visit_day", F.date_format("_visit", "yyyy-MM-dd")).drop("_visit")
    days = [r[0] for r in aside.select("visit_day").distinct().collect() if r[0] is not None]  # calendar days
    sink = spark.read.schema(_with(schema, visit_day=T.StringType())).parquet(f"{tables}/sink").filter(F.col("visit_day").isin(days))
    there = sink.select(*KEY).unionByName(before.select(*KEY)).select(*[F.col(k).alias(f"_{k}") for k in KEY])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    new = aside.drop("visit_day").dropDuplicates(KEY).join(there, same[0] & same[1], "left_anti")
    _write(new.withColumn(VERSION, F.lit(version).cast("long")), merged, [VERSION])


def landed_snapshots(spark: SparkSession, tables: str, schema: T.StructType) -> DataFrame:
    """The sink and what was merged after it."""
    _create(spark, f"{tables}/merged")
    sink, merged = (spark.read.schema(_with(schema, **extra)).parquet(f"{tables}/{name}") for name, extra in
                    (("sink", {"visit_day": T.StringType()}), ("merged", {VERSION: T.LongType()})))
    return sink.select(*schema.fieldNames()).unionByName(merged.select(*schema.fieldNames()))


# ---------------------------------------------------------------- STM-2

BUCKETS = 64


def bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def in_buckets_of(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of a table laid out by ``bucket`` that lie in buckets of ``rows``: at most ``BUCKETS`` numbers come to the
    driver and become a partition filter of the scan."""
    found = [r[0] for r in rows.select(BUCKET).distinct().collect()]
    return table.filter(F.col(BUCKET).isin(found))


def stream_upsert(spark: SparkSession, landing: str, schema: T.StructType, table_path: str, checkpoint: str,
                  keys: list[str], order: list[str], files_per_trigger: int | None = None) -> None:
    """STM-2: first-seen upsert per micro-batch into ``bucket=/batch_id=`` partitions; a batch reads the keys of its own buckets only.
    A replayed batch ignores and replaces its own rows."""
    stored = _with(schema, **{BUCKET: T.IntegerType(), BATCH: T.LongType()})
    _create(spark, table_path)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        new = batch.withColumn(BUCKET, bucket(keys))
        table = spark.read.schema(stored).parquet(table_path).filter(F.col(BATCH) < batch_id)
        rows = insert_if_absent(new, in_buckets_of(table, new).select(*keys), keys, order)
        _write(rows.withColumn(BATCH, F.lit(batch_id).cast("long")), table_path, [BUCKET, BATCH])

    _run(_landing(spark, landing, schema, files_per_trigger), checkpoint, upsert)


# ---------------------------------------------------------------- STM-3

#: Links are dealt by hash to so many lanes, and a lane is one entry of the state store: what a call of the Python operator costs
#: besides its rows (2 to 3 ms, the work of 300 rows) is paid for a lane, not for a link. Fixed for a checkpoint.
LANES = 1 << 12
#: A lane's state: the rows of its links, those of a link together and in order (its rows from the watermark on and one
#: before), times and ids beside them; the links whose older rows were let go; the links in that order and how many rows each has.
#: The rows are one compressed value (``_pack``): row by row they would fill the executors' memory.
STATE = "ts array<long>, ids array<long>, rows binary, pruned array<string>, links array<string>, sizes array<long>"
#: What the state tells about a row: the row before it, and for a row that was told before, the one before it then.
FOLLOWED = "kind string, row string, prev string, first boolean, told boolean, old_prev string, old_first boolean"
#: Divides a row's text: first what the row after it needs, then the columns. ``ESC`` marks a null and stands, with a digit, for
#: either character inside a column's text.
SEP, ESC = "\x1f", "\x1e"


def _row_text(schema: T.StructType, visit: Column) -> Column:
    """A row as one text: visit time in microseconds, comments and views (empty if null), then its columns."""
    parts = [F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in (F.unix_micros(visit), F.col("comments"), F.col("views"))])]
    for field in schema:
        text = F.col(field.name).cast("string")
        if isinstance(field.dataType, T.StringType):
            text = F.replace(F.replace(text, F.lit(ESC), F.lit(f"{ESC}0")), F.lit(SEP), F.lit(f"{ESC}1"))
        parts.append(F.coalesce(text, F.lit(ESC)))
    return F.concat_ws(SEP, *parts)


def _numbers(head: Column, schema: T.StructType) -> Column:
    """The first part of ``_row_text``: visited, comments, views."""
    n = F.split(head, ",")
    visited = F.timestamp_micros(n[0].try_cast("long")).cast("timestamp_ntz")
    return F.struct(visited.alias("visited"), *[n[at].try_cast(schema[c].dataType).alias(c) for at, c in ((1, "comments"), (2, "views"))])


def _columns(parts: Column, schema: T.StructType) -> list[Column]:
    """The columns of ``_row_text``, split at ``SEP``."""
    out = []
    for at, field in enumerate(schema, 1):
        value = F.nullif(parts[at], F.lit(ESC))
        if isinstance(field.dataType, T.StringType):
            value = F.replace(F.replace(value, F.lit(f"{ESC}1"), F.lit(SEP)), F.lit(f"{ESC}0"), F.lit(ESC))
        out.append(value.cast(field.dataType).alias(field.name))
    return out


def _pack(rows: list) -> bytes:
    return zlib.compress(pickle.dumps(rows), 1)


def _unpack(packed: bytes | None) -> list:
    return pickle.loads(zlib.decompress(packed)) if packed else []


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), dtype=object)
    out[:] = values
    return out


def _heads(rows: np.ndarray) -> list:
    return [row.partition(SEP)[0] for row in rows]


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A lane's rows of a batch against its state; links without rows in the batch stay as they are. Frames without links hold
    the rows of one, which the key names. A row that is older than its link's known rows, or has no time, is late; any other
    one is put in its place, and the row after it is told again if it was told before. All links of the lane are placed in
    one sort; of a copy the known row stays, else the first."""
    ts, ids, packed, pruned, links, sizes = state.get if state.exists else ([], [], None, [], [], [])
    code_of = {link: n for n, link in enumerate(links)}
    known, pruned = len(ts), set(pruned)
    texts, codes, t, i, readable = _unpack(packed), [np.repeat(np.arange(len(links)), sizes)], [np.array(ts, "int64")], [np.array(ids, "int64")], [np.ones(known, bool)]
    for frame in frames:
        of = frame["link"].tolist() if "link" in frame else [key[0]] * len(frame)
        codes.append(np.array([code_of.setdefault(link, len(code_of)) for link in of], "int64"))
        for columns, c in ((t, "t"), (i, "i"), (readable, "readable")):
            columns.append(frame[c].to_numpy())
        texts += frame["row"].tolist()
    texts, code, t, i, readable = _objects(texts), *(np.concatenate(c) for c in (codes, t, i, readable))
    names, touched = list(code_of), np.zeros(len(code_of), bool)
    touched[code[known:]] = True

    late = ~readable
    if pruned:  # known rows lie link by link in order, so the first of a link is its oldest
        oldest = np.searchsorted(code[:known], code[known:])
        oldest[~np.array([name in pruned for name in names], bool)[code[known:]]] = -1
        at = np.flatnonzero(oldest >= 0)
        before, new = oldest[at], at + known
        late[new] |= (t[new] < t[before]) | (t[new] == t[before]) & (i[new] < i[before])
    aside, placed = np.flatnonzero(late), np.flatnonzero(~late)

    # stable: of equal keys known rows come first, then those of the batch as they came
    placed = placed[np.lexsort((i[placed], t[placed], code[placed]))]
    copy = np.zeros(len(placed), bool)
    copy[1:] = (np.diff(code[placed]) == 0) & (np.diff(t[placed]) == 0) & (np.diff(i[placed]) == 0)
    placed = placed[~copy]
    code, t, i = code[placed], t[placed], i[placed]
    at, is_new, begins = np.arange(len(placed)), placed >= known, np.ones(len(placed), bool)
    begins[1:] = code[1:] != code[:-1]

    begin, last_known = (np.maximum.accumulate(np.where(x, at, 0 if x is begins else -1)) for x in (begins, ~is_new))
    told = ~is_new & ~begins
    told[1:] &= is_new[:-1]
    out = np.flatnonzero(is_new | told)
    prev, old = out - 1, last_known[out - 1]
    first, told = begins[out], told[out]
    old_first = told & (old < begin[out])
    heads, old_prev = np.full((2, len(out)), None, dtype=object)
    heads[~first] = _heads(texts[placed[prev[~first]]])
    old_prev[told & ~old_first] = _heads(texts[placed[old[told & ~old_first]]])

    # a row goes when the row after it is behind the watermark too
    gone = np.zeros(len(placed), bool)
    gone[:-1] = ~begins[1:] & (t[1:] < state.getCurrentWatermarkMs() * 1000) & touched[code[:-1]]
    pruned.update(names[n] for n in np.unique(code[gone]))
    kept = ~gone
    sizes = np.bincount(code[kept], minlength=len(names)).tolist()
    of = [(link, size) for link, size in zip(names, sizes, strict=True) if size]
    state.update((t[kept].tolist(), i[kept].tolist(), _pack(texts[placed[kept]].tolist()), list(pruned), [x[0] for x in of], [x[1] for x in of]))

    n, none = len(aside), np.full(len(aside), None, dtype=object)
    no = np.zeros(n, bool)
    both = {"kind": (["late"] * n, ["delta"] * len(out)), "row": (texts[aside], texts[placed[out]]), "prev": (none, heads), "first": (no, first),
            "told": (no, told), "old_prev": (none, old_prev), "old_first": (no, old_first)}
    yield pd.DataFrame({c: np.concatenate(parts) if n else parts[1] for c, parts in both.items()})


def stream_deltas(spark: SparkSession, landing: str, schema: T.StructType, tables: str, checkpoint: str,
                  year: int | None = None, delay: str = WATERMARK, files_per_trigger: int | None = None, lanes: int = LANES) -> None:
    """STM-3: per-link counter deltas in a keyed state operator -> ``tables/rows/kind=/version=``.

    The state of a link holds its rows of the last ``delay`` and one before them, so a row that comes late within that time is
    put in its place exactly, and the row after it is written again with its new delta (a later version replaces an
    earlier one, see ``current_deltas``; the old delta is written beside it). A copy changes nothing. Rows older than the
    state, and rows without a time or id, are written as ``kind=late`` and wait for ``apply_late``. A batch reads no
    table, and of the state the lanes of its links; a lane's rows of one batch are one group (``files_per_trigger`` bounds
    the batch, ``lanes`` the links of a lane).
    """
    from snapmetrics.functions.dates import in_year, parse_ts
    from snapmetrics.plans.snapshots import generated

    _create(spark, f"{tables}/rows")
    landed = _landing(spark, landing, schema, files_per_trigger)
    if year is not None:
        landed = landed.filter(in_year("created_timestamp", year))
    visit, lane = stamp("visited_timestamp"), F.pmod(F.xxhash64("link"), F.lit(lanes))
    timed = landed.select(
        lane.alias("lane"), "link", visit.alias("_visit"), (visit.isNotNull() & F.col("snapshot_id").isNotNull()).alias("readable"),
        F.coalesce(F.unix_micros(visit), F.lit(0)).alias("t"), F.coalesce("snapshot_id", F.lit(0).cast("long")).alias("i"),
        _row_text(schema, visit).alias("row"),
    )
    followed = timed.withWatermark("_visit", delay).groupBy("lane").applyInPandasWithState(_follow, FOLLOWED, STATE, "append", GroupStateTimeout.NoTimeout)

    def batch(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("row", F.split("row", SEP, -1)).withColumns({c: _numbers(F.col(c), schema) for c in ("prev", "old_prev")})
        visited = F.timestamp_micros(F.split(F.col("row")[0], ",")[0].try_cast("long")).cast("timestamp_ntz")
        rows = rows.select("kind", "first", "told", "old_first", "prev", "old_prev", visited.alias("visited_ts"), *_columns(F.col("row"), schema))
        rows = rows.withColumns({"created_ts": parse_ts("created_timestamp"), "prev_visited": F.col("prev.visited")})
        old = generated(F.col("old_first"), F.col("old_prev.comments"), F.col("old_prev.views"))
        rows = rows.withColumns({f"old_{c}": F.when(F.col("told"), old[c]) for c in ("comments_generated", "views_generated")})
        rows = rows.withColumns(generated(F.col("first"), F.col("prev.comments"), F.col("prev.views")))
        _write_rows(rows, schema, tables, batch_id * VERSIONS)

    _run(followed, checkpoint, batch)


def delta_rows_schema(schema: T.StructType) -> T.StructType:
    long = T.LongType()
    return _with(schema, prev_visited=T.TimestampNTZType(), time_passed=long, comments_generated=long, views_generated=long, told=T.BooleanType(),
                 old_comments_generated=long, old_views_generated=long, kind=T.StringType(), version=long)


def _write_rows(rows: DataFrame, schema: T.StructType, tables: str, version: int) -> None:
    columns = [c for c in delta_rows_schema(schema).fieldNames() if c != VERSION]
    _write(rows.select(*columns).withColumn(VERSION, F.lit(version).cast("long")), f"{tables}/rows", ["kind", VERSION])


def _rows(spark: SparkSession, tables: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(delta_rows_schema(schema)).parquet(f"{tables}/rows")


def _newest(rows: DataFrame) -> DataFrame:
    """The newest version of every snapshot's row. Most snapshots have one: dealt by id first, rows are sorted once, not before
    and after the shuffle."""
    columns = [c for c in rows.columns if c != "snapshot_id"]
    last = rows.filter("kind = 'delta'").repartition("snapshot_id").groupBy("snapshot_id").agg(F.max_by(F.struct(*columns), VERSION).alias("r"))
    return last.select("snapshot_id", "r.*")


def apply_late(spark: SparkSession, tables: str, schema: T.StructType) -> None:
    """Late rows of ``stream_deltas``: their links (and those of rows without a time, which come last) are computed again from their
    stored rows; new and changed deltas become a version of their own, with the old deltas beside them. Applying twice
    changes nothing. The links' rows are all that is computed; a run that finds no such link writes nothing. A row without an
    id can't be told from its copies: it stays among the late rows."""
    from snapmetrics.plans.snapshots import source, with_deltas

    stored = _rows(spark, tables, schema)
    columns = schema.fieldNames()
    late = stored.filter("kind = 'late'").select(*columns)
    if late.isEmpty():
        return
    now = _newest(stored)
    waiting = late.join(now.select("snapshot_id"), "snapshot_id", "left_anti").dropDuplicates(["snapshot_id"]).filter("snapshot_id IS NOT NULL")
    links = waiting.select("link").unionByName(late.filter(stamp("visited_timestamp").isNull()).select("link")).distinct().withColumnRenamed("link", "_link")
    again = now.join(links, F.col("link").eqNullSafe(F.col("_link")), "left_semi")
    done = with_deltas(source(again.select(*columns).unionByName(waiting.select(*columns)), year=None))
    names = ["prev_visited", "time_passed", "comments_generated", "views_generated"]
    before = again.select(F.col("snapshot_id").alias("_id"), F.struct(*names).alias("_before"))
    done = done.join(before, F.col("snapshot_id") == F.col("_id"), "left").filter(F.col("_id").isNull() | ~F.struct(*names).eqNullSafe(F.col("_before")))
    told = F.col("_id").isNotNull()
    done = done.withColumns({"kind": F.lit("delta"), "told": told, **{f"old_{c}": F.when(told, F.col("_before")[c]) for c in names[2:]}})
    version = (stored.filter("kind = 'delta'").agg(F.max(VERSION)).first()[0] or 0) + 1
    _write_rows(done, schema, tables, version)


def current_deltas(spark: SparkSession, tables: str, schema: T.StructType) -> DataFrame:
    """PIPE-1 from the newest version of every snapshot's row."""
    from snapmetrics.functions.dates import parse_ts

    now = _newest(_rows(spark, tables, schema)).withColumn("visited_timestamp", parse_ts("visited_timestamp"))
    return now.select("site", "link", "title", "snapshot_id", "visited_timestamp", "prev_visited", "time_passed",
                      "comments", "comments_generated", "views", "views_generated")


# ---------------------------------------------------------------- STM-4

SUMS = ["d_comments", "n_comments", "d_views", "n_views"]


def _changes(rows: DataFrame) -> DataFrame:
    """What a row of ``stream_deltas`` adds to its day: new less old delta, and the number of known deltas likewise."""
    change = {}
    for c in ("comments", "views"):
        new, old = F.col(f"{c}_generated"), F.col(f"old_{c}_generated")
        change[f"d_{c}"] = F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))
        change[f"n_{c}"] = new.isNotNull().cast("long") - (F.col("told") & old.isNotNull()).cast("long")
    return rows.filter("kind = 'delta'").withColumns({"_visit": stamp("visited_timestamp"), **change}).select("site", "_visit", *SUMS)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUMS]


def stream_daily_totals(spark: SparkSession, tables: str, schema: T.StructType, totals: str, checkpoint: str,
                        delay: str = WATERMARK, files_per_trigger: int | None = None) -> None:
    """STM-4: daily sums per site from the deltas' changes, under a watermark.

    Changes are routed; those on time are summed in day windows (state store, update mode: every batch writes the days it
    changed to ``totals/days/batch_id=``, and a day is closed and its state let go once the watermark passes its end).
    Changes of closed days are summed per batch as ``totals/corrections/batch_id=``. No batch reads what is stored."""
    days, fixes = f"{totals}/days", f"{totals}/corrections"
    _create(spark, days, fixes)
    rows = _landing(spark, f"{tables}/rows", delta_rows_schema(schema), files_per_trigger)
    changes = _changes(rows)
    route(changes, "_visit", delay, f"{totals}/routed", f"{checkpoint}/route")

    on_time = _routed(spark, f"{totals}/routed", "on_time", changes.schema).withWatermark("_visit", delay)
    summed = on_time.groupBy("site", F.window("_visit", "1 day").alias("w")).agg(*_sums())
    summed = summed.select("site", F.to_date("w.start").alias("date"), *SUMS)
    own = lambda df, n: df.withColumn(BATCH, F.lit(n).cast("long"))
    _run(summed, f"{checkpoint}/days", lambda df, n: _write(own(df, n), days, [BATCH]), "update")

    def correct(df: DataFrame, n: int) -> None:
        _write(own(df.groupBy("site", F.to_date("_visit").alias("date")).agg(*_sums()), n), fixes, [BATCH])

    _run(_routed(spark, f"{totals}/routed", "aside", changes.schema), f"{checkpoint}/corrections", correct)


def daily_totals(spark: SparkSession, totals: str) -> DataFrame:
    """PIPE-2 from the newest sums of each day and the corrections of closed days."""
    read = lambda name: spark.read.schema(f"site string, date date, {', '.join(f'{c} long' for c in SUMS)}, {BATCH} long").parquet(f"{totals}/{name}")
    days = read("days").groupBy("site", "date").agg(F.max_by(F.struct(*SUMS), BATCH).alias("s")).select("site", "date", "s.*")
    total = days.unionByName(read("corrections").select(*days.columns)).groupBy("site", "date").agg(*_sums())
    return total.select("site", "date", *[F.when(F.col(f"n_{c}") > 0, F.col(f"d_{c}")).alias(f"sum_{c}") for c in ("comments", "views")])


# ---------------------------------------------------------------- registered queries


def _waves(df: DataFrame, order: str, late: Column, copies: Column) -> list[DataFrame]:
    """Two deliveries: the rows up to the middle of ``order`` without the late ones, then the rest, the late rows and
    copies of some rows of the first delivery."""
    day = F.to_date(F.substring(order, 1, 10))
    ends = df.agg(F.min(day).alias("low"), F.max(day).alias("high"))
    middle = ends.select(F.expr("cast(date_add(low, cast(datediff(high, low) / 2 as int)) as string)")).first()[0]
    early = F.coalesce(F.substring(order, 1, 10) <= F.lit(middle), F.lit(False))
    return [df.filter(early & ~late), df.filter(~early | late).unionByName(df.filter(early & ~late & copies))]


def _snapshot_waves(spark: SparkSession, sf_dir: str, run: str) -> list[DataFrame]:
    """The snapshots are derived once and written; both deliveries are read from there."""
    from snapmetrics.sources import fixtures

    fixtures.snapshots(spark, sf_dir).write.parquet(f"{run}/snapshots")
    snaps = spark.read.parquet(f"{run}/snapshots")
    return _waves(snaps, "visited_timestamp", F.col("snapshot_id") % 17 == 0, F.col("snapshot_id") % 10 == 0)


def q_stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run_dir(spark, "snapshots")
    for wave in _snapshot_waves(spark, sf_dir, run):
        land(wave, f"{run}/landing", ["visited_timestamp", "snapshot_id"])
        stream_snapshots(spark, f"{run}/landing", wave.schema, f"{run}/tables", f"{run}/ckpt")
        merge_aside(spark, f"{run}/tables", wave.schema)
    return landed_snapshots(spark, f"{run}/tables", wave.schema)


def _deltas(spark: SparkSession, sf_dir: str, run: str, then=lambda schema: None) -> T.StructType:
    for wave in _snapshot_waves(spark, sf_dir, run):
        land(wave, f"{run}/landing", ["visited_timestamp", "snapshot_id"])
        stream_deltas(spark, f"{run}/landing", wave.schema, f"{run}/tables", f"{run}/ckpt", year=2024)
        then(wave.schema)
    apply_late(spark, f"{run}/tables", wave.schema)
    then(wave.schema)
    return wave.schema


def q_stream_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run_dir(spark, "deltas")
    return current_deltas(spark, f"{run}/tables", _deltas(spark, sf_dir, run))


def q_stream_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run_dir(spark, "daily")
    _deltas(spark, sf_dir, run, lambda schema: stream_daily_totals(spark, f"{run}/tables", schema, f"{run}/totals", f"{run}/ckpt-totals"))
    return daily_totals(spark, f"{run}/totals")


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmetrics.plans.listings import listings_clean
    from snapmetrics.plans.loading import DIMENSION_COLUMNS
    from snapmetrics.sources import fixtures

    run = _run_dir(spark, "upsert")
    clean = listings_clean(fixtures.raw_listings(spark, sf_dir)).select(*DIMENSION_COLUMNS, "measurement_day")
    none = F.lit(False)
    for wave in _waves(clean, "measurement_day", none, F.lit(True)):
        land(wave, f"{run}/landing", ["measurement_day", "id"])
        stream_upsert(spark, f"{run}/landing", clean.schema, f"{run}/table", f"{run}/ckpt", ["link"], ["measurement_day", "id"])
    return spark.read.parquet(f"{run}/table").select(*DIMENSION_COLUMNS)
