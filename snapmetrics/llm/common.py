"""Shared helpers of the training-data operators: reading, Arrow batches over whole texts, hashing, written tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from snapmetrics.session import configure, scratch_path

#: Rows of one Arrow batch: a batch of long texts must fit beside the model in a small Python worker.
BATCH_ROWS = 256


# ---------------------------------------------------------------------------------------------- session and tables
def prepare(spark: SparkSession) -> SparkSession:
    """Library settings plus small Arrow batches (whole texts are long rows)."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_WRITTEN: list[tuple[SparkSession, str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: the lineage ends in a table that every
    executor can read again."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def drop_stored(df: DataFrame) -> None:
    """Delete a table of ``stored`` that no later plan reads."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        known = [x for x in _WRITTEN if path.endswith(x[1].split("://", 1)[-1])]
        for x in known:
            delete(*x)
            _WRITTEN.remove(x)


@atexit.register
def _drop_written() -> None:
    for spark, path in _WRITTEN:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone: the folder then stays, as any scratch folder
            return


def held_out(doc_id: Column) -> Column:
    """Rows kept away from learning: crc32 of the id's text, modulo 3, is 1 (a null id is never learned from either)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


# ------------------------------------------------------------------------------------------------- batches of texts
def map_rows(df: DataFrame, fn: Callable, inputs: list[str], out: T.StructType, keep: list[str] = (), setup: Callable | None = None) -> DataFrame:
    """Apply ``fn(*values of inputs) -> tuple`` to every row inside Arrow batches; ``keep`` columns pass through
    untouched (an input that is kept is sent once). ``setup()``, if given, runs once per task and its result becomes the
    first argument of ``fn``."""
    keep, inputs = list(keep), list(inputs)
    sent = list(dict.fromkeys([*keep, *inputs]))
    at = [sent.index(c) for c in inputs]
    schema = T.StructType([*(df.schema[c] for c in keep), *out.fields])
    types = [to_arrow_type(f.dataType) for f in out.fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = () if setup is None else (setup(),)
        for b in batches:
            cols = [b.column(i).to_pylist() for i in at]
            rows = [fn(*first, *values) for values in zip(*cols, strict=True)]
            made = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *made], names=names)

    return df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(sent)]).mapInArrow(run, schema)


def map_lists(df: DataFrame, fn: Callable, inputs: list[str], out: T.StructType, keep: list[str] = (), setup: Callable | None = None) -> DataFrame:
    """``map_rows`` for functions of whole batches: ``fn(*lists of inputs) -> list of tuples``, one a row and in order."""
    keep, inputs = list(keep), list(inputs)
    sent = list(dict.fromkeys([*keep, *inputs]))
    at = [sent.index(c) for c in inputs]
    schema = T.StructType([*(df.schema[c] for c in keep), *out.fields])
    types = [to_arrow_type(f.dataType) for f in out.fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = () if setup is None else (setup(),)
        for b in batches:
            rows = fn(*first, *[b.column(i).to_pylist() for i in at])
            made = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *made], names=names)

    return df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(sent)]).mapInArrow(run, schema)


# ------------------------------------------------------------------------------------------ whole rows through a stage
ROW, ID_KEY, TEXT_KEY = "__row", "__id", "__text"


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, text_col and all other columns as one struct: whatever their names are, they don't clash with an operator's."""
    rest = [c for c in docs.columns if c != text_col]
    return docs.select(id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in rest]).alias(ROW))


def unpacked(rows: DataFrame, like: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``like`` from packed rows."""
    return rows.select(*[F.col(text_col) if c == text_col else F.col(ROW).getField(c).alias(c) for c in like.columns])


def id_key(id_col: str = "doc_id") -> Column:
    """Join key of an id of any type: its text behind a mark, so that a null id, the empty key, equals no id."""
    return F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias(ID_KEY)


def row_keys(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Join keys of a row: its id and a hash of its text, so that rows without an id can be told apart."""
    return [id_key(id_col), F.xxhash64(text_col).alias(TEXT_KEY)]


# -------------------------------------------------------------------------------------------------------- hashing
def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser over uint64 lanes (each output bit depends on every input bit)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, from the words' hashes; fewer words: the whole sequence as one; none: empty."""
    if len(h) == 0:
        return h
    n_here = min(n, len(h))
    acc = h[: len(h) - n_here + 1].copy()
    for k in range(1, n_here):
        acc = acc * ODD + h[k : len(h) - n_here + 1 + k]
    return mix(acc + np.uint64(n_here))


_BYTES = np.random.default_rng(20250711).integers(0, 1 << 64, 257, dtype=np.uint64)
_BASE = _BYTES[256] | np.uint64(1)
_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes hashed at a time; a longer text is cut at white space.
_PIECE = 1 << 20


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as a piece has needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up), 4096)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)])) for x in (_BASE, inverse))


_POWERS = _Powers()


def _hash_piece(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    _POWERS.reach(len(b) + 1)
    inside = np.zeros(len(b) + 2, bool)
    inside[1:-1] = _INSIDE[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * _POWERS.up[: len(b)], out=total[1:])
    return mix((total[end] - total[start]) * _POWERS.down[start])


def hash_text(data: bytes) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, in order, without a Python object a word: a word's hash is its
    share of one running polynomial over the bytes, moved to the origin."""
    parts, at = [], 0
    while len(data) - at > _PIECE:
        cut = max(data.rfind(c, at, at + _PIECE) for c in (b" ", b"\n"))
        if cut <= at:
            nearest = [i for c in (b" ", b"\n") if (i := data.find(c, at + _PIECE)) >= 0]
            cut = min(nearest, default=len(data))
        parts.append(_hash_piece(data[at:cut]))
        at = cut
    parts.append(_hash_piece(data[at:]))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]
