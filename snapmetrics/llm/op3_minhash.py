"""Near-duplicate documents: universal-hash minima, banding, signature check, full-set check, star components.

1. One pass over the whole texts hashes each document's word shingles and keeps the set's size, a 128-bit digest of the
   sorted set and ``BANDS * ROWS`` minima of universal hashes ``(a * x + b) mod 2^32``.
2. Documents of equal sets form a class (grouped by digest with map-side minima), so exact copies never meet again.
   Classes are numbered, and these numbers are linked: ids need be neither unique nor there.
3. Representatives that agree on the ``ROWS`` minima of a band share a bucket; at similarity 0.8 two documents share
   none with probability 4e-7. Each member is paired with the bucket centre (smallest id) it meets most often, one
   pair a member, and pairs whose signatures agree well enough are confirmed on the full sets.
   Large-star and small-star steps make components: a group of near copies is one by now.
4. No link is lost between members that still are in different components of one bucket. Pairing them all would grow
   with the square of a group, so their full sets are compared by counting: shingles that more than ``COMMON`` of these
   documents hold are only numbers (``common`` of a document's shingles are such), all others meet by an equi-join whose
   keys hold ``COMMON`` rows at most. Two documents with r rare shingles in common share at most min(common) + r;
   only pairs that can reach the similarity are confirmed on their texts. With r = 0 that takes two sets of nearly nothing
   but common shingles: they meet by bucket and size class.
5. Alternating large-star and small-star give the components of all confirmed links; the smallest id of its documents names
   a component.

Defined results: a text that is null, empty or without words has the empty set: 0 shingles, its own component, kept.
A null id can't name a group: such a row takes its component's id if another document has one, else null; of a component
without any id one text is kept. Rows that repeat an id and text repeat their result; rows that repeat an id with another text
get the result of their own text, and of several texts of a component's smallest id one is kept. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import ODD, drop_stored, hash_text, map_rows, mix, shingle_hashes, stored, table
from snapmetrics.llm.components import components

BANDS, ROWS = 28, 4
N_HASHES = BANDS * ROWS
SEED = 20250711
#: Signature agreement below this is not tried in step 3 (step 4 would still find such a link).
LEAST_AGREEMENT = 0.66
#: Documents that hold a shingle before it only counts as a number in step 4, and the width of a size class.
COMMON, SIZE_STEP = 40, 1.1

_rng = np.random.default_rng(SEED)
_A = (_rng.integers(0, 1 << 32, N_HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_B = _rng.integers(0, 1 << 32, N_HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
#: Shingles hashed at a time: the table of N_HASHES rows stays in the processor's cache.
_STEP = 512

LONGS = T.ArrayType(T.LongType(), False)
SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("keys", LONGS),
        T.StructField("short", T.BinaryType()),
    ]
)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    lower = text.encode("utf-8", "surrogatepass").lower() if text else b""  # bytes.lower touches A-Z only
    return np.unique(shingle_hashes(hash_text(lower), words))


def signature(x: np.ndarray) -> np.ndarray:
    """Minima of the universal hashes over a non-empty set."""
    low = (x >> np.uint64(32)).astype(np.uint32)[None, :]
    sig = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, low.shape[1], _STEP):
        np.minimum(sig, (_A * low[:, i : i + _STEP] + _B).min(axis=1), out=sig)
    return sig


_BAND = (np.arange(1, BANDS + 1, dtype=np.uint64) * ODD)[:, None]


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for the minima of each band, the band's number mixed in."""
    acc = _BAND[:, 0].copy()
    for row in sig.reshape(BANDS, ROWS).T.astype(np.uint64):
        acc = mix(acc * ODD + row)
    return acc.view(np.int64)


def sign(text: str | None, words: int = 4) -> tuple:
    """Size, digest, band keys and the signature's lowest bytes."""
    x = shingle_set(text, words)
    if len(x) == 0:
        return 0, None, None, None
    sig = signature(x)
    return len(x), xxhash.xxh3_128_digest(x.tobytes()), band_keys(sig), sig.astype(np.uint8).tobytes()


def _agreement(a: str, b: str) -> str:
    """SQL: share of equal minima of two signatures (one byte a minimum)."""
    return f"size(filter(sequence(1, {N_HASHES}), i -> substr({a}, i, 1) = substr({b}, i, 1))) / {float(N_HASHES)}D"


class _Links:
    """Confirms pairs; the left text's set is kept while consecutive pairs share it."""

    def __init__(self) -> None:
        self.key, self.set = None, None

    def __call__(self, key: int, a: str, b: str, words: int, percent: int) -> bool:
        if key != self.key:
            self.key, self.set = key, shingle_set(a, words)
        x, y = self.set, shingle_set(b, words)
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int, signed: bool = False) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough; sizes first, then (``signed``) signatures, then the texts.
    What belongs to ``b`` is shuffled once per pair; what belongs to ``a``, often the centre of a large bucket, is joined
    last and never shuffled with its pairs."""
    of = lambda c: texts.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("text", "n", "short")])
    both = pairs.join(of("b"), "b").join(of("a"), "a").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    if signed:
        both = both.filter(F.expr(_agreement("short_a", "short_b")) >= LEAST_AGREEMENT)

    def check(links: _Links, a: int, text_a: str, text_b: str) -> tuple:
        return (links(a, text_a, text_b, words, percent),)

    out = T.StructType([T.StructField("linked", T.BooleanType())])
    return map_rows(both, check, ["a", "text_a", "text_b"], out, ["a", "b"], setup=_Links).filter("linked").select("a", "b")


def minhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """One row per row of ``df``: id_col, text_key (xxhash64 of the text), n_shingles, class_id (smallest id of the equal
    sets), component_id, kept."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    signed = stored(map_rows(keyed, lambda t: sign(t, words), ["text"], SIGNED, ["id", "text_key"]), "signed")
    classes = signed.filter("n_shingles > 0").groupBy("digest").agg(F.min("id").alias("doc"))
    # numbered in the order of ids, so that a bucket's centre is its smallest id; written once: the numbers stay
    classes = classes.orderBy(F.col("doc").asc_nulls_last(), "digest")
    classes = stored(classes.select("digest", "doc", F.monotonically_increasing_id().alias("node")), "classes")
    reps = signed.select(F.col("id").alias("of"), F.col("digest").alias("of_digest"), "text_key", "n_shingles", "keys", "short")
    reps = reps.join(classes, (F.col("of_digest") == F.col("digest")) & F.col("of").eqNullSafe(F.col("doc"))).groupBy(F.col("node").alias("id"))
    same = [F.first(c).alias(a) for c, a in (("digest", "digest"), ("doc", "doc"), ("n_shingles", "n"), ("keys", "keys"), ("short", "short"))]
    reps = stored(reps.agg(F.min("text_key").alias("text_key"), *same), "reps")

    # from here on an id is a class's number
    members = reps.select("id", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")).filter("centre < last")
    grouped = stored(members.join(buckets.select("key", "centre"), "key"), "members")  # buckets of two or more only
    own = reps.join(grouped.select("id").distinct(), "id", "left_semi").select("id", "doc", "text_key", "n", "short")
    texts = docs.select(F.col("id").alias("of"), "text", F.xxhash64("text").alias("of_key"))
    texts = texts.join(own, F.col("of").eqNullSafe(F.col("doc")) & (F.col("of_key") == F.col("text_key")))
    texts = stored(texts.select("id", "text", "n", "short").dropDuplicates(["id"]), "texts")

    # one centre for each member: the one of most of its buckets
    star = grouped.filter("id <> centre").groupBy(F.col("id").alias("b"), F.col("centre").alias("a")).agg(F.count("*").alias("n"))
    star = star.groupBy("b").agg(F.max(F.struct("n", (-F.col("a")).alias("minus"))).alias("best")).select((-F.col("best.minus")).alias("a"), "b")
    links = stored(confirmed(star, texts, words, percent, signed=True), "links")
    parts = components(links)

    across = stored(_across(grouped, parts, texts, words, percent), "across")
    more = stored(confirmed(across, texts, words, percent), "links")
    if not more.isEmpty():
        parts = components(links.unionByName(more))
    for scratch in (classes, grouped, texts, across):
        drop_stored(scratch)

    # the smallest id of a component names it; of several texts of that id, or of a component without ids, one is kept
    named = reps.select("id", "digest", "doc", "text_key").join(parts.withColumnRenamed("node", "id"), "id", "left")
    first = F.min(F.struct(F.col("doc").isNull().alias("nameless"), "doc", "digest", "text_key")).alias("first")
    firsts = named.filter("component is not null").groupBy(F.col("component").alias("part")).agg(first)
    found = named.join(firsts, F.col("component") == F.col("part"), "left")
    chosen = F.when(F.col("part").isNull() | (F.col("first.digest") == F.col("digest")), F.col("text_key")).alias("chosen")
    found = found.select("digest", F.col("doc").alias("class_id"), F.coalesce("first.doc", "doc").alias("component_id"), chosen)
    out = signed.select("id", "text_key", "n_shingles", "digest").join(found, "digest", "left")
    alone = F.col("digest").isNull()
    kept = alone | (F.col("id").eqNullSafe(F.col("component_id")) & F.col("text_key").eqNullSafe(F.col("chosen")))
    return out.select(
        F.col("id").alias(id_col), "text_key", "n_shingles", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("component_id", "id").alias("component_id"), kept.alias("kept")
    )


def _across(grouped: DataFrame, parts: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components, members of buckets that hold several, whose counted shingles leave room for
    the similarity. Shared / (n_a + n_b - shared) >= percent / 100, so (100 + percent) * shared >= percent * (n_a + n_b)."""
    placed = grouped.select("key", "id").join(parts.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("key", "id", F.coalesce("component", "id").alias("part"))
    counts = placed.groupBy("key", "part").agg(F.count("*").alias("members"))
    mixed = counts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("members", "part")).alias("top")).filter("parts > 1")
    rest = stored(placed.join(mixed.select("key", F.col("top.part").alias("largest")), "key"), "rest")
    open_ids = rest.select("id", "part").distinct()

    sets = T.StructType([T.StructField("shingles", LONGS)])
    own = map_rows(texts.join(open_ids, "id"), lambda t: (shingle_set(t, words).view(np.int64),), ["text"], sets, ["id", "part", "n"])
    own = stored(own.select("id", "part", "n", F.explode("shingles").alias("shingle")), "shingles")
    held = own.groupBy("shingle").agg(F.count("*").alias("holders")).filter("holders > 1")
    held = stored(own.join(held, "shingle"), "held")
    common = F.sum((F.col("holders") > COMMON).cast("int")).alias("common")
    size = stored(held.groupBy("id", "part", "n").agg(common), "sizes")

    rare = held.filter(F.col("holders") <= COMMON)
    x, y = (rare.select("shingle", F.col("id").alias(i), F.col("part").alias(p)) for i, p in (("a", "part_a"), ("b", "part_b")))
    shared = x.join(y, "shingle").filter("a < b and part_a <> part_b").groupBy("a", "b").agg(F.count("*").alias("rare"))
    both = shared.join(size.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("common").alias("common_a")), "a")
    both = both.join(size.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("common").alias("common_b")), "b")
    room = (100 + percent) * (F.least("common_a", "common_b") + F.col("rare")) >= percent * (F.col("n_a") + F.col("n_b"))
    by_rare = both.filter(room).select("a", "b")

    # no rare shingle shared: both sets are nearly all common, and the sizes that suit the first are few classes
    full = rest.join(size.filter(100 * F.col("common") >= percent * F.col("n")).drop("part"), "id")
    full = full.withColumn("outside", F.col("part") != F.col("largest"))
    keys = rest.groupBy("id").agg(F.collect_set("key").alias("keys"))  # one a band at most
    full = full.join(keys, "id")
    step = lambda c: F.floor(F.log(c) / F.log(F.lit(SIZE_STEP))).cast("int")
    low, high = F.col("n") * (percent / 100), F.least(F.col("n") * (100 / percent), F.col("common") * ((100 + percent) / percent) - F.col("n"))
    of = lambda i: [F.col(c).alias(f"{c}_{i}") for c in ("id", "part", "n", "common", "keys", "outside")]
    x = full.filter(F.col("outside") & (high >= low)).select("key", F.explode(F.sequence(step(low), step(high + 1))).alias("class"), *of("a"))
    y = full.select("key", step(F.col("n")).alias("class"), *of("b"))
    fits = (100 + percent) * F.least("common_a", "common_b") >= percent * (F.col("n_a") + F.col("n_b"))
    # a pair counts in the first bucket it shares, and from one of its ends
    once = (~F.col("outside_b") | (F.col("id_a") < F.col("id_b"))) & (F.col("key") == F.array_min(F.array_intersect("keys_a", "keys_b")))
    by_size = x.join(y, ["key", "class"]).filter((F.col("part_a") != F.col("part_b")) & fits & once)
    by_size = by_size.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    return by_rare.unionByName(by_size.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: 4-word shingles, similarity of 0.8 or more."""
    found = minhash_components(table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


#: All pairs that share a shingle, and everything reachable over links: for tables small enough for that.
_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM words WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
either_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM reached r JOIN either_way e ON e.a = r.seen)
SELECT d.doc_id, CAST(coalesce(any_value(z.n), 0) AS BIGINT) AS n_shingles, min(r.seen) AS component_id, d.doc_id = min(r.seen) AS kept
FROM documents d JOIN reached r ON r.node = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id GROUP BY d.doc_id
"""

QUERIES = {"op3_minhash": op3_minhash}
ORACLE = {"op3_minhash": _SQL}
