"""Spelling variants by Bloom-guided neighbourhoods.

Words are counted over the whole corpus (DataFrame functions, combined before the shuffle). Two words are near if one edit
- a deleted, inserted or replaced code point - turns one into the other. Every word generates its deletions and, at each
place, the replacements by larger letters of the corpus; insertions are the deletions of the other word, and smaller
letters the replacements of the other word. The edits are never written out: a word's hash is a polynomial over its code
points, so an edit's hash follows from the hashes of what is before and after it, in numpy, and probes a blocked Bloom
filter of the words of the edit's length (one filter a length up to ``LENGTHS``, longer ones share the next). Only edits
whose filter is positive become text and are shuffled; an exact join with the vocabulary removes the false ones.

The filters are broadcast: ``BITS`` bits a word, together ``FILTER_BYTES`` at most whatever the vocabulary's size (beyond
that more false positives reach the join; the result stays exact). They are combined in Spark (an OR of words of bits),
and only they and the number of words a length come to the driver.

A word's form is its most frequent near word if that is ``TIMES`` times as frequent at least. Counts grow along forms, so
following them ends; roots are found by pointer doubling over written tables, in some rounds for 10^9 occurrences.

Defined results: null and empty texts have no words; a null id counts as an empty one; repeated rows count again; ties of
forms go to the smallest word in code-point order; a very long run of letters is a word like any other (its edits are probed
in pieces); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.common import drop_stored, mix, stored, table

#: Code points of the shortest word, occurrences of the rarest one, how much more frequent a form is.
SHORTEST, RAREST, TIMES = 5, 3, 2
#: Bits of filter a word, bits set by a word, 64-bit lanes of the smallest filter, bytes of all filters.
BITS, HASHES, LEAST_LANES, FILTER_BYTES = 32, 4, 1_024, 32_000_000
#: Lengths with a filter of their own.
LENGTHS = 48
#: Code points probed at a time, and words a task.
PIECE, TASK = 200_000, 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LETTER = np.uint64(0xC2B2AE3D27D4EB4F)


# ---------------------------------------------------------------------------------------------------------- vocabulary
def words(text: Column) -> Column:
    """The runs of letters of a text, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"([a-zÀ-ÿ]+)"), F.lit(1))


def vocabulary(rows: DataFrame, word_col: str = "word") -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    counts = rows.filter(F.length(word_col) >= SHORTEST).groupBy(F.col(word_col).alias("word")).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= RAREST)


# ------------------------------------------------------------------------------------------------------------- hashing
class Powers:
    """Powers of the base and of its inverse, up to the longest word so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 256)
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)])) for x in (_BASE, _INVERSE))


class Spelled:
    """Words end to end: code points, each one's place in its word, and the running polynomial."""

    def __init__(self, texts: list[str], powers: Powers) -> None:
        self.size = np.array([len(t) for t in texts], np.int64)
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.start = np.cumsum(self.size) - self.size
        self.word = np.repeat(np.arange(len(texts)), self.size)
        self.place = np.arange(len(self.codes)) - self.start[self.word]
        powers.reach(int(self.size.max(initial=0)) + 1)
        self.power, self.down = powers.up[self.place], _INVERSE
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letter(self.codes) * self.power)])
        self.hash = total[self.start + self.size] - total[self.start]  # of each word
        self.before = total[:-1] - total[self.start[self.word]]  # of what precedes each code point
        self.after = total[(self.start + self.size)[self.word]] - total[1:]


def letter(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) * _LETTER + np.uint64(1))


def shard(size: np.ndarray) -> np.ndarray:
    return np.minimum(size, LENGTHS + 1)


def lane_and_bits(h: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lane of a filter of 2^k lanes (``lanes``: 2^k - 1) that a hash falls in and its bits there."""
    h = mix(h)
    bits = np.zeros(len(h), np.uint64)
    for i in range(HASHES):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return (h >> np.uint64(32)) & lanes, bits


class Filters:
    """Blocked Bloom filters by shard of length: lanes of 64 bits, all in one array."""

    def __init__(self, counts: dict[int, int]) -> None:
        budget = FILTER_BYTES // 8
        total = max(sum(counts.values()), 1)
        self.mask = np.zeros(LENGTHS + 2, np.uint64)
        self.first = np.zeros(LENGTHS + 2, np.int64)
        size = 0
        for s in range(LENGTHS + 2):
            n = counts.get(s, 0)
            lanes = max(1, min(n * BITS // 64, budget * n // total // 2))
            lanes = max(1 << lanes.bit_length(), LEAST_LANES) if n else 0
            self.first[s] = size
            self.mask[s] = max(lanes - 1, 0)
            size += lanes
        self.has = np.array([counts.get(s, 0) > 0 for s in range(LENGTHS + 2)])
        self.lanes = np.zeros(size, np.uint64)
        self.words = total

    def places(self, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = shard(size)
        lane, bits = lane_and_bits(h, self.mask[s])
        return self.first[s] + lane.astype(np.int64), bits

    def holds(self, h: np.ndarray, size: np.ndarray) -> np.ndarray:
        known = np.flatnonzero(self.has[shard(size)])
        at, bits = self.places(h[known], size[known])
        return known[(self.lanes[at] & bits) == bits]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    """Words of column 0, up to ``PIECE`` code points (or one longer word) at a time."""
    now, size = [], 0
    for b in batches:
        for w in b.column(0).to_pylist():
            if now and size + len(w) > PIECE:
                yield now
                now, size = [], 0
            now.append(w)
            size += len(w)
    if now:
        yield now


def build_filters(vocab: DataFrame) -> Filters:
    """Filters of all words. To the driver come the number of words of each shard and the lanes that are not zero."""
    sizes = vocab.groupBy(F.least(F.length("word"), F.lit(LENGTHS + 1)).alias("s")).agg(F.count("*").alias("n")).collect()
    filters = Filters({r["s"]: r["n"] for r in sizes})
    if not sizes:
        return filters
    empty = Filters({r["s"]: r["n"] for r in sizes})

    def lanes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for texts in _batches(batches):
            spelled = Spelled(texts, powers)
            at, bits = empty.places(spelled.hash, spelled.size)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits.view(np.int64))], names=["lane", "bits"])

    made = vocab.select("word").mapInArrow(lanes, "lane long, bits long").groupBy("lane").agg(F.bit_or("bits").alias("bits")).toArrow()
    filters.lanes[made.column("lane").to_numpy()] = made.column("bits").to_numpy().view(np.uint64)
    return filters


# ---------------------------------------------------------------------------------------------------------------- edits
def positive_edits(texts: list[str], filters: Filters, alphabet: np.ndarray, powers: Powers) -> Iterator[tuple[int, str]]:
    """(index of a word, edit) for the deletions and the replacements by larger letters that a filter holds."""
    s = Spelled(texts, powers)
    size = s.size[s.word]
    # of equal neighbours the last one's deletion stands for all
    other = np.ones(len(s.codes), bool)
    other[:-1] = (s.codes[1:] != s.codes[:-1]) | (s.word[1:] != s.word[:-1])
    at = np.flatnonzero(other & (size > SHORTEST))
    h = s.before[at] + s.after[at] * s.down
    for i in at[filters.holds(h, size[at] - 1)].tolist():
        w, k = texts[s.word[i]], int(s.place[i])
        yield int(s.word[i]), w[:k] + w[k + 1 :]
    for c in alphabet.tolist():
        at = np.flatnonzero(s.codes < c)
        h = s.before[at] + letter(np.array([c], np.uint32)) * s.power[at] + s.after[at]
        for i in at[filters.holds(h, size[at])].tolist():
            w, k = texts[s.word[i]], int(s.place[i])
            yield int(s.word[i]), w[:k] + chr(c) + w[k + 1 :]


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(word, n, near, near_n), in both directions, of all words one edit apart."""
    spark = vocab.sparkSession
    built = build_filters(vocab)
    filters = spark.sparkContext.broadcast(built)
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint32)  # at most the letters of a run

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for texts in _batches(batches):
            of, made, size = [], [], 0
            for i, e in positive_edits(texts, filters.value, alphabet, powers):
                of.append(texts[i])
                made.append(e)
                size += len(e)
                if size > PIECE:
                    yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(made)], names=["word", "near"])
                    of, made, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.string()), pa.array(made, pa.string())], names=["word", "near"])

    found = vocab.select("word").repartition(1 + built.words // TASK, "word").mapInArrow(edits, "word string, near string")
    there = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    one_way = found.join(there, "near").join(vocab, "word").select("word", "n", "near", "near_n")
    back = one_way.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return one_way.unionByName(back)


# ---------------------------------------------------------------------------------------------------------------- roots
def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form: both not null, no cycles) -> (word, root), by pointer doubling."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(further, "root", "left_semi").isEmpty():
            return now
        then = now
        now = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        drop_stored(then)


def spelling_variants(vocab: DataFrame) -> DataFrame:
    """``vocab`` (word, n; a written table, it is read several times) -> word, n, n_near, form, form_n, root."""
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w")))
    near = near_pairs(vocab).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    frequent = -F.col("best.n") >= TIMES * F.col("n")
    judged = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.w")).alias("form"), F.when(frequent, -F.col("best.n")).alias("form_n"),
    )
    judged = stored(judged, "forms")
    found = roots(judged.filter("form IS NOT NULL"))
    return judged.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# ---------------------------------------------------------------------------------------------------------------- query
def with_slips(docs: DataFrame) -> DataFrame:
    """The query's rule: one run of letters in 97 loses a code point."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(words(F.col("text"))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.select(F.when(h % 97 == 0, cut).otherwise(F.col("run")).alias("word"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every frequent word of the corpus."""
    return spelling_variants(stored(vocabulary(with_slips(table(spark, sf_dir, "documents"))), "vocabulary"))


QUERIES = {"op13_spelling": op13_spelling}
ORACLE: dict[str, str] = {}
