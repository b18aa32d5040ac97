"""Benchmark decontamination by spaced seeds.

Texts become lower-cased tokens (ASCII punctuation separates). A mask selects some positions of a window of tokens and
ignores the others; equal hashes of the selected tokens are a hit, so a substituted word in an ignored position costs
nothing. All windows of all benchmark items are hashed under every mask; so is every window of every whole training
text, and the hashes that a bitmap of the benchmark's hashes lets through (a filter of at most ``MOST_BITS`` bits, no
matter how large the benchmark is) are joined with the benchmark's, frequent ones in parts. Around each hit's diagonal
the item is laid over the text and the best stretch of agreeing words, substitutions allowed, decides.

A document overlaps an item if a stretch holds ``needed(item)`` equal words - 12, or 60 % of a shorter item - and at least
``IDENTITY`` of the stretch's words agree. Items of under ``LEAST_WORDS`` words are no evidence and never match.

Defined results: null or empty texts and items match nothing; a null id stays null in the result; repeated rows repeat
their result, of equally good stretches the first diagonal's counts, a very long text is searched whole in time in proportion to its
length and hits; repeated items (same id and text) count once; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import ODD, hash_text, map_rows, stored, table

#: Fixed masks: 1 selects a token, 0 ignores it. Seven selected tokens each.
MASKS = ("1111111", "1101101101", "1011010111", "11100010111", "110100110011")
#: Fixed masks of items too short for those to tolerate a substitution anywhere, by the item's words (least, most): with one
#: changed word, a window of one of them is left whole.
SHORT_MASKS = {(5, 5): ("11111",), (6, 7): ("1111", "11011", "110011"), (8, 11): ("11111", "111011", "110111", "1110011")}
LEAST_WORDS, LEAST_MATCH, ITEM_SHARE, IDENTITY = 5, 12, 0.6, 0.7
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
#: Rows of one seed that one join key holds on either side, and seeds whose counts are broadcast for that: a seed beyond
#: them has less than a ``HOT``-th of the matches and is one key.
PART, HOT = 1000, 10_000

_PUNCTUATION = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_HIT = T.ArrayType(T.StructType([T.StructField("seed", T.LongType()), T.StructField("at", T.IntegerType())]))


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the normalised tokens of a whole text."""
    return hash_text(text.lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION)) if text else np.empty(0, np.uint64)


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the selected tokens of every window of a mask: a polynomial of their hashes, which are uniform in all bits."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, xxhash.xxh3_64_intdigest(mask), np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            acc *= ODD
            acc += h[k : k + n]
    return acc


def masks_for(n_words: int) -> list[str]:
    """Masks of an item: the long ones that fit, and the short ones of its length."""
    short = [m for (least, most), masks in SHORT_MASKS.items() if least <= n_words <= most for m in masks]
    return short + ([m for m in MASKS if len(m) <= n_words] if n_words >= LEAST_WORDS else [])


def item_seeds(text: str | None) -> tuple:
    h = tokens(text)
    found = [{"seed": int(s), "at": i} for m in masks_for(len(h)) for i, s in enumerate(seeds(h, m).view(np.int64).tolist())]
    return found, len(h)


def needed(n_item: int) -> int:
    return max(LEAST_WORDS, min(LEAST_MATCH, -(-int(n_item * ITEM_SHARE * 10) // 10)))


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(matches, start, end) of the stretch with the largest matches - 2 * mismatches, the longest of equals."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -2))])
    lowest = np.minimum.accumulate(total)
    gain = total - lowest
    end = int(len(gain) - 1 - np.argmax(gain[::-1]))
    start = int(np.flatnonzero(total[: end + 1] == lowest[end])[0])
    return int(equal[start:end].sum()), start, end


def overlap(doc: np.ndarray, item: np.ndarray, shifts: list[int]) -> tuple | None:
    """Best (matches, words, place in the text) over the diagonals, or None if too little agrees."""
    best = None
    for shift in sorted(set(shifts)):
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        if high <= low:
            continue
        m, start, end = best_stretch(doc[shift + low : shift + high] == item[low:high])
        # ends of the stretch that disagree were never taken in; what is left must agree well and long enough
        if m >= needed(len(item)) and m >= IDENTITY * (end - start) and (best is None or m > best[0]):
            best = (m, end - start, shift + low + start)
    return best


class Filter:
    """Two probes a seed into the bitmap of the benchmark's seeds."""

    def __init__(self, bits: np.ndarray, masks: list[str]) -> None:
        self.bits, self.masks, self.low = bits, masks, np.uint64(len(bits) * 8 - 1)

    def has(self, at: np.ndarray) -> np.ndarray:
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def __call__(self, text: str | None) -> tuple:
        h, found = tokens(text), []
        for mask in self.masks:
            s = seeds(h, mask)
            at = np.flatnonzero(self.has(s & self.low))
            at = at[self.has((s[at] >> np.uint64(32)) & self.low)]
            found += [{"seed": x, "at": i} for x, i in zip(s[at].view(np.int64).tolist(), at.tolist(), strict=True)]
        return (found,)


def bitmap(of: DataFrame, n: int) -> np.ndarray:
    """Bits of the seeds, gathered as whole 64-bit words: at most MOST_BITS / 64 rows reach the driver."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (512 * max(n, 1) - 1).bit_length()))
    probe = F.explode(F.array(F.col("seed").bitwiseAND(size - 1), F.shiftrightunsigned("seed", 32).bitwiseAND(size - 1))).alias("bit")
    words = of.select(probe).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def same_seeds(hits: DataFrame, of: DataFrame) -> DataFrame:
    """``hits`` and ``of`` joined by seed. A phrase that many texts and many items hold is dealt to one key for each ``PART``
    of its texts and ``PART`` of its items, so that no task makes all of its matches."""
    texts, items = (x.groupBy("seed").agg(F.count("*").alias(n)) for x, n in ((hits, "texts"), (of, "items")))
    crowded = texts.join(items, "seed").filter((F.col("texts") > PART) | (F.col("items") > PART))
    crowded = crowded.orderBy((F.col("texts") * F.col("items")).desc(), "seed").limit(HOT)
    parts = [F.ceil(F.col(n) / PART).cast("int").alias(f"{n}_parts") for n in ("texts", "items")]
    parts = F.broadcast(stored(crowded.select("seed", *parts), "crowded"))
    own = lambda *c, n: F.coalesce(F.pmod(F.xxhash64(*c), f"{n}_parts"), F.lit(0)).cast("int").alias(f"{n}_part")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(f"{n}_parts", F.lit(1)) - 1)).alias(f"{n}_part")
    x = hits.join(parts, "seed", "left").select("seed", "text_key", "at", own("text_key", "at", n="texts"), every("items"))
    y = of.join(parts, "seed", "left").select("seed", "item_key", "item_at", own("item_key", "item_at", n="items"), every("texts"))
    return x.join(y, ["seed", "texts_part", "items_part"])


class _Tokens:
    """Tokens of a text; kept while consecutive pairs share it."""

    def __init__(self) -> None:
        self.key, self.tokens = None, None

    def __call__(self, key: int, text: str) -> np.ndarray:
        if key != self.key:
            self.key, self.tokens = key, tokens(text)
        return self.tokens


def benchmark_overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per (row of docs, item) that overlap: id_col, text_key, item_col, matched, words (of the stretch),
    at_word (its first token in the text), item_words, item_share. text_key is xxhash64 of the text, for rows whose
    id is null or repeated."""
    spark = docs.sparkSession
    seeded = T.StructType([T.StructField("seeds", _HIT), T.StructField("item_words", T.IntegerType())])
    item = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("item_text")).filter("item_text is not null")
    item = stored(map_rows(item, item_seeds, ["item_text"], seeded, ["item", "item_text"]).withColumn("item_key", F.xxhash64("item_text")), "items")
    of = stored(item.select("item_key", F.explode("seeds").alias("s")).select("s.seed", "item_key", F.col("s.at").alias("item_at")).distinct(), "seeds")
    n = of.count()
    short = [r[0] for r in item.filter(F.col("item_words").between(LEAST_WORDS, max(most for _, most in SHORT_MASKS))).select("item_words").distinct().collect()]
    masks = list(dict.fromkeys([*MASKS, *(m for k in sorted(short) for m in masks_for(k))]))  # short masks only where an item needs them
    sent = spark.sparkContext.broadcast(bitmap(of, n))

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    scanned = map_rows(texts, lambda f, t: f(t), ["text"], T.StructType([T.StructField("hits", _HIT)]), ["id", "text"], setup=lambda: Filter(sent.value, masks))
    near = stored(scanned.filter(F.size("hits") > 0).withColumn("text_key", F.xxhash64("text")), "hits")

    # equal texts are searched once; every diagonal of a (text, item) pair comes together
    hits = near.groupBy("text_key").agg(F.first("hits").alias("hits"))
    hits = hits.select("text_key", F.explode("hits").alias("h")).select("text_key", "h.seed", "h.at")
    shifts = same_seeds(hits, of).select("text_key", "item_key", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    pairs = shifts.groupBy("text_key", "item_key").agg(F.collect_list("shift").alias("shifts"))

    bodies = near.groupBy("text_key").agg(F.first("text").alias("text"))
    item_texts = item.groupBy("item_key").agg(F.first("item_text").alias("item_text"))
    # the long texts come last: they aren't shuffled with their pairs, and a text's pairs stand together
    both = pairs.join(item_texts, "item_key").join(bodies, "text_key")
    numbers = ("matched", "words", "at_word", "item_words")

    def verify(text_tokens: _Tokens, text_key: int, text: str, item_text: str, at: list[int]) -> tuple:
        x = tokens(item_text)
        m = overlap(text_tokens(text_key, text), x, at)
        return (None,) * 4 if m is None else (*m, len(x))

    out = T.StructType([T.StructField(c, T.LongType()) for c in numbers])
    sure = map_rows(both, verify, ["text_key", "text", "item_text", "shifts"], out, ["text_key", "item_key"], setup=_Tokens).filter("matched is not null")
    sure = stored(sure, "overlaps")
    found = near.select("id", "text_key").join(sure, "text_key").join(item.select("item", "item_key").distinct(), "item_key")
    return found.select(F.col("id").alias(id_col), "text_key", F.col("item").alias(item_col), *numbers, (F.col("matched") / F.col("item_words")).alias("item_share"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of a document with a benchmark item."""
    found = benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLE: dict[str, str] = {}
