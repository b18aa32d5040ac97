"""Periodic runs of words by maximal pairs.

A run is a stretch of consecutive words that repeats with a smallest period ``q``, is at least ``max(LEAST, 2 q)`` words
long and can't be extended by a neighbouring word. Texts of a batch are joined (their words made distinct) and get one
suffix order by prefix doubling in numpy; the ranks of the doubling steps give the longest common prefixes (LCP) of
neighbours. LCP intervals are then closed bottom-up. An interval of LCP ``l`` holds the positions of its suffixes in text
order, each with the class of its left word; the smaller children are merged into the largest one.

Two positions that become neighbours in such a list, come from different children and have different left words are a
maximal pair: equal for exactly ``l`` words, and extendable neither way. If their distance ``q`` is at most ``l``, the
``l + q`` words from the first one are a run: nothing has to be extended or verified. Its period is the smallest, as a
smaller one would put another position of the interval between the two; for the same reason every run shows up as
neighbours, once. Intervals of LCP below half of ``LEAST`` hold no run and are not built.

A position is merged at most log2(n) times, so a text of n words takes O(n log^2 n) steps, whatever its repetitions. A
batch's texts are handled up to ``CHUNK`` words at a time, a longer text alone; its memory is some 12 bytes a word and
doubling step. Texts are never split over tasks, as a run may span all of one.

Defined results: a null or empty text has no words and no runs; a null id stays null (and is never rewritten by the
query); repeated rows repeat their result; ties of the longest run go to the smallest start, then period; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import map_lists, table

#: Words in the shortest run.
LEAST = 12
#: Words of the texts that share one suffix order.
CHUNK = 200_000

LONG = T.LongType()
RUN = T.StructType([T.StructField(n, LONG) for n in ("start", "length", "period")])
SCHEMA = T.StructType([T.StructField("n_words", LONG), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
Run = tuple[int, int, int]


# ------------------------------------------------------------------------------------------------------- suffix order
def _starts(changed: np.ndarray) -> np.ndarray:
    """Index of the first element of each element's group, from the marks of first elements."""
    return np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))


def _changed(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], x[1:] != x[:-1]])


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffixes in order, ranks by the first 1, 2, 4, ... words). ``words`` ends with a value that occurs once; a rank is the
    place of the first suffix that is equal so far, so only suffixes that still share one are sorted again."""
    order = np.argsort(words, kind="stable")
    first = _starts(_changed(words[order]))
    rank = np.empty(len(words), np.int32)
    rank[order] = first
    levels, k = [rank], 1
    shared = np.bincount(first, minlength=len(words))
    active = order[shared[first] > 1]
    while len(active):
        key = rank[active].astype(np.int64) << 32 | rank[active + k]
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        old, new = _starts(_changed(key >> 32)), _starts(_changed(key))
        rank = rank.copy()
        rank[active] += (new - old).astype(np.int32)
        levels.append(rank)
        active = active[np.bincount(new, minlength=len(new))[new] > 1]
        k *= 2
    order = np.empty(len(words), np.int64)
    order[rank] = np.arange(len(words))
    return order, levels


def common_prefixes(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` (different ones) have in common."""
    length = np.zeros(len(a), np.int64)
    for i in range(len(levels) - 1, -1, -1):
        length += np.where(levels[i][a + length] == levels[i][b + length], 1 << i, 0)
    return length


# ------------------------------------------------------------------------------------------------------ LCP intervals
def _close(lcp: int, children: list[list[int]], left: list[int], least: int, found: list[Run]) -> list[int]:
    """Merge the children's position lists; the pairs that become neighbours and qualify are runs."""
    if len(children) == 2 and len(children[0]) == 1 and len(children[1]) == 1:
        i, j = children[0][0], children[1][0]
        if i > j:
            i, j = j, i
        if j - i <= lcp and lcp + j - i >= least and left[i] != left[j]:
            found.append((i, lcp + j - i, j - i))
        return [i, j]
    largest = max(range(len(children)), key=lambda c: len(children[c]))
    base = children[largest]
    child = {p: c for c, positions in enumerate(children) if c != largest for p in positions}
    added = sorted(child)
    if len(added) * 16 < len(base):
        for p in added:
            base.insert(bisect_left(base, p), p)
    else:
        base.extend(added)
        base.sort()
    for p in added:
        at, own = bisect_left(base, p), child[p]
        if at:
            i = base[at - 1]
            if p - i <= lcp and lcp + p - i >= least and left[i] != left[p] and child.get(i, largest) != own:
                found.append((i, lcp + p - i, p - i))
        if at + 1 < len(base):
            j = base[at + 1]
            if j - p <= lcp and lcp + j - p >= least and left[p] != left[j] and j not in child:
                found.append((p, lcp + j - p, j - p))
    return base


def interval_runs(positions: list[int], lcps: list[int], left: list[int], least: int) -> list[Run]:
    """Runs from suffixes in order: ``lcps[t]`` is what suffixes t - 1 and t share. Intervals close bottom-up; those of an
    LCP under half of ``least`` are never opened."""
    found: list[Run] = []
    floor = (least + 1) // 2
    open_: list[tuple[int, list[list[int]]]] = []
    now = [positions[0]] if positions else []
    for p, h in zip(positions[1:], lcps[1:], strict=True):
        while open_ and open_[-1][0] > h:
            lcp, children = open_.pop()
            children.append(now)
            now = _close(lcp, children, left, least, found)
        if h >= floor:
            if open_ and open_[-1][0] == h:
                open_[-1][1].append(now)
            else:
                open_.append((h, [now]))
        now = [p]
    while open_:
        lcp, children = open_.pop()
        children.append(now)
        now = _close(lcp, children, left, least, found)
    return found


def runs_of(texts: list[list], least: int = LEAST) -> list[list[Run]]:
    """(start, length, period) of every text's runs, by start, then period; a text is its list of words."""
    number: dict = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    if sizes.sum() == 0:
        return [[] for _ in texts]
    ids = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, int(sizes.sum()))
    # one value that occurs once before each text and one after the last; equal words of two texts differ
    text = np.repeat(np.arange(len(texts)), sizes)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.arange(begin[-1] + 1, dtype=np.int64) + (len(texts) * len(number))
    words[np.arange(len(ids)) + text + 1] = text * len(number) + ids
    order, levels = suffix_order(words)
    # only suffixes that share their first four words (floor 6: eight would be too many) with a neighbour can be in an interval
    coarse = levels[min(2, len(levels) - 1)][order]
    shares = np.flatnonzero(coarse[1:] == coarse[:-1]) + 1 if (least + 1) // 2 >= 4 else np.arange(1, len(order))
    lcp = np.zeros(len(order), np.int64)
    lcp[shares] = common_prefixes(order[shares - 1], order[shares], levels)
    lcp[lcp < (least + 1) // 2] = 0
    used = (lcp > 0) | np.append(lcp[1:] > 0, False)
    left = np.roll(words, 1).tolist()
    found = interval_runs(order[used].tolist(), lcp[used].tolist(), left, least)
    out: list[list[Run]] = [[] for _ in texts]
    of = np.searchsorted(begin, [s - 1 for s, _, _ in found], side="right") - 1
    for (start, length, period), t in zip(found, of.tolist(), strict=True):
        out[t].append((start - 1 - int(begin[t]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Mask of the words that no run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:-1]) == 0


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only


def _batch(rewrite: Callable | None, ids: list, texts: list) -> list[tuple]:
    words = [_split(t) for t in texts]
    if rewrite is not None:
        words = [rewrite(i, w) for i, w in zip(ids, words, strict=True)]
    found, chunk, size = [], [], 0
    for w in [*words, None]:
        if chunk and (w is None or size + len(w) > CHUNK):
            found += runs_of(chunk)
            chunk, size = [], 0
        if w is not None:
            chunk.append(w)
            size += len(w)
    rows = []
    for w, runs in zip(words, found, strict=True):
        keep = w if not runs else [x for x, k in zip(w, kept_words(len(w), runs).tolist(), strict=True) if k]
        made = [{"start": s, "length": n, "period": p} for s, n, p in runs]
        rows.append((len(w), made, b" ".join(keep).decode("utf-8", "surrogatepass")))
    return rows


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable | None = None) -> DataFrame:
    """id_col, n_words, runs (start, length, period; by start, then period) and collapsed (the words that no run repeats, with
    one space between them): one row per row. ``rewrite(id, words) -> words`` may change a text's words before."""
    return map_lists(df, lambda ids, texts: _batch(rewrite, ids, texts), [id_col, text_col], SCHEMA, [id_col])


# -------------------------------------------------------------------------------------------------------------- query
def planted(doc_id: int | None, words: list) -> list:
    """The query's rule: one document in ten becomes periodic from word a on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document: their number, the longest one, and digests of all runs and of the text without them."""
    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.lit(1000).cast("long") * F.col("best.l") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_runs": op11_runs}
ORACLE: dict[str, str] = {}
