"""Toxicity by a counterfactually regularised linear classifier.

Features of a text are its words and their prefixes (presence, and a damped rate). Labelled sentences are copied with an
identity term exchanged for another term of its group; training adds ``FAIRNESS`` times the squared change of the
score between the copies to the logistic loss, so that neutral mentions of a group don't move a score.

Labels are learned from a bounded sample of at most about ``SAMPLE`` labelled documents of either class (drawn by a
hash of the id among all labelled rows that may be learned from; the share of the classes is put back into the
intercept) and from its ``FEATURES`` most telling features. All sentences and all identity terms of the sampled texts are swapped;
tasks sum the products of what the swaps change, and only these sums, bounded by the features, come to the driver. Every whole text is scored by the fitted weights, which are a few thousand numbers.

Defined results: a null or empty text scores the intercept alone; null labels are not learned from, an id labelled
twice takes its largest label, and of several texts the one of the smallest hash is learned from; without both classes to learn from the score is the learned share of toxic rows (0
without any label); a null id is never learned from and counts as held out; repeated rows repeat their result; ties of features go
to the smaller hash; a very long text takes time in proportion to its length; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import drop_stored, held_out, map_rows, stored, table

SAMPLE = 3_000
FEATURES = 600
PREFIXES = (4, 5, 6, 7)
FAIRNESS, RIDGE, STEPS = 10.0, 2e-4, 600
#: Steps of one in the sums of products of the swaps' changes (whole numbers, so that sums don't depend on their order).
PARTS = 1 << 24
THRESHOLD = 0.7

#: Identity terms by group; terms of one group are exchanged for each other.
IDENTITY_GROUPS = {
    "belief": "christian muslim jewish hindu buddhist catholic protestant atheist sikh christlich muslimisch jüdisch chrétien musulman juif cristiano musulmán judío".split(),
    "gender": "man woman men women boy girl male female transgender mann frau homme femme hombre mujer".split(),
    "orientation": "gay lesbian bisexual straight queer heterosexual homosexual schwul lesbisch".split(),
    "origin": "african asian european american mexican chinese indian arab turkish polish german french spanish black white latino".split(),
    "age and body": "old young elderly deaf blind disabled alt jung vieux jeune viejo joven".split(),
}
_GROUP = {term: words for words in IDENTITY_GROUPS.values() for term in words}
_TERM = re.compile(r"\b(" + "|".join(sorted(_GROUP, key=len, reverse=True)) + r")\b", re.IGNORECASE)
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


# ------------------------------------------------------------------------------------------------------- features
def word_features(word: str) -> list[int]:
    return [xxhash.xxh3_64_intdigest(word) >> 1, *(xxhash.xxh3_64_intdigest(f"{word[:n]}*") >> 1 for n in PREFIXES if len(word) >= n)]


class _FeatureCache(dict):
    def __missing__(self, word: str) -> list[int]:
        if len(self) > 200_000:
            self.clear()
        f = self[word] = word_features(word)
        return f


def features(text: str | None, of: dict | None = None) -> tuple[dict[int, int], int]:
    """Counts by feature, and the number of words."""
    counts: dict[int, int] = defaultdict(int)
    words = Counter(_WORD.findall((text or "").lower()))
    of = _FEATURES if of is None else of
    for w, n in words.items():
        for f in of[w]:
            counts[f] += n
    return counts, sum(words.values())


_FEATURES = _FeatureCache()


def damped(count: float, n_words: int) -> float:
    return math.sqrt(min(1.0, 25.0 * count / max(n_words, 1)))


#: What a swap changes: by feature, its presence and its damped rate, before less after.
Change = dict[int, tuple[float, float]]


def _exchange(counts: dict[int, int], n: int, term: str, other: str) -> Change:
    """One occurrence of ``term`` becomes ``other``, in a sentence of these feature counts and ``n`` words."""
    old, new = _FEATURES[term], _FEATURES[other]
    made: Change = {}
    for f in {*old, *new}:
        c = counts.get(f, 0)
        d = c - (f in old) + (f in new)
        if c != d:
            made[f] = (float(c > 0) - float(d > 0), damped(c, n) - damped(d, n))
    return made


def swapped(text: str) -> list[tuple[str, str, str]]:
    """(sentence, identity term in it, term of its group to put there) for every sentence and every term that it holds; a text
    without such terms lends its first sentence, which gets a term in front."""
    pairs = []
    for m in _SENTENCE.finditer(text):
        s = m.group()
        for term in sorted({t.lower() for t in _TERM.findall(s)}):
            group = _GROUP[term]
            pairs.append((s, term, group[(group.index(term) + 1 + xxhash.xxh32_intdigest(s) % (len(group) - 1)) % len(group)]))
    if not pairs and (m := _SENTENCE.search(text)):
        h = xxhash.xxh32_intdigest(m.group())
        group = list(IDENTITY_GROUPS.values())[h % len(IDENTITY_GROUPS)]
        a, b = group[h // 7 % len(group)], group[(h // 7 + 1) % len(group)]
        pairs.append((f"{a} {m.group()}", a, b))
    return pairs


def changes(text: str) -> list[Change]:
    """What every swap of a text changes; a sentence is counted once, however many terms it holds."""
    made, last, counted = [], None, ({}, 0)
    for s, term, other in swapped(text):
        if s is not last:
            last, counted = s, features(s)
        made.append(_exchange(*counted, term, other))
    return made


# ------------------------------------------------------------------------------------------------------- learning
def fit(x: np.ndarray, y: np.ndarray, swaps: np.ndarray, toxic_share: float) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient descent on logistic loss + ridge + counterfactual penalty (``swaps``: the mean
    product of the swaps' changes d, so that the mean squared change of the score is w' swaps w)."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    swaps = np.pad(swaps, (0, 1)).astype(np.float32)  # the bias does not change
    w = np.zeros(x.shape[1])
    v, t = w.copy(), 1.0
    # the loss's curvature is at most that of a quarter of the squared rows' mean
    top = np.ones(x.shape[1], np.float32)
    for _ in range(20):
        top = 0.25 * (x.T @ (x @ top)) / len(x) + FAIRNESS * (swaps @ top)
        top /= (norm := float(np.linalg.norm(top))) or 1.0
    step = 1 / (norm * 1.1 + RIDGE)
    keep = np.ones(x.shape[1])
    keep[-1] = 0
    for _ in range(STEPS):
        now = v.astype(np.float32)
        p = 1 / (1 + np.exp(-np.clip(x @ now, -30, 30)))
        g = x.T @ (p - y).astype(np.float32) / len(y) + RIDGE * keep * v + FAIRNESS * (swaps @ now)
        new = v - step * g
        t, s = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (s - 1) / t * (new - w), new
    sampled = float(y.mean())
    return w[:-1], float(w[-1]) + math.log(toxic_share / (1 - toxic_share)) - math.log(sampled / (1 - sampled))


LONGS = T.ArrayType(T.LongType())
DESCRIBED = T.StructType([T.StructField("ids", LONGS), T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("n", T.IntegerType())])
PRODUCTS = T.StructType([T.StructField("swaps", T.LongType()), T.StructField("at", LONGS), T.StructField("sums", LONGS)])


def _describe(text: str | None) -> tuple:
    counts, n = features(text)
    return list(counts), list(counts.values()), n


def products(place: dict[int, int], text: str | None) -> tuple:
    """Of a text's swaps that change a picked feature (``place``: its column): their number, and the sums of d d' as (row *
    columns + column, sum), in parts of ``PARTS``."""
    k, n, sums = len(place), 0, Counter()
    for change in changes(text or ""):
        d = [(place[f], here) for f, (here, _) in change.items() if f in place and here]
        d += [(k + place[f], rate) for f, (_, rate) in change.items() if f in place and rate]
        n += bool(d)
        for i, u in d:
            for j, v in d:
                sums[i * 2 * k + j] += round(u * v * PARTS)
    return n, list(sums), list(sums.values())


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """``docs`` (id, text), ``labels`` (id, label 0/1) -> bias and weights by feature. Features are chosen in Spark: those
    whose document share differs most between the classes of the sample, in standard deviations, and identity terms;
    the driver gets the chosen features' counts only."""
    known = labels.filter(~held_out(F.col("id")) & F.col("label").isin(0, 1))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    flat = {"bias": None, "share": sizes.get(1, 0) / total if total else 0.0, "weights": {}}
    if len(sizes) < 2:
        return flat
    draw = F.pmod(F.xxhash64(F.lit("label"), "id"), F.lit(1 << 40)) / float(1 << 40)
    share = F.when(F.col("label") == 1, SAMPLE / sizes[1]).otherwise(SAMPLE / sizes[0])
    sample = known.filter(draw < share).groupBy("id").agg(F.max("label").alias("label"))
    # about 2 * SAMPLE rows of two numbers, however large the tables are: the texts need no shuffle
    # one text an id, chosen by its hash
    sample = docs.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text"))
    noted = stored(map_rows(sample, _describe, ["text"], DESCRIBED, ["id", "label", "text"]), "sample")
    rows = sorted(tuple(r) for r in noted.select("id", "label", "n").collect())
    y = np.array([label for _, label, _ in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return flat

    each = noted.select("id", F.col("label"), F.explode(F.arrays_zip("ids", "counts")).alias("f")).select("id", "label", F.col("f.ids").alias("feature"), F.col("f.counts").alias("count"))
    n_pos, n_neg = float(y.sum()), float((1 - y).sum())
    stats = each.groupBy("feature").agg(F.sum("label").alias("pos"), F.count("*").alias("both"))
    at = F.col("both") / (n_pos + n_neg)
    apart = (F.col("pos") / n_pos - (F.col("both") - F.col("pos")) / n_neg) / F.sqrt(F.greatest(at * (1 - at), F.lit(1e-9)) * (1 / n_pos + 1 / n_neg))
    stats = stats.filter("both >= 4").withColumn("z", F.abs(apart)).filter("z >= 3")
    terms = [word_features(t)[0] for t in _GROUP]
    best = stats.orderBy(F.desc("z"), "feature").limit(FEATURES).select("feature")
    named = each.filter(F.col("feature").isin(terms)).select("feature").distinct()
    picked = np.array(sorted({r[0] for r in best.unionByName(named).collect()}), np.int64)
    cells = each.filter(F.col("feature").isin(picked.tolist())).select("id", "feature", "count").toArrow()

    k, place = len(picked), {row[0]: i for i, row in enumerate(rows)}
    words = np.array([max(n, 1) for _, _, n in rows])
    r = np.array([place[i] for i in cells.column("id").to_pylist()], np.int64)
    c = np.searchsorted(picked, np.array(cells.column("feature").to_pylist(), np.int64))
    x = np.zeros((len(rows), 2 * k), np.float32)
    x[r, c] = 1.0
    x[r, k + c] = np.sqrt(np.minimum(1.0, 25.0 * np.array(cells.column("count").to_pylist()) / words[r])) if len(r) else 0
    column = {f: i for i, f in enumerate(picked.tolist())}
    made = stored(map_rows(noted, lambda text: products(column, text), ["text"], PRODUCTS), "swaps")
    n_swaps = made.agg(F.sum("swaps")).first()[0]
    summed = made.select(F.explode(F.arrays_zip("at", "sums")).alias("s")).groupBy(F.col("s.at").alias("at")).agg(F.sum("s.sums").alias("v")).toArrow()
    swaps = np.zeros(4 * k * k)  # at most this many numbers reach the driver, whatever the texts' lengths
    swaps[summed.column("at").to_numpy()] = summed.column("v").to_numpy() / PARTS / max(n_swaps or 0, 1)
    w, bias = fit(x, y, swaps.reshape(2 * k, 2 * k), flat["share"])
    drop_stored(noted)
    drop_stored(made)
    return {"bias": bias, "weights": {f: (float(w[j]), float(w[k + j])) for j, f in enumerate(picked.tolist())}}


# -------------------------------------------------------------------------------------------------------- scoring
class Scorer:
    """Weights by word: a word without a chosen feature costs one look-up."""

    def __init__(self, model: dict) -> None:
        self.model = model
        weights = model["weights"]

        class Known(dict):
            def __missing__(self, word: str) -> tuple:
                if len(self) > 400_000:
                    self.clear()
                f = self[word] = tuple(x for x in word_features(word) if x in weights)
                return f

        self.known = Known()

    def __call__(self, text: str | None) -> float:
        if self.model["bias"] is None:
            return self.model["share"]
        counts, n = features(text, self.known)
        z = self.model["bias"]
        for f, c in counts.items():
            here, rate = self.model["weights"][f]
            z += here + rate * damped(c, n)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", keep: list[str] = ()) -> DataFrame:
    """id_col, ``keep``, held_out, score, predicted: one row per row of ``docs``; ``labels`` has id_col and label_col."""
    model = learn(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = T.StructType([T.StructField("score", T.DoubleType())])
    scored = map_rows(docs, lambda scorer, text: (scorer(text),), [text_col], out, [id_col, *keep], setup=lambda: Scorer(sent.value))
    return scored.select(id_col, *keep, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE: dict[str, str] = {}
