"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs the labelers, and
a span classifier trained on the resulting posteriors decides.

1. Patterns propose spans in every whole text: the base kinds (email, ip, card, phone; always kept) and looser ones
   (obfuscated email, national phone, social security number, IBAN, name after a title or with a first name of the gazetteer).
2. Five labelers vote yes, no or abstain on each candidate: strict form, checksum or range, gazetteer, context before,
   and neighbourhood (a number inside a longer code, a version, a price).
3. The votes of the whole corpus are counted by kind and vote pattern - a few hundred rows however large the corpus - and
   a Dawid-Skene EM on these counts gives each labeler's reliability and each pattern's posterior.
4. A logistic span classifier (votes, shape, context words; hashed) is trained on a bounded sample of at most about
   ``SAMPLE`` candidates against their posteriors; looser candidates that it gives ``ACCEPT`` or more become spans,
   unless they overlap a base span.

Defined results: a null or empty text has no span; a null id stays null; repeated rows repeat their result; very long
texts cost time in proportion (no pattern rescans a run, and overlaps are found by bisection); ties of overlapping looser spans go
to the earlier start, then end, then kind; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import map_rows, stored, table

SAMPLE = 20_000
DIMS = 1 << 12
ACCEPT = 0.9
EM_STEPS = 50
BASE = ("email", "ip", "card", "phone")
EXTRA = ("email_words", "phone_national", "ssn", "iban", "name")
KINDS = BASE + EXTRA
LABELERS = ("form", "check", "gazetteer", "context", "surroundings")

# ------------------------------------------------------------------------------------------------ base patterns
# the run before "@" starts where a run of its characters starts, so that no run is tried twice
_EMAIL_TAIL = r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++" + _EMAIL_TAIL)
_EMAIL_HERE = re.compile(r"[A-Za-z0-9._%+-]++" + _EMAIL_TAIL)
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    found, at = [], 0
    if "@" not in text:
        return found
    while True:
        # right after a match a run may begin in the middle of what the look-behind takes for one
        m = (_EMAIL_HERE.match(text, at) if found else None) or _EMAIL.search(text, at)
        if m is None:
            return found
        found.append(m.span())
        at = m.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _part(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) < 4 and int(p or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base kinds, by start, then kind."""
    spans = [(a, b, 0) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return spans
    spans += [(*m.span(), 1) for m in _IP.finditer(text) if all(map(_part, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((*m.span(), 2))
    if "+" in text:
        spans += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m.group())) <= 15]
    return sorted(spans, key=lambda s: (s[0], s[2]))


# ------------------------------------------------------------------------------------------- looser candidates
_TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame"
#: First names the gazetteer knows.
_NAMES = set("james mary john robert michael linda maria anna peter paul thomas hans jean pierre jose carlos luis ana laura sophie marie emma david daniel sarah".split())
_KNOWN = "|".join(sorted(n.capitalize() for n in _NAMES))
_WORD = r"[A-ZÀ-Þ][\w'-]++"
# a run is tried where it starts only and taken whole, so that no text is scanned twice
_RUN, _HOST, _DOT = r"(?<![\w.+-])[A-Za-z0-9._+-]++", "[A-Za-z0-9-]++", r" ?[\[(]? ?(?:dot|DOT) ?[\])]? ?"
_LOOSE = {
    4: re.compile(rf"{_RUN} ?(?:[\[(] ?(?:at|AT) ?[\])] ?{_HOST}(?:(?:{_DOT}|\.| \. ){_HOST})+|(?:at|AT) {_HOST}(?:{_DOT}{_HOST})+)(?!\w)"),
    5: re.compile(r"(?<![\w.+-])\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}(?![\w-])"),
    6: re.compile(r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    7: re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    8: re.compile(rf"(?<!\w)(?:(?:{_TITLES})\.? {_WORD}(?: {_WORD})?|(?:{_KNOWN}) {_WORD})"),
}
#: What must occur at all before a looser pattern is tried.
_NEEDS = {4: re.compile(r"\b(?:dot|DOT)\b|[\[(] ?(?:at|AT) ?[\])]"), 5: _DIGIT, 6: _DIGIT, 7: re.compile(r"[A-Z]{2}[0-9]{2}"), 8: re.compile(rf"\b(?:{_TITLES}|{_KNOWN})\b")}
#: Top-level domains and trigger words the gazetteer and context labelers know.
_DOMAINS = set("com org net edu gov io de fr es uk eu info biz co".split())
_TRIGGERS = {
    0: set("email mail e-mail contact write correo courriel".split()), 1: set("ip host address server login".split()),
    2: set("card visa mastercard credit pay tarjeta carte karte".split()), 3: set("call phone tel mobile fax telefon teléfono".split()),
    4: set("email mail e-mail contact write reach correo".split()), 5: set("call phone tel mobile fax telefon".split()),
    6: set("ssn social security".split()), 7: set("iban account bank konto cuenta compte".split()), 8: set("name contact signed by dear".split()),
}


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(text: str, start: int, end: int, kind: int, before: str) -> str:
    """One of y, n, - for each of LABELERS."""
    s = text[start:end]
    digits = re.sub(r"[^0-9]", "", s)
    say = lambda ok: "y" if ok else "n"
    form = {0: lambda: say(re.fullmatch(r"[^.].{0,62}[^.@]@(?!-)[^@]{3,}\.[A-Za-z]{2,}", s)), 1: lambda: say(not any(p.startswith("0") and p != "0" for p in s.split("."))),
            2: lambda: say(s[0] in "3456" and (len(digits) in (14, 15, 16))), 3: lambda: say(not re.search(r"[.-]{2}|\)[0-9]", s)),
            4: lambda: say("[" in s or "(" in s or len(re.findall(r"\b(?:at|AT)\b", s)) == 1 and s.isascii()), 5: lambda: say(len(set(re.findall(r"[ .-]", s))) == 1 or s.startswith("(")),
            6: lambda: "y", 7: lambda: say(len(s.replace(" ", "")) >= 15), 8: lambda: "y"}[kind]()
    check = {1: lambda: say(0 < int(s.split(".")[0].lstrip("0") or 0) < 224), 2: lambda: "y", 3: lambda: say(len(set(digits)) > 2), 5: lambda: say(digits[0] not in "01" and len(set(digits)) > 2),
             6: lambda: say(digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"), 7: lambda: say(_iban(s))}.get(kind, lambda: "-")()
    known = "-"
    if kind in (0, 4):
        known = say(re.split(r"[^a-z]+", s.lower().rstrip(")] "))[-1] in _DOMAINS)
    elif kind == 8:
        known = "y" if any(w in _NAMES for w in s.lower().split()) else "-"
    context = "y" if before in _TRIGGERS[kind] else "-"
    near = text[max(0, start - 1) : start] + text[end : end + 1]
    return form + check + known + context + ("n" if re.search(r"[\w$€#/=]", near) else "y")


def _in_word(c: str) -> bool:
    return c.isalnum() or c in "_-"


def word_before(text: str, start: int) -> str:
    """The word that ends at most three characters before ``start``, in lower case."""
    end = start
    while end > 0 and start - end < 3 and not _in_word(text[end - 1]):
        end -= 1
    at = end
    while at > 0 and _in_word(text[at - 1]):
        at -= 1
    return text[at:end].lower()


def candidates(text: str | None) -> tuple[list, list]:
    """Base spans, and all candidates (base and looser) with votes, shape and the word before. A looser candidate that overlaps a
    base span, or a looser one before it, is left out."""
    if not text:
        return [], []
    base = base_spans(text)
    starts, furthest = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
    loose = [(*m.span(), k) for k, p in _LOOSE.items() if _NEEDS[k].search(text) for m in p.finditer(text)]
    here, last = [], 0
    for a, b, k in sorted(loose):
        before = bisect_left(starts, b)  # base spans that start before this one's end
        if a >= last and (not before or furthest[before - 1] <= a):
            here.append((a, b, k))
            last = b
    rows = []
    for a, b, k in [*base, *here]:
        before = word_before(text, a)
        shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[a-zß-ÿ]", "a", re.sub(r"[A-ZÀ-Þ]", "A", re.sub(r"[0-9]", "9", text[a:b]))))
        rows.append({"start": a, "end": b, "kind": k, "votes": votes(text, a, b, k, before), "shape": shape, "before": before})
    return [{"start": a, "end": b, "kind": k} for a, b, k in base], rows


# ------------------------------------------------------------------------------------------ EM and classifier
def reliabilities(patterns: list[tuple[int, str, int]]) -> tuple[dict, dict]:
    """Dawid-Skene on counted vote patterns (kind, votes, n): posterior by (kind, votes), and per kind and labeler the
    chances of a yes given a true and a false span."""
    posterior, rates = {}, {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = [(v, n) for k, v, n in patterns if k == kind]
        n = np.array([c for _, c in rows], float)
        yes = np.array([[c == "y" for c in v] for v, _ in rows], float)
        cast = np.array([[c != "-" for c in v] for v, _ in rows], float)
        q = np.clip((yes.sum(1) + 0.5) / (cast.sum(1) + 1), 0.02, 0.98)  # starts at the share of yes votes
        for _ in range(EM_STEPS):
            prior = (n @ q + 1) / (n.sum() + 2)
            hit = ((n * q) @ yes + 2.0) / ((n * q) @ cast + 2.5)  # labelers are better than chance before any data
            slip = ((n * (1 - q)) @ yes + 0.5) / ((n * (1 - q)) @ cast + 2.5)
            odds = np.log(prior / (1 - prior)) + (yes * np.log(hit / slip) + (cast - yes) * np.log((1 - hit) / (1 - slip))).sum(1)
            q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        posterior |= {(kind, v): float(p) for (v, _), p in zip(rows, q, strict=True)}
        rates[KINDS[kind]] = {name: (round(float(h), 4), round(float(s), 4)) for name, h, s in zip(LABELERS, hit, slip, strict=True)}
    return posterior, rates


def span_features(kind: int, cast: str, shape: str, before: str) -> list[int]:
    said = [f"{kind}", *(f"{kind}{i}{c}" for i, c in enumerate(cast)), f"{kind}s{shape}", f"{kind}l{len(shape) // 4}", f"{kind}b{before}"]
    return [xxhash.xxh32_intdigest(x) % DIMS for x in said]


def fit(rows: list[tuple], goal: np.ndarray) -> np.ndarray:
    """Logistic regression on hashed span features against soft labels (AdaGrad over shuffled blocks)."""
    w, seen = np.zeros(DIMS), np.full(DIMS, 1e-6)
    if not rows:
        return w
    x = np.array([span_features(*r) for r in rows])
    rng = np.random.default_rng(7)
    for _ in range(12):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 64):
            at = x[order[i : i + 64]]
            p = 1 / (1 + np.exp(-w[at].sum(1)))
            g = np.zeros(DIMS)
            np.add.at(g, at, ((p - goal[order[i : i + 64]]) / len(at))[:, None])
            g += 1e-5 * w
            seen += g * g
            w -= 0.3 * g / np.sqrt(seen)
    return w


# ------------------------------------------------------------------------------------------------------ operator
_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.IntegerType())])
_CANDIDATE = T.StructType([*_SPAN.fields, *(T.StructField(n, T.StringType()) for n in ("votes", "shape", "before"))])
_FOUND = T.StructType([T.StructField("base", T.ArrayType(_SPAN)), T.StructField("candidates", T.ArrayType(_CANDIDATE))])


def personal_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``keep``, id_col, base and spans (arrays of start, end, kind number in KINDS; spans holds base and accepted ones)."""
    found = map_rows(df, candidates, [text_col], _FOUND, [id_col, *keep])
    noted = stored(found.select(id_col, "base", "candidates") if not keep else found, "candidates")
    each = noted.select(id_col, F.explode("candidates").alias("c")).select(id_col, "c.*")
    patterns = [(r["kind"], r["votes"], r["n"]) for r in each.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()]
    posterior, _ = reliabilities(patterns)
    total = sum(n for _, _, n in patterns)
    draw = F.pmod(F.xxhash64(id_col, "shape", "before", "start", "kind"), F.lit(1 << 40)) / float(1 << 40)
    sample = sorted(tuple(r) for r in each.filter(draw < SAMPLE / max(total, 1)).select("kind", "votes", "shape", "before").collect())
    weights = fit(sample, np.array([posterior[r[0], r[1]] for r in sample]))
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def accept(base: list, rows: list) -> tuple:
        spans = list(base)
        for c in rows:
            if c["kind"] >= len(BASE):
                z = float(sent.value[span_features(c["kind"], c["votes"], c["shape"], c["before"])].sum())
                if 1 / (1 + np.exp(-z)) >= ACCEPT:
                    spans.append({k: c[k] for k in ("start", "end", "kind")})
        return (sorted(spans, key=lambda s: (s["start"], s["kind"])),)

    out = T.StructType([T.StructField("spans", T.ArrayType(_SPAN))])
    return map_rows(noted, accept, ["base", "candidates"], out, [id_col, *keep, "base"])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts of the base kinds, digest of the base spans, all spans."""
    found = personal_spans(table(spark, sf_dir, "documents"))
    count = [F.expr(f"size(filter(base, s -> s.kind = {k}))").cast("long").alias(f"n_{name}") for k, name in enumerate(BASE)]
    names = F.array(*[F.lit(k) for k in KINDS])
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *count, F.sha2(said("base").cast("binary"), 256).alias("base_sha256"), said("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def redact(text: str | None, spans: list) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans are merged under the first's kind."""
    if not text or not spans:
        return text
    parts, at, until = [], 0, -1
    for s in spans:
        if s["start"] >= until:
            parts += [text[at : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
        until = at = max(at, s["end"])
    return "".join(parts) + text[at:]


def redacted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``keep``, id_col, text_col with every span redacted, n_spans."""
    found = personal_spans(df, id_col, text_col, [text_col, *keep])
    out = T.StructType([T.StructField("clean", T.StringType()), T.StructField("n_spans", T.LongType())])
    done = map_rows(found, lambda text, spans: (redact(text, spans), len(spans)), [text_col, "spans"], out, [id_col, *keep])
    return done.select(id_col, *keep, F.col("clean").alias(text_col), "n_spans")


QUERIES = {"op7_pii": op7_pii}
ORACLE: dict[str, str] = {}
