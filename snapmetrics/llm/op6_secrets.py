"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns (assign, access, hex; always kept) and looser ones (private keys, service tokens, random-looking strings)
propose spans in every whole text. Each candidate's secret is hashed; over the whole corpus the hash is counted by
distinct repositories and by distinct owners. A secret that more than ``MOST_OWNERS`` owners or more than
``MOST_REPOSITORIES`` repositories carry is a widely copied example; one that stays with its owner, in few of its
repositories, looks live. Looser candidates that no base span overlaps become spans if they look live.

Positions come from the pieces between matches: a regular expression splits the text and extracts its matches, and the
running sums of the lengths (code points) of pieces and matches are the ends. Running sums and extremes are made by doubling
(``_running``): the work of a text with n matches grows with n log n.

``documents`` names no repository: there, a document is its own repository and ``source`` is the owner.

Defined results: a null or empty text has no span; a null id stays null; null owners and repositories count as one each;
repeated rows repeat their result; of spans with one start the order is that of the kinds; a very long text is read whole, in
one row, as any other; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.common import stored, table

MOST_OWNERS = 2
MOST_REPOSITORIES = 20
BASE = ("assign", "access", "hex")
#: Fixed patterns. The base ones are matched leftmost, without overlap; (pattern, group of the secret, its least length).
PATTERNS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}+", 0, 32),
    "private_key": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\x09-\x0D\x20]*+(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?", 0, 40),
    "service": (r"(?<![A-Za-z0-9_])(?:gh[opsur]_[A-Za-z0-9]{30,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|[sr]k_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35}|glpat-[A-Za-z0-9_-]{20,}+)", 0, 10),
    "jwt": (r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", 0, 30),
    "random": (r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+", 0, 24),
}
KINDS = tuple(PATTERNS)


#: Plain texts that a match of the kind always holds: where none of them is in a text, its pattern isn't tried.
HINTS = {"access": "AKIA", "private_key": "PRIVATE KEY-----", "jwt": "eyJ"}
SPANS = "array<struct<start:int,kind:int,end:int,secret:string>>"


def _running(values: str, combine: str, back: bool = False) -> str:
    """SQL of the running sum, maximum, ... of an array, from its start or (``back``) from its end: after step s an element
    covers 2^s of its neighbours, so n elements take log2(n) passes."""
    inside, at = ("i + shiftleft(1, s) < size(acc)", "i + shiftleft(1, s)") if back else ("i >= shiftleft(1, s)", "i - shiftleft(1, s)")
    step = f"transform(acc, (v, i) -> if({inside}, {combine.format('v', f'acc[{at}]')}, v))"
    return f"aggregate(sequence(0, 31), {values}, (acc, s) -> if(s < 31 and shiftleft(1, s) < size(acc), {step}, acc))"


def found_spans(text: str, kind: str) -> Column:
    """Array of (start, kind number, end, hash of the secret) of a kind in the text column."""
    pattern, group, least = PATTERNS[kind]
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    # the secret within a match: the pattern reads the match alone as it reads it in the text
    secret = f"regexp_extract(m, '{p}', {group})" if group else "m"
    # a random-looking string has digits, capitals and small letters; other kinds have a least length
    holds = "x.secret rlike '[0-9]' and x.secret rlike '[A-Z]' and x.secret rlike '[a-z]'" if kind == "random" else f"length(x.secret) >= {least}"
    lengths = "transform(t.m, (m, i) -> length(t.p[i]) + length(m))"
    ends = _running(lengths, "{0} + {1}")
    span = f"named_struct('start', e[i] - length(m), 'kind', {KINDS.index(kind)}, 'end', e[i], 'secret', {secret})"
    spans = f"filter(flatten(transform(array({ends}), e -> transform(t.m, (m, i) -> {span}))), x -> {holds})"
    hashed = f"transform({spans}, x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end, 'secret', sha2(x.secret, 256)))"
    parts = f"named_struct('p', split({text}, '{p}', -1), 'm', regexp_extract_all({text}, '{p}', 0))"
    seen = f"contains({text}, '{HINTS[kind]}')" if kind in HINTS else f"{text} rlike '{p}'"
    return F.expr(f"case when {seen} then cast(flatten(transform(array({parts}), t -> {hashed})) as {SPANS}) else cast(array() as {SPANS}) end")


def apart_from_base(spans: str) -> Column:
    """The spans (array by start and kind) of looser kinds that overlap no base span: no base span before ends after its
    start, and the next base span starts after its end."""
    base = f"x.kind < {len(BASE)}"
    ended = _running(f"transform(a, x -> if({base}, x.end, 0))", "greatest({0}, {1})")
    following = _running(f"transform(a, x -> if({base}, x.start, 2147483647))", "least({0}, {1})", back=True)
    bound = f"array(named_struct('ended', {ended}, 'following', {following}))"
    kept = f"filter(a, (x, i) -> x.kind >= {len(BASE)} and r.ended[i] <= x.start and r.following[i] >= x.end)"
    return F.expr(f"cast(flatten(flatten(transform(array({spans}), a -> transform({bound}, r -> {kept})))) as {SPANS})")


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """id_col, base and spans (arrays of start, kind number in KINDS, end, secret, owners, repositories, live): base holds
    the base kinds, spans these and the accepted ones, both by start and kind. One row per row of ``df``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(owner_col).alias("owner"), F.col(repository_col).alias("repository"))
    rows = rows.withColumn("row_key", F.xxhash64(F.col("id").cast("string"), F.col("id").isNull(), "text"))
    rows = rows.select("id", "row_key", "owner", "repository", *[found_spans("text", k).alias(f"in_{k}") for k in KINDS])
    every = F.sort_array(F.concat(*[F.col(f"in_{k}") for k in KINDS]))
    noted = rows.select("id", "row_key", "owner", "repository", every.alias("every"))
    base = F.filter("every", lambda e: e["kind"] < len(BASE))
    noted = noted.select("id", "row_key", "owner", "repository", F.concat(base, apart_from_base("every")).alias("every"))
    noted = stored(noted, "candidates")

    each = noted.select("row_key", "owner", "repository", F.explode("every").alias("c")).select("row_key", "owner", "repository", "c.*")
    none = F.lit("")
    owners = each.select("secret", F.struct(F.col("owner").isNull(), F.coalesce(F.col("owner").cast("string"), none)).alias("o")).distinct().groupBy("secret").agg(F.count("*").alias("owners"))
    places = each.select("secret", F.struct(F.col("repository").isNull(), F.coalesce(F.col("repository").cast("string"), none)).alias("r")).distinct().groupBy("secret").agg(F.count("*").alias("repositories"))
    spread = owners.join(places, "secret").withColumn("live", (F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES))
    judged = each.select("row_key", "start", "kind", "end", "secret").distinct().join(spread, "secret")
    spans = judged.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "secret", "owners", "repositories", "live"))).alias("all"))
    out = noted.select("id", "row_key").join(spans, "row_key", "left")
    every = F.coalesce("all", F.array())
    of_base = F.filter(every, lambda s: s["kind"] < len(BASE))
    accepted = F.filter(every, lambda s: (s["kind"] < len(BASE)) | s["live"])
    return out.select(F.col("id").alias(id_col), of_base.alias("base"), accepted.alias("spans"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts of the base kinds, digest of the base spans, all spans, live and copied ones."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    said = lambda c: F.expr(f"array_join(transform({c}, s -> concat_ws(':', {names}[s.kind], cast(s.start as string), cast(s.end as string))), ',')")
    count = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)").alias(f"n_{name}") for k, name in enumerate(BASE)]
    live = F.expr("cast(size(filter(spans, s -> s.live)) as bigint)").alias("n_live")
    copied = F.expr("cast(size(filter(spans, s -> not s.live)) as bigint)").alias("n_copied")
    return found.select("doc_id", *count, F.sha2(said("base").cast("binary"), 256).alias("base_sha256"), said("spans").alias("spans"), live, copied)


def _oracle() -> str:
    """The same from its definition, by joins of spans. RE2 has no look-behind: of a random-looking run the mark before is
    looked at afterwards, a token starts at a word boundary, and the mark before ``eyJ`` is matched and taken off."""
    letters = lambda w: "".join(f"[{c.upper()}{c}]" for c in w)
    words = "|".join([*map(letters, ("password", "passwd", "secret", "token")), letters("api") + "_?" + letters("key")])
    assign = rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    pattern = {k: p.replace("}+", "}").replace("*+", "*") for k, (p, _, _) in PATTERNS.items()}
    pattern["assign"], pattern["hex"], pattern["random"] = assign, "[0-9a-f]+", "[A-Za-z0-9+/_-]+"
    pattern["service"] = pattern["service"].replace("(?<![A-Za-z0-9_])", r"\b")
    pattern["jwt"] = "(?:^|[^A-Za-z0-9_-])" + pattern["jwt"].split(")", 1)[1]
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    found = "\n  UNION ALL ".join(
        f"SELECT doc_id, source, {i} AS kind, string_split_regex(text, {quote(p)}) AS p, regexp_extract_all(text, {quote(p)}) AS m, regexp_extract_all(text, {quote(p)}, {PATTERNS[k][1]}) AS g FROM documents WHERE regexp_matches(text, {quote(p)})"
        for i, (k, p) in enumerate((k, pattern[k]) for k in KINDS)
    )
    least = " ".join(f"WHEN {i} THEN {PATTERNS[k][2]}" for i, k in enumerate(KINDS))
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    said = f"string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    random, jwt, n = KINDS.index("random"), KINDS.index("jwt"), len(BASE)
    return rf"""
WITH found AS ({found}),
each AS (SELECT doc_id, source, kind, unnest(p[1:len(m)]) AS p, unnest(m) AS m, unnest(g) AS g, unnest(range(len(m))) AS i FROM found),
placed AS (SELECT *, sum(length(p) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM each),
span AS (SELECT doc_id, source, kind, stop, CASE WHEN kind = {jwt} THEN regexp_replace(m, '^[^A-Za-z0-9_-]', '') ELSE m END AS whole,
    CASE WHEN kind = {jwt} THEN regexp_replace(g, '^[^A-Za-z0-9_-]', '') ELSE g END AS secret, coalesce(p[-1:], '') AS before FROM placed),
candidate AS (SELECT doc_id, source, kind, stop - length(whole) AS start, stop, secret FROM span
  WHERE length(secret) >= CASE kind {least} END AND (kind <> {random}
    OR (before <> '=' AND regexp_matches(secret, '[0-9]') AND regexp_matches(secret, '[A-Z]') AND regexp_matches(secret, '[a-z]')))),
kept AS (SELECT c.* FROM candidate c WHERE kind < {n} OR NOT EXISTS (
  SELECT 1 FROM candidate b WHERE b.doc_id = c.doc_id AND b.kind < {n} AND b.start < c.stop AND c.start < b.stop)),
spread AS (SELECT secret, count(DISTINCT coalesce(source, '')) <= {MOST_OWNERS} AND count(DISTINCT doc_id) <= {MOST_REPOSITORIES} AS live FROM kept GROUP BY secret),
judged AS (SELECT * FROM kept JOIN spread USING (secret)),
base AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS k, count(*) FILTER (WHERE kind = 2) AS h, {said} AS said FROM judged WHERE kind < {n} GROUP BY doc_id),
accepted AS (SELECT doc_id, {said} AS said, count(*) FILTER (WHERE live) AS live, count(*) FILTER (WHERE NOT live) AS copied FROM judged WHERE kind < {n} OR live GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(b.said, '')) AS base_sha256,
  coalesce(s.said, '') AS spans, coalesce(live, 0) AS n_live, coalesce(copied, 0) AS n_copied
FROM documents d LEFT JOIN base b ON b.doc_id = d.doc_id LEFT JOIN accepted s ON s.doc_id = d.doc_id
"""


QUERIES = {"op6_secrets": op6_secrets}
ORACLE: dict[str, str] = {"op6_secrets": _oracle()}
