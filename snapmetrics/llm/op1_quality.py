"""Quality rules by repetition coverage.

For several n-gram lengths a rolling hash runs over the words of a text (numpy, 64 bit); positions whose hash occurred
before mark their words, and the characters of marked words are the text's coverage for that length (the first
occurrence is no repetition). Repeated lines are measured likewise. A text whose coverage exceeds a length's limit is
rejected; a single repeated line, such as a header that is the footer, too, only by its share of the characters.

Defined results: a null text counts as empty; an empty text has no word, fails the base rule and is not kept; a null id
stays null; repeated rows give repeated results; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import ODD, hash_text, map_rows, table

#: Share of word characters (per cent) that duplicated n-grams may cover, published repetition rules.
NGRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Per cent of word characters on repeated lines, and of lines that repeat an earlier one.
LINE_CHARS_LIMIT, LINES_LIMIT = 20, 30
#: Symbols per 100 words.
SYMBOLS_LIMIT = 10
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

LONG = T.LongType()
SCHEMA = T.StructType(
    [T.StructField(n, LONG) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars")]
    + [T.StructField(f"dup{n}_chars", LONG) for n in NGRAM_LIMITS]
)


def repeated(h: np.ndarray, first: bool) -> np.ndarray:
    """Mask of the values that occurred before; with ``first``, of all that occur at least twice."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    mask = np.zeros(len(h), bool)
    mask[order[1:][same]] = True
    if first:
        mask[order[:-1][same]] = True
    return mask


def covered(mask: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Words inside a marked window of ``n`` words."""
    step = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(mask)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure(text: str | None) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    h = hash_text(data)
    n = len(h)
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup_lines = n_lines = dup_line_chars = 0
    for line in text.split("\n"):
        blank = sum(map(line.count, SPACES))
        if len(line) > blank:
            n_lines += 1
            if line in seen:
                dup_lines += 1
                dup_line_chars += len(line) - blank
            seen.add(line)
    repeat_words, cover = 0, dict.fromkeys(NGRAM_LIMITS, 0)
    if n > 3:
        lengths = None
        acc = h
        for k in range(2, max(NGRAM_LIMITS) + 1):
            if n < k:
                break
            acc = acc[:-1] * ODD + h[k - 1 :]  # rolls on from the hash of k - 1 words
            if k != 3 and k not in cover:
                continue
            mask = repeated(acc, first=k == 3)
            if not mask.any():
                break  # nothing longer can repeat either
            inside = covered(mask, k, n)
            if k == 3:
                repeat_words = int(inside.sum())
            if k in cover:
                if lengths is None:
                    lengths = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in data.split()), np.int64, n)
                cover[k] = int(lengths[inside].sum())
    return (n, word_chars, n_symbols, dup_lines, repeat_words, n_lines, dup_line_chars, *cover.values())


def repetition_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures of ``measure`` per row, with base_failed, reason (first rule that rejects, else null) and kept."""
    m = map_rows(df, measure, [text_col], SCHEMA, [id_col])
    hundred = F.lit(100)
    failed = (F.col("n_words") < 50) | (hundred * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rules = [
        (failed, "base"),
        (hundred * F.col("dup_line_chars") > LINE_CHARS_LIMIT * F.col("word_chars"), "line characters"),
        ((F.col("n_dup_lines") > 1) & (hundred * F.col("n_dup_lines") > LINES_LIMIT * F.col("n_lines")), "lines"),
        (hundred * F.col("n_symbols") > SYMBOLS_LIMIT * F.col("n_words"), "symbols"),
        *((hundred * F.col(f"dup{n}_chars") > top * F.col("word_chars"), f"{n} words") for n, top in NGRAM_LIMITS.items()),
    ]
    reason = F.coalesce(*[F.when(rule, F.lit(name)) for rule, name in rules])
    return m.withColumn("base_failed", failed).withColumn("reason", reason).withColumn("kept", F.col("reason").isNull())


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    return repetition_quality(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    grams = ",\n".join(
        f"w{n} AS (SELECT doc_id, pos, CASE WHEN {'count(*)' if n == 3 else 'row_number()'} OVER (PARTITION BY doc_id, lead{n}{'' if n == 3 else ' ORDER BY pos'}) > 1 AND lead{n} IS NOT NULL THEN 1 ELSE 0 END AS hit FROM\n"
        f"  (SELECT doc_id, pos, CASE WHEN pos + {n - 1} <= n THEN array_to_string(list_slice(ws, pos, pos + {n - 1}), ' ') END AS lead{n} FROM words)),\n"
        f"c{n} AS (SELECT doc_id, pos, max(hit) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside FROM w{n}),\n"
        f"s{n} AS (SELECT doc_id, sum(inside) AS n_inside, sum(inside * length(w)) AS chars FROM c{n} JOIN words USING (doc_id, pos) GROUP BY doc_id)"
        for n in (3, *NGRAM_LIMITS)
    )
    joins = "\n".join(f"LEFT JOIN s{n} ON s{n}.doc_id = d.doc_id" for n in (3, *NGRAM_LIMITS))
    dups = ",\n  ".join(f"CAST(coalesce(s{n}.chars, 0) AS BIGINT) AS dup{n}_chars" for n in NGRAM_LIMITS)
    rules = "\n    ".join(f"WHEN 100 * dup{n}_chars > {top} * word_chars THEN '{n} words'" for n, top in NGRAM_LIMITS.items())
    space = r"[\x20\x09-\x0D]"
    return f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS ws FROM documents),
words AS (SELECT doc_id, ws, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split),
{grams},
lines AS (SELECT doc_id, line, count(*) AS n, length(regexp_replace(line, '{space}', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line),
line_sums AS (SELECT doc_id, sum(n) AS n_lines, sum(n - 1) AS n_dup, sum((n - 1) * chars) AS dup_chars FROM lines GROUP BY doc_id),
measured AS (SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(d.text, '{space}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(l.n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(s3.n_inside, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(l.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(l.dup_chars, 0) AS BIGINT) AS dup_line_chars,
  {dups}
FROM split d LEFT JOIN line_sums l ON l.doc_id = d.doc_id
{joins}),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT *, CASE WHEN base_failed THEN 'base'
    WHEN 100 * dup_line_chars > {LINE_CHARS_LIMIT} * word_chars THEN 'line characters'
    WHEN n_dup_lines > 1 AND 100 * n_dup_lines > {LINES_LIMIT} * n_lines THEN 'lines'
    WHEN 100 * n_symbols > {SYMBOLS_LIMIT} * n_words THEN 'symbols'
    {rules} END AS reason, reason IS NULL AS kept FROM judged
"""


QUERIES = {"op1_quality": op1_quality}
ORACLE = {"op1_quality": _oracle()}
