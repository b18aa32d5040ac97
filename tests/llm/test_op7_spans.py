"""Base spans against plain finditer over the contract's patterns."""

import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from snapmetrics.llm.op7_pii import _LOOSE, KINDS, base_spans, candidates, personal_spans, redact, redacted, word_before


def _luhn(d):
    total = 0
    for i, c in enumerate(d[::-1]):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PATTERNS = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(re.sub("[ -]", "", s)) <= 19 and _luhn(re.sub("[ -]", "", s))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub("[^0-9]", "", s)) <= 15),
]


def brute(text):
    found = [(m.start(), m.end(), k) for k, (p, ok) in enumerate(PATTERNS) for m in re.finditer(p, text) if ok(m.group())]
    return sorted(found, key=lambda s: (s[0], s[2]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1.9@+-_ ()0%é", max_size=60))
def test_base_spans_equal_plain_matching(text):
    assert base_spans(text) == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "+1 (319) 555-5132", " ", "a.b@c.de", "@x.y", "10.0.0.255", "256.1.1.1", ".", "-", "é", "0000000001.2.3.4", "5"]), max_size=12))
def test_base_spans_of_real_forms(parts):
    assert base_spans("".join(parts)) == brute("".join(parts))


def test_long_runs_stay_linear():
    for run in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1 " * 60_000, "a@" * 60_000, "- " * 100_000, "(" * 100_000, "A1" * 100_000):
        candidates(run + " end")
    assert candidates(None) == ([], []) and candidates("") == ([], [])


def test_redaction_merges_overlaps():
    spans = [{"start": 2, "end": 6, "kind": 0}, {"start": 4, "end": 8, "kind": 3}]
    assert redact("ab1234567x", spans) == "ab[EMAIL]7x" and redact(None, spans) is None and redact("abc", []) == "abc"


def test_many_candidates_of_one_text_take_seconds():
    text = " ".join(f"a{i}@b.com 212-555-{i % 9000 + 1000} Maria Lopez" for i in range(34_000))
    start = time.perf_counter()
    base, rows = candidates(text)
    assert len(base) >= 34_000 and len(rows) > 100_000 and time.perf_counter() - start < 60


def test_looser_spans_equal_pairwise_comparison():
    rng = random.Random(4)
    parts = ["a@b.co", "4111111111111111", "212-555-1234", "Dr. Anna Lee", "jane [at] mail.com", "bob at x dot org", "+1 (319) 555-5132", "123-45-6789", "DE89370400440532013000", "ok", ","]
    for _ in range(300):
        text = rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        taken = base_spans(text)
        for a, b, k in sorted((*m.span(), k) for k, p in _LOOSE.items() for m in p.finditer(text)):
            if all(b <= x or a >= y for x, y, _ in taken):
                taken.append((a, b, k))
        assert sorted((r["start"], r["end"], r["kind"]) for r in candidates(text)[1]) == sorted(taken)


def test_proposed_names_and_written_out_addresses():
    said = lambda text: [(KINDS[r["kind"]], text[r["start"] : r["end"]]) for r in candidates(text)[1]]
    assert said("signed by Maria Lopez today") == [("name", "Maria Lopez")] and said("Dr. Who came") == [("name", "Dr. Who")]
    assert said("write jane [at] mail.com now") == [("email_words", "jane [at] mail.com")]
    assert said("bob (at) firm . org") == [("email_words", "bob (at) firm . org")] and said("x at y dot com") == [("email_words", "x at y dot com")]
    assert said("we met at school. Then home") == [] and said("maria lopez") == []
    long = "n" * 300 + " [at] " + "h" * 300 + ".com"
    assert said(long) == [("email_words", long)]


def test_word_before():
    assert word_before("Call: 5", 6) == "call" and word_before("a .... b", 7) == "" and word_before("x", 0) == "" and word_before("e-mail b", 7) == "e-mail"


def test_table_with_odd_rows(spark):
    text = "Contact Maria Lopez at maria@example.com or +1 (319) 555-5132."
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "a@b.co " * 40_000), (5, "no data")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1)).withColumn("spans", F.lit("clash")).withColumn("candidates", F.lit(2))
    got = personal_spans(df).collect()
    sizes = sorted((r["doc_id"] or 0, len(r["base"])) for r in got)
    assert sizes == [(0, 2), (1, 2), (1, 2), (2, 0), (3, 0), (4, 40_000), (5, 0)]
    assert all(r["spans"][: len(r["base"])] is not None and len(r["spans"]) >= len(r["base"]) for r in got)
    clean = {r["doc_id"]: r["text"] for r in redacted(df).collect()}
    assert "maria@example.com" not in clean[1] and clean[None] == clean[1] and clean[2] is None and clean[3] == "" and clean[5] == "no data"
    assert personal_spans(df.limit(0)).collect() == []
