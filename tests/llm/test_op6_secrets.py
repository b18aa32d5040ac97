"""Base spans against plain finditer, ownership, and odd tables."""

import random
import re
import time

import duckdb
from pyspark.sql import functions as F

from snapmetrics.llm.op6_secrets import KINDS, MOST_REPOSITORIES, ORACLE, op6_secrets, secret_spans

BASE = [
    (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
    (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
    (r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
]
PARTS = ["password", "PASSWD", "token", "api_key", "ApiKey", "secret", "=", ":", " ", '"', "'", "abcdefgh", "a1", "AKIA", "ABCDEFGHIJKL", "é", "\U0001f600", "\n", "0123456789abcdef" * 2, "=="]
RANDOM = "Zx9" + "aB3dE5" * 5


def brute(text):
    found = [(m.start(), k, m.end()) for k, (p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m)]
    return sorted(found)


def test_base_spans_equal_plain_matching(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(600)] + [None, "", "token=secret:abcdefgh", "AKIAAKIA" + "X" * 9]
    rows = [(i, t, f"o{i}") for i, t in enumerate(texts)]
    got = secret_spans(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == brute(texts[r["doc_id"]]), repr(texts[r["doc_id"]])


def test_widely_copied_strings_are_no_extra_spans(spark):
    example = "Yy8" + "cD4fG6" * 5
    rows = [(i, f"see {example} here", f"owner{i}") for i in range(6)] + [(10, f"key {RANDOM} end", "me"), (11, f"key {RANDOM} end", "me")]
    rows += [(11, f"key {RANDOM} end", "me"), (None, f"key {RANDOM}", None), (13, None, "me")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("spans", F.lit("clash")).withColumn("secret", F.lit(1))
    got = secret_spans(df).collect()
    assert len(got) == len(rows)
    for r in got:
        kinds = [KINDS[s["kind"]] for s in r["spans"]]
        assert kinds == (["random"] if r["doc_id"] in (10, 11, None) else [])
    assert secret_spans(df.limit(0)).collect() == []


LOOSE = [
    "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "MIIEpAIBAAKCAQEA" * 3, "ghp_" + "aZ09" * 9, "xoxb-" + "12ab-" * 4, "glpat-" + "x_Y9-" * 5, "AIza" + "Sy0" * 11 + "xy",
    "sk_live_" + "4eC39HqL" * 3, "eyJ" + "hbGciOi_" * 2 + "." + "eyJzdWIi" * 2 + "." + "SflKxwRJ-" * 2, "Qw7" + "rT5yU8" * 5, "Qw7" + "rT5yU9" * 5, "only-small-letters-in-a-run-of-words", "_", "-", ".", "\t",
]


def test_all_spans_equal_the_definition(spark, tmp_path):
    """Generated texts through Spark and through the SQL of the definition: overlaps, copies, owners and repositories."""
    rng = random.Random(8)
    texts = ["".join(rng.choices(PARTS + 2 * LOOSE, k=rng.randint(0, 25))) for _ in range(500)] + [None, ""]
    texts += [f"note {i} AKIA{i:04d}EXAMPLEKEY00 and Zz1" + "kL3mN5" * 5 for i in range(30)]
    rows = [(i, t, None if i % 50 == 3 else f"owner{i % 7 if i % 2 else 0}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in op6_secrets(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(ORACLE["op6_secrets"]).fetchall()
    assert got == sorted(want)
    kinds = {s.split(":")[0] for r in got for s in r[5].split(",") if s}
    assert kinds == set(KINDS) and any(r[7] for r in got)


def test_a_secret_in_many_repositories_of_one_owner_is_an_example(spark):
    few, many = "Aa1" + "bC3dE5" * 5, "Zz9" + "yX8wV7" * 5
    rows = [(i, f"see {many} there", "one") for i in range(MOST_REPOSITORIES + 1)] + [(100 + i, f"see {few}", "one") for i in range(MOST_REPOSITORIES)]
    got = secret_spans(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["doc_id"] for r in got if r["spans"]} == set(range(100, 100 + MOST_REPOSITORIES))


def test_long_text_of_many_candidates_and_long_key(spark):
    rng = random.Random(2)
    hexes = " ".join(f"{rng.getrandbits(128):032x}" for _ in range(30_000))
    loose = " ".join(f"Zx9{'aB3dE5' * 4}{i}" for i in range(30_000))
    key = "-----BEGIN PRIVATE KEY-----\n" + "MIIEvQ+/" * 20_000 + "\n-----END PRIVATE KEY-----"
    start = time.perf_counter()
    (r,) = secret_spans(spark.createDataFrame([(1, f"{hexes} {loose}\n{key}", "o")], "doc_id long, text string, source string")).collect()
    assert time.perf_counter() - start < 60  # seconds; comparing each with each takes many minutes
    assert len(r["base"]) == 30_000 and [s["end"] - s["start"] for s in r["spans"] if KINDS[s["kind"]] == "private_key"] == [len(key)]
    assert sum(KINDS[s["kind"]] == "random" for s in r["spans"]) >= 30_000
