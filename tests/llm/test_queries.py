"""Every registered training-data query on the small tables; SQL where there is one; plans without Python where asked."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry
from check_oracle import rows_of
from snapmetrics.llm.registry import MODULES, registry

SMALL = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op3_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_extract": ["page_id", "url", "text", "n_chars"],
    "op6_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op9_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op13_spelling": ["word", "form", "root", "n", "n_near", "form_n"],
}


def test_all_queries_are_registered():
    names = [n for n in registry()[0]]
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n != "pipeline"} == set(range(1, len(MODULES) + 1))
    assert set(registry()[0]) <= set(entry.queries()) and set(registry()[1]) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry()[0]))
def test_query_runs_and_equals_its_sql(spark, name):
    df = entry.queries()[name](spark, SMALL)
    assert set(CONTRACT.get(name, [])) <= set(df.columns)
    rows = df.collect()
    if name in CONTRACT and name != "op13_spelling":
        table = "pages" if name == "op5_extract" else "documents"
        assert len(rows) == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    if name in ("op6_secrets", "op10_licences"):
        plan = df._jdf.queryExecution().toString()
        assert "InArrow" not in plan and "Python" not in plan and "Pandas" not in plan
    if sql := registry()[1].get(name):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
        cur = con.execute(sql)
        columns = [d[0] for d in cur.description]
        assert sorted(columns) == sorted(df.columns) and rows_of(df.columns, rows) == rows_of(columns, cur.fetchall())
