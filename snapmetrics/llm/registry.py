"""Queries of the training-data operators and their DuckDB SQL (where SQL expresses them)."""

from __future__ import annotations

import importlib

import corpus_pipeline

MODULES = ["op1_quality", "op2_decontaminate", "op3_minhash", "op4_toxicity", "op5_extract", "op6_secrets", "op7_pii", "op8_mixing", "op9_language", "op10_licences", "op11_runs", "op12_bpe", "op13_spelling"]


def registry() -> tuple[dict, dict]:
    queries, oracle = {}, {}
    for name in MODULES:
        mod = importlib.import_module(f"snapmetrics.llm.{name}")
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    queries["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        oracle["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, oracle
