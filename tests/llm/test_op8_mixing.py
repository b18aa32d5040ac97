"""The schedule's windows and deviation, and the numbering against plain Python."""

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmetrics.llm.op8_mixing import exact_parts, pfair_mix, picks


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.fractions(0, 30, max_denominator=3), max_size=12))
def test_every_block_is_in_its_window_and_deviation_is_below_one_block(weights):
    parts, period = exact_parts(weights)
    assert set(parts) == {s for s, w in weights.items() if w > 0} and sum(parts.values()) == period
    total = sum(weights.values())
    assert all(Fraction(p, period) == weights[s] / total for s, p in parts.items())
    got = dict.fromkeys(parts, 0)
    plan = {slot: (s, turn) for s, turn, slot in picks(parts, period, parts)}
    assert sorted(plan) == list(range(period))
    for slot in range(period):
        s, turn = plan[slot]
        assert turn == got[s] and turn * period // parts[s] <= slot < -(-(turn + 1) * period // parts[s])
        got[s] += 1
        for x, p in parts.items():
            assert abs(got[x] - Fraction(p * (slot + 1), period)) < 1


def test_rows_fill_blocks_in_hash_order(spark):
    rows = [(i, "ab"[i % 3 == 0] if i % 11 else None, "x" * (i * 37 % 900)) for i in range(2_000)] + [(None, "a", None), (5, "b", ""), (5, "b", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash"))
    got = pfair_mix(df, {"a": 3, "b": 1, None: 1}, block_chars=5_000).collect()
    assert len(got) == len(rows)
    for s in ("a", "b", None):
        mine = sorted((r for r in got if r["source"] == s), key=lambda r: (r["block"], r["place"]))
        before = 0
        for r in mine:
            assert r["block"] * 5_000 + r["place"] == before and r["release"] <= r["slot"] < r["deadline"]
            before += r["size"]
    # blocks in the mix deviate from the weights by less than one block at every slot
    slots = {r["slot"]: r["source"] for r in got if r["in_mix"]}
    had = {"a": 0, "b": 0, None: 0}
    share = {"a": Fraction(3, 5), "b": Fraction(1, 5), None: Fraction(1, 5)}
    for t in range(max(slots) + 1):
        had[slots[t]] += 1
        assert all(abs(had[s] - share[s] * (t + 1)) < 1 for s in had)


def test_unlisted_source_comes_last_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "z", "yy")], "doc_id long, source string, text string")
    got = {r["doc_id"]: r for r in pfair_mix(df, {"a": 1}).collect()}
    assert got[2]["slot"] is None and not got[2]["in_mix"] and got[1]["slot"] == 0 and got[1]["in_mix"]
    assert pfair_mix(df.limit(0)).collect() == []


def test_deviation_from_the_unrounded_weights_stays_below_one_block(spark, monkeypatch):
    from snapmetrics.llm import op8_mixing

    monkeypatch.setattr(op8_mixing, "RANGE", 700, raising=False)  # several ranges, scheduled apart
    rows = [(i, "b" if i == 0 else "c" if i % 3 == 0 else "a", "x" * 10) for i in range(4_200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for weights in ({"a": 0.6671, "b": 0.0003, "c": 0.3326}, None):
        got = pfair_mix(df, weights, block_chars=10).collect()
        exact = {s: Fraction(w) for s, w in (weights or {s: sum(r["size"] for r in got if r["source"] == s) ** 0.5 for s in "abc"}).items()}
        share = {s: w / sum(exact.values()) for s, w in exact.items()}
        assert all(r["release"] == r["block"] // share[r["source"]] <= r["slot"] < r["deadline"] == -(-(r["block"] + 1) // share[r["source"]]) for r in got)
        assert len({r["slot"] for r in got}) == len(rows)
        mix = {r["slot"]: r["source"] for r in got if r["in_mix"]}
        had = dict.fromkeys(share, 0)
        for t in range(max(mix) + 1):
            had[mix[t]] += 1
            assert all(abs(had[s] - share[s] * (t + 1)) < 1 for s in had)
        if weights:
            assert max(mix) + 1 == -(-1 // share["b"]) > 3_300  # a source below 1/1000 is not over-weighted


def test_a_text_of_many_blocks(spark):
    rows = [(1, "a", "x" * 100_000), (2, "a", "y" * 10), (3, "a", ""), (4, "b", "z" * 50), (4, "b", "z" * 50), (5, "b", None)]
    got = pfair_mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), {"a": 2, "b": 1}, block_chars=100).collect()
    assert len(got) == len(rows) and all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    mine = sorted((r for r in got if r["source"] == "a"), key=lambda r: (r["block"], r["place"], r["size"]))
    before = 0
    for r in mine:
        assert r["block"] * 100 + r["place"] == before
        before += r["size"]
