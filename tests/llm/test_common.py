"""Word hashes by running polynomial against Python's split; batches keep what passes through."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm import common
from snapmetrics.llm.common import drop_stored, hash_text, map_rows, packed, stored, unpacked

SEEN: dict[bytes, int] = {}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é\U0001f600 \n\t\x0b\x0c\r\x1f\x85", max_size=120), st.sampled_from([8, 50, 1 << 20]))
def test_equal_words_have_equal_hashes_wherever_they_stand(text, piece):
    before, common._PIECE = common._PIECE, piece
    try:
        got = hash_text(text.encode())
    finally:
        common._PIECE = before
    words = text.encode().split()
    assert len(got) == len(words)
    for w, h in zip(words, got.tolist(), strict=True):
        assert SEEN.setdefault(w, h) == h


def test_different_words_have_different_hashes():
    words = [f"{a}{b}{c}" for a in range(40) for b in "abcdefghij" for c in range(60)]
    assert len(set(hash_text(" ".join(words).encode()).tolist())) == len(set(words))
    assert len(hash_text(b"")) == 0 and len(hash_text(b" \n ")) == 0 and len(hash_text(b"x" * 3_000_000 + b" y")) == 2


def test_rows_pass_through_whatever_their_columns_are_called(spark):
    df = spark.createDataFrame([(1, "a b", "k", [1, 2]), (None, None, None, None)], "doc_id long, text string, v0 string, row array<int>")
    out = T.StructType([T.StructField("n", T.LongType())])
    rows = map_rows(packed(df), lambda bias, t: (bias + len(t or ""),), ["text"], out, ["doc_id", "text", common.ROW], setup=lambda: 10)
    assert sorted(r["n"] for r in rows.collect()) == [10, 13]
    back = unpacked(rows, df)
    assert back.columns == df.columns and sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    kept = stored(back.withColumn("x", F.lit(1)), "test")
    assert kept.count() == 2
    drop_stored(kept)
