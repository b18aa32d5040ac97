"""Ids against the tokenizers library and against plain merging; round trips; odd rows."""

import hashlib
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapmetrics.llm.op12_bpe import bpe_decode, bpe_encode, coder, op12_bpe

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return coder(f.read())


def ids_of(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_every_token_is_its_own_encoding(own):
    v = own.vocabulary
    ids = [i for i in range(len(v.tokens)) if i not in v.special.values()]
    for i in ids:
        merged = v.by_merging(v.tokens[i])
        assert own.piece(v.tokens[i]) == merged and (v.tokens[i].decode("latin-1") in own.automaton) == (merged == [i])


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(library, own, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(own, text) == want
    assert own.decode(packed(want)) == library.decode(want, skip_special_tokens=False) == text


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aeinorst th\n'sl09 -<|>éüñ\x85　", max_size=200))
def test_near_words_equal_the_library_and_merging(library, own, text):
    assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids
    data = text.encode()
    if data:
        assert own.piece(data) == own.vocabulary.by_merging(data)


def test_code_points_split_as_in_the_library(library, own):
    for shape, step in (("a{}1 {}", 3), ("{}a  {}!", 17)):
        points = [shape.format(chr(c), chr(c)) for c in range(0, 0x110000, step) if not 0xD800 <= c < 0xE000]
        for i in range(0, len(points), 4_096):
            text = "\n".join(points[i : i + 4_096])
            assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids


def test_special_tokens_and_long_pieces(library, own):
    for text in ("<|endoftext|>", "a <|endoftext|> b  <|endoftext|><|endoftext|>\n", "<|endoftext|", " " * 5_000 + "x", "-" * 3_001, "ab" * 2_000 + "é" * 3_000):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own, text) == want and own.decode(packed(want)) == text
    start = time.perf_counter()
    assert own.decode(own.encode("thanatandthe" * 100_000)) == "thanatandthe" * 100_000
    assert time.perf_counter() - start < 30


def test_bytes_that_are_no_text_and_unknown_ids(library, own):
    ids = own.vocabulary.single[0xE2], own.vocabulary.single[0x28]
    assert own.decode(packed(ids)) == library.decode(list(ids), skip_special_tokens=False) == "�("
    assert own.decode(packed([4_000_000_000])) == ""


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same words"), (3, "same words"), (4, "word " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("clash"))
    done = bpe_decode(bpe_encode(df, PATH), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in done) == sorted((i or 0, t or "") for i, t in rows)
    assert bpe_encode(df.limit(0), PATH).collect() == []


def test_query_equals_the_library_over_the_whole_table(spark, library):
    got = {r["doc_id"]: r for r in op12_bpe(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
