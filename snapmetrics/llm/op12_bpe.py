"""Byte-level BPE by backtracking, exact without merging.

A text's pieces (the vocabulary's split pattern) are encoded one by one. An Aho-Corasick automaton over the tokens' bytes
names the longest token at every position of a piece. From the left, the encoder takes that token if it is compatible with
the one before it, else the next shorter token that is its prefix; if none is left, the position can't be a token's end, is
closed, and the token before it is shortened. Every position closes once, so the time is linear in the piece.

Two tokens are compatible if merging the bytes of both leaves the border between them. ``compatible`` undoes the merges on
both sides of the border, latest first, and looks for a merge across it that would have come earlier; results are
kept in a table. A sequence whose neighbours are all compatible is the one that merging gives.

Decoding gathers bytes from one buffer of all tokens through a table of offsets.

The vocabulary is a file that the caller names; the driver reads it and broadcasts it (its size is that of the file, whatever
the corpus). Tokens that merging never produces are left out of the automaton. A special token in a text is encoded as such,
as the tokenizers library does by default.

Defined results: a null text counts as empty and has no ids; a null id stays null; repeated rows repeat their result; a very
long text, or one without a border, takes time and memory in proportion to its length; ids outside the vocabulary decode
to nothing and bytes that are no UTF-8 to U+FFFD; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import map_rows, table

#: Fixed value: the split pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: From the first code point that may be unassigned on.
_HIGH = re.compile("[\u0378-\U0010ffff]")
#: Pieces up to this many characters are remembered, this many pieces and pairs at a time in a worker.
SHORT, PIECES, PAIRS = 40, 400_000, 1_000_000

IDS = T.StructType([T.StructField("ids", T.BinaryType())])
TEXT = T.StructType([T.StructField("decoded", T.StringType())])


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others
    from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Token bytes by id, the two halves of every merged token, and special tokens; ids rise with the merges' priority."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        at = byte_characters()
        raw = lambda token: bytes(at[c] for c in token)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.tokens = [b""] * size
        for token, i in model["vocab"].items():
            if token not in self.special:
                self.tokens[i] = raw(token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        last = -1
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = (model["vocab"][t] for t in (a, b, a + b))
            if z <= last:
                raise ValueError("ids of merged tokens must rise with the priority of their merges")
            last = z
            self.halves[z] = (x, y)
            self.merged[x, y] = z
        singles = {self.tokens[i]: i for i in range(size) if len(self.tokens[i]) == 1 and i not in self.special.values()}
        if len(singles) < 256 or max(singles.values()) > min(self.halves, default=size):
            raise ValueError("every byte must be a token, before the merged ones")
        self.single = [singles[bytes([b])] for b in range(256)]

    def by_merging(self, data: bytes) -> list[int]:
        """The definition: the earliest merge first, from the left."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            rank, at = min((self.merged.get((a, b), 1 << 40), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)))
            if rank == 1 << 40:
                break
            ids[at : at + 2] = [rank]
        return ids


class _Pieces(dict):
    """Ids of pieces as bytes; short ones are remembered."""

    def __init__(self, coder: Coder) -> None:
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.coder.piece(piece.encode("utf-8", "replace")), "<u4").tobytes()
        if len(piece) <= SHORT:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Coder:
    def __init__(self, content: bytes) -> None:
        v = self.vocabulary = Vocabulary(content)
        self.halves, self.merged = v.halves, v.merged
        self.length = [len(t) for t in v.tokens]
        made = set(v.single)  # a merged token is reached if no earlier merge crosses its halves' border
        made.update(i for i, (a, b) in v.halves.items() if self.compatible(a, b, i))
        usable = {v.tokens[i]: i for i in made}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.shorter = [-1] * len(v.tokens)  # the longest other token that a token starts with
        for data, i in usable.items():
            self.automaton.add_word(data.decode("latin-1"), i)
            self.shorter[i] = next((usable[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in usable), -1)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces = _Pieces(self)
        self.split = regex.compile(PATTERN).findall
        self.special = v.special
        self.specials = regex.compile("|".join(map(regex.escape, sorted(v.special, key=len, reverse=True)))) if v.special else None
        sizes = np.array(self.length, np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.bytes = np.frombuffer(b"".join(v.tokens), np.uint8)

    # ------------------------------------------------------------------------------------------------ encoding
    def compatible(self, a: int, b: int, limit: int = 1 << 40) -> bool:
        """True if merging the bytes of tokens ``a`` and ``b`` (up to the merge ``limit``) keeps the border between them."""
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                return False
            if a > b:  # the left token was made later: undo its merge, its right half meets the border
                if a not in self.halves:
                    return True
                limit, a = a, self.halves[a][1]
            else:  # of equal merges the left one comes first, so one across the border precedes that on the right
                if b not in self.halves:
                    return True
                limit, b = b + 1, self.halves[b][0]

    def _judge(self, a: int, b: int) -> bool:
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.pairs[a << 32 | b] = self.compatible(a, b)
        return known

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece's bytes."""
        n, length, shorter, pairs = len(data), self.length, self.shorter, self.pairs
        longest = [-1] * n
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # a later end is a longer token
        at, token, last = 0, longest[0], -1
        if length[token] == n:
            return [token]
        out: list[int] = []
        closed = bytearray(n + 1)
        while True:
            end = at + length[token]
            fits = not closed[end]
            if fits and last >= 0:
                fits = pairs.get(last << 32 | token)
                if fits is None:
                    fits = self._judge(last, token)
            if fits:
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, longest[end]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                closed[at] = 1
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1

    def _split(self, text: str) -> list[str]:
        if text.isascii() or not any(unicodedata.category(c) == "Cn" for c in set(_HIGH.findall(text))):
            return self.split(text)
        # code points that came after this Python's Unicode: which class they have depends on the tokenizers library
        from tokenizers.pre_tokenizers import ByteLevel

        return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)]

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self._split(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, little-endian unsigned 32-bit."""
        out, at = [], 0
        for m in self.specials.finditer(text or "") if self.specials else ():
            out += [self._plain(text[at : m.start()]), self.special[m.group()].to_bytes(4, "little")]
            at = m.end()
        out.append(self._plain((text or "")[at:]))
        return b"".join(out)

    # ------------------------------------------------------------------------------------------------ decoding
    def decode(self, data: bytes | None) -> str:
        """Text of little-endian unsigned 32-bit ids."""
        ids = np.frombuffer(data or b"", "<u4")
        ids = ids[ids < len(self.length)].astype(np.int64)
        start, end = self.offsets[ids], self.offsets[ids + 1]
        sizes = end - start
        before = np.cumsum(sizes) - sizes
        where = np.arange(int(sizes.sum())) + np.repeat(start - before, sizes)
        return self.bytes[where].tobytes().decode("utf-8", "replace")


_CODERS: dict[str, Coder] = {}


def coder(content: bytes) -> Coder:
    """The coder of a vocabulary file, made once a Python worker."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(content)
    return _CODERS[key]


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def bpe_encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and ids (binary: little-endian unsigned 32-bit) of every row; ``path`` is a tokenizer file on the driver."""
    vocabulary = _vocabulary(df, path)
    return map_rows(df, lambda c, text: (c.encode(text),), [text_col], IDS, [id_col], setup=lambda: coder(vocabulary.value))


def bpe_decode(df: DataFrame, path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and decoded (the ids' text) of every row."""
    vocabulary = _vocabulary(df, path)
    return map_rows(df, lambda c, ids: (c.decode(ids),), [ids_col], TEXT, list(keep), setup=lambda: coder(vocabulary.value))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and of the text decoded from them."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe_encode(table(spark, sf_dir, "documents"), path)
    digests = encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    done = bpe_decode(digests, path, keep=("doc_id", "n_tokens", "ids_sha256"))
    return done.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {"op12_bpe": op12_bpe}
ORACLE: dict[str, str] = {}
