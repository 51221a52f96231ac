"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text is cut at special tokens, normalised (NFC, white space runs to one space,
lower case), split into pieces by the tokenizer file's pattern, and each piece's
UTF-8 bytes become symbols, the last one carrying the word-end suffix. The pieces
are then merged: a segment tree holds the rank of every adjacent pair, its root
yields the lowest rank and the descent to the left child on ties the leftmost such
pair; a merge changes three leaves, each a logarithmic update, and the loop ends
when the root holds no rank.

The vocabulary file (parameter ``vocab_path``) is read where the work runs: at the
same path on every executor, as an installed package.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import importable, map_arrow, table

# Bytes of encoded pieces kept by one Python worker, and what a piece takes beside its characters.
CACHE_BYTES = 200_000_000
# The same for rows of token ids, whose batches take more memory themselves.
TOKENS_CACHE_BYTES = 40_000_000
PIECE_BYTES = 200
NO_RANK = 1 << 60


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next code point from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PairTree:
    """Segment tree of pair ranks: minimum at the root, leftmost minimum by descent."""

    __slots__ = ("node", "size")

    def __init__(self, ranks: list[int]):
        size = 1 << (len(ranks) - 1).bit_length()
        level = ranks + [NO_RANK] * (size - len(ranks))
        levels = [level]
        while len(level) > 1:
            level = list(map(min, level[::2], level[1::2]))
            levels.append(level)
        self.size = size
        self.node = [NO_RANK]
        for level in reversed(levels):
            self.node += level

    def lowest(self) -> int:
        """Position of the leftmost lowest rank, -1 if no pair can merge."""
        node, size = self.node, self.size
        low = node[1]
        if low == NO_RANK:
            return -1
        i = 1
        while i < size:
            i += i
            if node[i] != low:
                i += 1
        return i - size

    def put(self, at: int, rank: int) -> None:
        node = self.node
        i = at + self.size
        if node[i] == rank:
            return
        node[i] = rank
        while i > 1:
            other = node[i ^ 1]
            if other < rank:
                rank = other
            i >>= 1
            if node[i] == rank:
                return
            node[i] = rank


class _Pieces(dict):
    """Ids and tokens of pieces met, each a line; two generations, so that frequent pieces stay."""

    def __init__(self, codec: BpeCodec, cache_bytes: int):
        super().__init__()
        self.codec = codec
        self.most = cache_bytes
        self.before: dict[str, str] = {}
        self.held = 0

    def __missing__(self, piece: str) -> str:
        kept = self.before.get(piece)
        if kept is None:
            ids = self.codec.merge(piece)
            tokens = self.codec.tokens
            kept = " ".join(map(str, ids)) + "\n" + " ".join([tokens[i] for i in ids])
        size = PIECE_BYTES + len(piece) + len(kept)
        if 2 * (self.held + size) > self.most:
            self.before, self.held = dict(self), 0
            self.clear()
        if 2 * size <= self.most:
            self[piece] = kept
            self.held += size
        return kept


class BpeCodec:
    """Encoder and decoder of a tokenizer file of kind BPE with word ends."""

    def __init__(self, vocab_path: str, cache_bytes: int = CACHE_BYTES):
        with open(vocab_path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.ids.items()}
        self.rank_of: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.rank_of.setdefault((self.ids[a], self.ids[b]), rank)
            self.merged.append(self.ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        symbols = byte_symbols()
        self.byte_id = [self.ids[c] for c in symbols]
        self.last_byte_id = [self.ids[c + self.suffix] for c in symbols]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pieces_of = regex.compile(split["pattern"]["Regex"]).findall
        self.spaces = regex.compile(r"\s+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.cache_bytes = cache_bytes
        self.known = _Pieces(self, cache_bytes)

    def forget(self) -> None:
        """Drop the cached pieces."""
        self.known = _Pieces(self, self.cache_bytes)

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece."""
        data = piece.encode("utf-8")
        symbol = [self.byte_id[b] for b in data]
        symbol[-1] = self.last_byte_id[data[-1]]
        n = len(symbol)
        if n == 1:
            return symbol
        rank_of = self.rank_of.get
        tree = PairTree([rank_of(p, NO_RANK) for p in zip(symbol, symbol[1:])])
        put, node = tree.put, tree.node
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (rank := node[1]) != NO_RANK:
            at = tree.lowest()
            gone = after[at]
            merged = symbol[at] = self.merged[rank]
            symbol[gone] = -1
            right = after[at] = after[gone]
            if right < n:
                before[right] = at
                put(gone, NO_RANK)
                put(at, rank_of((merged, symbol[right]), NO_RANK))
            else:
                put(at, NO_RANK)
            left = before[at]
            if left >= 0:
                put(left, rank_of((symbol[left], merged), NO_RANK))
        return [i for i in symbol if i >= 0]

    def folded(self, text: str) -> str:
        """The text in NFC and lower case; its white space stays, no piece holds any."""
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        # lower case by code point: no final sigma
        return text.replace("Σ", "σ").lower()

    def normalise(self, text: str) -> str:
        return self.spaces.sub(" ", self.folded(text))

    def encoded(self, text: str | None) -> tuple[int, str, str]:
        """Number of tokens, ids joined by a space, and the decoded text."""
        found: list[str] = []
        for part in self.specials.split(text) if text and any(s in text for s in self.special) else (text or "",):
            if part in self.special:
                found.append(f"{self.special[part]}\n{part}")
            else:
                found += map(self.known.__getitem__, self.pieces_of(self.folded(part)))
        if not found:
            return 0, "", ""
        lines = "\n".join(found).split("\n")
        ids = " ".join(lines[::2])
        return ids.count(" ") + 1, ids, " ".join(lines[1::2])

    def encode(self, text: str | None) -> list[int]:
        ids = self.encoded(text)[1]
        return [int(i) for i in ids.split(" ")] if ids else []

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a space, as for a file without a decoder; ids that it lacks are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@lru_cache(maxsize=2)
def codec(vocab_path: str, cache_bytes: int = CACHE_BYTES) -> BpeCodec:
    return BpeCodec(vocab_path, cache_bytes)


def default_vocab() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def bpe_encode(docs: DataFrame, vocab_path: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """``docs`` with an array<int> column of token ids; a null text has none (empty array).

    One pass without a shuffle; rows keep their other columns. Empty texts give an
    empty array, repeated rows equal arrays, long texts are encoded whole.
    """
    importable(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(text: pd.Series) -> pd.Series:
        encode = codec(vocab_path).encode
        return pd.Series([encode(t) for t in text], dtype=object)

    return docs.withColumn(out_col, ids(F.col(text_col)))


def bpe_decode(docs: DataFrame, vocab_path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the decoded text of an array of ids (null array: empty text)."""
    importable(docs.sparkSession)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        decode = codec(vocab_path).decode
        return pd.Series([decode([] if i is None else list(i)) for i in ids], dtype=object)

    return docs.withColumn(out_col, text(F.col(ids_col)))


def bpe_digest(docs: DataFrame, vocab_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text: encode, then decode, in one pass.

    A null or empty text has no tokens and the digests of the empty string; repeated rows give equal rows; other
    columns are ignored; an empty table gives an empty one.
    """
    def digests(batch: pa.RecordBatch) -> dict:
        c = codec(vocab_path)
        rows = [c.encoded(t) for t in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "n_tokens": [r[0] for r in rows],
            "ids_sha256": [hashlib.sha256(r[1].encode()).hexdigest() for r in rows],
            "decoded_sha256": [hashlib.sha256(r[2].encode()).hexdigest() for r in rows],
        }

    return map_arrow(docs.select("doc_id", "text"), digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_tokens(docs: DataFrame, vocab_path: str) -> DataFrame:
    """doc_id, source, lang, token_ids, n_tokens, decoded_sha256 of every row of ``docs``, in one pass.

    A null or empty text has no tokens, repeated rows equal ones; other columns are ignored; a text
    of any length is encoded whole; an empty table gives an empty one.
    """
    def tokens(batch: pa.RecordBatch) -> dict:
        c = codec(vocab_path, TOKENS_CACHE_BYTES)
        rows = [c.encoded(t) for t in batch.column("text").to_pylist()]
        return {
            **{k: batch.column(k) for k in ("doc_id", "source", "lang")},
            "token_ids": [np.fromstring(r[1], dtype=np.int32, sep=" ") if r[1] else [] for r in rows],
            "n_tokens": [r[0] for r in rows],
            "decoded_sha256": [hashlib.sha256(r[2].encode()).hexdigest() for r in rows],
        }

    return map_arrow(docs.select("doc_id", "source", "lang", "text"), tokens,
                     "doc_id long, source string, lang string, token_ids array<int>, n_tokens long, decoded_sha256 string",
                     done=lambda: codec(vocab_path, TOKENS_CACHE_BYTES).forget())


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the word BPE vocabulary."""
    return bpe_digest(table(spark, sf_dir, "documents", "doc_id", "text"), default_vocab())
