"""Byte-level BPE encoding with a public vocabulary, and the encoding of a whole corpus.

A word's merges run over a contiguous array of part boundaries and the ranks of adjacent pairs: the least rank is searched, its
boundary deleted and the two neighbouring ranks looked up anew. Words longer than `LONG` bytes keep their pairs in a heap, which
gives the same merges.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from dotledger.plans.session import ship_package, spread

#: Where the public vocabulary files are; pass another place to the functions below if it differs.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes from which a word's pairs are kept in a heap.
LONG = 96
#: Remembered pieces of a worker and their greatest length; beyond it the memory starts afresh.
MEMO, MEMO_CHARS = 150_000, 120

_NO_RANK = 1 << 30


class Encoder:
    """Encodes text by the ranks of a vocabulary file (base64 token and rank on each line)."""

    def __init__(self, vocabulary: bytes):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in vocabulary.splitlines() if line)}
        self._words = regex.compile(PATTERN).findall
        self._irregular = re.compile(r" \s").search
        self._memo: dict[str, tuple[int, ...]] = {}

    def word(self, data: bytes) -> tuple[int, ...]:
        """The ids of one word."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return (whole,)
        if len(data) > LONG:
            return self._long(data)
        bounds = list(range(len(data) + 1))
        pairs = [ranks.get(data[k : k + 2], _NO_RANK) for k in range(len(data) - 1)]
        while pairs:
            least = min(pairs)
            if least == _NO_RANK:
                break
            k = pairs.index(least)
            del bounds[k + 1], pairs[k]
            if k < len(pairs):
                pairs[k] = ranks.get(data[bounds[k] : bounds[k + 2]], _NO_RANK)
            if k:
                pairs[k - 1] = ranks.get(data[bounds[k - 1] : bounds[k + 1]], _NO_RANK)
        return tuple(ranks[data[a:b]] for a, b in zip(bounds, bounds[1:]))

    def _long(self, data: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(data)
        after = list(range(1, n + 1))  # where the part that begins here ends; 0 once it is merged into another
        before = list(range(-1, n))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(data[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, end = heapq.heappop(heap)
            middle = after[k]
            if not middle or middle >= n or after[middle] != end:
                continue
            after[k], after[middle] = end, 0
            if end < n:
                before[end] = k
                if (r := ranks.get(data[k : after[end]])) is not None:
                    heapq.heappush(heap, (r, k, after[end]))
            if (p := before[k]) >= 0 and (r := ranks.get(data[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        out, k = [], 0
        while k < n:
            out.append(ranks[data[k : after[k]]])
            k = after[k]
        return tuple(out)

    def _piece(self, piece: str) -> tuple[int, ...]:
        out: list[int] = []
        memo = self._memo
        for w in self._words(piece):
            if (ids := memo.get(w)) is None:
                ids = self.word(w.encode("utf-8", "replace"))
                if len(w) <= MEMO_CHARS:
                    memo[w] = ids
            out.extend(ids)
        ids = tuple(out)
        if len(piece) <= MEMO_CHARS:
            if len(memo) >= MEMO:
                memo.clear()
            memo[piece] = ids
        return ids

    def extend(self, out: array, text: str) -> None:
        """Append the ids of `text`.

        Text between single spaces is encoded on its own, as no word of the pattern reaches over the space that begins the
        next one, unless a space is followed by more white space.
        """
        memo = self._memo
        if self._irregular(text):
            out.extend(self._piece(text))
            return
        head, *rest = text.split(" ")
        if head:
            out.extend(memo.get(head) or self._piece(head))
        for x in rest:
            x = " " + x
            out.extend(memo.get(x) or self._piece(x))

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        if text:
            self.extend(out, text)
        return out.tolist()


_ENCODERS: dict[int, Encoder] = {}


def encoder(vocabulary: bytes) -> Encoder:
    """The worker's encoder of this vocabulary, made once."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def _broadcast(df: DataFrame, path: str):
    """The vocabulary file, whose size (under 2 MB) doesn't depend on the data, for all executors."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 8_000_000:
        raise ValueError(f"{path} has {len(data)} bytes; vocabularies of up to 8 MB are broadcast")
    ship_package(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(data)


def _encoded(batch: pa.RecordBatch, at: int, enc: Encoder) -> tuple[np.ndarray, array]:
    out, offsets = array("i"), [0]
    for text in batch.column(at).to_pylist():
        if text:
            enc.extend(out, text)
        offsets.append(len(out))
    return np.asarray(offsets, np.int32), out


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (key bigint, ids array<int>): the ids of each text without special tokens.

    A null and an empty text have an empty list; text that spells a special token is encoded as plain text. Every row of `df`
    gives one row. No shuffle: each scanned batch is encoded where it lies, and a worker remembers the pieces that recur.
    """
    data = _broadcast(df, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(data.value)
        for batch in batches:
            offsets, ids = _encoded(batch, 1, enc)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [key, "ids"])

    return spread(df.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("text"))).mapInArrow(encode, f"`{key}` bigint, ids array<int>")


def count_tokens(df: DataFrame, key: str, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (key bigint, the columns of `keep` as strings, n_tokens bigint): each text's length in tokens; 0 for a null or empty one."""
    data = _broadcast(df, vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(data.value)
        for batch in batches:
            offsets, _ = _encoded(batch, 1, enc)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(np.diff(offsets).astype(np.int64))], [key, *keep, "n_tokens"])

    columns = [F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("text"), *(F.col(c).cast("string").alias(c) for c in keep)]
    return spread(df.select(*columns)).mapInArrow(count, ", ".join([f"`{key}` bigint", *(f"`{c}` string" for c in keep), "n_tokens bigint"]))
