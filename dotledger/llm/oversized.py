"""Splitting oversized texts at natural boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dotledger.plans.session import ship_package, spread

#: The stage's limit and the overlap of consecutive pieces, in tokens.
LIMIT, OVERLAP = 150, 15
#: Counts above the least one that are tried for cuts at stronger boundaries.
MORE = 3

_IDEOGRAPH = "぀-ヿ㐀-䶿一-鿿"
_TOKEN = re.compile(rf"[{_IDEOGRAPH}]|[^\s{_IDEOGRAPH}]+")
_SENTENCE = re.compile(r"[.!?…。！？｡।؟۔]['\"”’»)\]）」』]*$")
_CLAUSE = re.compile(r"[,;:،؛，、；：–—]['\"”’»)\]）」』]*$")
_CLOSERS = re.compile(r"[)\]）」』”’»。！？，、；：]+")
_SHORT = re.compile(r"(?:\b(?:[A-Za-z]|ca|cf|vs|al|eq|fig|figs|ref|refs|no|nos|sec|tab|vol|pp|approx|dr|prof|mr|mrs|ms|st|ed|eds|resp|e\.g|i\.e|etc|bzw|z\.\s?b|d\.\s?h|vgl|abb|std|u\.\s?a|рис|см|т)|\d)\.$", re.IGNORECASE)


def tokens(text: str) -> list[tuple[int, int]]:
    """Begin and end of every token: a kana or Han character, or a longest run of others that aren't white space."""
    return [m.span() for m in _TOKEN.finditer(text)]


def boundary_strengths(text: str, spans: list[tuple[int, int]]) -> list[int]:
    """For each token the strength of a cut before it: paragraph 5, line 4 after a sentence, sentence 4, clause 3, white space 2, between ideographs 1, before closing marks 0."""
    out = [0] * len(spans)
    for k in range(1, len(spans)):
        (a, b), (c, d) = spans[k - 1], spans[k]
        gap = text[b:c]
        left = text[max(a, b - 12) : b]
        if gap.count("\n") > 1:
            out[k] = 5
        elif _CLOSERS.match(text, c, d) and not gap:
            out[k] = 0
        elif _SENTENCE.search(left) and (gap or left[-1] in "。！？｡”」』’»)）") and not (_SHORT.search(text[max(0, b - 12) : b]) and not re.match(r"\s*[A-Z]", text[b : c + 1])):
            out[k] = 3 if _SHORT.search(text[max(0, b - 12) : b]) else 4
        elif _CLAUSE.search(left):
            out[k] = 3
        else:
            out[k] = 2 if gap else 1
    return out


def choose_cuts(strengths: list[int], limit: int, overlap: int) -> list[int]:
    """Token indices at which new pieces' own content begins.

    The least count of pieces gives equal-length targets; each is moved to the strongest boundary that leaves all pieces within
    the limit, the nearest of equals. If a cut misses a sentence end, more pieces are tried, and the count with the strongest
    weakest cut is taken.
    """
    n, step = len(strengths), limit - overlap
    least = max(1, -(-(n - overlap) // step))
    if n <= limit:
        return []
    best: tuple[tuple[int, int], list[int]] | None = None
    for m in range(least, least + MORE + 1):
        length = (n + (m - 1) * overlap) / m
        cuts, last, weakest = [], overlap, 9
        for i in range(1, m):
            target = round(length + (i - 1) * (length - overlap))
            high = min(last + step, n - 1)
            low = max(n - (m - i) * step, cuts[-1] + 1 if cuts else overlap + 1)
            reach = max(1, round((length - overlap) / 2))
            low, high = max(low, min(target - reach, high)), min(high, max(target + reach, low))
            if low > high:
                break
            cut = max(range(low, high + 1), key=lambda k: (strengths[k], -abs(k - target), -k))
            weakest = min(weakest, strengths[cut])
            cuts.append(cut)
            last = cut
        if len(cuts) < m - 1 or n - (cuts[-1] - overlap) > limit:
            continue
        if best is None or (weakest, -m) > best[0]:
            best = (weakest, -m), cuts
        if weakest >= 4:
            break
    return best[1]


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, int, str]]:
    """(first token, tokens, tokens shared with the piece before, text) of every piece."""
    spans = tokens(text)
    cuts = choose_cuts(boundary_strengths(text, spans), limit, overlap)
    out = []
    for k, (begin, end) in enumerate(zip([0, *cuts], [*cuts, len(spans)])):
        shared = overlap if k else 0
        first = begin - shared
        out.append((first, end - first, shared, text[spans[first][0] : spans[end - 1][1]] if spans else ""))
    return out


def split_oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Rows (key, piece_no, pieces, first_token, token_count, shared_tokens, piece) of every text with more than `limit` tokens.

    Pieces have at most `limit` tokens; each begins with the last `overlap` tokens of the one before. Texts within the limit,
    null and empty ones give no row; stored counts aren't read. One task may hold a long text, which is scanned once. No shuffle.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    ship_package(df.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pieces = split_text(t, limit, overlap)
                if len(pieces) > 1:
                    rows += [(k, i, len(pieces), *p) for i, p in enumerate(pieces)]
            if rows:
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [key, "piece_no", "pieces", "first_token", "token_count", "shared_tokens", "piece"])

    long = df.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("t")).filter(F.length("t") > limit)
    return spread(long).mapInArrow(split, f"`{key}` bigint, piece_no int, pieces int, first_token int, token_count int, shared_tokens int, piece string")
