"""Splitting packed cells over Arrow string buffers.

The bytes of a whole column are scanned at once: quotes by parity, brackets by depth, delimiters by mask. What is left between
the cuts becomes the child array of a list array; nothing loops over cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: What separates values wherever it stands outside quotes and brackets.
DELIMITERS = (";", "|", "\n", "\r", "\t", "；", "、", "，", "｜")
#: What separates values only between blanks.
SPACED_DELIMITERS = ("+", "/", "&", "and", "AND", "And")

_BLANKS = (0x20, 0x0B, 0x0C)
_WIDE_BLANKS = ("\u00a0", "\u3000", "\u2009", "\u202f", "\ufeff")


def _find(data: np.ndarray, needle: bytes) -> np.ndarray:
    """True where `needle` begins."""
    n = len(needle)
    if len(data) < n:
        return np.zeros(len(data), bool)
    hit = data == needle[0]
    for k in range(1, n):
        hit[: len(data) - k] &= data[k:] == needle[k]
    hit[len(data) - n + 1 :] = False
    return hit


def _spread(starts: np.ndarray, n: int) -> np.ndarray:
    """Marks `n` bytes from each start."""
    out = starts.copy()
    for k in range(1, n):
        out[k:] |= starts[: len(starts) - k]
    return out


def _previous(flag: np.ndarray) -> np.ndarray:
    """The last index at or before each byte where `flag` holds, or -1."""
    return np.maximum.accumulate(np.where(flag, np.arange(len(flag)), -1))


def _next(flag: np.ndarray) -> np.ndarray:
    """The first index at or after each byte where `flag` holds, or the length."""
    n = len(flag)
    return np.minimum.accumulate(np.where(flag, np.arange(n), n)[::-1])[::-1]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array; a null cell is an empty one."""
    column = column.cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, count=n + 1, offset=8 * column.offset) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    if column.null_count:
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        lengths = np.diff(off)
        raw = raw[np.repeat(valid, lengths)]
        off = np.concatenate([[0], np.cumsum(np.where(valid, lengths, 0))])
    return off, raw


def split_cells(column: pa.Array, tight_slash: bool = False, blank: bool = False) -> pa.LargeListArray:
    """The values of every cell, in reading order, as a list array with one list per cell.

    tight_slash: a slash separates even without blanks around it (not the one of a written-out null such as ``N/A``).
    blank: blanks separate, in a cell with no other delimiter.
    Outer blanks, the brackets of a cell that is one bracketed list, and quotes that enclose a value are removed; quotes within
    a value stay. Pieces without content are dropped; written-out nulls are kept. A null or empty cell has an empty list. A
    cell with an odd number of double quotes has no quoting; one whose brackets don't match has no nesting.
    """
    off, d = string_buffers(column)
    n, size = len(column), len(d)
    if not size:
        return pa.LargeListArray.from_arrays(pa.array(np.zeros(n + 1, np.int64)), pa.array([], pa.large_string()))
    lengths = np.diff(off)
    cell = np.repeat(np.arange(n), lengths)
    begin, end = off[:-1][cell], off[1:][cell]

    space = np.isin(d, _BLANKS)
    for w in _WIDE_BLANKS:
        b = w.encode()
        space |= _spread(_find(d, b), len(b))
    line = np.isin(d, (0x0A, 0x0D, 0x09))
    ink = ~(space | line)
    before = np.concatenate([[-1], _previous(ink)[:-1]])  # the last visible byte before this one
    after = np.concatenate([_next(ink)[1:], [size]])

    # A cell that is one bracketed list loses the outer brackets.
    visible = np.add.reduceat(np.concatenate([ink, [0]]), np.minimum(off[:-1], size)) * (lengths > 0)
    first = np.where(visible > 0, _next(ink)[np.minimum(off[:-1], size - 1)], 0)
    last = np.where(visible > 0, _previous(ink)[np.maximum(off[1:] - 1, 0)], 0)

    def within(inside: np.ndarray) -> np.ndarray:
        """A running count that starts anew in each cell; inclusive."""
        total = np.cumsum(inside)
        return total - np.where(begin > 0, total[begin - 1], 0)

    quote = d == 0x22
    even = np.bincount(cell, quote, n) % 2 == 0
    quote &= even[cell]
    at = within(quote)
    quoted = ((at % 2) == 1) | quote
    depth_in = within(np.where(quoted, 0, (d == 0x5B).astype(np.int8) - (d == 0x5D).astype(np.int8)))
    opens = (visible > 1) & (d[first] == 0x5B) & (d[last] == 0x5D)
    zero = (depth_in == 0) & ~quoted
    closes = _next(zero & (d == 0x5D))[first]  # where the first bracket is closed
    listed = opens & (closes == last)
    outer = np.zeros(size, bool)
    outer[first[listed]] = outer[last[listed]] = True

    # Single quotes enclose values only in such a list, beside a bracket or a comma.
    tick = (d == 0x27) & listed[cell] & ~quoted
    edge = outer | (d == 0x2C) | (d == 0x3B)
    tick &= (edge[np.maximum(before, 0)] & (before >= begin)) | (edge[np.minimum(after, size - 1)] & (after < end))
    tick &= (np.bincount(cell, tick, n) % 2 == 0)[cell]
    quoted |= ((within(tick) % 2) == 1) | tick

    live = ~quoted & ~outer
    up = live & ((d == 0x28) | (d == 0x5B) | (d == 0x7B))
    down = live & ((d == 0x29) | (d == 0x5D) | (d == 0x7D))
    up |= live & _find(d, "（".encode())
    down |= live & _find(d, "）".encode())
    nest = within(up.astype(np.int8) - down.astype(np.int8))
    low = np.zeros(n, np.int64)
    filled = np.flatnonzero(lengths > 0)
    low[filled] = np.minimum.reduceat(nest, off[:-1][filled])
    final = np.where(lengths > 0, nest[np.maximum(off[1:] - 1, 0)], 0)
    sound = (low >= 0) & (final == 0)
    live &= ~(((nest > 0) | down) & sound[cell])

    cut = np.zeros(size, bool)
    for x in DELIMITERS:
        b = x.encode()
        cut |= _spread(_find(d, b) & live, len(b))
    blank_next = np.concatenate([(space | line)[1:], [True]])
    blank_next[np.maximum(off[1:][lengths > 0] - 1, 0)] = True
    # A comma separates before a blank, at the cell's end and beside a quote; elsewhere it is part of a number or a name.
    beside = (quote | tick)[np.maximum(before, 0)] & (before >= begin) | (quote | tick)[np.minimum(after, size - 1)] & (after < end)
    comma = (d == 0x2C) & live
    cut |= comma & (blank_next | beside | listed[cell] & beside)
    blank_before = np.concatenate([[True], (space | line | cut)[:-1]])
    for x in SPACED_DELIMITERS:
        b = x.encode()
        hit = _find(d, b) & live & blank_before
        stop = np.minimum(np.arange(size) + len(b) - 1, size - 1)
        hit &= blank_next[stop] & (begin < np.arange(size)) & (stop + 1 < end)
        cut |= _spread(hit, len(b))
    if tight_slash:
        upper = d & 0xDF
        slash = (d == 0x2F) & live
        null = np.zeros(size, bool)
        if size > 2:
            null[1:-1] = slash[1:-1] & (upper[:-2] == 0x4E) & (upper[2:] == 0x41)
        cut |= slash & ~null
    if blank:
        plain = np.bincount(cell, cut | outer | quoted, n) == 0
        cut |= space & live & plain[cell]

    # Children: runs between cuts, without outer blanks and enclosing quotes.
    keep = ~(cut | outer)
    start = keep & np.concatenate([[True], ~keep[:-1] | (cell[1:] != cell[:-1])])
    run = np.cumsum(start) - 1
    solid = keep & ink
    if not solid.any():
        return pa.LargeListArray.from_arrays(pa.array(np.zeros(n + 1, np.int64)), pa.array([], pa.large_string()))
    where = np.flatnonzero(solid)
    runs = run[where]
    lead = np.concatenate([[True], runs[1:] != runs[:-1]])
    lo = where[lead]
    hi = where[np.concatenate([np.flatnonzero(lead)[1:] - 1, [len(where) - 1]])]
    marks = quote | tick
    paired = marks[lo] & marks[hi] & (hi > lo) & (d[lo] == d[hi])
    # The quotes enclose the value only if the first is not closed before the last.
    total = np.cumsum(quoted & ~marks | marks)
    paired &= total[hi] - total[lo] == hi - lo
    lo, hi = lo + paired, hi - paired
    lo = np.where(paired & (lo <= hi), np.minimum(_next(ink)[np.minimum(lo, size - 1)], hi + 1), lo)
    hi = np.where(paired & (lo <= hi), _previous(ink)[hi], hi)  # blanks just inside the quotes
    full = hi >= lo
    lo, hi = lo[full], hi[full]
    owner = cell[lo]
    change = np.zeros(size + 1, np.int8)
    change[lo] += 1
    change[hi + 1] -= 1
    data = d[np.cumsum(change[:-1]).astype(bool)]
    child = np.concatenate([[0], np.cumsum(hi - lo + 1)]).astype(np.int64)
    items = pa.LargeStringArray.from_buffers(len(lo), pa.py_buffer(child.tobytes()), pa.py_buffer(data.tobytes()))
    lists = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(lists), items)


def flatten_lists(lists: pa.LargeListArray, least: int = 1) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Parent index, position and value of every item of the lists with `least` or more items."""
    off = lists.offsets.to_numpy()
    counts = np.diff(off)
    parent = np.repeat(np.arange(len(counts)), counts)
    position = np.arange(off[-1] - off[0]) - np.repeat(off[:-1] - off[0], counts)
    chosen = counts[parent] >= least if len(parent) else np.zeros(0, bool)
    return parent[chosen], position[chosen].astype(np.int32), lists.flatten().filter(pa.array(chosen))
