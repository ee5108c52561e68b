"""Words of many texts at once, as arrays over their bytes.

A word is a longest run of bytes outside space and 0x09-0x0D. Texts are handled in
pieces of a few megabytes, so that memory does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that array code holds at a time; one longer text is a piece of its own.
PIECE_BYTES = 2_000_000
#: Stands for a missing id in int64 arrays; it sorts after all others.
NO_ID = np.iinfo(np.int64).max

_white = np.zeros(256, bool)
_white[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_byte_value = np.random.default_rng(20240607).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_WINDOW = np.uint64(0xD6E8FEB86659FD93)
_powers = {_BASE: np.ones(1, np.uint64), _BASE_INVERSE: np.ones(1, np.uint64)}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling."""
    table = _powers[base]
    while len(table) < n:
        step = np.uint64(pow(base, len(table), 2**64))
        table = np.concatenate([table, table * step])
        if len(table) <= 1 << 22:  # the tables of outsize texts are not kept
            _powers[base] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Byte ranges of the words, and `first[d]:first[d + 1]` as the words of text d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def codes(self, *prefixes: int) -> np.ndarray | list[np.ndarray]:
        """64 bits for each word, equal for equal words; with `prefixes`, a list that goes on
        with those of the words' first so many bytes."""
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_byte_value[self.data] * _power_table(_BASE, n), out=sums[1:])
        shift = _power_table(_BASE_INVERSE, max(n, 1))[self.start]
        out = []
        for size in (0, *prefixes):
            end = np.minimum(self.end, self.start + size) if size else self.end
            value = sums[end]
            value -= sums[self.start]
            value *= shift
            out.append(mix(value + (end - self.start).astype(np.uint64)))
        return out if prefixes else out[0]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, part: np.ndarray = ~_white) -> Words:
    """The words of texts that stand one after the other in `data`; `part` tells which bytes words have."""
    if lower:
        data = _lower[data]
    inside = part[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        starts, ends = offsets[:-1], offsets[1:]
        before[starts[starts < len(data)]] = False
        after[ends[ends > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """64 bits for each `size` consecutive codes; windows over text borders included."""
    n = max(0, len(codes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= _WINDOW
        out += codes[k : k + n]
    return mix(out)


def window_starts(first: np.ndarray, size: int, n_windows: int) -> np.ndarray:
    """True for the windows that lie within one text."""
    room = np.zeros(n_windows, bool)
    lengths = np.diff(first)
    # the last size - 1 words of each text start no window
    mark = np.zeros(n_windows + 1, np.int32)
    whole = np.flatnonzero(lengths >= size)
    mark[first[whole]] += 1
    mark[np.minimum(first[whole + 1] - size + 1, n_windows)] -= 1
    np.greater(np.cumsum(mark[:-1]), 0, out=room)
    return room


def as_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, index, body = column.buffers()
    offsets = np.frombuffer(index, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `size` bytes each; every text is in one."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = to


def ids(column) -> np.ndarray:
    """An id column as int64, null as NO_ID."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def id_column(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == NO_ID)
