"""Words, hashes and windows of Arrow text columns as numpy arrays, without a Python loop over words.

Texts of a batch are taken in slices of about a megabyte (a longer text is a
slice of its own), so that memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) | _U64(1)
_FOLDED_CODE = _BYTE_CODE.copy()
_FOLDED_CODE[65:91] = _BYTE_CODE[97:123]

#: Bytes of words: letters and digits, and every byte of a character beyond ASCII.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[48:58] = WORD_BYTE[65:91] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True
#: Bytes of tokens that white space ends.
SOLID_BYTE = np.ones(256, dtype=bool)
SOLID_BYTE[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of lines.
LINE_BYTE = np.ones(256, dtype=bool)
LINE_BYTE[10] = False

_powers: dict[str, np.ndarray] = {"up": np.ones(1, _U64), "down": np.ones(1, _U64)}


def powers(n: int, which: str) -> np.ndarray:
    have = _powers[which]
    if len(have) < n:
        size = max(n, 2 * len(have), SLICE_BYTES + 1)
        step = np.full(size, _BASE if which == "up" else _INVERSE, dtype=_U64)
        step[0] = 1
        have = _powers[which] = np.cumprod(step, dtype=_U64)
        if size > 64 * SLICE_BYTES:
            _powers[which] = have[: SLICE_BYTES + 1].copy()
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive rows of at most ``limit`` bytes, or one row."""
    data, offs = buffers(column)
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def spans(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every run of bytes for which ``inside`` holds; runs end with their row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = inside[data]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    at = offs[:-1][offs[:-1] < len(data)]
    first[at] = w[at]
    at = offs[1:][offs[1:] > 0] - 1
    last[at] = w[at]
    start = np.flatnonzero(first)
    return np.searchsorted(offs, start, "right") - 1, start, np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hash of each span of bytes; with ``fold`` ASCII capitals count as small letters."""
    total = np.zeros(len(data) + 1, _U64)
    np.cumsum((_FOLDED_CODE if fold else _BYTE_CODE)[data] * powers(len(data), "up"), dtype=_U64, out=total[1:])
    return mix((total[end] - total[start]) * powers(len(data) + 1, "down")[start] + (end - start).astype(_U64))


def window_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` consecutive codes (len(codes) - n + 1 of them)."""
    if len(codes) < n:
        return np.zeros(0, _U64)
    total = np.zeros(len(codes) + 1, _U64)
    np.cumsum(codes * powers(len(codes), "up"), dtype=_U64, out=total[1:])
    return mix((total[n:] - total[:-n]) * powers(len(codes) - n + 1, "down"))


def char_index(data: np.ndarray) -> np.ndarray:
    """Number of UTF-8 characters that begin before each byte position (one more than bytes)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
