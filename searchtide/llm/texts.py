"""Texts of an Arrow batch as flat arrays: words, lines and hashed n-grams, without a loop over texts.

A word is a run of characters other than blank and the control characters 9 to 13. All of these
are single bytes in UTF-8, so words and lines are found in the encoded text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORD = r"[^\x20\x09-\x0D]+"
#: bytes of text worked on at a time; a single longer text is worked on alone
CHUNK_BYTES = 1024 * 1024

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[10] = True
_MULTIPLIER = 0x9E3779B97F4A7C15

_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: n-grams longer than this are hashed and compared one by one
SHORT = 31


class Parts(NamedTuple):
    """Words or lines of several texts. Those of text ``i`` are ``first[i]:first[i + 1]``."""

    strings: pa.LargeStringArray
    first: np.ndarray
    starts: np.ndarray
    stops: np.ndarray


def filled(texts: pa.Array) -> pa.Array:
    """Texts with nulls as empty texts."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    return pc.fill_null(texts.cast(pa.large_string()), "")


def encoded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins (and the last ends)."""
    texts = filled(texts)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str | int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``most`` bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def split(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Parts:
    """Runs of bytes that are no separators, none of them over the border of a text."""
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=bounds[1:])
    strings = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[inside]))
    return Parts(strings, np.searchsorted(starts, offsets), starts, stops)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Parts:
    return split(data, offsets, _BLANK)


def lines_of(data: np.ndarray, offsets: np.ndarray) -> Parts:
    """Lines that are not empty."""
    return split(data, offsets, _NEWLINE)


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each character (its UTF-8 bytes as one number) of all texts, and where the characters of each text begin."""
    if len(data) == 0 or data.max() < 0x80:
        return data, offsets
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    value, inside = data[starts].astype(np.uint64), np.ones(len(starts), bool)
    for k in range(1, 4):
        byte = padded[starts + k]
        inside &= (byte & 0xC0) == 0x80
        value = np.where(inside, value * np.uint64(256) + byte, value)
    return value, np.searchsorted(starts, offsets)


def owners(first: np.ndarray) -> np.ndarray:
    """The text each part belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def numbered(strings: pa.LargeStringArray) -> tuple[np.ndarray, pa.LargeStringArray]:
    """A number for each string, equal for equal strings, and the string of each number."""
    if len(strings) == 0:
        return np.zeros(0, np.int64), strings
    coded = strings.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all else as it is."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:], dtype=total.dtype)
    return total[first[1:]] - total[first[:-1]]


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit numbers over all their bits."""
    h = hashes.astype(np.uint64)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rolled(values: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` consecutive values (one fewer for each step of ``n``)."""
    size = max(0, len(values) - n + 1)
    h = np.zeros(size, np.uint64)
    for k in range(n):
        h = h * np.uint64(_MULTIPLIER) + values[k : k + size].astype(np.uint64) + np.uint64(1)
    return h


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string: a polynomial in its bytes, from sums over all bytes at once."""
    data, offsets = encoded(strings)
    if len(offsets) < 2:
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(_MULTIPLIER, -1, 1 << 64))
    powers = np.cumprod(np.full(len(data) + 1, _MULTIPLIER, np.uint64), dtype=np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=total[1:], dtype=np.uint64)
    back = np.cumprod(np.full(len(data) + 1, inverse, np.uint64), dtype=np.uint64)
    return mixed((total[offsets[1:]] - total[offsets[:-1]]) * back[offsets[:-1]])


def eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def slice_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of each slice; all slices under 32 bytes at once."""
    lanes, size = eight(data), stops - starts
    h = np.uint64(seed) + _P5 + size.astype(np.uint64)
    at = starts.copy()
    for k in range(SHORT // 8):
        on = np.flatnonzero((size >= 8 * (k + 1)) & (size <= SHORT))
        lane = _turned(lanes[at[on]] * _P2, 31) * _P1
        h[on] = _turned(h[on] ^ lane, 27) * _P1 + _P4
        at[on] += 8
    on = np.flatnonzero(((size & 7) >= 4) & (size <= SHORT))
    lane = (lanes[at[on]] & np.uint64(0xFFFFFFFF)) * _P1
    h[on] = _turned(h[on] ^ lane, 23) * _P2 + _P3
    at[on] += 4
    for k in range(3):
        on = np.flatnonzero(((size & 3) > k) & (size <= SHORT))
        h[on] = _turned(h[on] ^ (data[at[on]].astype(np.uint64) * _P5), 11) * _P1
        at[on] += 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size > SHORT).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : stops[i]].tobytes(), seed)
    return h


def strong_hashes(strings: pa.Array, seed: int) -> np.ndarray:
    """XXH64 of each string."""
    data, offsets = encoded(strings)
    # eight bytes can be read from any place
    data = np.concatenate([data, np.zeros(9, np.uint8)])
    return slice_hashes(data, offsets[:-1], offsets[1:], seed)


def whole(first_owner: np.ndarray, n: int) -> np.ndarray:
    """Which runs of ``n`` consecutive parts lie in one text, given the text of each part."""
    size = max(0, len(first_owner) - n + 1)
    return first_owner[:size] == first_owner[n - 1 : n - 1 + size]
