"""Hashes of words and word runs, computed for many documents at once inside tasks.

All hashes have 64 bits. A word is hashed as a polynomial in its bytes and a run as a polynomial in
the hashes of its words, so both are differences of prefix sums, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Odd bases of the polynomials, with their inverses modulo 2**64.
_BASES = [(b, pow(b, -1, 1 << 64)) for b in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.array([b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
#: Bytes of text that are tokenised at a time, unless one document has more, and hashed at a time. A piece's
#: arrays take some 100 times its bytes.
_PIECE, _BLOCK = 256 << 10, 256 << 10


def mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each 64-bit key (the finaliser of splitmix64)."""
    keys = keys + _GOLDEN
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


_BYTES = mixed(np.arange(256, dtype=np.uint64))


class Powers:
    """Powers of a base and of its inverse, as many as were asked for so far."""

    def __init__(self, which: int):
        self.bases = _BASES[which]
        self.tables = [np.ones(1, np.uint64)] * 2

    def of(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < count:
            size = max(count, 2 * len(self.tables[0]))
            self.tables = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64) for b in self.bases]
        return self.tables[0][:count], self.tables[1][:count]


_OF_BYTES, _OF_WORDS, _OF_WORDS_TOO = Powers(0), Powers(1), Powers(2)


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Of ``values[start:end]`` for each start and end."""
    up, down = powers.of(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words(NamedTuple):
    """The words of some rows of a batch: rows from ``row`` on, ``first[i]`` to ``first[i + 1]`` being
    the words of the ``i``-th; bytes ``starts`` to ``ends`` of ``text`` are a word, and the spaces
    between the words of a row are one space each."""

    row: int
    first: np.ndarray
    hashes: np.ndarray
    text: bytes
    starts: np.ndarray
    ends: np.ndarray


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    found, at = [], 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, side="right")))
        low, high = starts[at], ends[to - 1]
        found.append(_range_hashes(_BYTES[data[low:high]], starts[at:to] - low, ends[at:to] - low, _OF_BYTES))
        at = to
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def words_of(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The words of a column of texts, in pieces of whole rows. A-Z are lower-cased if asked for."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    everything = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _PIECE, side="right")) - 1)
        data = everything[offsets[row] : offsets[to]]
        data = _LOWER[data] if lower else data
        bounds = offsets[row : to + 1] - offsets[row]
        space = _SPACE[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[bounds] = True
        first_byte, last_byte = ~space, ~space
        first_byte[1:] &= space[:-1] | begins[1:-1]
        last_byte[:-1] &= space[1:] | begins[1:-1]
        starts, ends = np.flatnonzero(first_byte), np.flatnonzero(last_byte) + 1
        kept = ~space
        kept[1:] |= ~space[:-1]
        place = np.r_[0, np.cumsum(kept)]
        text = np.where(space, np.uint8(0x20), data)[kept].tobytes()
        yield Words(row, np.searchsorted(starts, bounds), _word_hashes(data, starts, ends), text, place[starts], place[ends])
        row = to


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Of every run of ``size`` words."""
    starts = np.arange(max(0, len(words) - size + 1))
    return _range_hashes(words, starts, starts + size, _OF_WORDS)


def range_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Sixteen bytes that name the words from each start to each end."""
    return keys_of(_range_hashes(words, starts, ends, _OF_WORDS), _range_hashes(words, starts, ends, _OF_WORDS_TOO))


def keys_of(first: np.ndarray, second: np.ndarray) -> pa.Array:
    pairs = np.stack([first, second], axis=1).astype(">u8").tobytes()
    offsets = np.arange(len(first) + 1, dtype=np.int32) * 16
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(pairs)])


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Per row: distinct hashes of the runs of ``size`` words, sorted; fewer words are one run."""
    runs = run_hashes(words.hashes, size)
    for start, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if end - start >= size:
            yield np.unique(runs[start : end - size + 1])
        else:
            yield run_hashes(words.hashes[start:end], end - start) if end > start else np.zeros(0, np.uint64)


def members(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    at = np.searchsorted(of, values)
    return of[np.minimum(at, len(of) - 1)] == values


def set_key(hashes: np.ndarray) -> bytes:
    """Sixteen bytes that name a set of hashes."""
    once = mixed(hashes)
    return int(once.sum()).to_bytes(8, "big") + int(mixed(once).sum()).to_bytes(8, "big")


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, np.uint64).view(np.int64))


def long_lists(values: list[np.ndarray]) -> pa.Array:
    """One list per array."""
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), longs(flat))
