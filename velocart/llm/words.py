"""Array tokenizer shared by the operators that read words.

Works on whole Arrow string columns with numpy: no per-word Python objects.
A word is a maximal run of bytes other than space and \\x09-\\x0D; words never
cross documents. Words and word windows get 64-bit hashes that depend on
their bytes alone, so every task on every executor names them alike. Two
different strings share a hash with a probability of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once: bounds the arrays of a Python worker. A
#: longer single text is handled alone and whole.
CHUNK_BYTES = 2 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = np.random.Generator(np.random.PCG64(20240501)).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_STEP = 0x9E3779B97F4A7C15
_STEP_BACK = pow(_STEP, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer: spreads every input bit over the result."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for many spans, from one running sum."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_STEP, len(values)), out=total[1:])
    back = _power(_STEP_BACK, len(values) + 1)
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of a batch of texts: byte spans in ``data``; the words of text i are first[i] .. first[i+1]-1."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return span_hashes(_TABLE[self.data], self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the n+1 offsets of the texts. Null counts as empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def split_words(texts: pa.Array, lower: bool, gap: np.ndarray = _SPACE) -> Words:
    """Split texts into words; with ``lower``, A-Z only is lower-cased. ``gap`` marks the bytes between words."""
    data, at = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = ~gap[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[at] = True
    start, end = inside.copy(), inside.copy()
    if len(data):
        start[1:] &= ~inside[:-1] | opens[1:-1]
        end[:-1] &= ~inside[1:] | opens[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(data, start, end, np.searchsorted(start, at))


def window_hashes(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside one text, and the index of each window's first word."""
    if len(h) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(len(h)) + width <= last)
    return span_hashes(h, at, at + width), at


def text_chunks(batches: Iterator[pa.RecordBatch], column: str | int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``column``, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(column if isinstance(column, int) else batch.schema.get_field_index(column)))
        begin = 0
        while begin < batch.num_rows:
            stop = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
            yield batch.slice(begin, stop - begin)
            begin = stop


def group_slices(key: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each slice 0..n-1 that has entries: the slice and the positions with ``key % n`` equal to it."""
    part = (key % _U(n)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(n + 1))
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        yield k, order[bounds[k] : bounds[k + 1]]


class Known:
    """A worker's memory of 64-bit keys: each has a slot, counted up from 0."""

    def __init__(self):
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 where unknown."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slots[at], -1)

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Slots of new, different keys, in their order."""
        slots = np.arange(len(self.keys), len(self.keys) + len(keys))
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.slots = np.insert(self.keys, at, keys[order]), np.insert(self.slots, at, slots[order])
        return slots


def grown(a: np.ndarray, n: int) -> np.ndarray:
    """``a`` with room for n entries; room doubles."""
    while n > len(a):
        a = np.resize(a, 2 * len(a))
    return a


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different values, where each first stands, and the index of each entry's value."""
    code, keys = pd.factorize(h)
    place = np.empty(len(keys), np.int64)
    place[code[::-1]] = np.arange(len(code))[::-1]
    return keys, place, code


_kept: dict[str, object] = {}


def per_worker(key: str, make):
    """What ``make`` gives, once a worker: a reused worker keeps the last, under a key made on the driver."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]
