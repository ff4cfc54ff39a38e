"""Token ids of whole texts with a public tokenizer, by array operations.

A text is cut before every space that stands between two characters other
than white space, and between an ASCII letter and a full stop or the like; no
pretokenizer rule of the supported tokenizers reaches over such a cut, so the
ids of a text are the ids of its segments in a row.
Each different segment is encoded once a worker and then looked up by hash.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from velocart.llm.words import _LOWER, _SPACE, _TABLE, Known, distinct, grown, per_worker, span_hashes, text_bytes

#: Distinct segments a worker remembers before it starts afresh.
CACHE_SEGMENTS = 1_500_000
#: The special token that stands between segments encoded together, and how many are.
MARK, TOGETHER = "<|endoftext|>", 200

# After a cut stands " " and one of these: ASCII that is not white space, or the
# first byte of a character that can't be white space (U+0085, U+00A0, U+1680,
# U+2000.. and U+3000 begin with C2, E1, E2, E3).
_GOES_ON = np.zeros(256, bool)
_GOES_ON[0x21:0x7F] = True
_GOES_ON[0xC3:0xF5] = True
_GOES_ON[[0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True


def segments(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, the offsets of all segments (one more than segments), and the first segment of each text."""
    data, at = text_bytes(texts)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        cut[1:-2] = (data[1:-1] == 0x20) & ~_SPACE[data[:-2]] & _GOES_ON[data[2:]]
        # the byte after the space must belong to the same text
        inner = at[1:-1]
        cut[inner[inner > 0] - 1] = False
        cut[1:-1] |= _LETTER[data[:-1]] & _STOP[data[1:]]
    cut[at] = True
    bounds = np.flatnonzero(cut)
    return data, bounds, np.searchsorted(bounds, at)


class Encoder:
    """Encodes Arrow string columns; ``definition`` is the JSON text of a tokenizer of the tokenizers library."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        # a tokenizer that lower-cases gives "The" and "the" the same ids
        self.folds = '"type":"Lowercase"' in definition.replace(" ", "")
        # a special token between segments keeps them apart in one call
        self.mark = self.tokenizer.token_to_id(MARK)
        self.clear()

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in a row, and how many each has."""
        if self.mark is None or "<|" in "".join(parts):
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
            lengths = np.fromiter(map(len, coded), np.int64, len(coded))
            return np.fromiter(chain.from_iterable(coded), np.int32, int(lengths.sum())), lengths
        joined = [MARK.join(parts[i : i + TOGETHER]) for i in range(0, len(parts), TOGETHER)]
        coded = [e.ids + [self.mark] for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(coded), np.int32)
        marks = np.flatnonzero(ids == self.mark)
        return ids[ids != self.mark], np.diff(marks, prepend=-1) - 1

    def clear(self) -> None:
        self.known = Known()
        # per slot the place of its ids
        self.begin, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.used = np.zeros(1 << 18, np.int32), 0

    def _remember(self, keys: np.ndarray, parts: list[str]) -> np.ndarray:
        """Encode new segments; returns their slots."""
        fresh, lengths = self._ids(parts)
        slots = self.known.add(keys)
        n = int(slots[0])
        self.begin, self.size = grown(self.begin, n + len(keys)), grown(self.size, n + len(keys))
        self.ids = grown(self.ids, self.used + len(fresh))
        self.begin[n : n + len(keys)] = self.used + np.cumsum(lengths) - lengths
        self.size[n : n + len(keys)] = lengths
        self.ids[self.used : self.used + len(fresh)] = fresh
        self.used += len(fresh)
        return slots

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, ``end_id`` after each text, and the n+1 offsets of the texts."""
        if len(self.known) > CACHE_SEGMENTS:
            self.clear()
        data, bounds, first = segments(texts)
        if self.folds and b"<|" not in data.tobytes():  # special tokens are told apart by case
            # NFC comes before Lowercase: a capital before a mark may have no composed form where the small letter has
            data = np.where(np.append(data[1:], 0) < 0x80, _LOWER[data], data).astype(np.uint8)
        keys, place, code = distinct(span_hashes(_TABLE[data], bounds[:-1], bounds[1:]))
        slots = self.known.find(keys)
        new = np.flatnonzero(slots < 0)
        if len(new):
            raw = data.tobytes()
            spans = zip(bounds[place[new]].tolist(), bounds[place[new] + 1].tolist())
            slots[new] = self._remember(keys[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
        slots = slots[code]
        size = self.size[slots]
        # output place of every segment: ids before it, plus one end id a text before it
        ends = np.concatenate([[0], np.cumsum(size)])
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        out = np.empty(int(ends[-1]) + len(texts), np.int32)
        offsets = ends[first] + np.arange(len(first))
        inside = np.arange(int(ends[-1])) - np.repeat(ends[:-1], size)
        out[np.repeat(ends[:-1] + text_of, size) + inside] = self.ids[np.repeat(self.begin[slots], size) + inside]
        out[offsets[1:] - 1] = end_id
        return out, offsets


def worker_encoder(spark: SparkSession, path: str) -> Callable[[], Encoder]:
    """The worker's encoder for the tokenizer at ``path``, which only the driver reads: tasks get its JSON
    as a broadcast of a few MB, whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    key = uuid.uuid4().hex
    return lambda: per_worker(key, lambda: Encoder(definition.value))


def pieces_of(ids: np.ndarray, offsets: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """(text, begin, end) of the pieces of at most ``longest`` ids, in order."""
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for at in range(a, b, longest):
            yield i, at, min(b, at + longest)
