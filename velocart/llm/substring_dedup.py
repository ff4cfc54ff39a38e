"""Repeated passages found by recompression.

Rounds name runs and then pairs of neighbouring symbols, the words at first.
A name is a hash of what it replaces, so it is the same everywhere without a
dictionary; whether two neighbours become a pair is decided by a bit of each
one's name. So a passage gets the same symbols wherever it stands, but for
some at its ends. With one round of runs (of exactly two) and three of pairs a
symbol covers at most 16 words, and at most 2 + 2 + 4 + 8 = 16 words at either
end of a passage can be named otherwise: the symbol over the middle word of a
window of 35 is the same in all its occurrences, as are the words that all
windows with their middle in that symbol have in common. Every symbol is dealt
out by a hash of its name and those words (20 at least). Symbols that occur
once rule out their windows; for shared ones the whole windows with their
middle in the symbol are hashed, dealt out and compared in a second pass.

A task resolves what it meets twice itself and sends each different hash once,
so a passage that stands in a third of all texts is no hot key.

Defined results: a null text has no words, and an empty kept text; repeated
rows are different documents, so their windows repeat; null ids are kept as
they are; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocart.llm.store import located, slices, stored
from velocart.llm.words import Words, group_slices, mix, span_hashes, split_words, text_chunks

#: Words of a window. The rounds below leave the middle word's symbol certain for this width or more.
WIDTH, HALF = 35, 17
PAIR_ROUNDS = 3
#: Bytes of text between two flushes of a task's entries.
FLUSH = 24 << 20

_U = np.uint64
_A, _B, _RUN = _U(0x9FB21C651E98DF25), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_SEEDS = [_U(s) for s in (0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD)]


def recompress(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, first word and number of words of each symbol; symbols never cross texts."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    name, start, size = h.copy(), np.arange(len(h)), np.ones(len(h), np.int64)
    if len(h) < 2:
        return name, start, size

    def merge(at: np.ndarray, new: np.ndarray) -> None:
        """Replace symbols at and at + 1 by one."""
        nonlocal name, start, size
        name[at] = new
        size[at] += size[at + 1]
        left = np.ones(len(name), bool)
        left[at + 1] = False
        name, start, size = name[left], start[left], size[left]

    same = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    alone = same.copy()
    alone[1:] &= ~same[:-1]
    alone[:-1] &= ~same[1:]
    at = np.flatnonzero(alone)
    merge(at, mix(name[at] * _RUN))
    for seed in _SEEDS[:PAIR_ROUNDS]:
        right = (mix(name ^ seed) >> _U(63)).astype(bool)
        at = np.flatnonzero(~right[:-1] & right[1:] & (text[start[:-1]] == text[start[1:]]))
        merge(at, mix(name[at] * _A + name[at + 1] * _B))
    return name, start, size


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols that hold the middle word of a window: hash, text, number in the text, first and last middle word."""
    h = words.hashes()
    name, start, size = recompress(h, words.first)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))[start]
    number = np.arange(len(start)) - np.searchsorted(start, words.first)[text]
    begin, end = words.first[text], words.first[text + 1]
    from_, to = start + size - 1 - HALF, start + HALF + 1  # words common to all windows with their middle here
    ok = np.flatnonzero((from_ >= begin) & (to <= end) & (end - begin >= WIDTH))
    key = mix(span_hashes(h, from_[ok], to[ok]) ^ name[ok])
    low = np.maximum(start, begin + HALF)[ok]
    high = np.minimum(start + size - 1, end - 1 - HALF)[ok]
    return key, text[ok], number[ok], low, high


def _pack_marks(ids: np.ndarray, text: np.ndarray, number: np.ndarray) -> bytes:
    """Numbers by text, for the texts that have any."""
    order = np.lexsort((number, text))
    used, begin = np.unique(text[order], return_index=True)
    counts = np.diff(np.append(begin, len(text)))
    head = np.array([len(used)], "<u4")
    return b"".join(x.tobytes() for x in (head, ids[used].astype("<i8"), counts.astype("<u4"), number[order].astype("<u4")))


def _unpack_marks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Id and number of each mark."""
    k = int(np.frombuffer(data, "<u4", 1)[0])
    ids, counts = np.frombuffer(data, "<i8", k, 4), np.frombuffer(data, "<u4", k, 4 + 8 * k)
    return np.repeat(ids, counts), np.frombuffer(data, "<u4", -1, 4 + 12 * k)


def _pack(key: np.ndarray, ids: np.ndarray, text: np.ndarray, number: np.ndarray, wide: bool) -> bytes:
    """Entries of one slice, in order of text and number. Narrow keys keep 32 bits: chance hits are sorted out later."""
    used, begin = np.unique(text, return_index=True)
    step = np.diff(number, prepend=0)
    step[begin] = number[begin]
    small = not len(step) or step.max() < 1 << 16
    head = np.array([len(used), len(key), wide, small], "<u4")
    kept = key if wide else (key >> _U(32)).astype("<u4")
    counts = np.diff(np.append(begin, len(key))).astype("<u4")
    return b"".join(x.tobytes() for x in (head, ids[used].astype("<i8"), counts, kept, step.astype("<u2" if small else "<u4")))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, id and number of each entry."""
    k, n, wide, small = np.frombuffer(blob, "<u4", 4).tolist()
    at = 16
    parts = []
    for kind, count in (("<i8", k), ("<u4", k), ("<u8" if wide else "<u4", n), ("<u2" if small else "<u4", n)):
        parts.append(np.frombuffer(blob, kind, count, at))
        at += parts[-1].nbytes
    ids, counts, key, step = parts
    counts = counts.astype(np.int64)
    total = np.cumsum(step, dtype=np.int64)
    before = np.concatenate([[0], total])[np.cumsum(counts) - counts]
    return key.astype(np.uint64), np.repeat(ids, counts), total - np.repeat(before, counts)


#: Kind 0: a text (id); kind 1: marks of a flush (id); kind 2: entries of a flush (id) for a slice.
ROW = "slice int, kind int, id long, doc_id long, n_words long, sha string, data binary"
_NAMES = ["slice", "kind", "id", "doc_id", "n_words", "sha", "data"]


def _rows(kind: int, slice_, id_, doc_id=None, n_words=None, sha=None, data=None) -> pa.RecordBatch:
    k = len(slice_)
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    columns = [slice_, [kind] * k, id_, doc_id, n_words, sha, data]
    return pa.RecordBatch.from_arrays([pa.nulls(k, t) if c is None else pa.array(c, t) for c, t in zip(columns, types)], _NAMES)


def _twice(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose key occurs more than once, and those that are not the first of their key."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, later


class _Sender:
    """Collects a task's entries, resolves repeats among them, and deals out the others, a flush at a time."""

    def __init__(self, n_slices: int, wide: bool):
        self.n, self.wide = n_slices, wide
        self.flush_id = TaskContext.get().partitionId() << 24
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.ids: list[np.ndarray] = []
        self.texts, self.volume = 0, 0

    def add(self, key, text, number, ids, volume: int) -> None:
        self.parts.append((key, text + self.texts, number))
        self.ids.append(ids)
        self.texts += len(ids)
        self.volume += volume

    def flush(self):
        if not self.parts:
            return
        key, text, number = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        ids = np.concatenate(self.ids)
        self.clear()
        again, later = _twice(key)
        if again.any():
            yield _rows(1, [self.flush_id % self.n], [self.flush_id], data=[_pack_marks(ids, text[again], number[again])])
        key, text, number = key[~later], text[~later], number[~later]
        blobs = [(k, _pack(key[at], ids, text[at], number[at], self.wide)) for k, at in group_slices(key, self.n)]
        yield _rows(2, [b[0] for b in blobs], [self.flush_id] * len(blobs), data=[b[1] for b in blobs])
        self.flush_id += 1


def _meet(table: pa.Table) -> pa.Table:
    """One slice: marks of the hashes that several flushes sent. Rows of other kinds pass."""
    kind = table.column("kind").to_numpy()
    through, sent = table.filter(pa.array(kind != 2)), table.filter(pa.array(kind == 2))
    if not sent.num_rows:
        return through
    parts = [_unpack(b.as_py()) for b in sent.column("data")]
    again, _ = _twice(np.concatenate([p[0] for p in parts]))
    out, at = [], 0
    for flush, (key, ids, number) in zip(sent.column("id").to_pylist(), parts):
        own = again[at : at + len(key)]
        at += len(key)
        if own.any():
            texts, code = np.unique(ids[own], return_inverse=True)
            out.append((flush, _pack_marks(texts, code, number[own])))
    marks = _rows(1, [0] * len(out), [f for f, _ in out], data=[d for _, d in out])
    return pa.concat_tables([through, pa.Table.from_batches([marks], through.schema)])


def first_pass(source: DataFrame, n_slices: int) -> DataFrame:
    """Kind 0: every text with its words and their digest; kind 1: numbers of shared symbols."""

    def run(batches):
        sender = _Sender(n_slices, False)
        for batch in text_chunks(batches, "text"):
            ids, texts = batch.column(0).to_numpy(), batch.column(2)
            words = split_words(texts, False)
            raw = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts]
            sha = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in raw]
            yield _rows(0, ids % n_slices, ids, batch.column(1), np.diff(words.first), sha)
            key, text, number, _, _ = anchors(words)
            sender.add(key, text, number, ids, batch.nbytes)
            if sender.volume > FLUSH:
                yield from sender.flush()
        yield from sender.flush()

    return source.select("id", "doc_id", "text").mapInArrow(run, ROW).groupBy("slice").applyInArrow(_meet, ROW)


def _by_text(rows: DataFrame) -> DataFrame:
    """(id, marks) of every text with marks. All texts of a flush, and so all marks of a text, meet in one group."""

    def gather(table: pa.Table) -> pa.Table:
        ids, number = (np.concatenate(x) for x in zip(*(_unpack_marks(d) for d in table.column("data").to_pylist())))
        order = np.lexsort((number, ids))
        used, begin = np.unique(ids[order], return_index=True)
        marks = [m.tobytes() for m in np.split(number[order], begin[1:])]
        return pa.table({"id": pa.array(used, pa.int64()), "marks": pa.array(marks, pa.binary())})

    return rows.filter("kind = 1").select("id", "data").groupBy("id").applyInArrow(gather, "id long, marks binary")


def second_pass(candidates: DataFrame, n_slices: int) -> DataFrame:
    """Kind 1: first words of repeated windows, of the windows with their middle in a shared symbol."""

    def run(batches):
        sender = _Sender(n_slices, True)
        for batch in text_chunks(batches, "text"):
            ids, words = batch.column(0).to_numpy(), split_words(batch.column(1), False)
            _, text, number, low, high = anchors(words)
            chosen = np.zeros(len(text), bool)
            bounds = np.searchsorted(text, np.arange(len(ids) + 1))
            for i, marks in enumerate(batch.column(2).to_pylist()):
                own = np.frombuffer(marks, "<u4")
                chosen[bounds[i] : bounds[i + 1]] = np.isin(number[bounds[i] : bounds[i + 1]], own)
            count = (high - low + 1)[chosen]
            middle = np.repeat(low[chosen] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            begin, text = middle - HALF, np.repeat(text[chosen], count)
            key = span_hashes(words.hashes(), begin, begin + WIDTH)
            sender.add(key, text, begin - words.first[text], ids, batch.nbytes)
            if sender.volume > FLUSH:
                yield from sender.flush()
        yield from sender.flush()

    return candidates.select("id", "text", "marks").mapInArrow(run, ROW).groupBy("slice").applyInArrow(_meet, ROW)


def cover(n_words: int, begins: np.ndarray) -> np.ndarray:
    """True for the words of windows that begin at ``begins``."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + WIDTH, -1)
    return np.cumsum(edge[:-1]) > 0


def strip(cut: DataFrame) -> DataFrame:
    """(id, n_removed, sha, kept) of texts (id, text, marks: first words of repeated windows)."""

    def run(batches):
        for batch in text_chunks(batches, "text"):
            words = split_words(batch.column(1), False)
            removed, sha, kept = [], [], []
            raw = words.data.tobytes()
            for i, marks in enumerate(batch.column(2).to_pylist()):
                a, b = words.first[i], words.first[i + 1]
                gone = cover(b - a, np.unique(np.frombuffer(marks, "<u4")).astype(np.int64))
                left = np.flatnonzero(~gone) + a
                text = b" ".join(raw[s:e] for s, e in zip(words.start[left].tolist(), words.end[left].tolist()))
                removed.append(int(gone.sum()))
                sha.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode("utf-8", "replace"))
            columns = [batch.column(0), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_removed", "sha", "kept"])

    return cut.select("id", "text", "marks").mapInArrow(run, "id long, n_removed long, sha string, kept string")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256, and kept_text where words were removed (else null)."""
    n_slices = slices(docs.sparkSession)
    source = located(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "text": F.col(f"`{text}`").cast("string")}, "passages-docs")
    # the id of a row is a hash of its place, which tells equal rows apart
    source = source.select(F.xxhash64("file", "row").alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = stored(first_pass(source, n_slices), "passages-symbols")
    candidates = stored(source.select("id", "text").join(_by_text(found), "id"), "passages-texts")
    windows = stored(second_pass(candidates, n_slices), "passages-windows")
    cut = strip(candidates.select("id", "text").join(_by_text(windows), "id"))
    base = found.filter("kind = 0").select("id", "doc_id", "n_words", F.col("sha").alias("whole"))
    return base.join(cut, "id", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("sha", "whole").alias("kept_sha256"), F.col("kept").alias("kept_text"),
    )
