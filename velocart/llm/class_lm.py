"""Language-model scores by a class-based bigram model with exchange clustering.

Words are counted over all training texts. The most frequent ``FREQUENT``
words and, for all others, ``SHAPES`` groups by word ending are units; the
units' bigrams are counted over all training texts and the exchange algorithm
assigns units to classes: it moves one unit at a time to the class that raises
the likelihood of the class bigrams most. From these classes, rounds on Spark
move every other word seen ``LEAST`` times or more, so the clustered vocabulary
grows with the texts; only rarer and unseen words keep the class of their
ending. In a round, words beside classes are counted over all training texts,
and each hash slice moves its words to the class that raises the likelihood
most while all others stay; a round that doesn't raise it is taken back.

A token's probability is the transition from the class before, smoothed
towards the class's share, times the word's share of its class. The word
shares are the smoothed unigram estimates of the base score, so the score is
the base score plus what each class transition adds.

All texts are written once, as places in the list of their chunk's different
words, bucketed by chunk; those lists, words with their counts and classes are
bucketed by hash slice. A round looks the lists up in their slices, where
nothing moves, and sends what it found to the chunks (five bytes a word of a
list), whose texts don't move either. The scores are made of the same texts.
Tables of a round are deleted when the next is written. The driver gets bigrams
of units and of classes: tables whose size the parameters bound.

Defined results: a null text is empty and scores its end token; without
training texts the base score is 0 and all classes are alike; repeated rows get equal scores; a null id
counts as the empty text in the choice of training texts; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocart.llm.store import bucketed, discard, slices, stored
from velocart.llm.words import _TABLE, Words, distinct, group_slices, span_hashes, split_words, text_chunks

#: Units clustered one by one, groups of other words, classes, and words whose counts the driver ranks.
FREQUENT, SHAPES, CLASSES, KNOWN = 2000, 256, 64, 200_000
#: Weight of a class's share against its counted transitions.
PRIOR = 50.0
ROUNDS = 4
#: Words seen so often are clustered themselves, in so many rounds on Spark.
LEAST, SPARK_ROUNDS = 5, 2
ENDING = 3
#: Bytes of text between two flushes of a task's counts, at most.
FLUSH = 24 << 20
ADD = 0.1

_U = np.uint64


def shapes(words: Words) -> np.ndarray:
    """Group of each word by its last bytes."""
    h = span_hashes(_TABLE[words.data], np.maximum(words.start, words.end - ENDING), words.end)
    return (h % _U(SHAPES)).astype(np.uint8)


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct keys, where each first stands, and the sums of their values."""
    keys, first, code = np.unique(keys, return_index=True, return_inverse=True)
    return keys, first, np.bincount(code, values, len(keys)).astype(np.int64)


def count_words(texts: DataFrame, n_slices: int) -> DataFrame:
    """(slice, keys, counts, shapes): the vocabulary, a row a slice, keys ascending; (-1, ...) rows count texts."""

    def run(batches):
        keys, counts, kinds, volume, n_texts = [], [], [], 0, 0

        def flush():
            k, first, c = _sum_by(np.concatenate(keys), np.concatenate(counts))
            s = np.concatenate(kinds)[first]
            rows = [(i, k[at].tobytes(), c[at].tobytes(), s[at].tobytes()) for i, at in group_slices(k, n_slices)]
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names)

        types, names = [pa.int32(), pa.binary(), pa.binary(), pa.binary()], ["slice", "keys", "counts", "shapes"]
        for batch in text_chunks(batches, "text"):
            words = split_words(batch.column(0), True)
            n_texts += batch.num_rows
            code, k = pd.factorize(words.hashes())
            place = np.empty(len(k), np.int64)
            place[code] = np.arange(len(code))
            keys.append(k)
            counts.append(np.bincount(code, minlength=len(k)))
            kinds.append(shapes(words)[place])
            volume += batch.nbytes
            if volume > FLUSH:
                yield flush()
                keys, counts, kinds, volume = [], [], [], 0
        if keys:
            yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([b""]), pa.array([np.int64(n_texts).tobytes()]), pa.array([b""])], names)

    def add(table: pa.Table) -> pa.Table:
        k = table.column("slice")[0].as_py()
        counts = np.concatenate([np.frombuffer(b, np.int64) for b in table.column("counts").to_pylist()])
        if k < 0:
            keys, shape, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.array([counts.sum()])
        else:
            keys = np.concatenate([np.frombuffer(b, np.uint64) for b in table.column("keys").to_pylist()])
            shape = np.concatenate([np.frombuffer(b, np.uint8) for b in table.column("shapes").to_pylist()])
            keys, first, counts = _sum_by(keys, counts)
            shape = shape[first]
        return pa.table({"slice": pa.array([k], pa.int32()), "keys": [keys.tobytes()], "counts": [counts.tobytes()], "shapes": [shape.tobytes()]})

    schema = "slice int, keys binary, counts binary, shapes binary"
    return texts.select("text").mapInArrow(run, schema).groupBy("slice").applyInArrow(add, schema)


def _bin(count: np.ndarray) -> np.ndarray:
    """Ascending bins of counts: exact to 1024, then 16 a doubling."""
    return np.where(count <= 1024, count, 1024 + np.floor(16 * np.log2(np.maximum(count, 1024) / 1024))).astype(np.int64)


def summarize(vocabulary: DataFrame) -> tuple[int, int, int, np.ndarray, np.ndarray]:
    """Tokens, distinct words, texts; keys and counts of the most frequent words (``KNOWN`` at most, most frequent first)."""

    def bins(batches):
        for batch in batches:
            for k, c in zip(*(batch.column(i).to_pylist() for i in (0, 2))):
                c = np.frombuffer(c, np.int64)
                if k < 0:
                    rows = [(0, -1, int(c.sum()), 0)]
                else:
                    b, n = np.unique(_bin(c), return_counts=True)
                    rows = [(1, x, y, 0) for x, y in zip(b.tolist(), n.tolist())]
                    rows.append((3, 0, int(c.sum()), len(c)))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], ["kind", "bin", "n", "m"])

    found = vocabulary.mapInArrow(bins, "kind long, bin long, n long, m long").groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect()
    by = {(r["kind"], r["bin"]): (r["n"], r["m"]) for r in found}
    texts = by.get((0, -1), (0, 0))[0]
    tokens, distinct = by.get((3, 0), (0, 0))
    least, taken = None, 0
    for b in sorted((b for kind, b in by if kind == 1), reverse=True):
        taken += by[(1, b)][0]
        if taken > KNOWN:
            break
        least = b

    def frequent(batches):
        for batch in batches:
            for k, keys, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if k < 0 or least is None:
                    continue
                c = np.frombuffer(c, np.int64)
                at = np.flatnonzero(_bin(c) >= least)
                keys = np.frombuffer(keys, np.uint64)[at]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in (keys, c[at])], ["keys", "counts"])

    rows = vocabulary.mapInArrow(frequent, "keys binary, counts binary").collect()
    keys, counts = (np.frombuffer(b"".join(bytes(r[c]) for r in rows), t) for c, t in (("keys", np.uint64), ("counts", np.int64)))
    order = np.lexsort((keys, -counts))
    return tokens, distinct, texts, keys[order], counts[order]


@dataclass
class Units:
    """Numbers of units: frequent words, then shapes, then the end of a text."""

    keys: np.ndarray  # ascending
    unit: np.ndarray

    @property
    def end(self) -> int:
        return len(self.keys) + SHAPES

    def of(self, h: np.ndarray, shape: np.ndarray) -> np.ndarray:
        out = len(self.keys) + shape.astype(np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            out = np.where(self.keys[at] == h, self.unit[at], out)
        return out


def with_ends(values: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """An end before the first text and after each."""
    out = np.full(len(values) + len(first), end)
    out[np.arange(len(values)) + np.repeat(np.arange(1, len(first)), np.diff(first))] = values
    return out


def count_bigrams(texts: DataFrame, units, n_slices: int) -> np.ndarray:
    """Dense unit bigram counts; at most (FREQUENT + SHAPES + 1)**2 cells reach the driver."""

    def run(batches):
        u = units.value
        n = u.end + 1
        held, size = [], 0

        def flush():
            code, _, count = _sum_by(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            rows = [(k, code[at].astype("<u4").tobytes(), count[at].astype("<i8").tobytes()) for k, at in group_slices(code.astype(np.uint64), n_slices)]
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["slice", "codes", "counts"])

        for batch in text_chunks(batches, "text"):
            words = split_words(batch.column(0), True)
            seq = with_ends(u.of(words.hashes(), shapes(words)), words.first, u.end)
            code, count = np.unique(seq[:-1] * n + seq[1:], return_counts=True)
            held.append((code, count))
            size += len(code)
            if size > 4_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def add(table: pa.Table) -> pa.Table:
        codes = np.concatenate([np.frombuffer(b, "<u4") for b in table.column("codes").to_pylist()])
        counts = np.concatenate([np.frombuffer(b, "<i8") for b in table.column("counts").to_pylist()])
        code, _, count = _sum_by(codes, counts)
        return pa.table({"slice": table.column("slice").slice(0, 1), "codes": [code.astype("<u4").tobytes()], "counts": [count.tobytes()]})

    schema = "slice int, codes binary, counts binary"
    n = units.value.end + 1
    out = np.zeros(n * n, np.int64)
    for r in texts.select("text").mapInArrow(run, schema).groupBy("slice").applyInArrow(add, schema).toLocalIterator():
        out[np.frombuffer(bytes(r["codes"]), "<u4")] = np.frombuffer(bytes(r["counts"]), np.int64)
    return out.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit; the last unit, the end of a text, keeps class 0 for itself."""
    n = bigrams.astype(np.float64)
    m = len(n)
    by_count = np.argsort(-n[:-1].sum(axis=1), kind="stable")
    of = np.zeros(m, np.int64)
    of[by_count] = 1 + np.arange(m - 1) % (classes - 1)
    one = np.zeros((m, classes))
    one[np.arange(m), of] = 1
    out_to, in_from = n @ one, n.T @ one  # of each unit, by class
    table = one.T @ out_to
    for _ in range(rounds):
        moved = 0
        for u in by_count.tolist():
            old, self_ = of[u], n[u, u]
            if not out_to[u].any() and not in_from[u].any():
                continue
            o, i = out_to[u].copy(), in_from[u].copy()
            o[old] -= self_
            i[old] -= self_
            table[old] -= o
            table[:, old] -= i
            table[old, old] -= self_
            f = _xlogx(table)
            rows, columns = _xlogx(table + o) - f, _xlogx(table + i[:, None]) - f
            corner = np.diagonal(table)
            gain = rows.sum(axis=1) + columns.sum(axis=0) - np.diagonal(rows) - np.diagonal(columns)
            gain += _xlogx(corner + o + i + self_) - _xlogx(corner)
            left, right = table.sum(axis=1), table.sum(axis=0)
            gain -= _xlogx(left + o.sum() + self_) - _xlogx(left) + _xlogx(right + i.sum() + self_) - _xlogx(right)
            gain[0] = -np.inf  # the end stays alone
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new] += o
            table[:, new] += i
            table[new, new] += self_
            if new != old:
                moved += 1
                of[u] = new
                out_to[:, old] -= n[:, u]
                out_to[:, new] += n[:, u]
                in_from[:, old] -= n[u]
                in_from[:, new] += n[u]
        if not moved:
            break
    return of


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of class bigrams, up to what the words alone decide."""
    table = table.astype(np.float64)
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def best_classes(old: np.ndarray, word: np.ndarray, side: np.ndarray, count: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Class of each word that raises the likelihood most while all others stay.

    ``word``, ``side`` and ``count`` say how often a word (a place in ``old``) stands before class ``side`` or after
    class ``side - CLASSES``. A word's own bigrams are taken out of its old class; cells where both of its sides meet
    are taken as they stand.
    """
    table = table.astype(np.float64)
    cells = np.concatenate([table.T, table])  # by side, then by the word's class
    gain = np.zeros((len(old), CLASSES))
    step = 50_000  # bounds the arrays of one step
    for a in range(0, len(word), step):
        w, c = word[a : a + step], count[a : a + step, None].astype(np.float64)
        there = cells[side[a : a + step]]
        own = np.arange(len(w)), old[w]
        there[own] = np.maximum(there[own] - c[:, 0], 0)
        np.add.at(gain, w, _xlogx(there + c) - _xlogx(there))
    for axis, at in ((1, side < CLASSES), (0, side >= CLASSES)):
        size = np.bincount(word[at], count[at], len(old))
        for a in range(0, len(old), step):
            n, mine = size[a : a + step, None], old[a : a + step]
            whole = np.tile(table.sum(axis=axis), (len(mine), 1))
            own = np.arange(len(mine)), mine
            whole[own] = np.maximum(whole[own] - n[:, 0], 0)
            gain[a : a + step] -= _xlogx(whole + n) - _xlogx(whole)
    gain[:, 0] = -np.inf  # the end stays alone
    gain[:, table.sum(axis=0) + table.sum(axis=1) == 0] = -np.inf  # an empty class would draw all words at once
    new = gain.argmax(axis=1)
    every = np.arange(len(old))
    return np.where(gain[every, new] > gain[every, old] + 1e-9, new, old)


@dataclass
class Model:
    tokens: int
    distinct: int
    texts: int
    units: Units
    keys: np.ndarray  # of the most frequent words, ascending
    counts: np.ndarray
    of: np.ndarray  # class of each unit
    bonus: np.ndarray  # log10 of a transition's probability over the class's share

    @property
    def total(self) -> float:
        return self.tokens + ADD * (self.distinct + 1)


ROW = "slice int, kind int, chunk long, begin long, ids array<bigint>, data binary, counts binary, shapes binary, classes binary"
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
_NAMES = [c.split()[0] for c in ROW.split(", ")]
#: Kinds of rows: texts as places of words, words asked for, answers, words beside classes, class bigrams.
TEXTS, ASKED, ANSWER, BESIDE, TABLE = range(5)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in zip(_NAMES, _TYPES)], _NAMES)


def sequences(docs: DataFrame, n_slices: int) -> DataFrame:
    """ROWs of ``docs`` (doc_id, text, training): texts as places in the list of their chunk's different words (with
    their numbers of words, and in ``shapes`` whether they train), and by slice the words of that list, from place
    ``begin``, with their shapes."""

    def run(batches):
        partition, number, held, volume = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            chunk = partition << 24 | number
            keys, place, code = distinct(np.concatenate([h for _, h, _, _, _ in held]))
            kinds = np.concatenate([s for _, _, s, _, _ in held])[place]
            rank, begin, asked = np.empty(len(keys), np.int64), 0, []
            for k, at in group_slices(keys, n_slices):
                rank[at] = begin + np.arange(len(at))
                asked.append({"slice": k, "kind": ASKED, "chunk": chunk, "begin": begin, "data": keys[at].tobytes(), "shapes": kinds[at].tobytes()})
                begin += len(at)
            code, at = rank[code].astype("<u4"), 0
            for ids, h, _, size, training in held:
                row = {"kind": TEXTS, "chunk": chunk, "ids": ids, "data": code[at : at + len(h)].tobytes(), "counts": size.tobytes()}
                yield _rows([row | {"shapes": training.tobytes()}])
                at += len(h)
            if asked:
                yield _rows(asked)

        for batch in text_chunks(batches, "text"):
            words = split_words(batch.column(1), True)
            training = batch.column(2).fill_null(False).to_numpy(zero_copy_only=False).astype(np.uint8)
            held.append((batch.column(0).to_pylist(), words.hashes(), shapes(words), np.diff(words.first), training))
            volume += batch.nbytes
            if volume > FLUSH:
                yield from flush()
                number, held, volume = number + 1, [], 0
        if held:
            yield from flush()

    return docs.select("doc_id", "text", "training").mapInArrow(run, ROW)


#: An answer: place in the slice (with counts wanted: how often seen; -1 and 0 if unseen), and the class, of each word asked.
ANSWERS = "chunk long, slice int, begin long, data binary, classes binary"
_ANSWERS = pa.schema([("chunk", pa.int64()), ("slice", pa.int32()), ("begin", pa.int64()), ("data", pa.binary()), ("classes", pa.binary())])


def answered(asked: DataFrame, state: DataFrame, of_shape: np.ndarray, counts: bool) -> DataFrame:
    """ANSWERS to all ASKED rows: class and count, or class and place, -1 also for words that never move."""

    def look_up(rows: pa.Table, own: pa.Table) -> pa.Table:
        own = own.to_pylist()
        keys, count, classes = (np.frombuffer(own[0][c], t) if own else np.zeros(0, t) for c, t in (("keys", np.uint64), ("counts", np.int64), ("classes", np.uint8)))
        out = []
        for r in rows.to_pylist():
            words, shape = np.frombuffer(r["data"], np.uint64), np.frombuffer(r["shapes"], np.uint8)
            found, of = np.zeros(len(words), np.int64) if counts else np.full(len(words), -1, np.int32), of_shape[shape].astype(np.uint8)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
                seen = keys[at] == words
                of = np.where(seen, classes[at], of)
                found = np.where(seen, count[at], 0) if counts else np.where(seen & (count[at] >= LEAST), at, -1).astype(np.int32)
            out.append({"chunk": r["chunk"], "slice": r["slice"], "begin": r["begin"], "data": found.tobytes(), "classes": of.astype(np.uint8).tobytes()})
        return pa.Table.from_pylist(out, _ANSWERS)

    return asked.groupBy("slice").cogroup(state.groupBy("slice")).applyInArrow(look_up, ANSWERS)


def _listed(answers: pa.Table, kind) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """The answers to a chunk in the order of its list, and what they say of each word."""
    rows = sorted(answers.to_pylist(), key=lambda r: r["begin"])
    return rows, *(np.frombuffer(b"".join(r[c] for r in rows), t) for c, t in (("data", kind), ("classes", np.uint8)))


def _texts(chunk: pa.Table) -> list[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, words as places, numbers of words and the training flags of each row of a chunk's texts."""
    return [
        (r["ids"], np.frombuffer(r["data"], "<u4"), np.frombuffer(r["counts"], np.int64), np.frombuffer(r["shapes"], np.uint8) > 0)
        for r in chunk.to_pylist()
    ]


def beside(chunks: DataFrame, answers: DataFrame, words: bool) -> DataFrame:
    """TABLE rows (class bigram in ``chunk``, count in ``begin``) and, if wanted, BESIDE rows for all words that may
    move, of the training texts of ``chunks``."""

    def count(chunk: pa.Table, told: pa.Table) -> pa.Table:
        rows, place, classes = _listed(told, np.int32)
        of_list, pairs = np.append(classes, 0).astype(np.int64), np.zeros(CLASSES**2, np.int64)
        moves, width = np.append(place >= 0, False), 2 * CLASSES
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for _, seq, size, training in _texts(chunk):
            seq, size = seq[np.repeat(training, size)], size[training]
            own = with_ends(seq, np.concatenate([[0], np.cumsum(size)]), len(place)).astype(np.int64)
            of = of_list[own]
            pairs += np.bincount(of[:-1] * CLASSES + of[1:], minlength=CLASSES**2)
            if words:
                before, after = moves[own[:-1]], moves[own[1:]]
                code = np.concatenate([own[:-1][before] * width + of[1:][before], own[1:][after] * width + CLASSES + of[:-1][after]])
                found.append(np.unique(code, return_counts=True))
        out = [{"kind": TABLE, "chunk": int(k), "begin": int(pairs[k])} for k in np.flatnonzero(pairs)]
        code, _, n = _sum_by(np.concatenate([c for c, _ in found]), np.concatenate([k for _, k in found]))
        for r in rows:
            a, b = np.searchsorted(code, [r["begin"] * width, (r["begin"] + len(r["classes"])) * width])
            if a < b:
                at = place[code[a:b] // width].astype("<u4")
                out.append({"slice": r["slice"], "kind": BESIDE, "data": at.tobytes(), "classes": (code[a:b] % width).astype(np.uint8).tobytes(), "counts": n[a:b].astype("<u4").tobytes()})
        return pa.Table.from_batches([_rows(out)])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(count, ROW)


def class_table(counted: DataFrame) -> np.ndarray:
    """Bigrams of classes: at most CLASSES**2 cells reach the driver."""
    out = np.zeros(CLASSES**2, np.int64)
    for r in counted.filter(F.col("kind") == TABLE).groupBy("chunk").agg(F.sum("begin").alias("n")).collect():
        out[r["chunk"]] = r["n"]
    return out.reshape(CLASSES, CLASSES)


STATE = "slice int, keys binary, counts binary, shapes binary, classes binary"


def seeded(vocabulary: DataFrame, units: Units, of: np.ndarray) -> DataFrame:
    """The vocabulary with the class of each word's unit."""

    def run(batches):
        for batch in batches:
            for k, keys, counts, shape in zip(*(batch.column(i).to_pylist() for i in range(4))):
                classes = of[units.of(np.frombuffer(keys, np.uint64), np.frombuffer(shape, np.uint8))].astype(np.uint8)
                yield pa.RecordBatch.from_pylist([{"slice": k, "keys": keys, "counts": counts, "shapes": shape, "classes": classes.tobytes()}], _STATE)

    return vocabulary.filter("slice >= 0").mapInArrow(run, STATE)


_STATE = pa.schema([("slice", pa.int32()), *((c, pa.binary()) for c in ("keys", "counts", "shapes", "classes"))])


def moved(state: DataFrame, counted: DataFrame, table: np.ndarray, units: Units) -> DataFrame:
    """The state after one round: each slice moves its words seen ``LEAST`` times, except those clustered one by one."""

    def move(own: pa.Table, near: pa.Table) -> pa.Table:
        if not len(own):
            return own
        own = own.to_pylist()[0]
        classes = np.frombuffer(own["classes"], np.uint8).astype(np.int64)
        place, side, count = (np.frombuffer(b"".join(near.column(c).to_pylist()), t) for c, t in (("data", "<u4"), ("classes", np.uint8), ("counts", "<u4")))
        code, _, count = _sum_by(place.astype(np.int64) * 2 * CLASSES + side, count)
        free = ~np.isin(np.frombuffer(own["keys"], np.uint64), units.keys)
        at = free[code // (2 * CLASSES)]
        code, count = code[at], count[at]
        words, word = np.unique(code // (2 * CLASSES), return_inverse=True)
        classes[words] = best_classes(classes[words], word, code % (2 * CLASSES), count, table)
        return pa.Table.from_pylist([own | {"classes": classes.astype(np.uint8).tobytes()}], _STATE)

    near = counted.filter(F.col("kind") == BESIDE).select("slice", "data", "classes", "counts")
    return state.groupBy("slice").cogroup(near.groupBy("slice")).applyInArrow(move, STATE)


def masses(state: DataFrame) -> np.ndarray:
    """Occurrences and number of words of each class."""

    def run(batches):
        for batch in batches:
            for counts, classes in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                of, n = np.frombuffer(classes, np.uint8), np.frombuffer(counts, np.int64)
                per, words = np.bincount(of, n, CLASSES).astype(np.int64), np.bincount(of, minlength=CLASSES)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(per), pa.array(words)], ["class", "n", "words"])

    out = np.zeros((2, CLASSES))
    for r in state.mapInArrow(run, "class long, n long, words long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect():
        out[:, r["class"]] = r["n"], r["words"]
    return out


@dataclass
class Corpus:
    """All texts as ``sequences``: their chunks, and the words asked for, each bucketed by where they are read."""

    chunks: DataFrame
    asked: DataFrame


def corpus(docs: DataFrame, n_slices: int) -> Corpus:
    """Write ``docs`` (doc_id, text, training) as sequences, once."""
    rows = bucketed(sequences(docs, n_slices), "lm-texts", "chunk", n_slices)
    asked = rows.filter(F.col("kind") == ASKED).select("slice", "chunk", "begin", "data", "shapes")
    chunks = rows.filter(F.col("kind") == TEXTS).select("chunk", "ids", "data", "counts", "shapes")
    return Corpus(chunks, bucketed(asked, "lm-asked", "slice", n_slices))


def build(docs: DataFrame, n_slices: int) -> tuple[Model, DataFrame, Corpus]:
    """The model of the training rows of ``docs`` (doc_id, text, training), the stored vocabulary with its classes, and
    all rows as sequences."""
    spark = docs.sparkSession
    texts = docs.filter("training").select("text")
    vocabulary = stored(count_words(texts, n_slices), "lm-words")
    tokens, distinct_words, n_texts, keys, counts = summarize(vocabulary)
    units = Units(np.sort(keys[:FREQUENT]), np.arange(min(FREQUENT, len(keys))))
    order = np.argsort(keys)
    model = Model(tokens + n_texts, distinct_words + (n_texts > 0), n_texts, units, keys[order], counts[order], np.zeros(0), np.zeros(0))
    bigrams = count_bigrams(texts, spark.sparkContext.broadcast(units), n_slices)
    model.of = of = exchange(bigrams)
    one = np.zeros((len(of), CLASSES))
    one[np.arange(len(of)), of] = 1
    table = one.T @ bigrams @ one
    state = bucketed(seeded(vocabulary, units, of), "lm-classes", "slice", n_slices)
    discard(vocabulary)
    own = corpus(docs, n_slices)
    if SPARK_ROUNDS and distinct_words > len(units.keys):
        of_shape = model.of[len(units.keys) : -1]
        counted = stored(beside(own.chunks, answered(own.asked, state, of_shape, False), True), "lm-beside")
        for k in range(SPARK_ROUNDS):
            after = bucketed(moved(state, counted, table, units), "lm-classes", "slice", n_slices)
            discard(counted)
            counted = stored(beside(own.chunks, answered(own.asked, after, of_shape, False), k + 1 < SPARK_ROUNDS), "lm-beside")
            found = class_table(counted)
            if likelihood(found) <= likelihood(table):
                discard(after)
                break
            discard(state)
            state, table = after, found
        discard(counted)
    # shares: of each class by the unigram estimates; an unseen word is one more in each class with shapes
    n, words = masses(state)
    mass = n + ADD * words
    mass[np.unique(of[len(units.keys) : -1])] += ADD
    mass[0] = n_texts + ADD
    share = mass / model.total
    with np.errstate(divide="ignore", invalid="ignore"):
        smooth = (table + PRIOR * share / share.sum()) / (table.sum(axis=1, keepdims=True) + PRIOR)
        bonus = np.log10(smooth / share)
    model.bonus = np.where(np.isfinite(bonus), bonus, 0.0)
    return model, state, own


def score(own: Corpus, model: Model, vocabulary: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every text of the corpus."""
    end = np.log10((model.texts + ADD) / model.total)
    total, bonus, of_shape, extra = model.total, model.bonus, model.of[len(model.units.keys) : -1], int(model.texts > 0)

    def merge(chunk: pa.Table, told: pa.Table) -> pa.Table:
        """One chunk: its texts and what the slices found."""
        _, counts, classes = _listed(told, np.int64)
        share, seen = np.log10((counts + ADD) / total), counts > 0
        parts = []
        for ids, seq, size, _ in _texts(chunk):
            first, n = np.concatenate([[0], np.cumsum(size)]), len(size)
            text = np.repeat(np.arange(n), size)
            of = with_ends(classes[seq].astype(np.int64), first, 0)
            base = np.bincount(text, share[seq], n) + end
            step = np.add.reduceat(bonus[of[:-1], of[1:]], first[:-1] + np.arange(n))
            known = np.bincount(text, seen[seq], n).astype(np.int64) + extra
            parts.append(pa.table({"doc_id": pa.array(ids, pa.int64()), "n_tokens": size + 1, "n_known": known, "base_score": base, "score": base + step}))
        return pa.concat_tables(parts) if parts else pa.Table.from_pylist([], _SCORES)

    answers = answered(own.asked, vocabulary, of_shape, True)
    scores = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return own.chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(merge, scores)


_SCORES = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_tokens", "n_known")] + [(c, pa.float64()) for c in ("base_score", "score")])


def evaluate(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the rows of ``docs`` where ``training`` holds, score all."""
    n_slices = slices(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), training.alias("training")
    )
    model, vocabulary, own = build(rows, n_slices)
    return score(own, model, vocabulary).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
