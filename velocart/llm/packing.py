"""Packing by cutting-stock column generation.

Documents are cut into full pieces of the sequence length and one rest. Only
the histogram of piece lengths, in classes, reaches the driver (up to
``EXACT`` ids every length is a class, longer ones are rounded up by less than
3 %): a linear program over patterns of classes that fill a
sequence is solved by the simplex method, a knapsack dynamic program over the
dual prices supplies each new pattern, and the solution is rounded down; what
is left, fewer sequences than classes, is packed first-fit decreasing. If that
wastes more than ``WASTE`` (a common length that leaves gaps no other piece
fits), rests longer than half a sequence are cut at the half, and the program
is solved anew. On the executors every piece gets its rank among the pieces of
its class, and the patterns' places are dealt out by rank.

Defined results: a null text is an empty one (its end id only); null and
repeated ids are packed like any row (pieces are ranked by all their columns,
so a task that runs again places them alike); an empty table gives no rows;
other columns are not read. Texts of any length are cut whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velocart.llm.store import slices, stored
from velocart.llm.tokens import pieces_of, worker_encoder
from velocart.llm.words import text_chunks

#: Lengths that are classes of their own; beyond, the step between classes doubles with the length, up to 8 ids.
EXACT, STEPS = 64, 3
WASTE = 0.01
CUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, head_crc32 long, tail_crc32 long"


def cut(docs: DataFrame, tokenizer: str, end_id: int, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize every text and cut it: one row a piece."""
    encoder = worker_encoder(docs.sparkSession, tokenizer)

    def run(batches):
        own = encoder()
        for batch in text_chunks(batches, "text"):
            ids, at = own.encode(batch.column(1), end_id)
            cuts = np.array(list(pieces_of(ids, at, size)), np.int64).reshape(-1, 3)
            raw = ids.astype("<u4")
            spans = cuts[:, 1:].tolist()
            codes = [zlib.crc32(raw[a:b]) for a, b in spans]
            # a rest longer than half may be cut there later
            heads = [zlib.crc32(raw[a : a + size // 2]) if size // 2 < b - a < size else None for a, b in spans]
            tails = [zlib.crc32(raw[a + size // 2 : b]) if size // 2 < b - a < size else None for a, b in spans]
            of = cuts[:, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of)),
                    pa.array(cuts[:, 1] - at[of]),
                    pa.array(cuts[:, 2] - cuts[:, 1]),
                    pa.array(codes, pa.int64()),
                    pa.array(np.diff(at)[of]),
                    pa.array(heads, pa.int64()),
                    pa.array(tails, pa.int64()),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "head_crc32", "tail_crc32"],
            )

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, CUT)


def step_of(length: int) -> int:
    """Ids between two classes at this length."""
    return next((1 << k for k in range(STEPS) if length <= EXACT << k), 1 << STEPS)


def class_of(length: int, size: int) -> int:
    """The length a piece counts as."""
    step = step_of(length)
    return min(size, -(-length // step) * step)


def class_column(length: Column, size: int) -> Column:
    """``class_of`` as a column."""
    step = F.lit(1 << STEPS)
    for k in reversed(range(STEPS)):
        step = F.when(length <= EXACT << k, 1 << k).otherwise(step)
    return F.least(F.lit(size), F.ceil(length / step) * step).cast("long")


def best_pattern(price: np.ndarray, lengths: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of lengths that fits into ``size``.

    A length comes in bundles of 1, 2, 4 .. copies, each taken or not; one that costs no less room than another of
    its value is never taken.
    """
    value, taken = np.zeros(size + 1), []
    worth = price > np.concatenate([[0.0], np.maximum.accumulate(price)[:-1]]) + 1e-12
    for k in np.flatnonzero(worth).tolist():
        copies = 1
        while (room := copies * int(lengths[k])) <= size:
            total = value[:-room] + copies * price[k]
            better = total > value[room:] + 1e-12
            if better.any():
                value[room:][better] = total[better]
                taken.append((k, copies, room, better))
            copies *= 2
    pattern, left = np.zeros(len(lengths)), size
    for k, copies, room, better in reversed(taken):
        if left >= room and better[left - room]:
            pattern[k] += copies
            left -= room
    return float(value[size]), pattern


def column_generation(lengths: np.ndarray, demand: np.ndarray, size: int, gap: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Fewest sequences, as a linear program: basic patterns (a row each) and how often each is used.

    Stops at the optimum, within ``gap`` of a lower bound (the ids divided by
    the room, or the largest of the duals' values divided by the best pattern's),
    or after 12 patterns a length; any basis it stops at packs everything.
    """
    m = len(lengths)
    area = float(lengths @ demand) / size
    copies = np.maximum(1, size // lengths)
    basis = np.diag(copies.astype(float))  # columns are patterns
    inverse = np.diag(1.0 / copies)
    amount = inverse @ demand
    bound = area
    for _ in range(12 * m + 100):
        if amount.sum() <= bound * (1 + gap):
            break
        price = inverse.sum(axis=0)  # every pattern costs one sequence
        best, pattern = best_pattern(price, lengths, size)
        if best <= 1 + 1e-9:
            break
        bound = max(bound, amount.sum() / best)
        enter = inverse @ pattern
        ratio = np.full(m, np.inf)
        ok = enter > 1e-9
        ratio[ok] = amount[ok] / enter[ok]
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        theta = ratio[out]
        amount -= theta * enter
        np.maximum(amount, 0, out=amount)
        amount[out] = theta
        basis[:, out] = pattern
        row = inverse[out] / enter[out]
        inverse -= np.outer(enter, row)
        inverse[out] = row
    return basis.T.astype(np.int64), np.maximum(amount, 0)


def first_fit(lengths: np.ndarray, count: np.ndarray, size: int) -> list[dict[int, int]]:
    """Pack what rounding left, longest first, each into the fullest open sequence with room for it."""
    open_at: dict[int, list[dict[int, int]]] = {}
    done: list[dict[int, int]] = []
    for k in np.argsort(-lengths).tolist():
        length = int(lengths[k])
        for _ in range(int(count[k])):
            room = min((r for r, xs in open_at.items() if r >= length and xs), default=None)
            if room is None:
                room, one = size, {}
                done.append(one)
            else:
                one = open_at[room].pop()
            one[k] = one.get(k, 0) + 1
            open_at.setdefault(room - length, []).append(one)
    return done


def places(classes: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """Rows (class, first rank, pieces a sequence, sequence, position), by class and rank.

    A piece of this class with rank r, at or after the first rank, goes to
    sequence + (r - first) // pieces, as number position + (r - first) % pieces.
    """
    full = classes == size
    rows: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    if full.any():
        rows.append((size, 0, 1, 0, 0))
        sequence = int(count[full][0])
    short, left = classes[~full], count[~full].astype(np.int64)
    rank = np.zeros(len(short), np.int64)

    def use(pattern: list[tuple[int, int]], copies: int) -> None:
        nonlocal sequence
        position = 0
        for k, n in pattern:
            rows.append((int(short[k]), int(rank[k]), n, sequence, position))
            rank[k] += n * copies
            position += n
        sequence += copies

    if len(short):
        patterns, amount = column_generation(short, left.astype(float), size)
        for pattern, x in zip(patterns, amount):
            some = np.flatnonzero(pattern)
            whole = min([int(np.floor(x + 1e-6)), *(left[some] // pattern[some]).tolist()])
            if whole > 0:
                use([(k, int(pattern[k])) for k in some.tolist()], whole)
                left[some] -= whole * pattern[some]
        for one in first_fit(short, left, size):
            use(sorted(one.items()), 1)
    out = np.array(rows, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def plan(histogram: dict[int, int], size: int) -> tuple[bool, np.ndarray]:
    """Whether rests are cut at the half, and the places of all classes."""

    def solve(by_length: dict[int, int]) -> tuple[float, np.ndarray]:
        by_class: dict[int, int] = {}
        for length, n in by_length.items():
            k = class_of(length, size)
            by_class[k] = by_class.get(k, 0) + n
        table = places(np.array(sorted(by_class), np.int64), np.array([by_class[k] for k in sorted(by_class)], np.int64), size)
        sequences = _sequences(table, by_class)
        return 1 - sum(k * n for k, n in by_length.items()) / (size * max(1, sequences)), table

    waste, table = solve(histogram)
    half = size // 2
    if waste <= WASTE or not any(half < k < size for k in histogram):
        return False, table
    halved: dict[int, int] = {}
    for length, n in histogram.items():
        for part in (half, length - half) if half < length < size else (length,):
            halved[part] = halved.get(part, 0) + n
    waste2, table2 = solve(halved)
    return (True, table2) if waste2 < waste else (False, table)


def _sequences(table: np.ndarray, by_class: dict[int, int]) -> int:
    """Sequences of a table of places: one past the last that any class's last piece gets."""
    last = 0
    for i, (k, first, n, sequence, _) in enumerate(table.tolist()):
        end = table[i + 1, 1] if i + 1 < len(table) and table[i + 1, 0] == k else by_class[k]
        last = max(last, sequence + -(-(int(end) - first) // n))
    return last


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    rows = stored(cut(docs, tokenizer, end_id, size, doc_id, text), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    halve, table = plan(histogram, size)
    table = spark.sparkContext.broadcast(table)  # a few rows a class at most
    if halve:
        half = F.lit(size // 2).cast("long")
        head = F.struct("start", half.alias("length"), F.col("head_crc32").alias("ids_crc32"))
        tail = F.struct((F.col("start") + half).alias("start"), (F.col("length") - half).alias("length"), F.col("tail_crc32").alias("ids_crc32"))
        parts = F.when(F.col("head_crc32").isNull(), F.array(F.struct("start", "length", "ids_crc32"))).otherwise(F.array(head, tail))
        rows = rows.select("doc_id", "doc_tokens", F.inline(parts))

    # rank within a class: blocks of pieces, then the blocks' counts in order
    rows = rows.withColumn("class", class_column(F.col("length"), size))
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "start"), F.lit(slices(spark))))
    inner = Window.partitionBy("block", "class").orderBy("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    counts = blocks.groupBy("block", "class").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("block", "class", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = blocks.withColumn("own", F.row_number().over(inner) - 1).join(counts, ["block", "class"])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ranked = ranked.select(*names, "class", (F.col("own") + F.col("before")).alias("rank"))

    def deal(batches):
        t = table.value
        key = t[:, 0] << 40 | t[:, 1]
        for batch in batches:
            size_class, rank = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            at = t[np.searchsorted(key, size_class << 40 | rank, "right") - 1]
            step = rank - at[:, 1]
            columns = [*(batch.column(i) for i in range(5)), pa.array(at[:, 3] + step // at[:, 2]), pa.array(at[:, 4] + step % at[:, 2])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "position"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, position long"
    dealt = ranked.mapInArrow(deal, schema)
    ahead = Window.partitionBy("sequence_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.select(*names, "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"))
