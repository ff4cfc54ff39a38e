"""Audit of how five filters interact, for every order they can be applied in.

Each document is a mask: which filters it fails, and whether it is labelled
good or toxic. A mask alone decides what happens to the document at each of
the 5 steps of each of the 120 orders, so every mask is mapped to one wide
integer whose fields hold all those outcomes: six counters of ``BITS`` bits a
step. A task adds up the integers of its documents part by part (a mask seen k
times adds k times its integer), the sums of the tasks are added by part, and
the total is unpacked. A field holds less than 2**BITS documents, so no sum
carries over into the next field.

What travels is one integer a task and part (``WIDTH`` bytes), added up in two
steps, so a part that holds most rows is no hot key. Copies are found by
SHA-256: a digest keeps its smallest id, partial sums first, and documents meet
it by digest and id, which no group of copies shares.

Defined results: a null text is empty, a null part the empty string; repeated
rows are documents of their own, and equal ids are not smaller than each
other; a null id is neither smaller nor larger than any and has no labels; of
several labels of an id any 1 counts; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocart.llm.store import slices, stored
from velocart.llm.words import mix, split_words, text_bytes, text_chunks

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bits of a counter, and bytes of the whole integer.
BITS = 48
WIDTH = len(ORDERS) * len(FILTERS) * len(MEASURES) * BITS // 8
#: Bits of a mask past the filters' own.
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
#: Parts a task sums before it hands them on.
PARTS = 2000

_U = np.uint64
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*|")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def outcomes(mask: int) -> np.ndarray:
    """What happens to a document of ``mask``: 0 or 1 by order, step and measure."""
    out = np.zeros((len(ORDERS), len(FILTERS), len(MEASURES)), np.int64)
    fails = [bool(mask >> i & 1) for i in range(len(FILTERS))]
    for i, order in enumerate(ORDERS):
        gone = False
        for j, letter in enumerate(order):
            hit = fails[FILTERS.index(letter)]
            removed = hit and not gone
            out[i, j] = (
                not gone and not hit, removed, hit and gone, hit and sum(fails) == 1, removed and bool(mask & GOOD), removed and bool(mask & TOXIC)
            )
            gone = gone or hit
    return out


def pack(fields: np.ndarray) -> int:
    """The integer whose fields are ``fields``, the first lowest."""
    wide = fields.reshape(-1).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : BITS // 8]
    return int.from_bytes(wide.tobytes(), "little")


def unpack(total: int) -> np.ndarray:
    """Counters by order, step and measure of a sum of integers."""
    wide = np.frombuffer(total.to_bytes(WIDTH, "little"), np.uint8).reshape(-1, BITS // 8)
    fields = np.zeros((len(wide), 8), np.uint8)
    fields[:, : BITS // 8] = wide
    return fields.view("<u8").astype(np.int64).reshape(len(ORDERS), len(FILTERS), len(MEASURES))


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many ``flags`` each text has; text i is at[i]:at[i+1]."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def text_masks(texts: pa.Array) -> np.ndarray:
    """Bits A to D of each text; words are told apart by their 64-bit hashes."""
    words = split_words(texts, False)
    n = np.diff(words.first)
    raw, at = text_bytes(texts)
    text_of = words.text_of
    # a word of a text: its hash, moved by the text's number
    own = mix(words.hashes() ^ mix(text_of.astype(np.uint64) + _U(1)))
    distinct = np.bincount(text_of[~pd.Series(own).duplicated().to_numpy()], minlength=len(n))
    points = _sums((raw & 0xC0) != 0x80, at)
    failed = (n < 200, 100 * distinct < 50 * n, 100 * _sums(_CAPITAL[raw], at) > 3 * points, _sums(_SYMBOLS[raw], at) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def examine(docs: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, part, mask, digest): filters A to D of each text, and its SHA-256."""

    def run(batches):
        for batch in text_chunks(batches, "text"):
            raw, at = text_bytes(batch.column(2))
            whole = memoryview(raw)
            digests = [hashlib.sha256(whole[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            columns = [batch.column(0), batch.column(1), pa.array(text_masks(batch.column(2)), pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "digest"])

    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def masks(examined: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n): documents by their whole masks, copies (E) and labels (doc_id, quality, toxic) included; a
    part's mask may have several rows."""
    firsts = examined.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = examined.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(firsts, ["digest", "doc_id"], "left")
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("bad")
    )
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    whole = F.col("mask") + copy + F.coalesce("good", F.lit(0)) + F.coalesce("bad", F.lit(0))
    return rows.join(marks, "doc_id", "left").select("part", whole.cast("int").alias("mask"), "n")


def summed(found: DataFrame) -> DataFrame:
    """(part, total): for each part the sum of its documents' integers, as WIDTH bytes."""

    def run(batches):
        task, held = TaskContext.get().partitionId(), {}
        integers: dict[int, int] = {}

        def flush():
            columns = [list(held), [task] * len(held), [v.to_bytes(WIDTH, "little") for v in held.values()]]
            types = [pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "task", "total"])

        for batch in batches:
            counted = pd.DataFrame({c: batch.column(c).to_pandas() for c in ("part", "mask", "n")}).groupby(["part", "mask"])["n"].sum()
            for (part, mask), n in counted.items():
                if mask not in integers:
                    integers[mask] = pack(outcomes(mask))
                held[part] = held.get(part, 0) + int(n) * integers[mask]
            if len(held) > PARTS:
                yield flush()
                held = {}
        if held:
            yield flush()

    def add(table: pa.Table) -> pa.Table:
        total = sum(int.from_bytes(b, "little") for b in table.column("total").to_pylist())
        return pa.table({"part": table.column("part").slice(0, 1), "total": pa.array([total.to_bytes(WIDTH, "little")], pa.binary())})

    some = F.pmod("task", F.lit(slices(found.sparkSession))).alias("some")
    per_task = found.mapInArrow(run, "part string, task long, total binary")
    once = per_task.groupBy("part", some).applyInArrow(add, "part string, total binary")
    return once.groupBy("part").applyInArrow(add, "part string, total binary")


def report(totals: DataFrame) -> DataFrame:
    """A row for each part, order and step, with all measures and the filter's Shapley count."""
    measures = ", ".join(f"{m} long" for m in (*MEASURES, "shapley"))

    def run(batches):
        orders = [o for o in ORDERS for _ in FILTERS]
        letters = np.array([[FILTERS.index(c) for c in o] for o in ORDERS])
        for batch in batches:
            for part, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = unpack(int.from_bytes(total, "little"))
                over_all = np.bincount(letters.reshape(-1), counts[:, :, 1].reshape(-1), len(FILTERS)).astype(np.int64)
                columns = [pa.array([part] * len(orders)), pa.array(orders), pa.array(list(range(1, len(FILTERS) + 1)) * len(ORDERS), pa.int32())]
                columns += [pa.array(counts[:, :, i].reshape(-1)) for i in range(len(MEASURES))] + [pa.array(over_all[letters].reshape(-1))]
                yield pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *MEASURES, "shapley"])

    return totals.mapInArrow(run, f"part string, filter_order string, step int, {measures}")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The report of ``docs``, part by part of the column ``part``."""
    examined = stored(examine(docs, part), "examined")
    return report(summed(masks(examined, labels)))


def audit_sql(part: str = "lang") -> str:
    """DuckDB twin: masks counted by SQL, met with all orders and steps."""
    return f"""
WITH letters AS (SELECT unnest(['A','B','C','D','E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
),
steps AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, substr(filter_order, i, 1) AS letter, substr(filter_order, 1, i - 1) AS before
  FROM orders, unnest(range(1, 6)) AS r(i)
),
texts AS (
  SELECT doc_id, coalesce({part}, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM texts LEFT JOIN marks USING (doc_id)
),
counted AS (SELECT part, fails, good, toxic, count(*) AS n FROM failing GROUP BY ALL),
each AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails,
         contains(fails, letter) AS hit, regexp_matches(fails, '[' || before || '_]') AS gone
  FROM counted, steps
),
summed AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM each GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM summed
"""
