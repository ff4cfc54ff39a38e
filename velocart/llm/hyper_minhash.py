"""Near-duplicate components by HyperMinHash.

Every text is the set of its distinct 5-word shingles (as 64-bit hashes). A
shingle falls into one of ``REGISTERS`` buckets by one part of its hash; a
register keeps of the least other part in its bucket the number of leading
zeros and the next ``MANTISSA`` bits: two bytes. An empty register takes the
first filled one of a probe sequence of its own, which is the same for all
sets, so small sets agree in registers as large ones do.

Registers are grouped into bands; sets that agree in a whole band are
candidates. With the bands chosen for 0.85 (32 of 5), a pair of just that
similarity agrees in none with a probability of 7e-9.

Equal sets are one class. Classes are joined to parts in two ways, neither of
which makes a row for each pair of a group:

* ``STAR_ROUNDS`` rounds pair each part with one class of another part that
  shares bands with it, among ``HEADS`` a band bucket; these pairs are verified
  on the full sets. So a group of k near copies costs about k pairs a round.
* Then, for exactness, all band buckets in which several parts are left are
  looked through, split into units of bounded size. In a unit the similarity
  of every pair of different parts is estimated from the registers, corrected
  for registers that agree by chance, and classes without a partner within six
  standard deviations of the threshold (and not met in an earlier band) drop
  out. The sets of the others meet once more by unit; there all pairs are
  counted exactly and links that join parts are kept.

Defined results: null and empty texts, and those without words, have no
shingles and are alone; fewer than five words are one shingle; repeated rows
and ids are rows of one class; a null id never names a component that has
another, and is kept only where there is none; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocart.llm.components import components
from velocart.llm.ngram_join import class_of, shingles
from velocart.llm.store import documents_at, located, on_files, slices, stored
from velocart.llm.words import group_slices, mix, text_chunks

#: Registers of a set; a register is 5 bits of leading zeros and the mantissa.
REGISTERS, MANTISSA = 160, 11
#: A pair at the threshold may be missed so often.
MISSED = 1e-8
#: Tries of an empty register before it takes the next filled one.
PROBES = 1500
#: Rounds that join parts before the units, and classes a bucket offers as partners.
STAR_ROUNDS, HEADS = 3, 2
#: Classes, and shingles of all its classes, that one half of a unit holds on average.
UNIT_CLASSES, UNIT_SHINGLES = 1000, 2_000_000
#: Standard deviations an estimate may be off.
SIGMAS = 6.0

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)
_PROBE = (mix(np.arange(PROBES * REGISTERS, dtype=np.uint64) + _U(0x51ED270B)) % _U(REGISTERS)).astype(np.int64).reshape(PROBES, REGISTERS)


def band_width(percent: int) -> int:
    """Registers a band: the most with which a pair at the threshold is missed at most ``MISSED`` of the time."""
    t = percent / 100
    fits = [r for r in range(1, 17) if (1 - t**r) ** (REGISTERS // r) <= MISSED]
    return max(fits, default=1)


def leading_zeros(v: np.ndarray) -> np.ndarray:
    """Leading zeros of 64-bit values, at most 31."""
    high = (v >> _U(32)).astype(np.float64)
    return np.where(high > 0, 31 - np.floor(np.log2(np.maximum(high, 1))), 31).astype(np.uint64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers for each set; every set has an element."""
    k, n = REGISTERS, len(sets)
    h = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    spread = mix(h ^ _U(0x2545F4914F6CDD1D))
    bucket = ((spread >> _U(32)) * _U(k) >> _U(32)).astype(np.int64)
    least = np.full(n * k, _EMPTY, np.uint64)
    np.minimum.at(least, owner * k + bucket, mix(h + _U(0x9E3779B97F4A7C15)) & _U(0xFFFFFFFFFFFFFFFE))
    filled = (least != _EMPTY).reshape(n, k)
    # an empty register takes the first filled one of its probes
    source = np.tile(np.arange(k), (n, 1))
    row, column = np.nonzero(~filled)
    for probe in _PROBE:
        if not len(row):
            break
        to = probe[column]
        hit = filled[row, to]
        source[row[hit], column[hit]] = to[hit]
        row, column = row[~hit], column[~hit]
    for i, j in zip(row.tolist(), column.tolist()):
        there = np.flatnonzero(filled[i])
        source[i, j] = there[np.searchsorted(there, j) % len(there)]
    zeros = leading_zeros(least)
    mantissa = (least << (zeros + _U(1))) >> _U(64 - MANTISSA)
    packed = (zeros << _U(MANTISSA) | mantissa).astype(np.uint16).reshape(n, k)
    return np.take_along_axis(packed, source, 1)


def band_keys(sketch: np.ndarray, width: int) -> np.ndarray:
    """64-bit keys of all bands of each sketch; the lowest 8 bits are the band's number."""
    n, bands = len(sketch), REGISTERS // width
    parts = sketch[:, : bands * width].astype(np.uint64).reshape(n, bands, width)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + _U(1), (n, bands))
    for i in range(width):
        key = mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, i] + _U(1))
    return (key & ~_U(255)) | np.arange(bands, dtype=np.uint64)


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that registers of unrelated sets of these sizes agree."""
    zeros = np.arange(32)

    def share(n):
        load = np.maximum(np.asarray(n, np.float64), 1)[..., None] / REGISTERS
        low, high = np.where(zeros < 31, 2.0 ** -(zeros + 1), 0.0), 2.0**-zeros
        p = np.exp(-load * low) - np.exp(-load * high)
        return p / p.sum(axis=-1, keepdims=True)

    return (share(n_a) * share(n_b)).sum(axis=-1) / 2**MANTISSA


def estimate(agree: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of registers that agree, less those that do by chance."""
    e = chance(n_a, n_b)
    return (agree / REGISTERS - e) / (1 - e)


def least_estimate(n: np.ndarray, percent: int) -> np.ndarray:
    """What a pair at the threshold is estimated at least, if the smaller set has ``n`` shingles."""
    t = percent / 100
    sample = REGISTERS * -np.expm1(-np.asarray(n, np.float64) / REGISTERS)  # registers filled by own shingles
    return t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(sample, 1))


def sketched(source: DataFrame) -> DataFrame:
    """(doc_id, file, row, n, name, sketch) of every row; a class's sketch stands once a task."""

    def run(batches):
        seen: set[int] = set()
        for batch in text_chunks(batches, "text"):
            sets = shingles(batch.column(3))
            names = [class_of(s) if len(s) else None for s in sets]
            fresh = []
            for i, name in enumerate(names):
                if name is not None and name not in seen:
                    seen.add(name)
                    fresh.append(i)
            sketches: list[bytes | None] = [None] * len(sets)
            if fresh:
                for i, r in zip(fresh, registers([sets[i] for i in fresh])):
                    sketches[i] = r.astype("<u2").tobytes()
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *columns], ["doc_id", "file", "row", "n", "name", "sketch"])

    return source.mapInArrow(run, "doc_id long, file string, row long, n long, name long, sketch binary")


def shared_buckets(classes: DataFrame, width: int, n_slices: int) -> DataFrame:
    """(bucket, name, n): the band buckets that hold two classes or more."""

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sketch = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u2").reshape(-1, REGISTERS)
            keys = band_keys(sketch, width)
            names, n = (np.repeat(batch.column(i).to_numpy(), keys.shape[1]) for i in (0, 1))
            rows = np.stack([keys.reshape(-1).view(np.int64), names, n], 1)
            spread = mix(keys.reshape(-1))
            found = [(k, rows[at].tobytes()) for k, at in group_slices(spread, n_slices)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["slice", "rows"])

    def meet(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table.column("rows").to_pylist()), np.int64).reshape(-1, 3)
        _, code, count = np.unique(rows[:, 0], return_inverse=True, return_counts=True)
        rows = rows[count[code] > 1]
        return pa.table({c: rows[:, i] for i, c in enumerate(("bucket", "name", "n"))})

    dealt = classes.select("name", "n", "sketch").mapInArrow(deal, "slice int, rows binary")
    return dealt.groupBy("slice").applyInArrow(meet, "bucket long, name long, n long")


def sets_of(source: DataFrame, places: DataFrame) -> DataFrame:
    """(name, elements): the set, as ascending hashes, of the text at each of ``places`` (name, file, row)."""

    def run(batches):
        for batch in text_chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingles(batch.column(1))], pa.binary())], ["name", "elements"])

    texts = source.select("file", "row", "text").join(places, ["file", "row"]).select("name", "text")
    return texts.mapInArrow(run, "name long, elements binary")


def several_parts(entries: DataFrame) -> DataFrame:
    """The entries (bucket, part, ..) of buckets that hold several parts."""
    mixed = entries.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("bucket")
    return entries.join(mixed, "bucket", "left_semi")


def star_pairs(entries: DataFrame, percent: int, salt: int, tried: DataFrame | None) -> DataFrame:
    """(a, b), a < b, not tried: for each part the pair of one of its classes and a head of another part's that shares
    most buckets."""
    picks = [F.max_by("name", F.xxhash64("name", F.lit(HEADS * salt + k))) for k in range(HEADS)]
    heads = entries.groupBy("bucket").agg(F.array_distinct(F.array(*picks)).alias("heads"), F.min("part").alias("p"), F.max("part").alias("q"))
    heads = heads.filter("p <> q").select("bucket", "heads")
    pairs = entries.join(heads, "bucket").select("name", "n", "part", F.explode("heads").alias("head")).filter("name <> head")
    pairs = pairs.groupBy("name", "head").agg(F.max("n").alias("n"), F.max("part").alias("part"), F.count(F.lit(1)).alias("shared"))
    other = entries.groupBy(F.col("name").alias("head")).agg(F.max("n").alias("n_head"), F.max("part").alias("part_head"))
    pairs = pairs.join(other, "head").filter((F.col("part") != F.col("part_head")) & (100 * F.least("n", "n_head") >= percent * F.greatest("n", "n_head")))
    pairs = pairs.select("part", "shared", F.least("name", "head").alias("a"), F.greatest("name", "head").alias("b"))
    if tried is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    return pairs.groupBy("part").agg(F.max_by(F.struct("a", "b"), F.struct("shared", "a", "b")).alias("best")).select("best.a", "best.b").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar: a pair's two sets meet by pair."""

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            good = []
            for s, t in zip(x.to_pylist(), y.to_pylist()):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                common = len(np.intersect1d(s, t, assume_unique=True))
                good.append(100 * common >= percent * (len(s) + len(t) - common))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("name").alias("a"), F.col("elements").alias("x"))
    two = sets.select(F.col("name").alias("b"), F.col("elements").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


UNIT = ["bucket", "kind", "i", "j"]


def units(entries: DataFrame) -> DataFrame:
    """The entries (bucket, name, n, part) of buckets with several parts, dealt to units (bucket, kind, i, j).

    Any two classes of a bucket that are of different parts meet in a unit. A small bucket is one unit. In a large one
    the classes of the largest part and the others are each split into blocks by a hash of their names: the others'
    blocks meet each other (kind 1) and the largest part's (kind 2), the largest part's never meet among themselves.
    """
    mixed = several_parts(entries)
    per_part = mixed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    size = per_part.groupBy("bucket").agg(
        F.max_by("part", F.struct("c", "part")).alias("largest"), F.max_by("c", F.struct("c", "part")).alias("c1"), F.max_by("s", F.struct("c", "part")).alias("s1"),
        F.sum("c").alias("c"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("parts"),
    )

    def blocks(classes, shingles_):
        return F.greatest(F.ceil(classes / UNIT_CLASSES), F.ceil(shingles_ / UNIT_SHINGLES), F.lit(1)).cast("long")

    size = size.select("bucket", "largest", blocks(F.col("c"), F.col("s")).alias("all"), blocks(F.col("c1"), F.col("s1")).alias("k1"), blocks(F.col("c") - F.col("c1"), F.col("s") - F.col("s1")).alias("k2"))
    rows = mixed.join(size, "bucket")

    def unit(kind, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"))

    def up_to(n):
        return F.sequence(F.lit(0).cast("long"), n - 1)

    own1, own2 = F.pmod(F.xxhash64("name"), F.col("k1")), F.pmod(F.xxhash64("name"), F.col("k2"))
    others = F.concat(
        F.transform(up_to(F.col("k2")), lambda j: unit(1, F.least(own2, j), F.greatest(own2, j))), F.transform(up_to(F.col("k1")), lambda j: unit(2, own2, j))
    )
    largest = F.transform(up_to(F.col("k2")), lambda i: unit(2, i, own1))
    dealt = F.when(F.col("all") == 1, F.array(unit(0, F.lit(0), F.lit(0)))).when(F.col("part") == F.col("largest"), largest).otherwise(others)
    return rows.select("bucket", "name", "n", "part", F.explode(dealt).alias("u")).select("bucket", "u.kind", "u.i", "u.j", "name", "n", "part")


def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One table for each run of rows of the same unit."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(len(UNIT))], 1)
        starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        last = tuple(held[-1].column(i)[0].as_py() for i in range(len(UNIT))) if held else None
        if last is not None and last != tuple(keys[0].tolist()):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip([0, *starts.tolist()], [*starts.tolist(), batch.num_rows]):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def promising(sketch: np.ndarray, n: np.ndarray, part: np.ndarray, band: int, width: int, percent: int) -> np.ndarray:
    """Which classes of a unit have a partner of another part that may be similar, by the estimate, and that no earlier
    band brings together."""
    out = np.zeros(len(n), bool)
    for i in range(len(n) - 1):
        fits = np.flatnonzero((part[i + 1 :] != part[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i]))) + i + 1
        if not len(fits):
            continue
        agree = sketch[fits] == sketch[i]
        good = estimate(agree.sum(axis=1), n[fits], np.full(len(fits), n[i])) >= least_estimate(np.minimum(n[fits], n[i]), percent)
        fits, agree = fits[good], agree[good]
        if len(fits) and band:
            fits = fits[~agree[:, : band * width].reshape(len(fits), band, width).all(axis=2).any(axis=1)]
        if len(fits):
            out[fits] = out[i] = True
    return out


def joining_links(sets: list[np.ndarray], part: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Places of similar pairs, as few as join the same parts as all similar pairs of the unit do."""
    n = np.array([len(s) for s in sets])
    _, parts = np.unique(part, return_inverse=True)
    root = list(range(int(parts.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    token, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), n)
    count = np.bincount(code, minlength=len(token))
    kept = count[code] > 1
    code, owner = code[kept], owner[kept]
    order = np.argsort(code, kind="stable")
    members, begin = owner[order], np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(token)))])
    own = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sets)))])
    links = []
    for i in range(len(sets)):
        mine = code[own[i] : own[i + 1]]
        if not len(mine):
            continue
        size = begin[mine + 1] - begin[mine]
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - begin[mine], size)
        common = np.bincount(members[at], minlength=len(sets))
        for j in np.flatnonzero((100 * common >= percent * (n + n[i] - common)) & (parts != parts[i])).tolist():
            x, y = find(int(parts[i])), find(int(parts[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((i, j))
    return links


def unit_links(entries: DataFrame, classes: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): similar pairs that join all parts (of ``entries``) which any similar pair in a bucket joins."""
    n_parts = slices(entries.sparkSession)

    def together(df: DataFrame) -> DataFrame:
        return df.repartition(n_parts, *UNIT).sortWithinPartitions(*UNIT, "name")

    def choose(batches):
        for table in whole_units(batches):
            table = table.combine_chunks()
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u2").reshape(-1, REGISTERS)
            good = promising(sketch, table.column("n").to_numpy(), table.column("part").to_numpy(), table.column("bucket")[0].as_py() & 255, width, percent)
            if good.any():
                yield from table.drop_columns(["n", "sketch"]).filter(pa.array(good)).to_batches()

    def count(batches):
        for table in whole_units(batches):
            table = table.combine_chunks()
            names = table.column("name").to_pylist()
            sets = [np.frombuffer(b, np.uint64) for b in table.column("elements").to_pylist()]
            if links := joining_links(sets, table.column("part").to_numpy(), percent):
                a, b = [names[i] for i, _ in links], [names[j] for _, j in links]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    key = "bucket long, kind int, i long, j long"
    dealt = units(entries).join(classes.select("name", "sketch"), "name").select(*UNIT, "name", "part", "n", "sketch")
    chosen = stored(together(dealt).mapInArrow(choose, f"{key}, name long, part long"), "units")
    full = chosen.join(sets, "name").select(*UNIT, "name", "part", "elements")
    return together(full).mapInArrow(count, "a long, b long")


def join(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept, component (its name; null without shingles), file, row."""
    n_slices, width = slices(docs.sparkSession), band_width(percent)
    source = located(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "text": F.col(f"`{text}`").cast("string")}, "near-docs")
    source = source.select("doc_id", "file", "row", F.coalesce("text", F.lit("")).alias("text"))
    surveyed = stored(sketched(source), "sketched")
    rows = surveyed.select("doc_id", "file", "row", "n", "name")
    classes = surveyed.filter("sketch IS NOT NULL").groupBy("name").agg(F.max("n").alias("n"), F.max("sketch").alias("sketch"))
    classes = stored(classes, "classes")
    entries = stored(shared_buckets(classes, width, n_slices), "buckets")

    places = rows.filter("name IS NOT NULL").groupBy("name").agg(F.min(F.struct("file", "row")).alias("at"))
    places = places.join(entries.select("name").distinct(), "name").select("name", "at.file", "at.row")
    sets = stored(sets_of(source, places), "sets")

    parted, links, tried = entries.withColumn("part", F.col("name")), None, None
    for salt in (*range(STAR_ROUNDS), None):
        if salt is None:
            new = stored(unit_links(parted, classes, sets, width, percent), "links")
        else:
            pairs = stored(star_pairs(parted, percent, salt, tried), "pairs")
            new = stored(verified(pairs, sets, percent), "links")
            tried = pairs if tried is None else tried.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        found = components(links)
        parted = entries.join(found, F.col("name") == F.col("node"), "left").withColumn("part", F.coalesce("root", "name")).drop("node", "root")

    roots = rows.filter("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("smallest"))
    roots = roots.join(found, F.col("name") == F.col("node"), "left").select("name", "smallest", F.coalesce("root", "name").alias("component"))
    ids = roots.groupBy("component").agg(F.min("smallest").alias("component_id"))
    by_name = stored(roots.join(ids, "component").select("name", "component_id", "component"), "names")
    component_id = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    rows = rows.join(by_name, "name", "left").select("doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"), "component", "file", "row")
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs``, with their columns, but of each component only the one with the smallest id (null after
    all others, then by place). Rows without shingles all stay."""
    docs = on_files(docs, "near-docs")
    rows = join(docs, percent)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("file"), F.col("row"))).alias("at")
    firsts = rows.filter("component IS NOT NULL").groupBy("component").agg(first).select("at.file", "at.row")
    return documents_at(docs, firsts.unionByName(rows.filter("component IS NULL").select("file", "row")))
