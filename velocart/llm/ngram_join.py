"""N-gram Jaccard join with prefix tries.

Every text is the set of its distinct 5-word shingles (as 64-bit hashes). A
global order puts rare shingles first, by a counter table of fixed size over
all texts and then by hash. Two sets with Jaccard similarity of 0.75 or more
have the first shingle they share among the first n - ceil(0.75 n) + 1 of each;
only those prefixes travel, dealt out by shingle. Each task stores its part of
the prefixes in a trie, most shared shingles first, so that sets with a common
beginning share nodes, and walks it with bounds on the lengths left: if a
shingle is the first that two sets share, they share no more than it and the
shorter of the rests behind it. A pair that this bound leaves at any shingle is
a candidate. At the shingle that is truly their first, the bound holds for
every similar pair, so no link is lost; shingles that meet by a shortened hash
can only add candidates.

Equal sets are one class from the start. The prefix shingles that several
classes have are written once, bucketed by slice, and don't move again; only
what became of the parts travels to them. In up to ``STAR_ROUNDS``
rounds, while they find links, every part found so far (a class at first) is
paired with the class of another part it shares most with, among the class with
most shared shingles of each shingle and ``HEADS`` that hashes pick anew each
round, if they are a candidate there. A class looks for partners in at most
``OFFERS`` of its slices, others each round, so that a round has no more than
``OFFERS`` rows a class however many slices there are. Those pairs, tried once
each, are verified on the whole sets and join parts. Then the trie is walked for the candidates across parts: subtrees inside
one part or out of the bounds are pruned, and the pairs left that were not
tried before are verified too. So a group of k near copies costs about k pairs
a round, and no link between different parts is lost.

Defined results: null and empty texts, and those without words, have no
shingles and are alone; fewer than five words are one shingle; repeated rows
and ids are rows of one class; a null id never names a component that has
another; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocart.llm.components import components
from velocart.llm.store import bucketed, discard, documents_at, located, on_files, slices, stored
from velocart.llm.words import group_slices, mix, split_words, span_hashes, text_chunks, window_hashes

WIDTH = 5
#: Counters of the frequency table, and the pieces it is summed in. Its size does not depend on the input.
COUNTERS, BLOCKS = 1 << 22, 256
#: Members verified against a class in one group; more members make more groups.
GROUP = 500
#: Rounds that pair parts before the trie is walked, and classes a shingle offers as partners in a round.
STAR_ROUNDS, HEADS = 3, 2
#: Slices in which a class looks for a partner in a round.
OFFERS = 8
#: Bytes of text between two flushes of a task's prefixes.
FLUSH = 24 << 20

_U = np.uint64


def shingles(texts: pa.Array) -> list[np.ndarray]:
    """The set of each text: ascending distinct hashes of its 5-word windows, or of all its words if fewer."""
    words = split_words(texts, True)
    h = words.hashes()
    got, at = window_hashes(h, words.first, WIDTH)
    bounds = np.searchsorted(at, words.first)
    short = np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < WIDTH))
    whole = dict(zip(short.tolist(), span_hashes(h, words.first[short], words.first[short + 1])))
    sets = []
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        sets.append(np.unique(got[a:b]) if b > a else np.array([whole[i]], np.uint64) if i in whole else np.zeros(0, np.uint64))
    return sets


def class_of(s: np.ndarray) -> int:
    """64-bit name of a set, the same for equal sets."""
    total = mix(s ^ _U(0xA0761D6478BD642F)).sum(dtype=np.uint64) + _U(len(s))
    return int(mix(np.array([total], np.uint64))[0].astype(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Both ascending and distinct."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def largest_partner(n: int, position: int, percent: int) -> int:
    """The most shingles of a set with which one of ``n`` can be similar, if they share none before ``position``."""
    return (100 + percent) * (n - position) // percent - n


class Trie:
    """Prefix parts of classes as paths of shingles; ``header`` finds all nodes of a shingle.

    A node knows the classes that pass it (in order of insertion) with the
    size of the largest partner its shingle allows each, the range of their
    set sizes, the largest of those partners, and their part if all are in
    the same.
    """

    def __init__(self):
        self.children: dict[tuple[int, int], int] = {}
        self.header: dict[int, list[int]] = {}
        self.members: list[list[tuple[int, int, int, int]]] = [[]]
        self.least, self.most, self.reach, self.part = [0], [0], [0], [0]

    def insert(self, member: int, path: list[tuple[int, int]], n: int, part: int) -> None:
        """``path``: each shingle with the size of the largest partner it allows."""
        node = 0
        for token, partner in path:
            below = self.children.get((node, token))
            if below is None:
                below = self.children[(node, token)] = len(self.members)
                self.header.setdefault(token, []).append(below)
                self.members.append([])
                self.least.append(n)
                self.most.append(n)
                self.reach.append(partner)
                self.part.append(part)
            node = below
            self.members[node].append((member, n, partner, part))
            self.least[node] = min(self.least[node], n)
            self.most[node] = max(self.most[node], n)
            self.reach[node] = max(self.reach[node], partner)
            if self.part[node] != part:
                self.part[node] = None

    def partners(self, path: list[tuple[int, int]], n: int, part: int, percent: int) -> set[int]:
        """Classes of other parts that may be similar, if one of the shingles of ``path`` is the first shared."""
        found, low, high = set(), percent * n / 100, 100 * n / percent
        for token, partner in path:
            most = min(high, partner)
            for node in self.header.get(token, ()):
                if self.part[node] == part or self.most[node] < low or self.least[node] > most or self.reach[node] < n:
                    continue
                for other, theirs, reach, of in self.members[node]:
                    if of != part and low <= theirs <= most and reach >= n:
                        found.add(other)
        return found


def paths_of(token: np.ndarray, member: np.ndarray, partner: np.ndarray) -> tuple[list[int], list[list[tuple[int, int]]]]:
    """For each member its shingles with their largest partners, the most shared shingles first."""
    _, code, count = np.unique(token, return_inverse=True, return_counts=True)
    order = np.lexsort((token, -count[code], member))
    names, begin = np.unique(member[order], return_index=True)
    pairs = list(zip(token[order].tolist(), partner[order].tolist()))
    ends = [*begin[1:].tolist(), len(pairs)]
    return names.tolist(), [pairs[a:b] for a, b in zip(begin.tolist(), ends)]


def cross_pairs(token, member, n, position, part, percent: int) -> set[tuple[int, int]]:
    """All pairs (a < b) of different parts that may be similar, if one of the shingles here is the first they share."""
    size, part_of = dict(zip(member.tolist(), n.tolist())), dict(zip(member.tolist(), part.tolist()))
    names, paths = paths_of(token, member, largest_partner(n, position, percent))
    trie, out = Trie(), set()
    for name, path in zip(names, paths):
        for other in trie.partners(path, size[name], part_of[name], percent):
            out.add((min(name, other), max(name, other)))
        trie.insert(name, path, size[name], part_of[name])
    return out


ENTRY = np.dtype([("token", "<u4"), ("owner", "<u4"), ("position", "<u4")])
OWNER = np.dtype([("name", "<i8"), ("n", "<u4")])


def _pack(names, n, token, owner, position) -> bytes:
    """One slice of a task's prefixes: the classes, then the entries."""
    used, owner = np.unique(owner, return_inverse=True)
    owners, entries = np.empty(len(used), OWNER), np.empty(len(token), ENTRY)
    owners["name"], owners["n"] = names[used], n[used]
    entries["token"], entries["owner"], entries["position"] = token, owner, position
    return len(used).to_bytes(4, "little") + owners.tobytes() + entries.tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    k = int.from_bytes(blob[:4], "little")
    owners = np.frombuffer(blob, OWNER, k, 4)
    entries = np.frombuffer(blob, ENTRY, -1, 4 + k * OWNER.itemsize)
    at = entries["owner"]
    return entries["token"], owners["name"][at], owners["n"][at], entries["position"]


def _shared(token: np.ndarray, name: np.ndarray, n: np.ndarray, position: np.ndarray) -> list[np.ndarray]:
    """Entries of shingles that two classes have, those of a class that several tasks sent once."""
    order = np.lexsort((position, name, token))
    columns = [c[order] for c in (token, name, n, position)]
    token, name, _, position = columns
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1]) | (position[1:] != position[:-1])
    token, name, n, position = (c[new] for c in columns)
    _, first, code = np.unique(token, return_index=True, return_inverse=True)
    several = np.bincount(code, name != name[first][code]) > 0
    return [c[several[code]] for c in (token, name, n, position)]


def survey(source: DataFrame) -> DataFrame:
    """One pass over all texts: rows of kind 0 (doc_id, file, row, n, name) and of kind 1, the counters by block."""

    def run(batches):
        counts = np.zeros(COUNTERS, np.int32)
        for batch in text_chunks(batches, "text"):
            sets = shingles(batch.column(3))
            if any(len(s) for s in sets):
                at, n = np.unique((np.concatenate(sets) % _U(COUNTERS)).astype(np.int64), return_counts=True)
                counts[at] += n.astype(np.int32)
            n = [len(s) for s in sets]
            names = [class_of(s) if len(s) else None for s in sets]
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * k, pa.int32()), batch.column(0), batch.column(1), batch.column(2),
                 pa.array(n, pa.int64()), pa.array(names, pa.int64()), pa.nulls(k, pa.binary())],
                ["kind", "doc_id", "file", "row", "n", "name", "counts"],
            )
        if counts.any():
            parts = [p.tobytes() for p in np.split(np.minimum(counts, 255).astype(np.uint8), BLOCKS)]
            k = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.string()), pa.array(range(k), pa.int64()),
                 pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(parts, pa.binary())],
                ["kind", "doc_id", "file", "row", "n", "name", "counts"],
            )

    return source.mapInArrow(run, "kind int, doc_id long, file string, row long, n long, name long, counts binary")


def frequencies(surveyed: DataFrame) -> np.ndarray:
    """How often shingles of each counter occur, on a logarithmic scale: the global order goes by it. A task
    counts to 255; ``BLOCKS`` rows of fixed size reach the driver."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block not in total:
                    total[block] = np.zeros(COUNTERS // BLOCKS, np.int64)
                total[block] += np.frombuffer(part, np.uint8)
        if total:
            scaled = [np.round(16 * np.log2(1 + t)).astype("<u2").tobytes() for t in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(scaled, pa.binary())], ["row", "counts"])

    blocks = surveyed.filter("kind = 1").select("row", "counts")
    blocks = blocks.repartition(slices(surveyed.sparkSession), "row").mapInArrow(add, "row long, counts binary")
    out = np.zeros((BLOCKS, COUNTERS // BLOCKS), np.uint16)
    for r in blocks.collect():
        out[r["row"]] = np.frombuffer(r["counts"], "<u2")
    return out.reshape(-1)


def prefixes(source: DataFrame, counts, n_slices: int, percent: int) -> DataFrame:
    """(slice, blob): the prefix of every class a task meets, dealt out by shingle."""

    def run(batches):
        seen: set[int] = set()
        held: list[tuple[int, int, np.ndarray]] = []
        volume = 0

        def flush():
            names = np.array([h[0] for h in held], np.int64)
            n = np.array([h[1] for h in held], np.int64)
            size = np.array([len(h[2]) for h in held])
            token = np.concatenate([h[2] for h in held]) if held else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(held)), size)
            position = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
            spread = mix(token)
            rows = [(k, _pack(names, n, (spread[at] >> _U(32)).astype(np.uint32), owner[at], position[at])) for k, at in group_slices(spread, n_slices)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["slice", "blob"])

        table = counts.value
        for batch in text_chunks(batches, "text"):
            for s in shingles(batch.column(0)):
                if len(s) and (name := class_of(s)) not in seen:
                    seen.add(name)
                    order = np.lexsort((s, table[(s % _U(COUNTERS)).astype(np.int64)]))
                    held.append((name, len(s), s[order[: prefix_length(len(s), percent)]]))
            volume += batch.nbytes
            if volume > FLUSH:
                yield flush()
                held, volume = [], 0
        if held:
            yield flush()

    return source.select("text").mapInArrow(run, "slice int, blob binary")


def shared_entries(dealt: DataFrame) -> DataFrame:
    """Per slice (slice, token, name, n, position): the prefix shingles that two classes have."""

    def meet(table: pa.Table) -> pa.Table:
        k = table.column("slice")[0].as_py()
        parts = [_unpack(b) for b in table.column("blob").to_pylist()]
        columns = _shared(*(np.concatenate([p[i] for p in parts]) for i in range(4)))
        out = {"slice": pa.array(np.full(len(columns[0]), k, np.int32))}
        return pa.table(out | {c: pa.array(v.astype(np.int64)) for c, v in zip(("token", "name", "n", "position"), columns)})

    return dealt.groupBy("slice").applyInArrow(meet, "slice int, token long, name long, n long, position long")


ENTRY_COLUMNS = ("token", "name", "n", "position")


def mixed_entries(own: pa.Table, parts: pa.Table) -> tuple[np.ndarray, ...]:
    """Token, name, n, position, part, common and looks of the entries of a slice whose shingle several parts have.
    ``parts`` has, packed, name, common, part and looks of each class of the slice."""
    token, name, n, position = (own.column(c).to_numpy() for c in ENTRY_COLUMNS)
    if not len(name):
        return token, name, n, position, name, name, name
    known, common, root, looks = np.frombuffer(b"".join(parts.column("rows").to_pylist()), np.int64).reshape(-1, 4).T
    order = np.argsort(known)
    at = order[np.searchsorted(known[order], name)]
    part, common, looks = root[at], common[at], looks[at]
    _, first, code = np.unique(token, return_index=True, return_inverse=True)
    mixed = (np.bincount(code, part != part[first][code]) > 0)[code]
    return tuple(c[mixed] for c in (token, name, n, position, part, common, looks))


def heads_of(token: np.ndarray, name: np.ndarray, common: np.ndarray, salt: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each entry, one head of its shingle at a time (the place of the head's entry), and whether it is a new one:
    the class with most shared shingles, and ``HEADS`` chosen by hashes of this round."""
    _, code = np.unique(token, return_inverse=True)
    keys = [common.astype(np.uint64)] + [mix(name.view(np.uint64) ^ _U(0x9E3779B97F4A7C15 * (HEADS * salt + k + 1) % 2**64)) for k in range(HEADS)]
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for key in keys:
        order = np.lexsort((name, key, code))
        last = np.ones(len(order), bool)
        last[:-1] = code[order][1:] != code[order][:-1]
        head = order[last][code]
        fresh = np.ones(len(token), bool)
        for other, _ in out:
            fresh &= name[head] != name[other]
        out.append((head, fresh))
    return out


def looking(owner: np.ndarray, name: np.ndarray, slice_: np.ndarray, salt: int) -> np.ndarray:
    """For each slice of an owner, if it is one of the ``OFFERS`` that hashes pick for it in this round."""
    order = np.lexsort((mix(mix(name.view(np.uint64) ^ _U(salt)) ^ slice_), owner))
    _, begin, code = np.unique(owner[order], return_index=True, return_inverse=True)
    out = np.zeros(len(owner), np.int64)
    out[order] = np.arange(len(owner)) - begin[code] < OFFERS
    return out


def dealt_parts(classes: DataFrame, n_slices: int, salt: int) -> DataFrame:
    """(slice, rows): name, common and part of ``classes`` (name, common, part, slices) to each slice a class is in,
    and whether it looks for a partner there in round ``salt``."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            # a batch may be a slice of a larger one: offsets count from the first value of that
            sent = batch.column(3).flatten().to_numpy().astype(np.uint64)
            at = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(3).offsets.to_numpy()))
            name, common, part = (batch.column(i).to_numpy()[at] for i in range(3))
            rows = np.stack([name, common, part, looking(at, name, sent, salt)], 1)
            found = [(k, rows[some].tobytes()) for k, some in group_slices(sent, n_slices)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["slice", "rows"])

    return classes.select("name", "common", "part", "slices").mapInArrow(run, "slice int, rows binary")


def by_slice(entries: DataFrame, parts: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on the entries and the parts of each slice; the entries, bucketed by slice, don't move."""
    return entries.groupBy("slice").cogroup(parts.groupBy("slice")).applyInArrow(run, schema)


STARS = "name long, head long, part long, part_head long, shared long"


def star_pairs(entries: DataFrame, parts: DataFrame, percent: int, salt: int, tried: DataFrame | None) -> DataFrame:
    """(a, b), a < b, not tried: for each part the class and the head of another part that share most, among
    each class's best head of each slice that it looks in and that is a candidate there."""

    def run(own: pa.Table, joined: pa.Table) -> pa.Table:
        token, name, n, position, part, common, looks = mixed_entries(own, joined)
        found = [np.zeros((0, 2), np.int64)]
        for head, fresh in heads_of(token, name, common, salt):
            good = fresh & (looks > 0) & (part != part[head]) & (100 * np.minimum(n, n[head]) >= percent * np.maximum(n, n[head]))
            at = np.flatnonzero(good)
            found.append(np.stack([at, head[at]], 1))
        at, partner = np.concatenate(found), largest_partner(n, position, percent)
        x, y = at[:, 0], at[:, 1]
        pairs = pd.DataFrame({"x": x, "y": y, "a": name[x], "b": name[y], "may": (n[y] <= partner[x]) & (n[x] <= partner[y])})
        pairs = pairs.groupby(["a", "b"], sort=False).agg(x=("x", "first"), y=("y", "first"), may=("may", "any"), shared=("x", "size"))
        pairs = pairs[pairs["may"]].reset_index()
        # a class's best head here
        order = np.lexsort((pairs["b"], common[pairs["y"].to_numpy(np.int64)], pairs["shared"], pairs["a"]))
        pairs = pairs.iloc[order].drop_duplicates("a", keep="last")
        x, y, shared = (pairs[c].to_numpy(np.int64) for c in ("x", "y", "shared"))
        values = (name[x], name[y], part[x], part[y], shared)
        return pa.table({c.split()[0]: pa.array(v, pa.int64()) for c, v in zip(STARS.split(", "), values)})

    pairs = by_slice(entries, parts, run, STARS).groupBy("name", "head")
    pairs = pairs.agg(F.max("part").alias("part"), F.sum("shared").alias("shared"))
    pairs = pairs.select("part", "shared", F.least("name", "head").alias("a"), F.greatest("name", "head").alias("b"))
    if tried is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    chosen = pairs.groupBy("part").agg(F.max_by(F.struct("a", "b"), F.struct("shared", "a", "b")).alias("best"))
    return chosen.select("best.a", "best.b").distinct()


def walk(entries: DataFrame, parts: DataFrame, percent: int, tried: DataFrame | None) -> DataFrame:
    """(a, b), a < b: all candidates across parts that were not tried."""

    def run(own: pa.Table, joined: pa.Table) -> pa.Table:
        pairs = cross_pairs(*mixed_entries(own, joined)[:5], percent)
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    pairs = by_slice(entries, parts, run, "a long, b long").distinct()
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar. ``texts`` has a text of each class (name, text).

    The members b of a class a are split into groups of about ``GROUP``; each
    group gets the text of a, and is read as a stream: one set is held.
    """
    size = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("long").alias("groups"))
    members = pairs.join(size, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).alias("g"), F.lit(1).alias("role"), F.col("b").alias("name"))
    heads = size.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g"), F.lit(0).alias("role"), F.col("a").alias("name"))
    wanted = members.unionByName(heads).hint("merge").join(texts, "name")  # the texts are bucketed by name and stay
    wanted = wanted.repartition(slices(pairs.sparkSession), "a", "g").sortWithinPartitions("a", "g", "role")

    def run(batches):
        key, head = None, None
        for batch in text_chunks(batches, "text"):
            a, b = [], []
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), shingles(batch.column(4)))
            for x, g, role, name, s in rows:
                if role == 0:
                    key, head = (x, g), s
                elif key == (x, g) and similar(head, s, percent):
                    a.append(x)
                    b.append(name)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return wanted.select("a", "g", "role", "name", "text").mapInArrow(run, "a long, b long")


def join(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, component (its name; null without shingles), file, row."""
    spark = docs.sparkSession
    n_slices = slices(spark)
    source = located(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "text": F.col(f"`{text}`").cast("string")}, "join-docs")
    source = source.select("doc_id", "file", "row", F.coalesce("text", F.lit("")).alias("text"))
    surveyed = stored(survey(source), "survey")
    counts = spark.sparkContext.broadcast(frequencies(surveyed))  # COUNTERS small integers, whatever the input
    rows = surveyed.filter("kind = 0").select("doc_id", "file", "row", "n", "name")

    dealt = prefixes(source, counts, n_slices, percent).repartition(n_slices, "slice")
    entries = bucketed(shared_entries(dealt), "entries", "slice", n_slices)
    where = entries.groupBy("slice", "name").agg(F.count(F.lit(1)).alias("common"))
    where = stored(where.groupBy("name").agg(F.sum("common").alias("common"), F.collect_list("slice").alias("slices")), "where")

    # a text of every class that shares a shingle with another; by a shuffle at every size, as neither side has a bound
    some = rows.filter("name IS NOT NULL").groupBy("name").agg(F.min(F.struct("file", "row")).alias("at"))
    some = some.join(where.select("name"), "name").select("name", "at.file", "at.row")
    texts = source.select("file", "row", "text").join(some.hint("merge"), ["file", "row"]).select("name", "text")
    texts = bucketed(texts.repartition(n_slices, "name"), "texts", "name", n_slices)

    parts = dealt_parts(where.withColumn("part", F.col("name")), n_slices, 0)
    found, links, tried, salt, settled = None, None, None, 0, False
    while True:
        walking = settled or salt == STAR_ROUNDS
        pairs = stored(walk(entries, parts, percent, tried) if walking else star_pairs(entries, parts, percent, salt, tried), "pairs")
        new = stored(verified(pairs, texts, percent), "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        if walking:
            break
        settled, salt = new.isEmpty(), salt + 1
        if not settled:
            before, found = found, components(links)
            parted = where.join(found, F.col("name") == F.col("node"), "left").withColumn("part", F.coalesce("root", "name"))
            parts = dealt_parts(parted, n_slices, salt)
            if before is not None:
                discard(before)
    if found is None or not new.isEmpty():
        found = components(links)
    discard(entries, where, texts)

    roots = rows.filter("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("smallest"))
    roots = roots.join(found, F.col("name") == F.col("node"), "left").select("name", "smallest", F.coalesce("root", "name").alias("root"))
    ids = roots.groupBy("root").agg(F.min("smallest").alias("component_id"))
    by_name = stored(roots.join(ids, "root").select("name", "component_id", F.col("root").alias("component")), "names")
    return rows.join(by_name, "name", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component", "file", "row",
    )


def keep(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs``, with their columns, but of each component only the one with the smallest id (null
    after all others, then by place). Rows without shingles all stay."""
    docs = on_files(docs, "join-docs")
    rows = join(docs, percent)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("file"), F.col("row"))).alias("at")
    firsts = rows.filter("component IS NOT NULL").groupBy("component").agg(first).select("at.file", "at.row")
    return documents_at(docs, firsts.unionByName(rows.filter("component IS NULL").select("file", "row")))
