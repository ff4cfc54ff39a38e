"""Alignment of the tokens of two public tokenizers, A (byte-level BPE) and B (pieces with byte fallback).

Both encode space + text. Byte offsets where a token of A and a token of B end
cut the text into groups; within a group every A token is linked with every B
token. An id pair's count is the number of documents that hold it linked.

An array maps every A id to the B id of the same bytes. Groups of one such pair,
most of all groups, are counted in a vector as long as A's vocabulary; only the
pairs of irregular groups are dealt out by hash, as sorted distinct codes of a
chunk of texts (8 bytes each, once), summed there, and the counts go back to
the chunks. The driver and the tasks get two vectors of A's vocabulary.

Texts are cut before spaces between characters that are no white space: no
pretokenizer rule of A and no piece of B reaches over such a cut (checked when
the model is loaded), so both tokenizers end a token there and groups never
cross. Each different segment is encoded and aligned once a worker. What the
second pass needs of a chunk (its texts as distinct segments, their links) is
written once, bucketed by chunk, so that only the counts travel to it.

Defined results: texts that are null or empty, or whose joined bytes of A or B
tokens differ from space + text (as with U+2581, which B's pieces use for a
space) have no tokens: zeros and an empty digest. Strings of special tokens
inside a text are plain text. Repeated rows are documents of their own; null
ids are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velocart.llm.store import bucketed, slices, stored
from velocart.llm.tokens import _GOES_ON, Encoder
from velocart.llm.words import _SPACE, _TABLE, Known, distinct, group_slices, grown, mix, per_worker, span_hashes, text_bytes, text_chunks

#: Distinct segments a worker remembers before it starts afresh.
CACHE_SEGMENTS = 400_000
#: Bytes of text of a chunk, at most (one longer text is a chunk of its own).
FLUSH = 6 << 20
#: Pieces in which vectors of A's vocabulary are summed.
BLOCKS = 64
#: B writes a space so.
SPACE_MARK = "▁"

_U = np.uint64


def byte_values() -> dict[str, int]:
    """The character by which byte-level BPE writes each byte, as the byte: printable Latin-1 stands for itself, the
    others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def segments(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, the offsets of all segments (one more than segments), and the first segment of each text. Texts begin
    with a space and so does every segment."""
    data, at = text_bytes(texts)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        cut[1:-2] = (data[1:-1] == 0x20) & ~_SPACE[data[:-2]] & _GOES_ON[data[2:]]
        inner = at[1:-1]  # the byte after the space must belong to the same text
        cut[inner[inner > 0] - 1] = False
    cut[at] = True
    bounds = np.flatnonzero(cut)
    return data, bounds, np.searchsorted(bounds, at)


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0].., begin[1].. and so on, size[i] values each."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - begin, size)


class Aligner:
    """A worker's two tokenizers and the alignments of all segments it has met."""

    def __init__(self, definition: str, model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.encoder = Encoder(definition)  # for segments without "<|", many in one call
        self.plain = Tokenizer.from_str(definition)
        self.plain.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        value = byte_values()
        vocabulary = self.plain.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(value[c] for c in token)
        names = self.pieces.id_to_piece(list(range(self.pieces.vocab_size())))
        special = [self.pieces.is_byte(i) for i in range(len(names))]
        self.bytes_b = [bytes([int(s[1:-1], 16)]) if b else s.replace(SPACE_MARK, " ").encode() for s, b in zip(names, special)]
        if any(SPACE_MARK in s.lstrip(SPACE_MARK) for s in names):
            raise ValueError("a piece reaches over a space")
        self.space = self.pieces.piece_to_id(SPACE_MARK)
        self.length_a, self.length_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.bytes_a, self.bytes_b))
        same = {b: i for i, b in enumerate(self.bytes_b) if special[i]} | {
            b: i for i, b in enumerate(self.bytes_b) if not (special[i] or self.pieces.is_control(i) or self.pieces.is_unknown(i))
        }
        self.identity = np.array([same.get(b, -1) for b in self.bytes_a])
        self.clear()

    def clear(self) -> None:
        self.known, self.groups = Known(), []
        self.numbers = np.zeros((1 << 14, 4), np.int64)  # a slot's tokens of A and of B, groups, links
        self.begin, self.size, self.bad = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, bool)
        self.codes, self.times, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint32), 0

    def regular(self, codes: np.ndarray) -> np.ndarray:
        """Whether each pair code is an A id and the B id of the same bytes."""
        return self.identity[codes // len(self.bytes_b)] == codes % len(self.bytes_b)

    def ids(self, parts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: the ids of all segments in a row, and how many each has."""
        texts = [p.decode("utf-8") for p in parts]
        if any("<|" in t for t in texts):
            coded = [e.ids for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)]
            size = np.fromiter(map(len, coded), np.int64, len(coded))
            a = np.fromiter(chain.from_iterable(coded), np.int64, int(size.sum())), size
        else:
            a = self.encoder._ids(texts)
        # B adds a space of its own, but none to nothing
        coded = [ids or [self.space] for ids in self.pieces.encode([t[1:] for t in texts], num_threads=1)]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        return [a, (np.fromiter(chain.from_iterable(coded), np.int64, int(size.sum())), size)]

    def _whole(self, parts: list[bytes], ids: np.ndarray, size: np.ndarray, table: list[bytes]) -> np.ndarray:
        """Whether the joined bytes of each segment's tokens are the segment."""
        coded = [table[i] for i in ids.tolist()]
        if b"".join(coded) == b"".join(parts):
            sums = np.concatenate([[0], np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))])[np.concatenate([[0], np.cumsum(size)])]
            return np.diff(sums) == np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(size).tolist()
        return np.array([b"".join(coded[e - n : e]) == p for p, e, n in zip(parts, ends, size.tolist())], bool)

    def remember(self, keys: np.ndarray, parts: list[bytes]) -> np.ndarray:
        """Encode and align new segments; returns their slots."""
        (a, size_a), (b, size_b) = self.ids(parts)
        ok = self._whole(parts, a, size_a, self.bytes_a) & self._whole(parts, b, size_b, self.bytes_b)
        seg_a, seg_b = np.repeat(np.arange(len(parts)), size_a), np.repeat(np.arange(len(parts)), size_b)
        a, b, seg_a = a[ok[seg_a]].astype(np.int64), b[ok[seg_b]].astype(np.int64), seg_a[ok[seg_a]]
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        n_a, n_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        segment = seg_a[first_a]  # of each group
        # links: every A token with all B tokens of its group
        times = n_b[group_a]
        code = np.repeat(a, times) * len(self.bytes_b) + b[ranges(first_b[group_a], times)]
        links, n = np.unique(np.repeat(seg_a, times).astype(np.uint64) << _U(32) | code.astype(np.uint64), return_counts=True)
        of = (links >> _U(32)).astype(np.int64)
        slots = self.known.add(keys)
        s, e = int(slots[0]), int(slots[0]) + len(parts)
        self.numbers = grown(self.numbers.reshape(-1), 4 * e).reshape(-1, 4)
        self.begin, self.size, self.bad = grown(self.begin, e), grown(self.size, e), grown(self.bad, e)
        self.codes, self.times = grown(self.codes, self.used + len(links)), grown(self.times, self.used + len(links))
        per = [np.bincount(segment, w, len(parts)) for w in (n_a, n_b, np.ones(len(common)), n_a * n_b)]
        self.numbers[s:e], self.bad[s:e] = np.stack(per, 1), ~ok
        self.size[s:e] = np.bincount(of, minlength=len(parts))
        self.begin[s:e] = self.used + np.cumsum(self.size[s:e]) - self.size[s:e]
        self.codes[self.used : self.used + len(links)] = (links & _U(0xFFFFFFFF)).astype(np.uint32)
        self.times[self.used : self.used + len(links)] = n
        self.used += len(links)
        # the groups as text
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        spans = zip(first_a.tolist(), (first_a + n_a).tolist(), first_b.tolist(), (first_b + n_b).tolist())
        text = [f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}" for i, j, k, m in spans]
        at = np.searchsorted(segment, np.arange(len(parts) + 1)).tolist()
        self.groups += [";".join(text[i:j]).encode() for i, j in zip(at, at[1:])]
        return slots

    def slots(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The slots of all segments of texts that begin with a space, and how many each text has."""
        data, bounds, first = segments(texts)
        keys, place, code = distinct(span_hashes(_TABLE[data], bounds[:-1], bounds[1:]))
        slots = self.known.find(keys)
        new = np.flatnonzero(slots < 0)
        if len(new):
            raw, spans = data.tobytes(), zip(bounds[place[new]].tolist(), bounds[place[new] + 1].tolist())
            slots[new] = self.remember(keys[new], [raw[i:j] for i, j in spans])
        return slots[code], np.diff(first)


def worker_aligner(spark: SparkSession, tokenizer_a: str, tokenizer_b: str):
    """The worker's aligner for the files at the two paths, which only the driver reads: tasks get their content as a
    broadcast of a few MB, whatever the corpus."""
    with open(tokenizer_a, encoding="utf-8") as f, open(tokenizer_b, "rb") as g:
        content = spark.sparkContext.broadcast((f.read(), g.read()))
    key = uuid.uuid4().hex
    return lambda: per_worker(key, lambda: Aligner(*content.value))


ROW = "kind int, key long, chunk long, codes binary, counts binary"
#: Kinds of rows: pairs of a chunk by hash slice; vectors by block, summed or to be; answers to chunks; highest counts by block.
ASKED, VECTOR, ANSWER, HIGHEST, TOTAL = range(5)
_ROW = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("chunk", pa.int64()), ("codes", pa.binary()), ("counts", pa.binary())])
CHUNK = (
    "chunk long, ids array<bigint>, numbers binary, digests binary, groups array<string>, "
    "doc_size binary, doc_segment binary, doc_times binary, seg_size binary, seg_link binary, seg_times binary, links binary"
)
_BINARY = ("numbers", "digests", "doc_size", "doc_segment", "doc_times", "seg_size", "seg_link", "seg_times", "links")
_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("groups", pa.list_(pa.string())), *((c, pa.binary()) for c in _BINARY)]
    + [f for f in _ROW if f.name != "chunk"]
)


def _blocks(vector: np.ndarray, kind: int) -> list[dict]:
    return [{"kind": kind, "key": k, "counts": v.astype("<i8").tobytes()} for k, v in enumerate(np.array_split(vector, BLOCKS))]


def first_pass(docs: DataFrame, aligner, n_slices: int, with_groups: bool) -> DataFrame:
    """CHUNK columns and ROW columns: a chunk's texts and links, its irregular pairs by slice, and a task's vector."""

    def run(batches):
        own, task, number = aligner(), TaskContext.get().partitionId(), 0
        vector = np.zeros(len(own.bytes_a), np.int64)
        held, volume = [], 0

        def flush():
            chunk = task << 24 | number
            ids = [i for h in held for i in h[0]]
            slots, size = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            doc = np.repeat(np.arange(len(ids)), size)
            none = np.bincount(doc, own.bad[slots], len(ids)) > 0
            digests, groups = [], []
            for gone, e, n in zip(none.tolist(), np.cumsum(size).tolist(), size.tolist()):
                text = b"" if gone or not n else b";".join([own.groups[s] for s in slots[e - n : e].tolist()])
                digests.append(hashlib.sha256(text).digest() if text else bytes(32))
                if with_groups:
                    groups.append(text.decode())
            slots, doc = slots[~none[doc]], doc[~none[doc]]
            numbers = np.stack([np.bincount(doc, own.numbers[slots, i], len(ids)).astype(np.int64) for i in range(4)], 1)
            # a text's distinct segments, and the chunk's
            pair, times = np.unique(doc.astype(np.uint64) << _U(32) | slots.astype(np.uint64), return_counts=True)
            doc, slot = (pair >> _U(32)).astype(np.int64), (pair & _U(0xFFFFFFFF)).astype(np.int64)
            here, segment = np.unique(slot, return_inverse=True)
            at = ranges(own.begin[here], own.size[here])
            links, link = np.unique(own.codes[at], return_inverse=True)
            # the documents that hold each pair
            begin, n = (np.cumsum(own.size[here]) - own.size[here])[segment], own.size[here][segment]
            holds = np.unique(np.repeat(doc, n).astype(np.uint64) << _U(32) | link[ranges(begin, n)].astype(np.uint64))
            counts = np.bincount((holds & _U(0xFFFFFFFF)).astype(np.int64), minlength=len(links))
            regular = own.regular(links.astype(np.int64))
            np.add.at(vector, links[regular].astype(np.int64) // len(own.bytes_b), counts[regular])
            codes, counts = links[~regular], counts[~regular]
            yield {
                "chunk": chunk, "ids": ids, "groups": groups or None, "numbers": numbers.tobytes(), "digests": b"".join(digests),
                "doc_size": np.bincount(doc, minlength=len(ids)).astype("<u4").tobytes(), "doc_segment": segment.astype("<u4").tobytes(),
                "doc_times": times.astype("<u4").tobytes(), "seg_size": own.size[here].astype("<u4").tobytes(),
                "seg_link": link.astype("<u4").tobytes(), "seg_times": own.times[at].astype("<u4").tobytes(), "links": links.astype("<u4").tobytes(),
            }
            for k, some in group_slices(mix(codes.astype(np.uint64)), n_slices):
                yield {"kind": ASKED, "key": k, "chunk": chunk, "codes": codes[some].astype("<u4").tobytes(), "counts": counts[some].astype("<u4").tobytes()}

        for batch in text_chunks(batches, "text"):
            text = batch.column(1)
            spaced = pc.if_else(pc.equal(pc.binary_length(text), 0), "", pc.binary_join_element_wise(" ", text, ""))
            slots, size = own.slots(spaced.cast(pa.large_string()))
            held.append((batch.column(0).to_pylist(), slots, size))
            volume += batch.nbytes
            if volume > FLUSH:
                for row in flush():
                    yield pa.RecordBatch.from_pylist([row], _CHUNK)
                held, volume, number = [], 0, number + 1
            if len(own.known) > CACHE_SEGMENTS:
                if held:
                    for row in flush():
                        yield pa.RecordBatch.from_pylist([row], _CHUNK)
                    held, volume, number = [], 0, number + 1
                own.clear()
        if held:
            for row in flush():
                yield pa.RecordBatch.from_pylist([row], _CHUNK)
        if vector.any():
            yield pa.RecordBatch.from_pylist(_blocks(vector, VECTOR), _CHUNK)

    fields = f"chunk long, ids array<bigint>, groups array<string>, {', '.join(f'{c} binary' for c in _BINARY)}, kind int, key long, codes binary, counts binary"
    return docs.mapInArrow(run, fields)


def summed_pairs(asked: DataFrame, n_b: int, n_a: int) -> DataFrame:
    """ROWs: per slice the sums of its pairs (TOTAL), for each chunk the sums of the pairs it asked (ANSWER, in its order),
    and the highest sum of each A id (HIGHEST, by block)."""

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        key = rows[0]["key"]
        codes, counts = ([np.frombuffer(r[c], "<u4") for r in rows] for c in ("codes", "counts"))
        code, place = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(code)).astype(np.int64)
        answers = np.split(total[place], np.cumsum([len(c) for c in codes])[:-1])
        out = [{"kind": ANSWER, "key": key, "chunk": r["chunk"], "counts": v.astype("<i8").tobytes()} for r, v in zip(rows, answers)]
        out.append({"kind": TOTAL, "key": key, "codes": code.astype("<u4").tobytes(), "counts": total.astype("<i8").tobytes()})
        highest = np.zeros(n_a, np.int64)
        np.maximum.at(highest, code.astype(np.int64) // n_b, total)
        return pa.Table.from_pylist(out + _blocks(highest, HIGHEST), _ROW)

    return asked.groupBy("key").applyInArrow(add, ROW)


def vector_of(rows: DataFrame, kind: int, n_a: int, merge) -> np.ndarray:
    """Vectors of A's vocabulary, merged block by block on the executors: the vocabulary's length reaches the driver."""

    def add(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, "<i8") for b in table.column("counts").to_pylist()]
        row = {"kind": kind, "key": table.column("key")[0].as_py(), "counts": merge(np.stack(parts), axis=0).astype("<i8").tobytes()}
        return pa.Table.from_pylist([row], _ROW)

    found = rows.filter(F.col("kind") == kind).select("kind", "key", "chunk", "codes", "counts").groupBy("key").applyInArrow(add, ROW)
    out = np.array_split(np.zeros(n_a, np.int64), BLOCKS)
    for r in found.collect():
        out[r["key"]] = np.frombuffer(bytes(r["counts"]), "<i8")
    return np.concatenate(out)


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Alignment:
    """The alignment of a corpus: ``documents`` and ``pairs``."""

    def __init__(self, docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = False):
        spark = docs.sparkSession
        self.n_slices = n_slices = slices(spark)
        self.aligner = worker_aligner(spark, tokenizer_a, tokenizer_b)
        own = self.aligner()
        self.n_a, self.n_b, self.identity = len(own.bytes_a), len(own.bytes_b), own.identity
        rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
        # one pass writes both: a chunk's own row stays in its bucket, the others have no digests
        found = bucketed(first_pass(rows, self.aligner, n_slices, with_groups), "alignment", "chunk", n_slices)
        self.chunks = found.filter(F.col("kind").isNull())
        self.summed = stored(summed_pairs(found.filter(F.col("kind") == ASKED).select("kind", "key", "chunk", "codes", "counts"), self.n_b, self.n_a), "alignment-pairs")
        self.vector = vector_of(found, VECTOR, self.n_a, np.sum)
        self.highest = np.maximum(self.vector, vector_of(self.summed, HIGHEST, self.n_a, np.max))
        self.with_groups = with_groups

    def documents(self) -> DataFrame:
        """A row a document: doc_id, the six numbers, groups_sha256, and ``groups`` if wanted."""
        vectors = self.chunks.sparkSession.sparkContext.broadcast((self.vector, self.highest, self.identity))
        n_b, n_slices, with_groups = self.n_b, self.n_slices, self.with_groups

        def merge(chunks: pa.Table, answers: pa.Table) -> pa.Table:
            vector, highest, identity = vectors.value
            parts = []
            for r in chunks.to_pylist():
                links, doc_size, doc_segment, doc_times, seg_size, seg_link, seg_times = (
                    np.frombuffer(r[c], "<u4").astype(np.int64) for c in ("links", "doc_size", "doc_segment", "doc_times", "seg_size", "seg_link", "seg_times")
                )
                a = links // n_b
                odd = np.flatnonzero(identity[a] != links % n_b)
                count = vector[a]
                told = {x["key"]: np.frombuffer(x["counts"], "<i8") for x in answers.to_pylist()}
                for k, some in group_slices(mix(links[odd].astype(np.uint64)), n_slices):
                    count[odd[some]] = told[k]
                best = count == highest[a]
                segment = np.repeat(np.arange(len(seg_size)), seg_size)
                of_segment = [np.bincount(segment, seg_times * v[seg_link], len(seg_size)) for v in (best, count)]
                doc = np.repeat(np.arange(len(doc_size)), doc_size)
                sums = [np.bincount(doc, doc_times * v[doc_segment], len(doc_size)).astype(np.int64) for v in of_segment]
                numbers = np.frombuffer(r["numbers"], np.int64).reshape(-1, 4)
                digests = [r["digests"][i : i + 32] for i in range(0, len(r["digests"]), 32)]
                columns = {"doc_id": pa.array(r["ids"], pa.int64())}
                columns |= dict(zip(NUMBERS, [*numbers.T, *sums]))
                columns["groups_sha256"] = [d.hex() if n else "" for d, n in zip(digests, numbers[:, 0].tolist())]
                if with_groups:
                    columns["groups"] = pa.array(r["groups"], pa.string())
                parts.append(pa.table(columns))
            return pa.concat_tables(parts) if parts else pa.table({k: pa.array([], t) for k, t in kinds.items()})

        kinds = {"doc_id": pa.int64(), **{c: pa.int64() for c in NUMBERS}, "groups_sha256": pa.string()} | ({"groups": pa.string()} if with_groups else {})
        schema = ", ".join(f"{k} {'string' if t == pa.string() else 'long'}" for k, t in kinds.items())
        answers = self.summed.filter(F.col("kind") == ANSWER).select("chunk", "key", "counts")
        return self.chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(merge, schema)

    def pairs(self) -> DataFrame:
        """(a, b, documents): all linked id pairs and how many documents hold them."""
        n_b = self.n_b

        def unfold(batches):
            for batch in batches:
                for codes, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    code, n = np.frombuffer(codes, "<u4").astype(np.int64), np.frombuffer(counts, "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array(code // n_b), pa.array(code % n_b), pa.array(n)], ["a", "b", "documents"])

        irregular = self.summed.filter(F.col("kind") == TOTAL).select("codes", "counts").mapInArrow(unfold, "a long, b long, documents long")
        at = np.flatnonzero(self.vector)
        rows = list(zip(at.tolist(), self.identity[at].tolist(), self.vector[at].tolist()))
        return irregular.unionByName(self.chunks.sparkSession.createDataFrame(rows, "a long, b long, documents long"))
