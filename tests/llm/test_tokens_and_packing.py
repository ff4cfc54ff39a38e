import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from velocart.llm import packing, token_files
from velocart.llm.store import new_path


def encoded(name, texts, end):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    return [np.array(plain.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for t in texts]


def test_token_files_round_trip(spark, docs, corpus):
    path, name = new_path(spark, "test-tokens"), "word_bpe_49k.json"
    token_files.write_token_files(docs, path, public_tokenizers.path(name), 1)
    rows = token_files.read_token_files(spark, path)
    ids = encoded(name, [c[1] for c in corpus], 1)
    starts = np.cumsum([0] + [len(x) for x in ids])
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.digests(rows).collect()} == {
        c[0]: (starts[i], len(ids[i]), zlib.crc32(ids[i].tobytes())) for i, c in enumerate(corpus)
    }
    assert {r.doc_id: r.ids for r in rows.collect()} == {c[0]: ids[i].tolist() for i, c in enumerate(corpus)}
    # metadata reads leave the ids alone; integers are delta-encoded, ids have a dictionary
    plan = rows.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids:" not in plan
    import glob

    encodings = {}
    for file in glob.glob(path.removeprefix("file:") + "/*.parquet"):
        group = pq.ParquetFile(file).metadata
        for g in range(group.num_row_groups):
            for c in range(group.num_columns):
                column = group.row_group(g).column(c)
                encodings.setdefault(column.path_in_schema, set()).update(column.encodings)
                assert column.has_offset_index
    assert "DELTA_BINARY_PACKED" in encodings["doc_id"]


def test_token_files_awkward(spark, awkward, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    where = new_path(spark, "test-tokens")
    token_files.write_token_files(awkward, where, path, 1)
    rows = sorted(token_files.read_token_files(spark, where).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 4, 4, 4, 5, 6] and [r.n_tokens for r in rows][-1] == 1
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    where = new_path(spark, "test-tokens")
    token_files.write_token_files(nothing, where, path, 1)
    assert token_files.digests(token_files.read_token_files(spark, where)).count() == 0


def check_packed(rows, ids_by_doc, size):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for doc, ids in ids_by_doc.items():
        parts = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        at = 0
        for r in parts:
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return 1 - sum(r.length for r in rows) / (size * len(by_sequence))


def test_packing(docs, corpus):
    name = "byte_bpe_50k.json"
    ids = dict(zip([c[0] for c in corpus], encoded(name, [c[1] for c in corpus], 0)))
    rows = packing.pack(docs, public_tokenizers.path(name)).collect()
    assert check_packed(rows, ids, 1024) < 0.05


def test_packing_awkward(awkward, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(awkward, path).collect()
    assert check_packed([r for r in rows], {}, 1024) < 1 and len(rows) == 7
    assert packing.pack(nothing, path).count() == 0


def test_plans_pack_every_length_within_one_percent():
    rng = np.random.default_rng(0)
    for hot in (None, 700, 513, 1023):
        lengths = rng.integers(1, 1024, 20000)
        if hot:
            lengths = np.where(rng.random(len(lengths)) < 0.4, hot, lengths)
        histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
        halve, table = packing.plan(histogram, 1024)
        pieces = {}
        for k, n in histogram.items():
            for part in (512, k - 512) if halve and 512 < k < 1024 else (k,):
                pieces[packing.class_of(part, 1024)] = pieces.get(packing.class_of(part, 1024), 0) + n
        used, sequences = np.zeros(200000), 0
        for i, (k, first, per, sequence, _) in enumerate(table.tolist()):
            end = table[i + 1, 1] if i + 1 < len(table) and table[i + 1, 0] == k else pieces[k]
            ranks = np.arange(end - first)
            np.add.at(used, sequence + ranks // per, k)
            sequences = max(sequences, sequence + int(ranks[-1] // per) + 1 if len(ranks) else 0)
        assert used.max() <= 1024
        assert sequences * 1024 * 0.985 <= lengths.sum(), (hot, halve, sequences, lengths.sum() / 1024)


def test_knapsack_finds_the_best_pattern():
    lengths = np.array([3, 5, 7])
    value, pattern = packing.best_pattern(np.array([0.3, 0.52, 0.7]), lengths, 10)
    assert pattern @ lengths <= 10 and abs(value - max(0.3 * a + 0.52 * b + 0.7 * c for a in range(4) for b in range(3) for c in range(2) if 3 * a + 5 * b + 7 * c <= 10)) < 1e-9


def test_short_pieces_fill_sequences():
    """5,000 equal pieces take at most one sequence more than they need."""
    for length in (1, 2, 5, 9, 17, 63, 64):
        _, table = packing.plan({length: 5000}, 1024)
        assert packing._sequences(table, {length: 5000}) <= -(-5000 // (1024 // length)) + 1, length


def test_classes_round_up_a_little(spark):
    size = 1024
    lengths = list(range(1, size + 1))
    rows = spark.createDataFrame([(x,) for x in lengths], "length long").select("length", packing.class_column(F.col("length"), size).alias("class")).collect()
    assert {r["length"]: r["class"] for r in rows} == {x: packing.class_of(x, size) for x in lengths}
    assert all(x <= packing.class_of(x, size) <= min(size, 1.03 * x) for x in lengths)
    assert all(packing.class_of(x, 1000) <= 1000 for x in range(1, 1001))


def test_empty_texts_and_repeated_ids_are_packed_alike(spark):
    """One-id documents fill sequences; equal ids with different texts have their places in any order of the rows."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    empty = packing.pack(spark.range(5000).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text"), path).collect()
    assert len(empty) == 5000 and check_packed(empty, {}, 1024) < 0.2 and len({r.sequence_id for r in empty}) <= 6
    rows = [(i % 3, "word " * (i % 40)) for i in range(300)]
    first, second = (
        sorted(tuple(r) for r in packing.pack(spark.createDataFrame(x, "doc_id long, text string").repartition(n), path).collect())
        for x, n in ((rows, 3), (rows[::-1], 5))
    )
    assert first == second
