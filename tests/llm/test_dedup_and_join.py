import hashlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.conftest import LOWER, WORD
from velocart.llm import exact_dedup, ngram_join, substring_dedup
from velocart.llm.components import components


def norm(t):
    return (t or "").translate(LOWER)


def expected_dedup(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append(d)
    return {d: (max(groups[norm(t)]), len(groups[norm(t)]), d == max(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for d, t in rows}


def test_exact_dedup_and_collisions(docs, corpus):
    wanted = expected_dedup([(c[0], c[1]) for c in corpus])
    for key in (None, lambda c: F.substring(c, 1, 1)):  # a weak key makes hits that are no copies
        got = exact_dedup.dedup(docs, state_key=key)
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()} == wanted


def test_exact_dedup_lowers_ascii_only(spark):
    got = exact_dedup.dedup(spark.createDataFrame([(1, "Éa"), (2, "éA"), (3, "ÉA")], "doc_id long, text string"))
    assert {r.doc_id: r.keep_id for r in got.collect()} == {1: 3, 2: 2, 3: 3}


def test_exact_dedup_awkward(awkward, nothing):
    rows = exact_dedup.dedup(awkward).collect()
    assert len(rows) == 7 and sum(r.kept for r in rows) == 3
    assert sorted((r.keep_id, r.group_size) for r in rows if r.kept) == [(4, 1), (4, 3), (6, 3)]
    assert exact_dedup.dedup(nothing).count() == 0
    assert exact_dedup.keep(awkward).columns == awkward.columns and exact_dedup.keep(awkward).count() == 3


def expected_join(rows, percent=75):
    sets, root = {}, {}
    for d, t in rows:
        words = WORD.findall(norm(t))
        sets[d] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()
        root[d] = d

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_ngram_join_equals_brute_force(docs, corpus):
    for percent in (75, 50):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, percent).collect()}
        assert got == expected_join([(c[0], c[1]) for c in corpus], percent)


def test_ngram_join_of_a_large_group_of_near_copies(spark):
    """All pairs of 400 near copies are similar; links stay about as many as documents."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[: i % 190] + [f"x{i}"] + base[i % 190 + 1 :])) for i in range(400)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert {r.component_id for r in got} == {0}


def test_ngram_join_chain(spark):
    """Links reach along a chain whose ends share nothing."""
    rows = [(i, " ".join(f"w{k}" for k in range(i * 10, i * 10 + 100))) for i in range(40)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_ngram_join_awkward(awkward, nothing):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(awkward).collect()), key=str)
    assert got == sorted([(None, 0, None), (None, 1, 4), (4, 1, 4), (4, 1, 4), (4, 1, 4), (5, 0, 5), (6, 0, 6)], key=str)
    assert ngram_join.join(nothing).count() == 0
    kept = ngram_join.keep(awkward)
    assert kept.columns == awkward.columns and kept.count() == 5


def test_trie_prunes_parts_and_lengths():
    trie = ngram_join.Trie()
    trie.insert(1, [(7, 130), (8, 130)], 100, 1)
    trie.insert(2, [(7, 130), (9, 130)], 100, 1)
    trie.insert(3, [(9, 13)], 10, 3)
    assert trie.partners([(7, 130)], 100, 1, 75) == set()
    assert trie.partners([(7, 130)], 100, 5, 75) == {1, 2}
    assert trie.partners([(9, 130)], 100, 5, 75) == {2}
    # too far back in one set or in the other
    assert trie.partners([(7, 99)], 100, 5, 75) == set()
    assert trie.partners([(7, 140)], 131, 5, 75) == set()


def test_trie_finds_every_similar_pair():
    """Brute force over random sets: whatever is similar meets at its first common shingle, within the bounds."""
    import numpy as np

    rng = np.random.default_rng(8)
    for percent in (75, 60, 90):
        sets, base = [], rng.permutation(4000)[:120]
        for i in range(80):
            s = base.copy()
            change = rng.integers(0, 30)
            s[rng.integers(0, len(s), change)] = rng.integers(5000, 9000, change)
            sets.append(np.unique(s[: rng.integers(90, 121)]))
        order = rng.permutation(9000)  # of all shingles
        rows = []
        for i, s in enumerate(sets):
            prefix = s[np.argsort(order[s])][: ngram_join.prefix_length(len(s), percent)]
            rows += [(int(t), i, len(s), at) for at, t in enumerate(prefix)]
        token, member, n, position = (np.array(c) for c in zip(*rows))
        found = ngram_join.cross_pairs(token, member, n, position, member, percent)
        wanted = {(a, b) for b in range(len(sets)) for a in range(b) if ngram_join.similar(sets[a], sets[b], percent)}
        assert wanted and wanted <= found
        parts = member % 7
        assert {p for p in wanted if p[0] % 7 != p[1] % 7} <= ngram_join.cross_pairs(token, member, n, position, parts, percent)
        assert all(a % 7 != b % 7 for a, b in ngram_join.cross_pairs(token, member, n, position, parts, percent))


def test_shortened_hashes_that_meet_lose_no_link():
    """Two sets sharing 90 of 110 shingles, whose tokens are forced to meet wrongly, early or within one set."""
    import numpy as np

    n, own = 100, 10
    shared = np.arange(1000, 1090)
    sets = [np.concatenate([np.arange(own), shared]), np.concatenate([np.arange(500, 500 + own), shared])]
    prefix = ngram_join.prefix_length(n, 75)
    for clash in range(prefix):
        tokens = [s[:prefix].copy() for s in sets]
        tokens[1][clash] = tokens[0][prefix - 1 - clash]  # not the same shingle
        rows = [(int(t), i, n, at) for i, s in enumerate(tokens) for at, t in enumerate(s)]
        token, member, size, position = (np.array(c) for c in zip(*rows))
        if tokens[1][own] == tokens[0][own]:  # unless the first common shingle itself was overwritten
            assert ngram_join.cross_pairs(token, member, size, position, member, 75) == {(0, 1)}


def test_ngram_join_ends_alike_without_rounds(spark, docs, corpus, monkeypatch):
    """Rounds only save work."""
    wanted = expected_join([(c[0], c[1]) for c in corpus])
    for rounds in (0, 1):
        monkeypatch.setattr(ngram_join, "STAR_ROUNDS", rounds)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()} == wanted


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 50)] + [(100, 102), (102, 101), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(51)}) == 1 and len({got[i] for i in (100, 101, 102)}) == 1
    assert got[0] != got[100] and 200 not in got


def expected_passages(rows, width=35):
    words = {i: WORD.findall(t or "") for i, (_, t) in enumerate(rows)}
    seen = Counter(tuple(v[i : i + width]) for v in words.values() for i in range(len(v) - width + 1))
    out = []
    for k, (d, _) in enumerate(rows):
        v, gone = words[k], set()
        for i in range(len(v) - width + 1):
            if seen[tuple(v[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(v) if i not in gone)
        out.append((d, len(v), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_passages_equal_brute_force(spark, docs, corpus):
    import random

    rng = random.Random(3)
    rows = [(c[0], c[1]) for c in corpus]
    passages = [rng.choices("abcdef", k=rng.randint(30, 60)) for _ in range(20)]
    for i in range(600):  # few different words, long runs, cut passages
        text = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.4:
                p = rng.choice(passages)
                text += p[rng.randint(0, 5) : len(p) - rng.randint(0, 5)]
            elif kind < 0.6:
                text += [rng.choice("xyz")] * rng.randint(1, 50)
            else:
                text += rng.choices("abcdefghijkl", k=rng.randint(1, 30))
        rows.append((1000 + i, " ".join(text)))
    got = substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == expected_passages(rows)


def test_passages_awkward(awkward, nothing, spark):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = substring_dedup.dedup(awkward).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == expected_passages(rows)
    assert substring_dedup.dedup(nothing).count() == 0
    long = " ".join(f"a{i}" for i in range(40))
    twice = substring_dedup.dedup(spark.createDataFrame([(1, long), (1, long), (None, "z " + long)], "doc_id long, text string"))
    assert sorted((r.n_words, r.n_removed, r.kept_text) for r in twice.collect()) == [(40, 40, ""), (40, 40, ""), (41, 40, "z")]


def test_a_class_looks_in_a_bounded_number_of_slices():
    """All its slices if they are few, else as many as allowed, others in another round."""
    import numpy as np

    few, many = ngram_join.OFFERS - 2, 5 * ngram_join.OFFERS
    owner = np.repeat([0, 1], [few, many])
    name = np.repeat(np.array([-5, 7]), [few, many])
    place = np.concatenate([np.arange(few), np.arange(many)]).astype(np.uint64)
    rounds = [ngram_join.looking(owner, name, place, salt) for salt in (0, 1)]
    for looks in rounds:
        assert looks[:few].all() and looks[few:].sum() == ngram_join.OFFERS
    assert (rounds[0] != rounds[1]).any()
    assert len(ngram_join.looking(owner[:0], name[:0], place[:0], 0)) == 0


def test_exact_dedup_goes_on_from_retained_state(spark, tmp_path):
    """A later arrival meets the state of an earlier run: it is counted, and stays if its id is larger."""
    schema = "doc_id long, file string, row long, key binary"
    arrivals, checkpoint = str(tmp_path / "arrivals"), str(tmp_path / "state")
    batches = [[(1, "f", 0, b"a"), (2, "f", 1, b"a"), (3, "f", 2, b"b")], [(9, "g", 0, b"a"), (0, "g", 1, b"b"), (4, "g", 2, b"c")], []]
    wanted = [{b"a": (2, 2), b"b": (3, 1)}, {b"a": (9, 3), b"b": (3, 2), b"c": (4, 1)}]
    for batch, state in zip(batches, wanted + wanted[1:]):  # the last run has nothing new
        if batch:
            spark.createDataFrame(batch, schema).write.mode("append").parquet(arrivals)
        got = exact_dedup.stream_state(spark, arrivals, spark.read.parquet(arrivals).schema, checkpoint)
        assert {bytes(r.key): (r.keep.doc_id, r.n) for r in got.collect()} == state


def test_rows_at_equals_a_join(spark, tmp_path, monkeypatch):
    """Places at the edges of words and maps, repeated or nowhere; the same rows with and without a broadcast."""
    from velocart.llm import store

    spark.range(3 * store.SPAN + 5).select(F.col("id").alias("doc_id"), F.lit(1).alias("span")).repartitionByRange(2, "doc_id").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    place = store.located(docs, {"doc_id": F.col("doc_id")}, "edges")
    ids = [0, 63, 64, 4095, 4096, 6146, 6147, 8191, 12292]
    places = place.filter(F.col("doc_id").isin(ids)).select("file", "row")
    odd = spark.createDataFrame([("nowhere", 0), (None, 1), ("nowhere", None)], "file string, row long")
    for maps in (store.MAPS, 0):
        monkeypatch.setattr(store, "MAPS", maps)
        got = store.documents_at(docs, places.unionAll(places).unionAll(odd))
        assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == ids
    assert store.documents_at(docs, odd).count() == 0


def test_rows_drawn_anew_at_each_read_are_stored_first(spark, tmp_path):
    from velocart.llm import store

    spark.range(10).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert store.on_files(docs.filter("id > 3"), "plain").columns == ["id"]
    drawn = store.on_files(docs.withColumn("draw", F.rand()), "drawn")
    assert hasattr(drawn, "_velocart_path") and not hasattr(store.on_files(docs, "plain"), "_velocart_path")
