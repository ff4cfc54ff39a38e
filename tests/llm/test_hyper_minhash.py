import random

import numpy as np
import pytest

from tests.llm.test_dedup_and_join import expected_join
from velocart.llm import hyper_minhash as H
from velocart.llm.words import mix

FIELDS = "doc_id long, text string"


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def sets_of_similarity(rng, size, t):
    """Two sets of about ``size`` with the similarity ``t`` or just over it."""
    both = int(np.ceil(2 * size * t / (1 + t) - 1e-9))
    ids = mix(rng.integers(0, 2**63, 2 * size, dtype=np.uint64))
    own = size - both
    return np.unique(ids[:size]), np.unique(np.concatenate([ids[:both], ids[size : size + own]]))


@pytest.mark.parametrize("size", [13, 20, 60, 150, 400, 3000])
def test_pairs_at_the_threshold_share_a_band(size):
    rng = np.random.default_rng(size)
    pairs = [sets_of_similarity(rng, size, 0.85) for _ in range(400)]
    sketch = H.registers([s for p in pairs for s in p])
    keys = H.band_keys(sketch, H.band_width(85))
    assert (keys[::2] == keys[1::2]).any(axis=1).all()
    n = np.array([len(s) for p in pairs for s in p])
    agree = (sketch[::2] == sketch[1::2]).sum(axis=1)
    got = H.estimate(agree, n[::2], n[1::2])
    assert (got >= H.least_estimate(np.minimum(n[::2], n[1::2]), 85)).all()
    true = [len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in pairs]
    assert abs(got.mean() - np.mean(true)) < 0.02 and max(true) < 0.91


def test_chance_agreement_is_corrected():
    """Unrelated sets agree in registers about as often as ``chance`` says, and are estimated about 0."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64)) for _ in range(400)]
    sketch = H.registers(sets)
    agree = (sketch[::2] == sketch[1::2]).mean()
    expected = H.chance(np.array([5000]), np.array([5000]))[0]
    assert 0.3 * expected < agree < 3 * expected
    few = np.array([H.REGISTERS * expected])
    assert abs(H.estimate(few, np.array([5000]), np.array([5000]))[0]) < 1e-9


def test_registers_do_not_depend_on_company():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 3, 50, 1000)]
    together = H.registers(sets)
    assert all((H.registers([s])[0] == r).all() for s, r in zip(sets, together))
    assert len(set(H.registers([sets[0]])[0].tolist())) == 1


@pytest.mark.parametrize("percent", [85, 75])
def test_components_equal_brute_force(spark, docs, corpus, percent):
    assert found(H.join(docs, percent)) == expected_join([(c[0], c[1]) for c in corpus], percent)


def mutated(rng, base, changes):
    words = list(base)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.random()}"
    return " ".join(words)


def family(rng, n, start=0, most=8):
    """Copies of one text with few to many changes: some similar, some only to others."""
    base = [f"w{rng.random()}" for _ in range(120)]
    return [(start + i, mutated(rng, base, rng.randint(0, most))) for i in range(n)]


@pytest.mark.parametrize("rounds,classes", [(3, 1000), (0, 1000), (0, 7), (1, 5)])
def test_families_with_and_without_rounds_and_split_units(spark, monkeypatch, rounds, classes):
    """Rounds only save work; units of a few classes find what whole buckets do."""
    monkeypatch.setattr(H, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(H, "UNIT_CLASSES", classes)
    rng = random.Random(7)
    rows = family(rng, 60) + family(rng, 25, 100) + family(rng, 12, 200, 3)
    rows += [(300 + i, " ".join(f"v{k}" for k in range(i * 6, i * 6 + 100))) for i in range(25)]  # a chain
    if rounds == 0 and classes == 1000:
        monkeypatch.setattr(H, "UNIT_SHINGLES", 300)
        rows = rows[:40] + rows[97:]
    got = found(H.join(spark.createDataFrame(rows, FIELDS).repartition(3)))
    assert got == expected_join(rows, 85)


def test_large_group_makes_no_row_a_pair(spark):
    """300 near copies of which about half aren't similar to each other: what is written between the steps stays
    about linear."""
    rng = random.Random(9)
    rows = family(rng, 300, most=6)
    got = found(H.join(spark.createDataFrame(rows, FIELDS).repartition(3)))
    assert got == expected_join(rows, 85)
    sets = [np.unique(np.array([hash(w) & (2**63 - 1) for w in t.split()], np.uint64)) for _, t in rows]
    assert len(H.joining_links(sets, np.arange(len(sets)), 50)) < len(sets)


def test_awkward(spark, awkward, nothing):
    renamed = awkward.withColumn("name", awkward.n).withColumn("sketch", awkward.key).withColumn("bucket", awkward.n)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in H.join(renamed).collect()), key=str)
    wanted = [(None, 0, None, True), (None, 1, 4, False), (4, 1, 4, True), (4, 1, 4, True), (4, 1, 4, True), (5, 0, 5, True), (6, 0, 6, True)]
    assert got == sorted(wanted, key=str)
    assert H.join(nothing).count() == 0
    kept = H.keep(awkward)
    assert kept.columns == awkward.columns and kept.count() == 5


def test_very_long_texts(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(base)), (2, mutated(rng, base, 500)), (3, mutated(rng, base, 9000)), (3, "")]
    got = sorted((r.doc_id, r.component_id) for r in H.join(spark.createDataFrame(rows, FIELDS)).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (3, 3)]
