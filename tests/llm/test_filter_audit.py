import re
from itertools import permutations

import pytest

from tests.llm.conftest import WORD
from velocart.llm import filter_audit


def expected(rows, labels):
    """Brute force: every document walked through every order."""
    smallest, out = {}, {}
    for d, t, _ in rows:
        t = t or ""
        if d is not None:
            smallest[t] = min(smallest.get(t, d), d)
    for d, t, part in rows:
        t, part = t or "", part or ""
        words = WORD.findall(t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if d is not None and d > smallest[t]:
            fails.add("E")
        good = any(q == 1 for i, q, _ in labels if i == d and d is not None)
        toxic = any(x == 1 for i, _, x in labels if i == d and d is not None)
        for order in permutations("ABCDE"):
            gone = False
            for k, letter in enumerate(order):
                row = out.setdefault((part, "".join(order), k + 1), [0] * 6)
                hit = letter in fails
                row[0] += not hit and not gone
                row[1] += hit and not gone
                row[2] += hit and gone
                row[3] += fails == {letter}
                row[4] += hit and not gone and good
                row[5] += hit and not gone and toxic
                gone = gone or hit
    shapley = {}
    for (part, order, k), row in out.items():
        shapley[part, order[k - 1]] = shapley.get((part, order[k - 1]), 0) + row[1]
    return {key: (*row, shapley[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def found(df):
    measures = (*filter_audit.MEASURES, "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[m] for m in measures) for r in df.collect()}


LABELS = "doc_id long, quality int, toxic int"


def test_audit_equals_brute_force(spark, docs, corpus):
    extra = [(500, "The " * 250, "en"), (501, "The " * 250, "de"), (502, " ".join(f"w{i}" for i in range(300)), "en"), (503, "ÉÀ a" * 9, "en"), (504, "a|b", None)]
    rows = [(c[0], c[1], c[2]) for c in corpus] + extra
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 60)] + [(0, 1, 0), (500, 1, 1), (9999, 1, 1)]
    labels = [(i, int(q), int(x)) for i, q, x in labels]
    got = filter_audit.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), spark.createDataFrame(labels, LABELS))
    assert found(got) == expected(rows, labels)


def test_audit_awkward(spark, awkward, nothing):
    """Null ids and texts, repeated rows, clashing column names, empty tables."""
    rows = [(r.doc_id, r.text, r.file) for r in awkward.collect()]
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 1), (5, None, None)], LABELS)
    got = filter_audit.audit(awkward.withColumn("mask", awkward.n).withColumn("part", awkward.key), labels, part="file")
    assert found(got) == expected(rows, [(4, 1, 0), (5, None, None)])
    assert filter_audit.audit(nothing, labels).count() == 0
    none = labels.filter("false")
    assert found(filter_audit.audit(awkward, none, part="key")) == expected([(r.doc_id, r.text, r.key) for r in awkward.collect()], [])


def test_very_long_text(spark):
    rows = [(1, "Ab# " * 400_000, "en"), (2, "ab " * 10, "en")]
    got = filter_audit.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([], LABELS))
    assert found(got) == expected(rows, [])


@pytest.mark.parametrize("n", [1, 2**40, 2**filter_audit.BITS - 1])
def test_integers_do_not_overflow(n):
    """The most documents a field holds, all of one mask: fields come back whole."""
    for mask in (0, 1, 31, 0b1100000 + 5):
        assert (filter_audit.unpack(n * filter_audit.pack(filter_audit.outcomes(mask))) == n * filter_audit.outcomes(mask)).all()
    a, b = filter_audit.outcomes(3), filter_audit.outcomes(24)
    assert (filter_audit.unpack(5 * filter_audit.pack(a) + 7 * filter_audit.pack(b)) == 5 * a + 7 * b).all()


def test_parts_are_handed_on(spark, monkeypatch):
    """More parts than a task holds at once."""
    monkeypatch.setattr(filter_audit, "PARTS", 3)
    rows = [(i, "text", f"p{i % 17}") for i in range(100)]
    got = filter_audit.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), spark.createDataFrame([], LABELS))
    assert found(got) == expected(rows, [])
