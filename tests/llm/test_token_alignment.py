import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from velocart.llm import token_alignment
from velocart.llm.token_alignment import NUMBERS, Aligner, Alignment, byte_values

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = "doc_id long, text string"


class Plain:
    """Whole texts by the two libraries, groups by offsets: no segments, no cache."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.value = byte_values()

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False)
        left = [(i, len(bytes(self.value[c] for c in t))) for i, t in zip(a.ids, a.tokens)]
        right = []
        whole_b = b""
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            right.append((i, len(raw)))
            whole_b += raw
        whole = (" " + text).encode()
        if b"".join(bytes(self.value[c] for c in t) for t in a.tokens) != whole or whole_b != whole:
            return []
        out, at_a, at_b, i, j, group = [], 0, 0, 0, 0, ([], [])
        while i < len(left) or j < len(right):
            if at_a <= at_b:
                group[0].append(left[i][0])
                at_a += left[i][1]
                i += 1
            else:
                group[1].append(right[j][0])
                at_b += right[j][1]
                j += 1
            if at_a == at_b:
                out.append(group)
                group = ([], [])
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(rows, plain):
    documents, counts, links = [], Counter(), []
    for d, t in rows:
        groups = plain.groups(t)
        pairs = [(a, b) for x, y in groups for a in x for b in y]
        links.append(pairs)
        counts.update(set(pairs))
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        documents.append((d, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(pairs), text))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for (d, a, b, g, n, text), pairs in zip(documents, links):
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((d, a, b, g, n, sum(counts[p] == best[p[0]] for p in pairs), sum(counts[p] for p in pairs), digest))
    return sorted(out, key=str), counts


def found(df):
    return sorted(((r.doc_id, *(r[c] for c in NUMBERS), r.groups_sha256) for r in df.collect()), key=str)


STRANGE = [
    "<|endoftext|> a <|endoftext|>b <s>x</s> <unk> <0x41>", "a▁b", "▁", " ", "  ", "a ", " a", "a  b   c", "\n\n a\t b", "x  y", "   z",
    "　 w   v", "don't we'll I'D", "Straße naïve ÉCOLE Ünïcödé", "日本語 テキスト 中文", "🙂 👩‍👩‍👧 é", "a\0b \x01", "1234567 3.14 -- ... !!!", "x" * 300, "ab " * 200,
    "\r\n x \x85 y", "<| |>", "a.b,c;d", "the The THE",
]


def test_alignment_equals_brute_force(spark, docs, corpus, plain):
    rows = [(c[0], c[1]) for c in corpus] + [(1000 + i, t) for i, t in enumerate(STRANGE)]
    wanted, counts = expected(rows, plain)
    got = Alignment(spark.createDataFrame(rows, FIELDS).repartition(5), A, B, with_groups=True)
    assert found(got.documents()) == wanted
    assert {(r.a, r.b): r.documents for r in got.pairs().collect()} == counts
    for r in got.documents().collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")


def test_chunks_and_caches_make_no_difference(spark, corpus, plain, monkeypatch):
    """Small chunks, and a worker memory that is cleared again and again."""
    monkeypatch.setattr(token_alignment, "FLUSH", 3000)
    rows = [(c[0], c[1]) for c in corpus[:60]]
    wanted, _ = expected(rows, plain)
    assert found(Alignment(spark.createDataFrame(rows, FIELDS).repartition(2), A, B).documents()) == wanted
    monkeypatch.setattr(token_alignment, "CACHE_SEGMENTS", 5)
    assert found(Alignment(spark.createDataFrame(rows, FIELDS).repartition(2), A, B).documents()) == wanted


def test_alignment_awkward(spark, awkward, nothing, plain):
    wanted, _ = expected([(r.doc_id, r.text) for r in awkward.collect()], plain)
    renamed = awkward.withColumn("chunk", awkward.n).withColumn("kind", awkward.n).withColumn("groups", awkward.key)
    assert found(Alignment(renamed, A, B).documents()) == wanted
    assert found(Alignment(nothing, A, B).documents()) == []
    assert Alignment(nothing, A, B).pairs().count() == 0


def test_very_long_text(spark, plain):
    rng = random.Random(1)
    rows = [(1, "".join(rng.choices("abé ,.\n1", k=400_000))), (2, "b"), (2, "b")]
    wanted, _ = expected(rows, plain)
    assert found(Alignment(spark.createDataFrame(rows, FIELDS), A, B).documents()) == wanted


def test_segments_are_aligned_as_whole_texts(plain):
    """Random texts over awkward characters: the segments' ids in a row are the text's."""
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        own = Aligner(f.read(), g.read())
    rng = random.Random(2)
    alphabet = "ab Z19.,;'’\n\t\r 　 \u0085é́ßÅ日🙂<|>s_-​‍ "
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(4000)]
    slots, size = own.slots(pa.array([" " + t for t in texts], pa.large_string()))
    ends = size.cumsum().tolist()
    for t, e, n in zip(texts, ends, size.tolist()):
        mine = b"" if own.bad[slots[e - n : e]].any() else b";".join(own.groups[s] for s in slots[e - n : e])
        assert mine.decode() == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in plain.groups(t)), repr(t)
