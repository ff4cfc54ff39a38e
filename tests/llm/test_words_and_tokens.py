import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import LOWER, WORD
from velocart.llm import words as w
from velocart.llm.tokens import Encoder

CHARACTERS = ["A", "I", "K", "\u0307", "\u030a", " ", " ", "\n", "\t", " ", " ", "　", "\u0085", "\x1c", "a", "B", "é", "é", "1", "'s", ".", ",", "!", "日", "😀", "<|endoftext|>", "<|ENDOFTEXT|>", "ß", "İ", "Σ", "?x"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(CHARACTERS, k=rng.randint(0, 40))) for _ in range(n)] + ["", " ", "a ", None]


def test_words_are_those_of_the_pattern():
    texts = random_texts(400)
    found = w.split_words(pa.array(texts), True)
    for i, t in enumerate(texts):
        own = [found.word(k).decode() for k in range(found.first[i], found.first[i + 1])]
        assert own == WORD.findall((t or "").translate(LOWER))


def test_equal_words_and_windows_have_equal_hashes():
    a = w.split_words(pa.array(["p q r s t u", "zz q r s t u v"]), False)
    h, at = w.window_hashes(a.hashes(), a.first, 5)
    by_place = dict(zip(at.tolist(), h.tolist()))
    assert by_place[1] == by_place[7] and len(set(by_place.values())) == 4


def test_chunks_keep_all_rows_and_long_texts_whole():
    batch = pa.record_batch([pa.array(["a" * 10, "b" * 5000, None, "", "c" * 30])], ["text"])
    parts = list(w.text_chunks(iter([batch]), "text", 32))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_whole_text(name, corpus):
    path = public_tokenizers.path(name)
    plain, own = Tokenizer.from_file(path), Encoder(open(path, encoding="utf-8").read())
    texts = random_texts(3000) + [c[1] for c in corpus]
    for part in (texts, texts[::-1]):
        ids, at = own.encode(pa.array(part), 7)
        for i, t in enumerate(part):
            assert ids[at[i] : at[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids + [7]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_capitals_without_a_composed_form(name):
    path = public_tokenizers.path(name)
    plain, own = Tokenizer.from_file(path), Encoder(open(path, encoding="utf-8").read())
    pairs = ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a"]
    rng = random.Random(3)
    texts = [f"x {p} y" for p in pairs] + [p for p in pairs] + ["T", "\u0308 a"]
    texts += ["".join(rng.choices([*pairs, "H", "t", "W", "y", " ", ".", "\u030a", "\u0323", "é"], k=rng.randint(1, 30))) for _ in range(1000)]
    ids, at = own.encode(pa.array(texts), 7)
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids + [7]


def test_known_keys():
    known, keys = w.Known(), np.array([9, 3, 7], np.uint64)
    assert known.find(keys).tolist() == [-1, -1, -1]
    assert known.add(keys).tolist() == [0, 1, 2]
    assert known.add(np.array([5], np.uint64)).tolist() == [3]
    assert known.find(np.array([7, 5, 1], np.uint64)).tolist() == [2, 3, -1]
