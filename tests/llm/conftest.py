import random
import re
import string

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    from velocart.llm.store import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def corpus():
    """Random texts with exact copies (case changed), near copies, shared passages, empty and long texts."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 6))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    passages = [prose(60) for _ in range(6)]
    texts = []
    for _ in range(60):
        words = (prose(rng.randint(1, 90)) + " " + (rng.choice(passages) if rng.random() < 0.3 else "") + " " + prose(30)).split()
        texts.append(" ".join(words))
    for i in range(0, 30):
        words = texts[i].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words).upper() if i % 5 == 0 else " ".join(words))
    texts += [None, "", " \n\t", "one", "One two three", "one two three", prose(6000), "x " * 500, texts[3], texts[3], texts[4] + "\n"]
    rng.shuffle(texts)
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids and texts, repeated rows, and further columns named like the operators' own."""
    rows = [
        (None, None, 1, 1, "a", "k"), (None, "same text here", 2, 2, "b", "k"), (4, "Same text here", 3, 3, None, None),
        (4, "Same text here", 3, 3, None, None), (4, "other text", 4, 4, "d", "k"), (5, "", None, None, "e", "k"), (6, None, 5, 5, "f", "k"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, row long, n int, file string, key string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
