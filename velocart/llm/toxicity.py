"""Toxicity: subword-bag embeddings under a linear softmax.

A word is the mean of the embeddings of its character n-grams, between word
marks, hashed into buckets; so misspellings and endings never seen share most
of a word's vectors. A window of two words is the mean of its words, a linear
softmax scores it, and a document is as toxic as its worst window: one insult
counts the same in a long text. Embeddings and softmax are trained jointly in
numpy on whole texts of a bounded sample of labelled rows; a held-back part
of the sample calibrates the score. As the model is linear up to the windows,
tasks get one number a bucket, and score each different word once a worker.

Defined results: null and empty texts score like a window without words;
labels other than 0 and 1, or null, are left out, as are labels without a
document and null ids of labels; without both classes (an empty table of
labels, too) every score is 0; an empty table of documents gives no rows; ids
with equal hashes and repeated ids are ordered by id and text, so the sample is
the same in every run; repeated rows get equal scores; other columns are not
read. No text is cut.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velocart.llm.words import _TABLE, Known, distinct, grown, per_worker, span_hashes, split_words, text_chunks

#: Labelled rows learned from, at most: of each label those with the smallest hashes of their ids.
TOXIC_SAMPLE, CLEAN_SAMPLE = 1400, 2800
#: Bytes of text learned from, at most, of each label.
SAMPLE_BYTES = 32 << 20
BUCKETS, DIM, WINDOW = 1 << 17, 8, 2
NGRAMS = (3, 4, 5, 6)
#: Words whose n-grams are handled at once in training.
BLOCK_WORDS = 30_000
#: Scored words a worker remembers before it starts afresh.
CACHE_WORDS = 1_500_000

# Between words: every ASCII character but letters and digits.
_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words in a row, and how many each word has (one at least)."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    end = np.cumsum(size)
    start, stop = end - size, np.repeat(end, size)
    at = np.arange(len(data))
    owner = np.repeat(np.arange(len(words)), size)
    begin, length, of = [start], [size], [np.arange(len(words))]  # the whole word
    for n in NGRAMS:
        fits = at[at + n <= stop]
        begin.append(fits)
        length.append(np.full(len(fits), n))
        of.append(owner[fits])
    begin, length, of = map(np.concatenate, (begin, length, of))
    bucket = (span_hashes(_TABLE[data], begin, begin + length) % np.uint64(BUCKETS)).astype(np.int32)
    order = np.argsort(of, kind="stable")
    return bucket[order], np.bincount(of, minlength=len(words))


def _mean(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Means of consecutive groups; count is 1 at least."""
    return np.add.reduceat(values, np.cumsum(count) - count) / count if len(count) else np.zeros(0)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the windows of all texts in a row, and the text of each; a rest shorter than half joins the last."""
    n = np.diff(first)
    k = np.maximum((n + WINDOW // 2) // WINDOW, (n > 0).astype(np.int64))
    of = np.repeat(np.arange(len(n)), k)
    size = np.full(len(of), WINDOW)
    last = np.cumsum(k)[k > 0] - 1
    size[last] = n[k > 0] - (k[k > 0] - 1) * WINDOW
    return size, of


def repeated(code: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Words that stand earlier in their window: they add nothing to its mean."""
    window = np.repeat(np.arange(len(size)), size)
    out = np.zeros(len(code), bool)
    for k in range(1, min(int(size.max(initial=1)), len(code))):
        out[k:] |= (code[k:] == code[:-k]) & (window[k:] == window[:-k])
    return out


@dataclass
class Model:
    """One number a bucket (the softmax's margin of its embedding), the margin's bias, and the calibration."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def train(texts: list[str], toxic: np.ndarray, epochs: int = 60, seed: int = 7) -> Model:
    """Fit on three quarters of the texts, calibrate on the rest."""
    if len(set(toxic.tolist())) < 2:
        return Model(np.zeros(BUCKETS), 0.0, 0.0, -60.0)
    rng = np.random.default_rng(seed)
    batch = pa.record_batch([pa.array(texts, pa.large_string())], ["text"])
    parts = [split_words(b.column(0), True, _GAP) for b in text_chunks(iter([batch]), "text")]
    _, place, code = distinct(np.concatenate([p.hashes() for p in parts]))
    before = np.cumsum([0] + [len(p.start) for p in parts])
    part_of = np.searchsorted(before, place, "right") - 1
    spelled = [parts[k].word(i - before[k]) for i, k in zip(place.tolist(), part_of.tolist())]
    # the n-grams of the words, in blocks that bound the arrays made of them
    blocks = [subwords(spelled[k : k + BLOCK_WORDS]) for k in range(0, len(place), BLOCK_WORDS)]
    edges = range(BLOCK_WORDS, len(place), BLOCK_WORDS)
    size, of = windows(np.cumsum(np.concatenate([[0], *(np.diff(p.first) for p in parts)])))
    del parts, spelled, batch
    begin = np.cumsum(size) - size
    per_text = np.bincount(of, minlength=len(texts))
    full = np.flatnonzero(per_text)  # texts with words
    y = toxic[full].astype(float)
    held = rng.random(len(full)) < 0.25
    held &= ~_only(y, held)
    balance = np.where(held, 0.0, np.where(y > 0, 0.5 / max(1, (y[~held] > 0).sum()), 0.5 / max(1, (y[~held] == 0).sum())))
    text_begin = np.cumsum(per_text[full]) - per_text[full]
    groups = np.repeat(np.arange(len(full)), per_text[full])

    embed = rng.normal(0, 1e-3, (BUCKETS, DIM)).astype(np.float32)  # n-grams never seen stay near 0
    softmax = rng.normal(0, 1.0, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2)
    speed = [np.full(BUCKETS, 1e-10), np.full((DIM, 2), 1e-10), np.full(2, 1e-10)]  # Adagrad
    once = (~repeated(code, size)).astype(np.float32)

    def margins() -> np.ndarray:
        per_bucket = embed @ (softmax[:, 1] - softmax[:, 0])
        per_word = np.concatenate([_mean(per_bucket[b], c) for b, c in blocks])
        return np.add.reduceat(per_word[code] * once, begin) / size + (bias[1] - bias[0])

    for epoch in range(epochs):
        z = margins()
        sharp = 1.0 + 4.0 * epoch / epochs  # the worst window counts more and more
        top = np.maximum.reduceat(z, text_begin)
        e = np.exp(sharp * (z - top[groups]))
        total = np.add.reduceat(e, text_begin)
        margin = top + np.log(total) / sharp
        slope = balance * (1 / (1 + np.exp(-margin)) - y)  # of the loss by a text's margin
        g = slope[groups] * e / total[groups]  # by a window's margin
        by_word = np.bincount(code, np.repeat(g / size, size) * once, len(place))
        by_bucket = sum(np.bincount(b, np.repeat(w / c, c), BUCKETS) for (b, c), w in zip(blocks, np.split(by_word, edges)))
        direction = softmax[:, 1] - softmax[:, 0]
        by_softmax = embed.T @ by_bucket
        if epoch == 0:
            speed[0] += (0.01 * np.abs(by_bucket).max()) ** 2  # rare n-grams learn slowly
        speed[0] += by_bucket**2
        embed -= (by_bucket / np.sqrt(speed[0]))[:, None] * direction[None, :] / (np.abs(direction).max() + 1e-9)
        for k, sign in ((0, -1), (1, 1)):
            speed[1][:, k] += by_softmax**2
            softmax[:, k] -= 0.1 * sign * by_softmax / np.sqrt(speed[1][:, k])
            speed[2][k] += g.sum() ** 2
            bias[k] -= 0.1 * sign * g.sum() / np.sqrt(speed[2][k])
    worst = np.maximum.reduceat(margins(), text_begin)
    part = held if held.any() else np.ones(len(y), bool)
    slope, shift = calibrate(worst[part], y[part])
    return Model((embed @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0]), slope, shift)


def _only(y: np.ndarray, held: np.ndarray) -> np.ndarray:
    """All true if holding back would take a class out of the training or calibration part."""
    parts = [set(y[held].tolist()), set(y[~held].tolist())]
    return np.full(len(y), min(map(len, parts)) < 2)


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label by the margin, with smoothed targets, by Newton's method."""
    n1, n0 = (y > 0).sum(), (y == 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y > 0, 0.5 / max(1, n1), 0.5 / max(1, n0))
    middle, spread = margin.mean(), margin.std() + 1e-9
    x = np.stack([(margin - middle) / spread, np.ones(len(y))])
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(b @ x, -30, 30)))
        gradient = x @ (weight * (p - target)) + 1e-4 * b
        hessian = (x * (weight * p * (1 - p))) @ x.T + 1e-4 * np.eye(2)
        det = hessian[0, 0] * hessian[1, 1] - hessian[0, 1] ** 2
        step = np.array([hessian[1, 1] * gradient[0] - hessian[0, 1] * gradient[1], hessian[0, 0] * gradient[1] - hessian[0, 1] * gradient[0]]) / det
        b -= np.clip(step, -2, 2)
    return float(b[0] / spread), float(b[1] - b[0] * middle / spread)


def sample(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """(label, text): whole texts of the bounded sample of ``labels`` (doc_id, label) where ``usable`` holds.

    Of each label, rows go by a hash of their id, then id, then text, a total
    order: so many that ``TOXIC_SAMPLE`` or ``CLEAN_SAMPLE`` rows and
    ``SAMPLE_BYTES`` bytes aren't exceeded, but one at least. Each task sends
    no more rows than that, also where an id repeats without end.
    """
    picked = None
    for label, most in ((1, TOXIC_SAMPLE), (0, CLEAN_SAMPLE)):
        part = labels.filter((F.col("label") == label) & usable & F.col("doc_id").isNotNull()).select("doc_id", "label").distinct()
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    rows = rows.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= max(TOXIC_SAMPLE, CLEAN_SAMPLE))
    rows = rows.filter((F.col("label") == 0) & (F.col("k") <= CLEAN_SAMPLE) | (F.col("label") == 1) & (F.col("k") <= TOXIC_SAMPLE))
    volume = F.sum(F.octet_length("text")).over(Window.partitionBy("label").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("volume", volume).filter((F.col("volume") <= SAMPLE_BYTES) | (F.col("k") == 1)).select("label", "k", "text")


def fit(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """The model of the sample, trained by one task; the driver gets its numbers, one a bucket, and no text."""
    rows = sample(docs, labels, usable).withColumn("one", F.lit(1))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("k", "ascending")])
        model = train(table.column("text").to_pylist(), table.column("label").to_numpy().astype(np.int64))
        numbers = np.concatenate([model.weight, [model.bias, model.slope, model.shift]])
        return pa.table({"model": pa.array([numbers.astype("<f8").tobytes()], pa.binary())})

    found = rows.groupBy("one").applyInArrow(run, "model binary").collect()
    if not found:
        return train([], np.zeros(0, np.int64))
    numbers = np.frombuffer(bytes(found[0]["model"]), "<f8")
    return Model(numbers[:-3], *numbers[-3:].tolist())


class Scorer:
    """Scores Arrow string columns; remembers the words it has seen."""

    def __init__(self, model: Model):
        self.model = model
        self.known, self.value = Known(), np.zeros(1 << 16)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known = Known()
        words = split_words(texts, True, _GAP)
        keys, place, code = distinct(words.hashes())
        slots = self.known.find(keys)
        new = np.flatnonzero(slots < 0)
        if len(new):
            bucket, count = subwords([words.word(i) for i in place[new]])
            slots[new] = self.known.add(keys[new])
            self.value = grown(self.value, len(self.known))
            self.value[slots[new]] = _mean(self.model.weight[bucket], count)
        size, of = windows(words.first)
        worst = np.full(len(texts), self.model.bias)
        if len(size):
            value = np.where(repeated(code, size), 0.0, self.value[slots][code])
            z = np.add.reduceat(value, np.cumsum(size) - size) / size + self.model.bias
            per_text = np.bincount(of, minlength=len(texts))
            worst[per_text > 0] = np.maximum.reduceat(z, (np.cumsum(per_text) - per_text)[per_text > 0])
        return self.model.score(worst)


def worker_scorer(spark: SparkSession, model: Model) -> Callable[[], Scorer]:
    """The worker's scorer of a broadcast model (one number a bucket); a reused worker keeps the words it has seen."""
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    return lambda: per_worker(key, lambda: Scorer(shared.value))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """doc_id, toxicity (0 to 1) and toxic (at least ``threshold``) of every row."""
    scorer = worker_scorer(docs.sparkSession, model)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        own = scorer()
        for batch in text_chunks(batches, "text"):
            s = own(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array(s >= threshold)], ["doc_id", "toxicity", "toxic"])

    return rows.mapInArrow(run, "doc_id long, toxicity double, toxic boolean")


def clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with their columns, that score under ``threshold``."""
    scorer = worker_scorer(docs.sparkSession, model)
    at = docs.columns.index(text)

    def run(batches):
        own = scorer()
        for batch in text_chunks(batches, at):
            yield batch.filter(pa.array(own(batch.column(at)) < threshold))

    return docs.mapInArrow(run, docs.schema)
