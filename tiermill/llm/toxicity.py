"""Toxicity by averaged subword embeddings under a linear softmax, trained together."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.llm.common import short_batches
from tiermill.session import written

# Documents of each label the model is fitted on at most; those with the smallest hash are taken.
TRAIN_ROWS = 2000
BUCKETS = 1 << 20
DIMENSIONS = 4
GRAMS = (3, 5)
EPOCHS = 25
BATCH_TEXTS = 250
RATE = 0.1
DECAY = 1e-4
# Words of a window, and what its mean is multiplied by before the outputs.
WINDOW = 16
SCALE = 10.0
THRESHOLD = 0.7
REMEMBERED = 200_000
# Letters of a word; longer runs are several words.
LONGEST = 40
WORD = re.compile(r"\w+")


def subwords(word: str) -> list[int]:
    """Buckets of the word and of its character n-grams, with its ends marked."""
    letters = f"<{word}>".encode("utf-16-le")
    low, high = GRAMS
    grams = [
        letters[i : i + 2 * n]
        for n in range(low, high + 1)
        for i in range(0, len(letters) - 2 * n + 1, 2)
    ]
    return [crc32(g) % BUCKETS for g in (letters, *grams)]


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores. Longer ones than LONGEST, as in scripts without spaces,
    are cut into pieces that overlap by all but one letter of the longest n-gram."""
    words = WORD.findall(text.lower()) if text else []
    if not any(len(w) > LONGEST for w in words):
        return words
    step = LONGEST - GRAMS[1] + 1
    return [
        w[i : i + LONGEST]
        for w in words
        for i in range(0, max(1, len(w) - GRAMS[1] + 1), step)
    ]


def window_starts(words: int) -> np.ndarray:
    """Where the windows of about WINDOW words begin that a text is cut into."""
    windows = max(1, round(words / WINDOW))
    return np.arange(windows) * words // windows


class Bags:
    """Texts as windows, windows as rows of words, and words as rows of subwords."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.columns, self.weights, self.sizes, self.windows, self.labels = [], [], [], [], []

    def add(self, text: str | None, label: int) -> None:
        words = words_of(text)
        if not words:
            return
        place = self.places.setdefault
        self.columns.append(np.array([place(w, len(self.places)) for w in words], np.int32))
        sizes = np.diff(np.append(window_starts(len(words)), len(words)))
        self.weights.append(np.repeat(1 / sizes, sizes).astype(np.float32))
        self.sizes.append(sizes)
        self.windows.append(len(sizes))
        self.labels.append(label)

    def batches(self, count: int, least: int = 3) -> list[Batch]:
        """The texts dealt into batches, without words of fewer than ``least`` texts: their subwords
        say what they have in common."""
        seen = np.zeros(len(self.places), np.int64)
        for column in self.columns:
            seen[np.unique(column)] += 1
        words = list(self.places)
        order = np.random.default_rng(1).permutation(len(self.labels))
        return [Batch(self, order[i::count], seen >= least, words) for i in range(count)]


class Batch:
    """Some texts, with what is needed to sum subwords by word, words by window and back."""

    def __init__(self, bags: Bags, texts: np.ndarray, kept: np.ndarray, words: list[str]):
        self.labels = np.array([bags.labels[i] for i in texts], np.float32)
        self.counts = np.array([bags.windows[i] for i in texts])
        self.firsts = np.cumsum(self.counts) - self.counts
        sizes = np.concatenate([bags.sizes[i] for i in texts])
        rows = np.repeat(np.arange(len(sizes)), sizes)
        columns = np.concatenate([bags.columns[i] for i in texts])
        weights = np.concatenate([bags.weights[i] for i in texts])
        there = kept[columns]
        own, self.columns = np.unique(columns[there], return_inverse=True)
        self.weight, rows = weights[there][:, None], rows[there]
        grams = [subwords(words[i]) for i in own]
        sizes_of = np.array([len(g) for g in grams], np.int64)
        self.gram = np.array([b for g in grams for b in g], np.int64)
        self.word_of = np.repeat(np.arange(len(own)), sizes_of)
        self.share = np.repeat(1 / np.maximum(sizes_of, 1), sizes_of).astype(np.float32)[:, None]
        self.rows, self.by_window = rows, _sums(rows, len(sizes))
        self.by_column = _sums(self.columns, len(own))
        self.by_word = _sums(self.word_of, len(own))

    def use(self, used: np.ndarray) -> None:
        """Number the buckets by their place among those that occur."""
        self.gram = np.searchsorted(used, self.gram)
        self.by_gram = _sums(self.gram, len(used))


def _sums(index: np.ndarray, size: int):
    """For sums of items by ``index``: an order, where each sum starts, and which sums there are."""
    order = np.argsort(index, kind="stable")
    sorted_index = index[order]
    starts = np.flatnonzero(np.append(True, sorted_index[1:] != sorted_index[:-1])[: len(index)])
    return order, starts, sorted_index[starts], size


def _summed(values: np.ndarray, sums) -> np.ndarray:
    order, starts, which, size = sums
    out = np.zeros((size, values.shape[1]), np.float32)
    if len(which):
        out[which] = np.add.reduceat(values[order], starts, axis=0)
    return out


def train(bags: Bags, seed: int = 7) -> tuple[np.ndarray, float]:
    """Subword vectors and softmax weights, fitted together by Adam on batches of texts. Returns what
    each bucket adds to the log odds of label 1 when it is averaged, and the constant.

    A word is the mean of its subwords' vectors and a window the mean of its words. The margin of the
    two outputs is therefore a mean of one number per bucket, the product of both trained matrices. A
    text's margin is that of its windows, weighted towards the largest: a few words in a long text
    must tell.
    """
    batches = bags.batches(max(1, len(bags.labels) // BATCH_TEXTS))
    used = np.unique(np.concatenate([b.gram for b in batches]))
    for batch in batches:
        batch.use(used)
    share = min(max(float(np.mean(bags.labels)), 1e-6), 1 - 1e-6)
    rng = np.random.default_rng(seed)
    parts = [
        rng.normal(0, 0.1, (len(used), DIMENSIONS)).astype(np.float32),
        rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32),
        np.zeros((1, 2), np.float32),
    ]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, EPOCHS * len(batches) + 1):
        of = batches[step % len(batches)]
        vectors, output, constant = parts
        word = _summed(vectors[of.gram] * of.share, of.by_word)
        window = SCALE * _summed(word[of.columns] * of.weight, of.by_window)
        z = window @ output + constant
        margin = z[:, 1] - z[:, 0]
        part_of = pooling(margin, of.firsts, of.counts)
        pooled = np.add.reduceat(part_of * margin, of.firsts)
        balance = np.where(of.labels > 0, 0.5 / share, 0.5 / (1 - share)) / len(of.labels)
        wrong = balance * (1 / (1 + np.exp(-np.clip(pooled, -50, 50))) - of.labels)
        error = (part_of * np.repeat(wrong, of.counts)).astype(np.float32)[:, None]
        error = error * np.float32([-1, 1])
        to_window = SCALE * (error @ output.T)
        to_word = _summed(to_window[of.rows] * of.weight, of.by_column)
        slopes = [
            _summed(to_word[of.word_of] * of.share, of.by_gram) + DECAY * vectors,
            window.T @ error + DECAY * output,
            error.sum(axis=0, keepdims=True),
        ]
        rate = RATE * (1 - step / (EPOCHS * len(batches) + 1))
        for part, slope, m, v in zip(parts, slopes, first, second):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            size = np.sqrt(v / (1 - 0.99**step)) + 1e-8
            part -= (rate / (1 - 0.9**step) * m / size).astype(np.float32)
    vectors, output, constant = parts
    effect = np.zeros(BUCKETS, np.float32)  # buckets that were not seen add nothing
    effect[used] = SCALE * (vectors @ (output[:, 1] - output[:, 0]))
    return effect, float(constant[0, 1] - constant[0, 0])


def pooling(margin: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How much each window counts in its text: the softmax of the windows' margins."""
    top = np.repeat(np.maximum.reduceat(margin, firsts), counts)
    part = np.exp(margin - top)
    return part / np.repeat(np.add.reduceat(part, firsts), counts)


class Scorer:
    """Probability of label 1, remembering what each word adds to it."""

    def __init__(self, effect: np.ndarray, constant: float):
        # Plain 32-bit numbers: a list of objects would take ten times the memory.
        self.effect, self.constant, self.known = array("f", effect.tobytes()), constant, {}

    def word(self, word: str) -> float:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        buckets, effect = subwords(word), self.effect
        added = self.known[word] = sum([effect[b] for b in buckets]) / len(buckets)
        return added

    def __call__(self, text: str | None) -> float:
        words, known = words_of(text), self.known
        if not words:
            return float(1 / (1 + np.exp(-self.constant)))
        added = [known.get(w) for w in words]
        added = np.array([self.word(w) if a is None else a for w, a in zip(words, added)])
        starts = window_starts(len(words))
        margin = np.add.reduceat(added, starts) / np.diff(np.append(starts, len(words)))
        one = np.zeros(1, np.int64)
        pooled = (pooling(margin, one, np.array([len(margin)])) * margin).sum() + self.constant
        return float(1 / (1 + np.exp(-np.clip(pooled, -500, 500))))


_SCORERS: dict[str, Scorer] = {}


def _scorer(name: str, model: tuple[np.ndarray, float]) -> Scorer:
    """One for each worker process, so that remembered words outlast a task."""
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(*model)
    return _SCORERS[name]


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """The model of the texts of ``docs`` and their label ``toxic`` in ``labels``. Of each label the
    ``rows`` documents with the smallest hash of their id are taken, whose words one task counts and
    fits; rows without text or label are left out. Without rows of both labels, every score is the
    share of label 1.

    The documents are chosen among the labels, so that only these few ids, at most two times ``rows``,
    are broadcast to the texts."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", "toxic").distinct()
    known = known.withColumn("hash", F.xxhash64("doc_id", "toxic"))
    parts = [known.filter(f"toxic = {k}").orderBy("hash", "doc_id").limit(rows) for k in (0, 1)]
    chosen = written(parts[0].union(parts[1]), "toxic-labels")
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text")
    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", "hash")
    sample = written(sample, "toxic-sample")
    have = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(have) < 2:
        share = 0.5 if not have else float(next(iter(have)))
        return np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6)))

    def fitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bags = Bags()
        for frame in frames:
            for text, label in zip(frame["text"], frame["toxic"]):
                bags.add(text, int(label))
        if bags.labels:
            effect, constant = train(bags)
            yield pd.DataFrame({"effect": [effect.tobytes()], "constant": [constant]})

    one = sample.repartition(1).sortWithinPartitions("hash", "text").select("text", "toxic")
    model = one.mapInPandas(fitted, "effect binary, constant double").collect()
    if not model:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(model[0]["effect"], np.float32).copy(), model[0]["constant"]


def score_column(spark, model: tuple[np.ndarray, float]):
    """A function of a text column that gives the probability of label 1. The model is BUCKETS numbers
    whatever the data."""
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    name = xxhash.xxh64_hexdigest(model[0].tobytes()) + str(model[1])

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        of = _scorer(name, shared.value)
        return pd.Series([of(t) for t in texts], dtype="float64")

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    The model learns from the labels of rows whose crc32 of ``doc_id`` leaves 0 or 2 when divided by
    3; the others are held out. It sees nothing but the text. Null and empty texts get the model's
    constant; repeated rows and null ids are scored like any others. Other columns are ignored; an
    empty table gives an empty result.
    """
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    held_out = F.coalesce(held_out, F.lit(False))
    score = score_column(docs.sparkSession, fit(docs, labels.filter(~held_out)))
    scored = docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic; the model learns as in ``toxicity``."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    score = score_column(docs.sparkSession, fit(docs, labels.filter(~held_out)))
    return docs.filter(score("text") < THRESHOLD)
