"""Text quality from overlapping heuristics: a label model, and a hashed linear scorer trained on it."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import short_batches
from tiermill.session import written

# Texts the scorer is fitted on at most; those with the smallest hash are taken. The label model
# counts the votes on all texts.
TRAIN_ROWS = 5000
BUCKETS = 1 << 18
EPOCHS = 200
RATE = 0.05
DECAY = 1e-4
REMEMBERED = 200_000
THRESHOLD = 0.5

# Frequent words of four languages.
STOP_WORDS = frozenset(
    "the of and to in that is was for it with as be by at from are this on"
    " der die und das den von zu mit sich des auf für ist im dem nicht ein eine"
    " de la que el en y los las del se por con una su para es al lo"
    " le les et des du un dans est pour qui par sur au plus ne pas".split()
)
LINE = re.compile(r"[^\n]*\S[^\n]*")
REPEATED = re.compile(r"(.)\1+")
GOOD, BAD, NONE = 2, 1, 0
LABELLERS = 8
PIECE_WORDS = 1000
PRIOR_SHARE = 0.01
SCALE = 5.0  # of word shares, so that weights need not grow large


def _between(value: float, bad: float, good: float) -> int:
    """A vote on a share of which much is bad: bad from ``bad`` on, good up to ``good``."""
    return BAD if value >= bad else GOOD if value <= good else NONE


def votes(text: str | None) -> tuple[int, ...]:
    """What each labeller says of a text. They overlap: junk of one kind is seen by several. Those that
    know one kind of junk only say bad or nothing, as its absence does not make a text good; the others
    abstain where their sign is unclear. A text without words gets no votes."""
    words = text.split() if text else []
    if not words:
        return (NONE,) * LABELLERS
    n, counts = len(words), Counter(words)
    ends = Counter(w[-1] for w in words)
    marks = sum(c for e, c in ends.items() if not e.isalnum() and e not in ".,;:?!)\"'»”") / n
    shouts = sum(c for w, c in counts.items() if len(w) > 1 and w[-2:] in ("!!", "??")) / n
    upper = sum(c for w, c in counts.items() if w.isupper()) / n
    echoes = sum(map(eq, words, words[1:])) / n
    bars = sum(c for w, c in counts.items() if not any(map(str.isalnum, w))) / n
    stops = sum(c for w, c in counts.items() if w.lower() in STOP_WORDS) / n
    top = max(counts.values()) / n
    lines = LINE.findall(text)
    same = 1 - len(set(lines)) / len(lines)
    return (
        BAD if marks + shouts >= 0.15 else NONE,
        BAD if upper >= 0.25 else NONE,
        BAD if echoes >= 0.1 else NONE,
        BAD if bars >= 0.1 else NONE,
        GOOD if stops >= 0.1 else BAD if stops <= 0.04 and n >= 20 else NONE,
        _between(top, 0.2, 0.1) if n >= 20 else NONE,
        BAD if same >= 0.3 and len(lines) > 3 else NONE,
        _between(_repeated(words), 0.6, 0.35) if n >= 20 else NONE,
    )


def _repeated(words: list[str]) -> float:
    """The share of words that occurred before in their piece of PIECE_WORDS: over a whole text it grows
    with the length of the text, whatever the text is like."""
    pieces = [words[at : at + PIECE_WORDS] for at in range(0, len(words), PIECE_WORDS)]
    return 1 - sum(len(set(piece)) for piece in pieces) / len(words)



def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200):
    """Expectation-maximisation over how often each pattern of votes occurs.

    Given the quality, labellers are taken to vote independently, each with its own probabilities of
    good, bad and no vote. Starting from the belief that a text is good if nobody says bad, the posterior
    of every pattern and these probabilities are estimated in turn. A labeller is taken to be seldom
    wrong beforehand, with the weight of PRIOR_SHARE of the texts. Returns the share of good texts, the probabilities by quality,
    labeller and vote, and the posterior of good for each pattern.
    """
    weights = counts / max(counts.sum(), 1)
    lean = (patterns == GOOD).sum(axis=1) - 2 * (patterns == BAD).sum(axis=1)
    good = 1 / (1 + np.exp(-lean.astype(float)))
    expected = np.array([[0.5, 0.45, 0.05], [0.5, 0.01, 0.49]]) * PRIOR_SHARE
    for _ in range(rounds):
        prior = float(np.clip(weights @ good, 1e-6, 1 - 1e-6))
        chances = np.empty((2, patterns.shape[1], 3))
        for quality, belief in enumerate((1 - good, good)):
            held = weights * belief
            for vote in (NONE, BAD, GOOD):
                chances[quality, :, vote] = held @ (patterns == vote) + expected[quality, vote]
            chances[quality] /= chances[quality].sum(axis=1, keepdims=True)
        before, good = good, posterior(prior, chances, patterns)
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return prior, chances, good


def posterior(prior: float, chances: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """The probability of good quality of each pattern of votes."""
    places = np.arange(patterns.shape[1])
    odds = np.log(prior / (1 - prior)) + (
        np.log(chances[1, places, patterns]) - np.log(chances[0, places, patterns])
    ).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def features(word: str) -> tuple[int, int]:
    """Buckets of a word in lower case and of its shape: letters by case, digits, and marks."""
    shape = "".join(
        "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word
    )
    shape = REPEATED.sub(r"\1\1", shape)
    return crc32(f"w{word.lower()}".encode()) % BUCKETS, crc32(f"s{shape}".encode()) % BUCKETS


def text_features(words: list[str]) -> list[int]:
    """Buckets of how often words follow themselves and how many differ, in tenths."""
    n = len(words)
    echoes = int(10 * sum(map(eq, words, words[1:])) / n)
    return [crc32(f"e{echoes}".encode()) % BUCKETS, crc32(f"d{10 * len(set(words)) // n}".encode()) % BUCKETS]


def train(texts: list[list[str]], targets: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on hashed features, by Adam on all texts at once, towards probabilities.
    Word features are shares of the text's words."""
    rows, columns, values = [], [], []
    for i, words in enumerate(texts):
        counts: Counter[int] = Counter()
        for word, count in Counter(words).items():
            for bucket in features(word):
                counts[bucket] += count
        known = text_features(words)
        rows += [i] * (len(counts) + len(known))
        columns += [*counts, *known]
        values += [c / len(words) for c in counts.values()] + [0.2] * len(known)
    used, columns = np.unique(columns, return_inverse=True)
    rows, values = np.array(rows), np.array(values)
    weights, constant = np.zeros(len(used)), 0.0
    first, second, n = np.zeros(len(used) + 1), np.zeros(len(used) + 1), len(texts)
    for epoch in range(1, EPOCHS + 1):
        z = SCALE * np.bincount(rows, values * weights[columns], n) + constant
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - targets) / n
        slope = SCALE * np.bincount(columns, values * error[rows], len(used)) + DECAY * weights
        slope = np.append(slope, error.sum())
        first += 0.1 * (slope - first)
        second += 0.01 * (slope * slope - second)
        step = RATE * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.99**epoch)) + 1e-8)
        weights, constant = weights - step[:-1], constant - step[-1]
    effect = np.zeros(BUCKETS)
    effect[used] = SCALE * weights
    return effect, float(constant)


class Scorer:
    """Probability of good quality, remembering what each word adds to it."""

    def __init__(self, effect: np.ndarray, constant: float):
        self.effect, self.constant, self.known = effect.tolist(), constant, {}

    def __call__(self, words: list[str]) -> float:
        total, known, effect = 0.0, self.known, self.effect
        for word in words:
            added = known.get(word)
            if added is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                added = known[word] = sum(effect[b] for b in features(word))
            total += added
        z = self.constant
        if words:
            z += total / len(words) + 0.2 * sum(effect[b] for b in text_features(words))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


_SCORERS: dict[str, Scorer] = {}


def _code(votes_of: tuple[int, ...]) -> int:
    return sum(v * 3**i for i, v in enumerate(votes_of))


def _patterns(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(LABELLERS) % 3


def quality_scores(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``weak_label`` (the label model's probability of good quality), ``score`` (the
    scorer's) and ``keep`` (1 if the score is at least THRESHOLD) of every row of ``docs``.

    The votes of all texts are counted by pattern, of which there are at most 3^LABELLERS, and the
    label model is fitted to these counts on the driver. Its posteriors are the targets of the scorer,
    which one task fits on the ``rows`` texts with the smallest hash. No given label is used. Null and
    empty texts have no votes, so the label model gives them a prior, and are not kept: their score is
    0. Repeated rows and null ids are scored like others; other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    short_batches(spark)

    @F.pandas_udf("int")
    def pattern(texts: pd.Series) -> pd.Series:
        return pd.Series([_code(votes(t)) for t in texts], dtype="int32")

    counted = docs.select(pattern("text").alias("code")).groupBy("code").count().toPandas()
    codes = counted["code"].to_numpy(np.int64)
    prior, chances, _ = fit_labellers(_patterns(codes), counted["count"].to_numpy(float))

    def fitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, of = [], []
        for frame in frames:
            for text in frame["text"]:
                if words := text.split():
                    texts.append(words)
                    of.append(votes(text))
        if texts:
            effect, constant = train(texts, posterior(prior, chances, np.array(of)))
            yield pd.DataFrame({"effect": [effect.tobytes()], "constant": [constant]})

    # About twice as many rows as are wanted, by their hash, before the smallest ones are taken:
    # otherwise every task would send as many texts as are wanted in all.
    part = min(1.0, 2 * rows / max(1, int(counted["count"].sum())))
    sample = docs.filter("text IS NOT NULL").select("text", F.xxhash64("doc_id", "text").alias("hash"))
    sample = sample.filter(F.pmod("hash", F.lit(1 << 30)) < int(part * (1 << 30)))
    sample = written(sample.orderBy("hash", "text").limit(rows), "quality-sample")
    one = sample.repartition(1).sortWithinPartitions("hash").select("text")
    model = one.mapInPandas(fitted, "effect binary, constant double").collect()
    effect = np.frombuffer(model[0]["effect"], float) if model else np.zeros(BUCKETS)
    constant = model[0]["constant"] if model else 0.0
    shared = spark.sparkContext.broadcast((effect, constant, prior, chances))
    name = f"{crc32(effect.tobytes())}-{constant}"

    @F.pandas_udf("struct<weak_label: double, score: double>")
    def scored(texts: pd.Series) -> pd.DataFrame:
        effect, constant, prior, chances = shared.value
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(effect, constant)
        of = np.array([votes(t) for t in texts], int).reshape(-1, LABELLERS)
        scores = [_SCORERS[name](t.split()) if t and t.split() else 0.0 for t in texts]
        return pd.DataFrame({"weak_label": posterior(prior, chances, of), "score": scores})

    found = docs.select("doc_id", scored("text").alias("of")).select("doc_id", "of.*")
    return found.withColumn("keep", (F.col("score") >= THRESHOLD).cast("int"))
