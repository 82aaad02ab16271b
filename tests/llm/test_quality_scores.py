import numpy as np

from tests_llm_text import edge_docs, no_docs  # noqa: F401
from tiermill.llm import quality
from tiermill.llm.quality import (
    BAD,
    GOOD,
    LABELLERS,
    NONE,
    fit_labellers,
    posterior,
    quality_scores,
    votes,
)
from tiermill.llm.queries import op3_quality

SF_DIR = "/root/testdata/sf0.01"


def test_scores_agree_with_labels_that_were_not_used(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    found = {r["doc_id"]: r for r in op3_quality(spark, SF_DIR).collect()}
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    good = [found[i]["keep"] for i, q in labels.items() if q == 1]
    bad = [found[i]["keep"] for i, q in labels.items() if q == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1
    assert all(0 <= r["score"] <= 1 and r["keep"] == (r["score"] >= 0.5) for r in found.values())


def test_edge_rows(spark, edge_docs, no_docs):
    found = quality_scores(edge_docs).collect()
    assert len(found) == edge_docs.count()
    blank = [r for r in found if r["doc_id"] in (3, 4, 5)]
    assert all(r["score"] == 0 and r["keep"] == 0 for r in blank)
    assert len({r["score"] for r in found if r["doc_id"] == 2}) == 1
    assert quality_scores(no_docs).count() == 0
    only_null = edge_docs.filter("text IS NULL")
    assert [r["score"] for r in quality_scores(only_null).collect()] == [0.0] * only_null.count()


def test_votes():
    plain = "the cat sat on the mat and it was warm there in the sun with all of them. " * 2
    assert BAD not in votes(plain) and GOOD in votes(plain)
    assert votes("A!! CAT!! SAT!! ON!! MAT!! ")[:2] == (BAD, BAD)
    assert votes("one one one one two two two two")[2] == BAD
    assert votes("one | two | three | four")[3] == BAD
    assert votes("same line here\n" * 5)[6] == BAD
    assert votes(None) == votes("") == votes(" \n") == (NONE,) * LABELLERS


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.8
    chance = np.array([0.9, 0.8, 0.95, 0.7, 0.85, 0.9])
    right = rng.random((20_000, 6)) < chance
    seen = np.where(right == good[:, None], GOOD, BAD)
    seen[rng.random(seen.shape) < 0.2] = NONE
    patterns, counts = np.unique(seen, axis=0, return_counts=True)
    prior, chances, _ = fit_labellers(patterns, counts.astype(float))
    assert abs(prior - 0.8) < 0.03
    found = chances[1, :, GOOD] / (1 - chances[1, :, NONE])
    assert np.abs(found - chance).max() < 0.04
    belief = posterior(prior, chances, seen)
    majority = (seen == GOOD).sum(axis=1) >= (seen == BAD).sum(axis=1)
    assert ((belief > 0.5) == good).mean() >= (majority == good).mean()


def test_long_words_and_texts_are_looked_at_as_a_whole():
    long_word = "a" * 30
    assert quality.features(long_word + "!") != quality.features(long_word + "9")
    assert quality.features("x" * 24 + "AAA1") != quality.features("x" * 24 + "bbb")
    fresh = [f"w{i}" for i in range(1000)]
    for count in (1000, 1001, 5000):
        words = (fresh * 5)[:count]
        assert quality.votes(" ".join(words))[7] == quality.GOOD
        assert quality.votes(" ".join(["a", "b", "c"] * count))[7] == quality.BAD
