import zlib

import numpy as np
import pytest

from tests_llm_text import edge_docs, no_docs  # noqa: F401
from tiermill.llm import toxicity as tox
from tiermill.llm.queries import op6_toxicity
from tiermill.llm.toxicity import toxicity, without_toxic

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    found = op6_toxicity(spark, SF_DIR).collect()
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in labels]
    truth, said = map(np.array, zip(*held))
    # 2,636 labels, 10 % of them toxic. Five times as many give 0.99, with 0.97 of the toxic found.
    assert (truth == said).mean() >= 0.93
    assert said[truth == 1].mean() >= 0.6 and said[truth == 0].mean() <= 0.05


@pytest.fixture(scope="module")
def model():
    bags, rng = tox.Bags(), np.random.default_rng(0)
    clean = [f"word{i}" for i in range(60)]
    for i in range(300):
        words = list(rng.choice(clean, 40))
        if i % 2:
            words[int(rng.integers(40))] = str(rng.choice(["rascal", "villain"]))
        bags.add(" ".join(words), i % 2)
    return tox.train(bags)


def test_unseen_spellings_share_subwords(model):
    score = tox.Scorer(*model)
    around = " ".join(f"word{i}" for i in range(20))
    assert score(f"{around} rascal {around}") > 0.7 > score(f"{around} {around}")
    assert score(f"{around} rascall {around}") > score(f"{around} unheard {around}")
    assert score(f"{around} RASCAL, {around}") == score(f"{around} rascal {around}")


def test_edge_rows(spark, edge_docs, no_docs):
    schema = "doc_id long, toxic int, quality int, text string"
    labels = [(i, i % 2, 1, "x") for i in range(11)] + [(None, 1, 0, "x"), (1, None, 0, "x"), (2, 5, 1, "x")]
    labels = spark.createDataFrame(labels, schema)
    found = toxicity(edge_docs, labels).collect()
    assert len(found) == edge_docs.count()
    blank = {r["score"] for r in found if r["doc_id"] in (3, 4, 5)}
    assert len(blank) == 1 and all(0 <= r["score"] <= 1 for r in found)
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)
    assert toxicity(no_docs, labels).count() == 0
    assert toxicity(edge_docs, labels.limit(0)).count() == edge_docs.count()
    kept = without_toxic(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["predicted"] == 0 for r in found)


def test_long_runs_are_scored_to_their_end(model):
    run = "_".join(f"word{i}" for i in range(20))
    pieces = tox.words_of(run)
    assert max(map(len, pieces)) == 40 and pieces[0] + "".join(p[4:] for p in pieces[1:]) == run
    assert tox.words_of("a" * 40) == ["a" * 40] and len(tox.words_of("a" * 41)) == 2
    score = tox.Scorer(*model)
    assert score(f"{run}_villain") > score(run) + 0.01
