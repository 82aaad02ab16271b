import math
import random

import numpy as np
import pytest

from tiermill.llm import topk
from tiermill.llm.queries import op5_topk
from tiermill.llm.topk import MTree, scaled, top_inner_products

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, asked, k=5):
    out = []
    for query_id, query in asked:
        found = sorted(
            (-sum(a * b for a, b in zip(query, v)), i)
            for i, v in rows
            if i != query_id and len(v) == len(query)
        )
        out += [(query_id, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def whole(rows):
    ok = [
        (i, v)
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    return [(i, [math.floor(256 * float(x)) for x in v]) for i, v in ok]


@pytest.mark.parametrize("page", [8192, 90])
def test_query_equals_brute_force(spark, monkeypatch, page):
    monkeypatch.setattr(topk, "PAGE_ROWS", page)
    monkeypatch.setattr(topk, "LEAF_ROWS", 16)
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    rows = whole([tuple(r) for r in table.collect()])
    found = sorted(map(tuple, op5_topk(spark, SF_DIR).collect()))
    assert found == brute(rows, [r for r in rows if r[0] % 50 == 0])


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "PAGE_ROWS", 7)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(20)]
    rows += [(100 + i, [0.5, -0.25, 0.125]) for i in range(30)]
    rows += [(50, None), (51, []), (52, [1.0, None, 1.0]), (53, [1.0, float("nan"), 0.0])]
    rows += [(54, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (150, [1.0, 1.0])]
    rows += [(200, [0.0, 0.0, 0.0]), (0, rows[0][1])]
    schema = "vec_id long, embedding array<float>, page string, block string, score int"
    df = scaled(spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], schema))
    rows = whole([(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    asked = [r for r in rows if r[0] % 50 == 0]
    queries = df.filter("vec_id % 50 = 0")
    found = sorted(map(tuple, top_inner_products(df, queries, 5).collect()))
    once = sorted(set(found))
    assert once == sorted(set(brute(rows, [r for k, r in enumerate(asked) if r not in asked[:k]], 5)))
    assert top_inner_products(df.limit(0), queries, 5).count() == 0
    assert top_inner_products(df, queries.limit(0), 5).count() == 0


def test_tree_finds_all():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 400, (20, 4))
    vectors = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(0, 4, (3000, 4))).astype(np.int64)
    tree = MTree(np.arange(3000), vectors)
    for q in range(0, 3000, 100):
        scores = vectors @ vectors[q]
        want = sorted(((int(s), -i) for i, s in enumerate(scores) if i != q), reverse=True)[:5]
        assert sorted(tree.search(q, vectors[q], 5, None), reverse=True) == want
        assert sorted(tree.search(q, vectors[q], 5, want[-1][0]), reverse=True) == want
