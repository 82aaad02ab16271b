import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tiermill.llm import negatives as n

RAW = "vec_id long, label int, embedding array<float>"
WHOLE = "vec_id long, label long, vector array<long>"


def brute(rows, is_anchor, positives=5, negatives=5, least=80, most=100):
    """Every row against every anchor, by plain integers."""
    out = []
    for i, (anchor, label, x) in enumerate(rows):
        if not is_anchor(anchor):
            continue
        scored = [
            (-sum(a * b for a, b in zip(x, y)), other, j, own == label)
            for j, (other, own, y) in enumerate(rows)
            if j != i and len(x) == len(y)
        ]
        scored.sort()
        for score, positive, _, _ in [s for s in scored if s[3]][:positives]:
            fitting = [
                s for s in scored if not s[3] and least * -score <= 100 * -s[0] <= most * -score
            ]
            for rank, (other_score, negative, _, _) in enumerate(fitting[:negatives], 1):
                out.append((anchor, positive, rank, negative, -score, -other_score))
    return sorted(out)


def found(spark, rows, anchors, **options):
    df = spark.createDataFrame(rows, WHOLE).withColumn("rank", F.lit("clash"))
    return sorted(tuple(r) for r in n.hard_negatives(df, F.expr(anchors), **options).collect())


@pytest.fixture
def small_pages(monkeypatch):
    monkeypatch.setattr(n, "PAGE_ROWS", 16)
    monkeypatch.setattr(n, "BLOCK_ROWS", 4)
    monkeypatch.setattr(n, "GRID_BLOCKS", 2)
    monkeypatch.setattr(n, "GRID_PAGES", 3)
    monkeypatch.setattr(n, "PAIRS", 32)
    monkeypatch.setattr(n, "GATHERED", 8)


def clustered(count, width, seed):
    random = np.random.default_rng(seed)
    centres = random.integers(-60, 60, (6, width))
    rows = []
    for i in range(count):
        kind = int(random.integers(0, 6))
        vector = centres[kind] + random.integers(-9, 9, width)
        rows.append((i, kind if random.random() < 0.7 else int(random.integers(0, 6)), vector.tolist()))
    return rows


@pytest.mark.parametrize("width", [1, 3, 20])
def test_equals_brute_force_over_many_pages(spark, small_pages, width):
    rows = clustered(150, width, width)
    rows += [(i + 500, 2, rows[3][2]) for i in range(25)]  # copies under other ids
    rows += [(7, 1, rows[7][2]), (7, 1, rows[7][2]), (10, 3, rows[11][2])]  # repeated ids and rows
    rows += [(600 + i, i % 2, [5] * (width + 1)) for i in range(6)]  # another length
    rows += [(700 + i, i % 3, [0] * width) for i in range(4)]
    wanted = brute(rows, lambda i: i % 10 == 0)
    assert wanted and found(spark, rows, "vec_id % 10 = 0") == wanted


def test_other_counts_and_shares(spark, small_pages):
    rows = clustered(80, 8, 5)
    options = {"positives": 2, "negatives": 3, "least": 50, "most": 95}
    wanted = brute(rows, lambda i: i % 7 == 0, **options)
    assert wanted and found(spark, rows, "vec_id % 7 = 0", **options) == wanted


def test_scores_beyond_doubles_are_exact(spark, small_pages):
    big = 1 << 29
    rows = [(i, i % 2, [big + i, big - 3 * i, 7 + i]) for i in range(30)]
    assert found(spark, rows, "vec_id < 4") == brute(rows, lambda i: i < 4)


def test_edge_rows(spark):
    assert found(spark, [], "true") == []
    assert found(spark, [(0, 1, [3, 4])], "true") == []
    assert found(spark, [(0, 1, [3, 4]), (1, 2, [3, 4])], "true") == []
    three = [(0, 1, [3, 4]), (1, 1, [3, 4]), (2, 2, [3, 3])]
    assert found(spark, three, "vec_id = 0") == [(0, 1, 1, 2, 25, 21)]
    assert found(spark, three, "vec_id > 90") == []
    below_zero = [(0, 1, [1]), (1, 1, [-4]), (2, 2, [-4]), (3, 2, [-3])]
    assert found(spark, below_zero, "vec_id = 0") == []


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [0.5]), (3, 1, None), (4, 1, [0.5, None]), (5, 1, [nan]),
            (6, 1, [inf]), (7, 1, [-inf, 1.0]), (8, 1, []), (None, 1, [1.0])]
    kept = n.scaled(spark.createDataFrame(rows, RAW).withColumn("vector", F.lit(1)))
    assert [tuple(r) for r in kept.collect()] == [(1, 1, [128, -1])]


@pytest.mark.parametrize("width", [1, 2, 7, 64])
def test_bounds_hold_on_every_level(width):
    random = np.random.default_rng(width)
    x, y = (random.integers(-300, 300, (40, width)).astype(float) + 100 for _ in range(2))
    exact, reaches = x @ y.T, []
    for edges in n.segments(width):
        (xm, xd), (ym, yd) = n.summary(x, edges), n.summary(y, edges)
        middle, reach = xm @ ym.T, xd @ yd.T
        assert (np.abs(exact - middle) <= reach + 1e-6).all()
        reaches.append(reach.mean())
    assert reaches == sorted(reaches, reverse=True)


def test_pages_that_cannot_reach_are_not_met(spark, small_pages):
    """Labels apart in space: a block of anchors meets few of the pages."""
    random = np.random.default_rng(1)
    rows = []
    for label in range(12):
        centre = np.zeros(16)
        centre[label] = 2000
        for i in range(40):
            rows.append((100 * label + i, label, (centre + random.integers(-5, 5, 16)).astype(int).tolist()))
    df = spark.createDataFrame(rows, WHOLE).selectExpr(
        "*", "true AS asks", "vec_id AS row", "array(cast(3000000 AS bigint)) AS known"
    )
    pages = n.packed(df, len(rows), 16).cache()
    every = pages.count() ** 2
    met = n.meetings(pages, pages, f"{n.HIGHEST} >= b.known_low").count()
    assert pages.count() <= met < every / 6
    data = [n.Page.read(r.data) for r in pages.select("data").collect()]
    assert sum(len(p.row) for p in data) == len(rows)
    assert all(len(p.row) <= 16 for p in data)


def test_pairs_are_thinned_before_they_are_scored(monkeypatch):
    random = np.random.default_rng(2)
    vectors = np.repeat(random.integers(-500, 500, (10, 1)), 32, axis=1) + random.integers(-3, 3, (10, 32))
    vectors = np.concatenate([vectors] * 20).astype(np.int64)
    count = len(vectors)
    table = pa.table(
        {
            "row": np.arange(count), "vec_id": np.arange(count), "label": np.zeros(count, np.int64),
            "vector": vectors.tolist(), "asks": [True] * count, "known": [[]] * count,
        }
    )
    page, scored = n.Page(table), []
    exact = n.Page.scores
    monkeypatch.setattr(n.Page, "scores", lambda *a: scored.append(len(a[1])) or exact(*a))
    pairs = sum(len(a) for a, _, _ in n.best_alike(page, page, 5))
    assert pairs == 5 * count
    assert sum(scored) < count * count / 5
