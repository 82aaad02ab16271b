"""Hard negatives by inner product, with bounds from the means and deviations of vector segments."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tiermill.session import written

SCALE = 256
# Vectors of a page, anchors of a block, blocks that are held against pages in one task.
PAGE_ROWS = 4096
BLOCK_ROWS = 1024
GRID_BLOCKS = 512
GRID_PAGES = 4096
# Pairs whose bounds, and whose segments, are computed at once.
PAIRS = 1 << 20
GATHERED = 1 << 16
# Segments of the coarsest level; each finer one has four times as many. Segments of a page's directory.
FINER = 4
DIRECTORY_SEGMENTS = 16
# Bounds are widened by this share of the lengths' product, against rounding.
SLACK = 1e-9
EXACT = float(1 << 53)
# A page and what is known of it without taking it apart.
DIRECTORY = pa.schema(
    [(c, pa.int64()) for c in ("page", "width", "label_low", "label_high", "known_low", "known_high")]
    + [(c, pa.list_(pa.float64())) for c in ("mean_low", "mean_high", "reach")]
    + [("slack", pa.float64()), ("data", pa.binary())]
)


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and ``vector``: floor(scale * x) of every component as a whole number. Rows
    without id, label or vector, without components, or with a null or non-finite one are left out."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('Infinity'))"
    whole = f"transform(embedding, x -> cast(floor({scale} * cast(x AS double)) AS bigint))"
    kept = vectors.dropna(subset=["vec_id", "label", "embedding"]).filter("size(embedding) > 0")
    return kept.filter(finite).selectExpr(
        "cast(vec_id AS bigint) AS vec_id", "cast(label AS bigint) AS label", f"{whole} AS vector"
    )


def segments(width: int) -> list[np.ndarray]:
    """Where the segments of each level begin: one, four, sixteen, as long as they hold two components."""
    levels, count = [], 1
    while not levels or 2 * count <= width:
        levels.append(np.arange(count + 1) * width // count)
        count *= FINER
    return levels


def summary(vectors: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of each row, scaled so that the products of means and of
    deviations add up to the middle and the reach of the bounds of an inner product."""
    widths = np.diff(edges)
    means = np.add.reduceat(vectors, edges[:-1], axis=1) / widths
    centred = vectors - np.repeat(means, widths, axis=1)
    deviations = np.sqrt(np.add.reduceat(centred * centred, edges[:-1], axis=1))
    return means * np.sqrt(widths), deviations


class Page:
    """Rows of one width, with the summaries of all levels. ``known`` are scores that were found for a row
    before, ``given`` says how many of them there are."""

    def __init__(self, table: pa.Table):
        self.row, self.id, self.label, self.asks = (
            table[c].to_numpy() for c in ("row", "vec_id", "label", "asks")
        )
        column = table["vector"].combine_chunks()
        self.whole = column.flatten().to_numpy().reshape(len(self.row), -1)
        self.vectors = self.whole.astype(float)
        self.levels = [summary(self.vectors, edges) for edges in segments(self.vectors.shape[1])]
        self.lengths = np.sqrt((self.vectors**2).sum(axis=1))
        self.largest = np.abs(self.vectors).max(initial=0.0)
        known = table["known"].to_pylist()
        self.given = np.array([len(k) for k in known], np.int64)
        self.known = np.zeros((len(known), self.given.max(initial=0)), np.int64)
        for i, values in enumerate(known):
            self.known[i, : len(values)] = values

    @classmethod
    def read(cls, data: bytes) -> Page:
        return cls(pa.ipc.open_stream(data).read_all().combine_chunks())

    def scores(self, rows: np.ndarray, other: Page, others: np.ndarray) -> np.ndarray:
        """Exact inner products, in 64 bits where doubles would round."""
        if self.largest * other.largest * self.vectors.shape[1] < EXACT:
            return np.einsum("ij,ij->i", self.vectors[rows], other.vectors[others]).astype(np.int64)
        return np.einsum("ij,ij->i", self.whole[rows], other.whole[others])


def _pairs(anchors: Page, page: Page, first: int, allowed: np.ndarray, low, high, keep: int | None):
    """(anchor, row, score) of the allowed pairs whose score may be in [low, high] of the anchor.

    Level by level the bounds of what is left get narrower, and pairs whose bounds miss the range go.
    With ``keep``, so do those that are below that many others' lower bounds.
    """
    span = slice(first, first + len(allowed))
    slack = SLACK * anchors.lengths[span, None] * page.lengths[None, :] + 0.5
    for level, ((am, ad), (pm, pd)) in enumerate(zip(anchors.levels, page.levels)):
        there = np.count_nonzero(allowed)
        if not there:
            break
        if level == 0 or there * 8 > allowed.size:
            middle, reach = am[span] @ pm.T, ad[span] @ pd.T + slack
            allowed &= (middle + reach >= low[:, None]) & (middle - reach <= high[:, None])
            if keep and keep < allowed.shape[1]:
                lower = np.where(allowed, middle - reach, -np.inf)
                kth = -np.partition(-lower, keep - 1, axis=1)[:, keep - 1]
                low = np.maximum(low, kth)
                allowed &= middle + reach >= low[:, None]
            continue
        a, r = np.nonzero(allowed)
        for at in range(0, len(a), GATHERED):
            i, j = a[at : at + GATHERED], r[at : at + GATHERED]
            middle = np.einsum("ij,ij->i", am[first + i], pm[j])
            reach = np.einsum("ij,ij->i", ad[first + i], pd[j]) + slack[i, j]
            allowed[i, j] = (middle + reach >= low[i]) & (middle - reach <= high[i])
    a, r = np.nonzero(allowed)
    exact = anchors.largest * page.largest * page.vectors.shape[1] < EXACT
    if exact and len(a) * 8 > allowed.size:
        scores = (anchors.vectors[span] @ page.vectors.T)[a, r].astype(np.int64)
    else:
        parts = range(0, len(a), GATHERED)
        found = [
            anchors.scores(first + a[at : at + GATHERED], page, r[at : at + GATHERED]) for at in parts
        ]
        scores = np.concatenate(found) if found else np.zeros(0, np.int64)
    inside = (scores >= low[a]) & (scores <= high[a])
    return first + a[inside], r[inside], scores[inside]


def _best(a: np.ndarray, r: np.ndarray, scores: np.ndarray, page: Page, count: int) -> np.ndarray:
    """Places of the ``count`` best pairs of each anchor: by score, then by id, then by row."""
    order = np.lexsort((page.row[r], page.id[r], -scores, a))
    starts = np.flatnonzero(np.diff(a[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < count]


def _in_chunks(anchors: Page, page: Page) -> Iterator[tuple[int, np.ndarray]]:
    size = max(1, PAIRS // max(1, len(page.row)))
    for first in range(0, len(anchors.row), size):
        span = slice(first, first + size)
        yield first, anchors.label[span, None] == page.label[None, :]


def best_alike(anchors: Page, page: Page, count: int):
    """The ``count`` best rows of the anchor's label for every anchor, itself left out; a known score is
    one that so many rows reach anyway."""
    for first, same in _in_chunks(anchors, page):
        span = slice(first, first + len(same))
        same &= anchors.row[span, None] != page.row[None, :]
        low = np.full(len(same), -np.inf)
        if anchors.known.shape[1]:
            low = np.where(anchors.given[span] > 0, anchors.known[span, 0], low)
        a, r, scores = _pairs(anchors, page, first, same, low, np.full(len(same), np.inf), count)
        kept = _best(a, r, scores, page, count)
        yield a[kept], r[kept], scores[kept]


def _percent(scores: np.ndarray, share: int) -> np.ndarray:
    """floor(scores * share / 100), also where the product would not fit 64 bits."""
    return scores // 100 * share + scores % 100 * share // 100


def best_in_windows(anchors: Page, page: Page, count: int, least: int, most: int):
    """For every anchor the rows of other labels that are among the ``count`` best in the window of any
    of its known scores."""
    lows, highs = -_percent(-anchors.known, least), _percent(anchors.known, most)
    given = np.arange(anchors.known.shape[1]) < anchors.given[:, None]
    for first, same in _in_chunks(anchors, page):
        span = slice(first, first + len(same))
        low = np.where(given[span], lows[span], np.inf).min(axis=1, initial=np.inf)
        high = np.where(given[span], highs[span], -np.inf).max(axis=1, initial=-np.inf)
        a, r, scores = _pairs(anchors, page, first, ~same, low, high, None)
        chosen = np.zeros(len(a), bool)
        for k in range(anchors.known.shape[1]):
            inside = given[a, k] & (scores >= lows[a, k]) & (scores <= highs[a, k])
            inside = np.flatnonzero(inside)
            chosen[inside[_best(a[inside], r[inside], scores[inside], page, count)]] = True
        yield a[chosen], r[chosen], scores[chosen]


def packed(vectors: DataFrame, rows: int, size: int) -> DataFrame:
    """The rows in pages of one width and at most ``size`` rows, with what bounds them: labels, means and
    deviations. Rows of a label with similar means come together, copies of a vector are dealt out."""
    eighth = [f"slice(vector, int(1 + size(vector) * {i} div 8), int(size(vector) div 8 + 1))" for i in range(8)]
    signs = [f"int(aggregate({e}, 0D, (t, x) -> t + x) > 0) * {1 << i}" for i, e in enumerate(eighth)]
    order = ["width", "label", "_shape", "_deal"]
    dealt = vectors.selectExpr(
        "*", "size(vector) AS width", " + ".join(signs) + " AS _shape", "xxhash64(row) AS _deal"
    )
    parts = max(1, -(-rows // (4 * size)))
    ordered = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        for width, table in _of_one_width(batches, size):
            vectors = table["vector"].combine_chunks().flatten().to_numpy()
            vectors = vectors.reshape(table.num_rows, width).astype(float)
            edges = np.arange(min(width, DIRECTORY_SEGMENTS) + 1) * width
            means, deviations = summary(vectors, edges // min(width, DIRECTORY_SEGMENTS))
            labels = table["label"].to_numpy()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_table(table.combine_chunks())
            # A score that no anchor of the block falls below, and one that none exceeds.
            known = table["known"].to_pylist()
            every = all(known)
            yield pa.RecordBatch.from_pydict(
                {
                    "page": [task + made], "width": [width],
                    "label_low": [int(labels.min())], "label_high": [int(labels.max())],
                    "mean_low": [means.min(axis=0).tolist()], "mean_high": [means.max(axis=0).tolist()],
                    "reach": [deviations.max(axis=0).tolist()],
                    "slack": [SLACK * float((vectors**2).sum(axis=1).max()) + 0.5],
                    "known_low": [min(map(min, known)) if every else None],
                    "known_high": [max(map(max, known)) if every else None],
                    "data": [sink.getvalue().to_pybytes()],
                },
                DIRECTORY,
            )
            made += 1

    return ordered.select("width", "row", "vec_id", "label", "vector", "asks", "known").mapInArrow(
        pack,
        from_arrow_schema(DIRECTORY),
    )


def _of_one_width(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, pa.Table]]:
    """Tables of at most ``size`` rows of one width, in the order of the rows."""
    held, rows, held_width = [], 0, None

    def joined() -> tuple[int, pa.Table]:
        return held_width, pa.Table.from_batches(held).drop_columns(["width"])

    for batch in batches:
        widths = batch["width"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(widths)) + 1).tolist(), len(widths)]
        for start, stop in zip(cuts, cuts[1:]):
            while start < stop:
                if held and (rows == size or widths[start] != held_width):
                    yield joined()
                    held, rows = [], 0
                taken = min(stop - start, size - rows)
                held.append(batch.slice(start, taken))
                held_width, rows, start = int(widths[start]), rows + taken, start + taken
    if held:
        yield joined()


def _bound(pick: str, sign: str) -> str:
    """SQL of the highest or lowest score between a block and a page, from the ranges of their means."""
    products = ", ".join(f"b.mean_{x}[i] * p.mean_{y}[i]" for x in ("low", "high") for y in ("low", "high"))
    return (
        f"(aggregate(sequence(0, size(p.reach) - 1), 0D, (t, i) ->"
        f" t + {pick}({products}) {sign} b.reach[i] * p.reach[i]) {sign} greatest(b.slack, p.slack))"
    )


HIGHEST, LOWEST = _bound("greatest", "+"), _bound("least", "-")


def meetings(blocks: DataFrame, pages: DataFrame, condition: str) -> DataFrame:
    """``block`` and ``page`` of those that may hold pairs, by the bounds of the directory. Blocks and
    pages are dealt into a grid, whose cells are the tasks' work; a cell has a bounded size."""
    listed = [c for c in pages.columns if c != "data"]
    rows = max(1, -(-blocks.count() // GRID_BLOCKS))
    columns = max(1, -(-pages.count() // GRID_PAGES))

    def dealt(df, here, there, count, others):
        own = F.pmod(F.xxhash64("page"), F.lit(count)).cast("int").alias(here)
        return df.select(*listed, own, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(there))

    b = dealt(blocks, "_row", "_column", rows, columns).alias("b")
    p = dealt(pages, "_column", "_row", columns, rows).alias("p")
    cell = (F.col("b._row") == F.col("p._row")) & (F.col("b._column") == F.col("p._column"))
    met = b.join(p, cell & (F.col("b.width") == F.col("p.width")) & F.expr(condition))
    return met.select(F.col("b.page").alias("block"), F.col("p.page").alias("page"))


def _compared(blocks: DataFrame, pages: DataFrame, condition: str, compare, names: str) -> DataFrame:
    """What ``compare`` finds in each pair of a block and a page that meet."""
    asked = blocks.select(F.col("page").alias("block"), F.col("data").alias("asked"))
    met = meetings(blocks, pages, condition)
    joined = met.join(asked, "block").join(pages.select("page", "data"), "page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a page follow each other, so it is taken apart once.
        every = ((r["page"], r["data"], r["asked"]) for b in batches for r in b.to_pylist())
        for _, group in groupby(every, key=lambda row: row[0]):
            page = None
            for _, data, block in group:
                page = page or Page.read(data)
                yield from _found(Page.read(block), page, compare, names)

    return joined.select("page", "data", "asked").mapInArrow(run, _schema(names))


def _schema(names: str) -> str:
    return f"anchor_row long, anchor_id long, {names}_row long, {names}_id long, {names}_score long"


def _found(anchors: Page, page: Page, compare, names: str) -> Iterator[pa.RecordBatch]:
    for a, r, scores in compare(anchors, page):
        if len(a):
            columns = (anchors.row[a], anchors.id[a], page.row[r], page.id[r], scores)
            fields = ["anchor_row", "anchor_id", *[f"{names}_{c}" for c in ("row", "id", "score")]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=fields)


def _ranked(df: DataFrame, by: list[str], names: str, most: int) -> DataFrame:
    order = [F.desc(f"{names}_score"), F.asc(f"{names}_id"), F.asc(f"{names}_row")]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score`` and
    ``negative_score`` over ``vec_id``, ``label`` and ``vector`` (whole numbers).

    An anchor's positives are its ``positives`` best other rows of its label; for each, its negatives are
    the ``negatives`` best rows of other labels whose score is from ``least`` to ``most`` percent of the
    positive's. A score is the inner product; the higher comes first, then the smaller id. Rows with one
    id are rows of their own, also as anchors. Vectors of another length are not compared, and scores
    have to fit 64 bits. Fewer rows give fewer positives or negatives, an empty table gives none.

    Vectors are kept in pages with the mean and deviation of each segment: the product of two means plus
    or minus that of the deviations bounds a segment's share of the score. The bounds of whole pages
    choose which blocks of anchors meet which pages, then finer segments thin the pairs, and what is left
    is scored exactly. A look at the anchor's own page gives a score that its positives reach anyway.
    """
    wanted = vectors.select("vec_id", "label", "vector", F.coalesce(anchors, F.lit(False)).alias("asks"))
    stored = written(wanted.withColumn("row", F.monotonically_increasing_id()), "vectors")
    nothing = F.array().cast("array<bigint>").alias("known")
    rows, asking = stored.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    pages = written(packed(stored.select("*", nothing), rows, PAGE_ROWS), "pages")

    def positive(anchors: Page, page: Page):
        return best_alike(anchors, page, positives)

    def negative(anchors: Page, page: Page):
        return best_in_windows(anchors, page, negatives, least, most)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in (d.as_py() for batch in batches for d in batch["data"]):
            table = pa.ipc.open_stream(data).read_all().combine_chunks()
            asking = table.filter(table["asks"]).combine_chunks()
            if len(asking):
                yield from _found(Page(asking), Page(table), positive, "positive")

    seen = pages.select("data").mapInArrow(look, _schema("positive")).groupBy("anchor_row")
    seen = seen.agg(F.count(F.lit(1)).alias("n"), F.min("positive_score").alias("least"))
    seen = seen.filter(F.col("n") >= positives).selectExpr("anchor_row AS row", "array(least) AS known")
    asked = stored.filter("asks")
    first = asked.join(seen, "row", "left").withColumn("known", F.coalesce("known", F.array()))
    blocks = written(packed(first, asking, BLOCK_ROWS), "blocks")
    alike = "b.label_low <= p.label_high AND p.label_low <= b.label_high"
    reaches = f"(b.known_low IS NULL OR {HIGHEST} >= b.known_low)"
    found = _compared(blocks, pages, f"{alike} AND {reaches}", positive, "positive")
    best = written(_ranked(found, ["anchor_row"], "positive", positives).drop("rank"), "positives")
    known = best.groupBy("anchor_row").agg(F.array_sort(F.collect_list("positive_score")).alias("known"))
    second = asked.join(known.withColumnRenamed("anchor_row", "row"), "row")
    blocks = written(packed(second, asking, BLOCK_ROWS), "blocks")
    unlike = "(b.label_low < b.label_high OR p.label_low < p.label_high OR b.label_low <> p.label_low)"
    # Scores of both signs: a share of a negative score is the higher end.
    below = f"least(b.known_low * {least}D, b.known_low * {most}D) / 100"
    above = f"greatest(b.known_high * {least}D, b.known_high * {most}D) / 100"
    near = f"{unlike} AND {HIGHEST} >= {below} AND {LOWEST} <= {above}"
    found = _compared(blocks, pages, near, negative, "negative").drop("anchor_id")
    share = F.expr("cast(negative_score AS decimal(20, 0)) * 100")
    score = F.col("positive_score").cast("decimal(20, 0)")
    inside = (share >= score * least) & (share <= score * most)
    both = best.join(found, "anchor_row").filter(inside)
    ranked = _ranked(both, ["anchor_row", "positive_row"], "negative", negatives)
    return ranked.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
