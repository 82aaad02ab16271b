"""Exact search for the largest inner products with an M-tree, one subtree for each page of vectors."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import short_batches, with_address
from tiermill.session import written

SCALE = 256
# Vectors of a subtree, of a leaf, and children of an inner node.
PAGE_ROWS = 8192
LEAF_ROWS = 128
FANOUT = 16
# Queries that go to every page together.
QUERY_ROWS = 4096
# Relative slack of distances, against rounding: a bound this close is not used for pruning.
SLACK = 1e-9


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector``: floor(scale * x) of every component as a whole number. Rows without
    id or vector, without components, or with a null or non-finite one are left out."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('Infinity'))"
    whole = f"transform(embedding, x -> cast(floor({scale} * cast(x AS double)) AS bigint))"
    kept = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0")
    return kept.filter(finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.expr(whole).alias("vector")
    )


class MTree:
    """Vectors in nodes with a routing vector, the radius that covers them, and the distance to the
    parent's routing vector, bottom up from leaves of nearby vectors.

    Inner products are made distances by one more component: with ``sqrt(m² - |x|²)``, m being the
    largest length, all vectors have length m, and the nearer to the query the larger the product.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        lengths = (vectors * vectors).sum(axis=1).astype(float)
        self.reach = lengths.max(initial=0.0)
        lifted = np.sqrt(np.maximum(self.reach - lengths, 0.0))
        self.points = np.concatenate([vectors, lifted[:, None]], axis=1).astype(float)
        self.ids, self.vectors = ids, vectors
        # A leaf: its places, its routing point, its radius, and each place's distance to that point.
        groups = self._near(self.points, np.arange(len(ids)), LEAF_ROWS)
        nodes = [self._node(g, self.points[g], np.zeros(len(g)), None) for g in groups]
        while len(nodes) > 1:
            points = np.array([n["point"] for n in nodes])
            groups = self._near(points, np.arange(len(nodes)), FANOUT)
            nodes = [
                self._node(
                    None, points[g], np.array([nodes[i]["radius"] for i in g]), [nodes[i] for i in g]
                )
                for g in groups
            ]
        self.root = nodes[0]

    @staticmethod
    def _near(points: np.ndarray, places: np.ndarray, most: int) -> list[np.ndarray]:
        """Groups of at most ``most`` places, split again and again between two far points."""
        out, left = [], [places]
        while left:
            group = left.pop()
            if len(group) <= most:
                out.append(group)
                continue
            own = points[group]
            a = own[np.argmax(((own - own[0]) ** 2).sum(axis=1))]
            b = own[np.argmax(((own - a) ** 2).sum(axis=1))]
            order = np.argsort(((own - a) ** 2).sum(axis=1) - ((own - b) ** 2).sum(axis=1), kind="stable")
            left += [group[order[: len(group) // 2]], group[order[len(group) // 2 :]]]
        return out

    @staticmethod
    def _node(places, points: np.ndarray, radii: np.ndarray, children) -> dict:
        centre = points.mean(axis=0)
        middle = points[np.argmin(((points - centre) ** 2).sum(axis=1))]
        to_parent = np.sqrt(((points - middle) ** 2).sum(axis=1))
        return {
            "point": middle, "radius": float((to_parent + radii).max()), "to_parent": to_parent,
            "radii": radii, "places": places, "children": children, "points": points,
        }

    def search(self, query_id: int, query: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """The k best (score, -id) of scores of at least ``least``, without the query's own row.

        Nodes are visited by the smallest distance any of their vectors can have. A child or vector is
        skipped without computing its distance if the stored distance to the parent shows that it is
        too far: its distance is at least the difference of the parent's distance and that.
        """
        whole = float((query * query).sum())
        query_point = np.append(query, 0.0).astype(float)

        def far(score: float) -> float:
            """The distance of a vector with this score, with slack."""
            return np.sqrt(max(whole + self.reach - 2 * score, 0.0)) * (1 + SLACK) + SLACK

        best: list[tuple[int, int]] = []
        limit = far(least) if least is not None else np.inf
        start = float(np.sqrt(((self.root["point"] - query_point) ** 2).sum()))
        queue, order = [(max(0.0, start - self.root["radius"]), 0, start, self.root)], 1
        while queue and queue[0][0] <= limit:
            _, _, distance, node = heapq.heappop(queue)
            near = np.flatnonzero(np.abs(distance - node["to_parent"]) - node["radii"] <= limit)
            if not len(near):
                continue
            if node["children"] is None:
                places = node["places"][near]
                scores = self.vectors[places] @ query
                cut = best[0][0] if len(best) == k else (least if least is not None else scores.min())
                good = np.flatnonzero((scores >= cut) & (self.ids[places] != query_id))
                found = zip(scores[good].tolist(), (-self.ids[places[good]]).tolist())
                for pair in found:
                    if len(best) < k:
                        heapq.heappush(best, pair)
                    elif pair > best[0]:
                        heapq.heapreplace(best, pair)
                if len(best) == k:
                    limit = min(limit, far(best[0][0]))
                continue
            distances = np.sqrt(((node["points"][near] - query_point) ** 2).sum(axis=1))
            for i, d in zip(near.tolist(), distances.tolist()):
                bound = max(0.0, d - node["radii"][i])
                if bound <= limit:
                    heapq.heappush(queue, (bound, order, d, node["children"][i]))
                    order += 1
        return best


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` rows of ``vectors`` with
    the largest inner product with each row of ``queries`` (both ``vec_id`` and ``vector``, whole
    numbers), other than the query's own; ties go to the smaller id.

    Vectors are dealt evenly into pages, whatever they hold and however often one occurs; a task
    builds the M-tree of a page and searches it for a block of queries, best node first. Every page
    meets every block, and returns k rows a query at most. A first look at one page gives each query a
    score that it reaches anyway, below which the other pages prune. Vectors of another length than
    the query's are not compared with it. With fewer rows than ``k`` all are returned. Rows that share
    an id are all candidates, but never for a query of that id; repeated queries are asked once. Empty tables give an empty result.
    """
    short_batches(vectors.sparkSession, 4096)
    vectors = with_address(vectors.withColumn("width", F.size("vector")), "vectors")
    queries = queries.select("vec_id", "vector").distinct()
    queries = queries.select("*", F.size("vector").alias("width"), F.xxhash64("vector").alias("key"))
    queries = written(queries, "vector-queries")
    pages = max(1, -(-vectors.count() // PAGE_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    page = F.pmod(F.xxhash64("_file", "_row"), F.lit(pages)).cast("int")
    paged = vectors.select("vec_id", "vector", "width", page.alias("page"))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    blocked = queries.select("*", block.alias("block"))
    anyway = F.lit(None).cast("bigint").alias("least")
    best = _searched(paged.filter("page = 0"), blocked.select("*", anyway), [0], blocks, k)
    best = written(best, "top")
    least = best.groupBy("vec_id", "key").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    least = least.filter(F.col("n") >= k).select("vec_id", "key", "least")
    if pages > 1:
        known = blocked.join(least, ["vec_id", "key"], "left")
        rest = _searched(paged.filter("page > 0"), known, list(range(1, pages)), blocks, k)
        best = best.union(rest)
    order = Window.partitionBy("vec_id", "key").orderBy(F.desc("score"), F.asc("found_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("vec_id").alias("query_id"), "rank", F.col("found_id").alias("vec_id"), "score"
    )


def _searched(
    paged: DataFrame, queries: DataFrame, pages: list[int], blocks: int, k: int
) -> DataFrame:
    """The best rows of every page for every query. Pages are repeated for each block of queries and
    blocks for each page, so that a page and a block meet in one task."""
    left = paged.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    every = F.explode(F.sequence(F.lit(pages[0]), F.lit(pages[-1])))
    right = queries.withColumn("page", every)
    keys = ["page", "block", "width"]

    def search(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(asked):
            tree = MTree(vectors["vec_id"].to_numpy(), np.stack(vectors["vector"].to_numpy()))
            columns = (asked[c] for c in ("vec_id", "key", "vector", "least"))
            for query_id, key, query, least in zip(*columns):
                least = None if pd.isna(least) else int(least)
                for score, found in tree.search(query_id, np.asarray(query), k, least):
                    out.append((query_id, key, -found, score))
        return pd.DataFrame(out, columns=["vec_id", "key", "found_id", "score"]).astype("int64")

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "vec_id long, key long, found_id long, score long"
    )
