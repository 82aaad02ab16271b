"""Shards of nearly equal bytes that keep equal texts together, by longest processing time first."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import place_within, utf8_bytes, with_address

# Bytes a row costs beside its text.
ROW_BYTES = 16
# Bits of a size that tell its class: classes are a 256th apart, and below 512 exact.
CLASS_BITS = 8


def size_class(size: str) -> F.Column:
    """A number that grows with the size; at most 64 * 2^CLASS_BITS classes for any data."""
    shift = f"greatest(0, cast(floor(log2({size})) AS int) - {CLASS_BITS})"
    return F.expr(f"({shift} * {1 << (CLASS_BITS + 1)}L) + shiftright({size}, {shift})")


def _whole_rounds(loads: np.ndarray, groups: int, mean: float) -> np.ndarray:
    """How many of ``groups`` equal groups the heap gives to each shard before any load rises above a
    level, for the highest level (to rounding) that does not need more groups than there are."""
    low, high = loads.min(), loads.min() + groups * mean
    dealt = np.zeros(len(loads), np.int64)
    for _ in range(60):
        level = (low + high) / 2
        taken = np.maximum(0, np.floor((level - loads) / mean)).astype(np.int64)
        if taken.sum() <= groups:
            low, dealt = level, taken
        else:
            high = level
    return dealt


def schedule(classes: pd.DataFrame, shards: int) -> pd.DataFrame:
    """Longest processing time first over size classes: the largest groups go one by one to the shard
    with the least bytes, taken from a heap.

    ``classes`` has ``class``, ``groups`` and ``bytes``. Groups of a class are taken to have its mean
    size, and those of a large class are dealt in bulk up to the level that the heap would reach
    before it deals the last few. Returns ``class``, ``shard``, ``start`` and ``stop``: the places in
    the class that a shard gets.
    """
    loads, out = np.zeros(shards), []
    for name, groups, size in classes.sort_values("class", ascending=False)[
        ["class", "groups", "bytes"]
    ].itertuples(index=False):
        mean = size / groups
        taken = np.zeros(shards, np.int64)
        if groups > 2 * shards:
            taken = _whole_rounds(loads, groups, mean)
        heap = [(load, shard) for shard, load in enumerate(loads + taken * mean)]
        heapq.heapify(heap)
        for _ in range(groups - int(taken.sum())):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + mean, shard))
            taken[shard] += 1
        loads = loads + taken * mean
        stops = np.cumsum(taken)
        for shard in np.flatnonzero(taken):
            out.append((name, shard, stops[shard] - taken[shard], stops[shard]))
    return pd.DataFrame(out, columns=["class", "shard", "start", "stop"])


def shard_by_bytes(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes of the text plus ROW_BYTES), ``text_crc32``, ``text_md5``,
    ``shard`` and ``slot`` (gapless from 0 in each shard) of every row.

    Rows with equal texts form a group and share a shard; null texts are a group of their own, of rows
    that hold ROW_BYTES each. Groups are dealt largest first to the least loaded shard. The driver
    sees one row per size class, whose number is bounded whatever the data; groups and rows stay in
    tables. Repeated rows and null ids get slots of their own; other columns are ignored.
    """
    text = F.col("text")
    rows = docs.select(
        "doc_id",
        (utf8_bytes(text) + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("text_md5"),
    )
    rows = with_address(rows, "shard-rows")
    groups = rows.groupBy("text_md5").agg(F.sum("size").alias("bytes"))
    groups = with_address(groups.withColumn("class", size_class("bytes")), "shard-groups")
    classes = groups.groupBy("class").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("bytes").alias("bytes")
    )
    plan = schedule(classes.toPandas(), shards)
    spans = docs.sparkSession.createDataFrame(
        plan.astype({"class": "int64", "shard": "int32"}),
        "class long, shard int, start long, stop long",
    )
    placed = place_within(groups, "class")
    dealt = placed.join(F.broadcast(spans), "class").filter("place >= start AND place < stop")
    assigned = rows.join(dealt.select("text_md5", "shard"), "text_md5")
    return place_within(assigned, "shard", name="slot").select(
        "doc_id", "size", "text_crc32", "text_md5", "shard", "slot"
    )
