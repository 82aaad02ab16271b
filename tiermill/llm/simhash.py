"""Near duplicates by SimHash, linked through a Gray-ordered hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.llm.common import short_batches
from tiermill.llm.components import components
from tiermill.session import written

SEED = 42  # of the contract's XXH64
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

# Rows with one block pattern that one task compares; larger groups are cut and compared cut by cut.
GROUP_ROWS = 4096
# Rows of one block pattern that are expected where patterns are spread evenly.
EXPECTED_ROWS = 4096
# Children of an upper node, and pairs of nodes looked at together.
FANOUT = 8
PAIRS_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text, as a signed 64-bit number."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(words) - shingle)
    spans = zip(starts[: last + 1].tolist(), ends[-(last + 1) :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255  # sums of up to 255 bits fit a byte
    ones = bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    ones = ones + bits[whole:].sum(axis=0, dtype=np.int64)
    packed = np.packbits((2 * ones > len(bits)).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def _fingerprint_column(shingle: int):
    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id`` and ``fp`` of every row of ``docs``; a text without words has fingerprint zero."""
    short_batches(docs.sparkSession)
    return docs.select("doc_id", _fingerprint_column(shingle)("text").alias("fp"))


def block_masks(distance: int, rows: int) -> list[int]:
    """Masks such that any two fingerprints within ``distance`` bits agree on all bits of one.

    64 bits are cut into more blocks than ``distance``; that many blocks can differ and the rest are
    equal. More blocks make the equal part longer, so their number follows from the number of rows.
    """
    for blocks in range(distance + 1, distance + 5):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        parts = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(blocks)]
        masks = [sum(chosen) for chosen in combinations(parts, blocks - distance)]
        if rows >> min(m.bit_count() for m in masks) <= EXPECTED_ROWS:
            break
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _upper(group: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
    """One level above: runs of up to FANOUT nodes of a group, with the bits that are one, and that
    are zero, in all of them. Returns group, ones, zeros and the first child of each node."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
    first = np.flatnonzero(place % FANOUT == 0)
    both = np.bitwise_and.reduceat
    return group[first], both(ones, first), both(zeros, first), first


def _root(label: np.ndarray, of: np.ndarray) -> np.ndarray:
    while True:
        up = label[of]
        if np.array_equal(up, of):
            return of
        of = up


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make the ends of all links share a label, the smallest place that is reachable."""
    while len(a):
        ra, rb = _root(label, a), _root(label, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))


def linked_within(group: np.ndarray, codes: np.ndarray, distance: int) -> np.ndarray:
    """For fingerprints sorted by group and Gray rank, the place of the first one in each one's
    component under links of at most ``distance`` bits within the group.

    A node keeps the bits that all its fingerprints share. Walking down pairs of nodes, the
    differences in shared bits add up; a pair is dropped with all below it once they exceed
    ``distance``. Fingerprints already known to be connected are not compared.
    """
    label, step = np.arange(len(codes)), np.arange(FANOUT)
    levels = [(group, codes, ~codes, np.arange(len(codes)))]
    while True:
        above = _upper(*levels[-1][:3])
        if len(above[0]) == len(levels[-1][0]):
            break
        levels.append(above)
        if len(np.unique(above[0])) == len(above[0]):
            break
    top = len(levels) - 1
    nodes = np.arange(len(levels[top][0]))
    none = np.zeros(len(nodes), np.uint64)
    stack = [(top, nodes, nodes, none, np.zeros(len(nodes), np.uint8))]
    while stack:
        level, a, b, known, differing = stack.pop()
        if len(a) > PAIRS_AT_ONCE:
            half = len(a) // 2
            stack.append((level, *(x[half:] for x in (a, b, known, differing))))
            stack.append((level, *(x[:half] for x in (a, b, known, differing))))
            continue
        _, ones, zeros, _ = levels[level]
        new = (ones[a] | zeros[a]) & (ones[b] | zeros[b]) & ~known
        differing = differing + np.bitwise_count((ones[a] ^ ones[b]) & new)
        near = differing <= distance
        a, b, known, differing = a[near], b[near], (known | new)[near], differing[near]
        if level == 0:
            _unite(label, a, b)
            continue
        # The children of every pair; of a node with itself, each pair of children once.
        first = levels[level][3]
        last = np.append(first[1:], len(levels[level - 1][0]))
        shape = (len(a), FANOUT, FANOUT)
        ca = np.broadcast_to((first[a][:, None] + step)[:, :, None], shape)
        cb = np.broadcast_to((first[b][:, None] + step)[:, None, :], shape)
        there = (ca < last[a][:, None, None]) & (cb < last[b][:, None, None])
        there &= (a != b)[:, None, None] | (ca < cb if level == 1 else ca <= cb)
        pair = np.nonzero(there)[0]
        ca, cb = ca[there], cb[there]
        if level == 1:
            apart = label[ca] != label[cb]
            pair, ca, cb = pair[apart], ca[apart], cb[apart]
        if len(pair):
            stack.append((level - 1, ca, cb, known[pair], differing[pair]))
    return _root(label, label)


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links from each fingerprint to the first of its component, group by group of a partition."""
    held = list(batches)
    if not held:
        return
    held = pa.Table.from_batches(held)
    keys = held.select(["mask", "pattern", "cut_a", "cut_b"]).to_pandas()
    codes = held["fp"].to_numpy().view(np.uint64)
    group = keys.groupby(list(keys.columns), sort=False).ngroup().to_numpy()
    order = np.lexsort((_gray_rank(codes), group))
    group, codes = group[order], codes[order]
    first = linked_within(group, codes, distance)
    moved = np.flatnonzero(first != np.arange(len(first)))
    signed = codes.view(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(signed[moved]), pa.array(signed[first[moved]])], names=["u", "v"]
    )


def near_fingerprints(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """Edges ``u``, ``v`` between fingerprints (column ``fp``, each once, a written table) that
    connect all those within ``distance`` bits of each other: a spanning forest, not all pairs.

    Each fingerprint goes to one group per block mask. A group above GROUP_ROWS is cut into parts by
    a hash, and every pair of parts is a group of its own, so no task gets more than two parts.
    """
    rows = distinct.count()
    masks = [_signed(m) for m in block_masks(distance, rows)]
    mask = F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")
    blocks = distinct.select("fp", mask).withColumn("pattern", F.expr("fp & mask"))
    sizes = blocks.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.filter("size > 1").withColumn("cuts", F.ceil(F.col("size") / GROUP_ROWS))
    cut = F.pmod(F.xxhash64("fp", F.lit("cut")), F.col("cuts"))
    placed = blocks.join(sizes, ["mask", "pattern"]).withColumn("cut", cut)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1))
    placed = placed.withColumn("other", other).select(
        "mask", "pattern", "fp",
        F.least("cut", "other").alias("cut_a"), F.greatest("cut", "other").alias("cut_b"),
    )
    tasks = max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), 5 * rows // 250_000)
    keys = ["mask", "pattern", "cut_a", "cut_b"]
    return placed.repartition(tasks, *keys).mapInArrow(
        lambda batches: _links(batches, distance), "u long, v long"
    )


def simhash_components(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id``, ``fp``, ``component`` (the smallest fingerprint) and ``component_id`` (the smallest
    ``doc_id``) of every row, over links between fingerprints at most ``distance`` bits apart.

    Texts are lower-cased for A to Z and split at ASCII white space; ``shingle`` words make a shingle,
    and a text with fewer words is one. Null, empty and blank texts have fingerprint zero and are
    linked like any others. Repeated rows stay. A null ``doc_id`` is linked too but never names a
    component, so ``component_id`` is null where no id is reachable. Other columns are ignored; an
    empty table gives an empty result.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    lowest = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints")
    found = components(near_fingerprints(lowest.select("fp"), distance))
    member = lowest.join(found, lowest["fp"] == found["vertex"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component")
    )
    named = member.groupBy("component").agg(F.min("low").alias("component_id"))
    named = member.join(named, "component").select("fp", "component", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of ``docs`` for each component: that with its smallest ``doc_id``. Of several rows with
    this id, and in a component without any id, it is the smallest row."""
    found = written(simhash_components(docs, shingle, distance), "components")
    named = found.filter("doc_id <=> component_id")
    ids = named.groupBy("doc_id").count()
    once = ids.filter("count = 1 AND doc_id IS NOT NULL").select("doc_id")
    result = docs.join(once, "doc_id", "left_semi").select(docs.columns)
    # Rows that repeat an id, or have none, are told apart by their fingerprint and columns.
    unclear = ids.filter("count > 1 OR doc_id IS NULL").select("doc_id")
    if unclear.isEmpty():
        return result
    same = docs["doc_id"].eqNullSafe(unclear["doc_id"])
    rows = docs.join(unclear, same, "left_semi").select(
        F.struct(*docs.columns).alias("_row"), _fingerprint_column(shingle)("text").alias("fp")
    )
    same = F.expr("_row.doc_id <=> doc_id")
    rows = rows.join(named.select("doc_id", "fp", "component").distinct(), "fp").filter(same)
    return result.union(rows.groupBy("component").agg(F.min("_row").alias("_row")).select("_row.*"))
