"""Trie of conversation prefixes: balanced parentheses in shards of sorted conversations, merged at the
spines that neighbouring shards share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import broadcast_if_small, utf8_bytes
from tiermill.operators.lookups import lookup_all
from tiermill.operators.numbering import number_within
from tiermill.session import written

# Turns of a conversation that one window takes; longer conversations are added up block by block.
BLOCK_TURNS = 1 << 16
# Conversations of a shard, places of an excess block, blocks under a node of the tree above them.
SHARD_ROWS = 8192
EXCESS_BLOCK = 64
FANOUT = 8
# Ids joined into one text, and rows of a task that joins them.
CHUNK_IDS = 8192
SLICE_IDS = 500_000
# Bytes of a prefix's key.
KEY = 16


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1, by turn, null first), a digest of role and text (``a``, ``b``) and
    the UTF-8 bytes of the text as ``size``.

    Null roles and texts are empty; turns of one number are ordered by role and text; rows without a
    conv_id are left out. Texts are not shuffled, only those of turns with one number are looked at
    again. A conversation may hold any share of all rows.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)))
    longs = [
        F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint").alias(name)
        for at, name in ((1, "a"), (17, "b"))
    ]
    given = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        *longs, utf8_bytes(text).alias("size"),
    )
    rows = written(given.drop("role", "text"), "turns")
    numbered = number_within(
        rows, ["conv_id"], ["turn", "a", "b"], "place", previous={"_turn": "turn", "_a": "a", "_b": "b"}
    )
    numbered = written(numbered, "places")
    group = ["conv_id", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("_number")]
    again = F.col("turn").eqNullSafe(F.col("_turn")) & ((F.col("a") != F.col("_a")) | (F.col("b") != F.col("_b")))
    tied = written(numbered.filter((F.col("place") > 1) & again).select(*group).distinct(), "ties")
    places = numbered.select(*group, "place", "a", "b", "size")
    if not tied.isEmpty():
        keys = ["conv_id", "_number"]
        texts = lookup_all(given.select(*group, "role", "text", "a", "b", "size"), [(tied, keys)])
        ordered = number_within(written(texts, "tied"), keys, ["role", "text"], "_nth")
        first = lookup_all(places, [(tied, keys)]).groupBy(*keys).agg(F.min("place").alias("_first"))
        held = lookup_all(ordered, [(first, keys)])
        held = held.withColumn("place", F.col("_first") + F.col("_nth") - 1)
        alone = lookup_all(places, [(tied.withColumn("_tied", F.lit(True)), keys)], "left")
        alone = alone.filter("_tied IS NULL")
        places = alone.select(places.columns).union(held.select(places.columns))
    return places.drop("_number")


def with_heads(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """Every conversation with its first turns replaced: the first ``heads`` (``most`` at most) of the
    conversation ``base``, all if it has fewer and none if there is no such conversation, and then its
    own turns after its first ``heads``. Both are functions of ``conv_id``."""
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("turns"))
    lengths = written(lengths.select("conv_id", "turns", base.alias("_base"), heads.alias("_heads")), "lengths")
    bases = lengths.select(F.col("conv_id").alias("_base"), F.col("turns").alias("_held"))
    plan = lookup_all(lengths.drop("turns"), [(bases, ["_base"])], "left")
    plan = written(plan.withColumn("_lead", F.least("_heads", F.coalesce("_held", F.lit(0)))), "heads")
    first = turns.filter(F.col("place") <= most).withColumnRenamed("conv_id", "_base")
    led = lookup_all(plan.filter("_lead > 0"), [(first, ["_base"])]).filter("place <= _lead")
    own = lookup_all(turns, [(plan, ["conv_id"])]).filter("place > _heads")
    own = own.withColumn("place", F.col("place") - F.col("_heads") + F.col("_lead"))
    return led.select(turns.columns).union(own.select(turns.columns))


def _prefixes(turns: DataFrame) -> DataFrame:
    """Every turn with the key of the prefix that ends there (``x``, ``y``), that of the prefix before
    (``px``, ``py``), and the bytes up to there.

    A key is what the hashes of the turns, each with its place, give by exclusive or, 128 bits; so it
    can be added up block by block however long a conversation is.
    """
    hashes = [F.xxhash64(F.lit(seed), "place", "a", "b").alias(n) for seed, n in ((1, "_x"), (2, "_y"))]
    block = F.floor((F.col("place") - 1) / BLOCK_TURNS).cast("bigint").alias("_block")
    rows = turns.select("conv_id", "place", "size", *hashes, block)
    here = Window.partitionBy("conv_id", "_block").orderBy("place")
    here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"x": F.bit_xor("_x").over(here), "y": F.bit_xor("_y").over(here), "bytes": F.sum("size").over(here)}
    keyed = rows.withColumns(sums)
    long_ones = written(turns.filter(F.col("place") > BLOCK_TURNS).select("conv_id").distinct(), "long")
    if not long_ones.isEmpty():
        before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        totals = lookup_all(rows, [(long_ones, ["conv_id"])]).groupBy("conv_id", "_block").agg(
            F.bit_xor("_x").alias("_x"), F.bit_xor("_y").alias("_y"), F.sum("size").alias("_bytes")
        )
        offsets = totals.select(
            "conv_id", "_block", F.bit_xor("_x").over(before).alias("_ox"),
            F.bit_xor("_y").over(before).alias("_oy"), F.sum("_bytes").over(before).alias("_obytes"),
        ).filter("_block > 0")
        keyed = lookup_all(keyed, [(offsets, ["conv_id", "_block"])], "left").withColumns(
            {
                "x": F.col("x").bitwiseXOR(F.coalesce("_ox", F.lit(0))),
                "y": F.col("y").bitwiseXOR(F.coalesce("_oy", F.lit(0))),
                "bytes": F.col("bytes") + F.coalesce("_obytes", F.lit(0)),
            }
        )
    return keyed.select(
        "conv_id", F.col("place").alias("depth"), "x", "y", F.col("x").bitwiseXOR(F.col("_x")).alias("px"),
        F.col("y").bitwiseXOR(F.col("_y")).alias("py"), "size", "bytes",
    )


class Parentheses:
    """Balanced parentheses with a tree of the least and greatest excess of blocks of places."""

    def __init__(self, opens: np.ndarray):
        self.excess = np.cumsum(np.where(opens, 1, -1))
        low = high = self.excess
        self.levels, width = [], EXCESS_BLOCK
        while len(low) > 1:
            fill = -len(low) % width
            low = np.append(low, np.full(fill, np.iinfo(np.int64).max)).reshape(-1, width).min(axis=1)
            high = np.append(high, np.full(fill, -1)).reshape(-1, width).max(axis=1)
            self.levels.append((low, high, width))
            width = FANOUT

    def findclose(self, place: int) -> int:
        """The place of the parenthesis that closes the one at ``place``: the first after it with one less
        excess. From its block upwards the blocks after it are looked at, then from the first that
        reaches that excess downwards."""
        target = int(self.excess[place]) - 1
        end = min((place // EXCESS_BLOCK + 1) * EXCESS_BLOCK, len(self.excess))
        found = np.flatnonzero(self.excess[place + 1 : end] == target)
        if len(found):
            return place + 1 + int(found[0])
        level, at = 0, place // EXCESS_BLOCK + 1
        while True:
            low, high, _ = self.levels[level]
            end = min((at // FANOUT + (at % FANOUT > 0)) * FANOUT, len(low))
            inside = np.flatnonzero((low[at:end] <= target) & (high[at:end] >= target))
            if len(inside):
                at += int(inside[0])
                break
            level, at = level + 1, -(-end // FANOUT)
        while level:
            level -= 1
            start = at * FANOUT
            low, high, _ = self.levels[level]
            span = slice(start, start + FANOUT)
            at = start + int(np.flatnonzero((low[span] <= target) & (high[span] >= target))[0])
        start = at * EXCESS_BLOCK
        return start + int(np.flatnonzero(self.excess[start : start + EXCESS_BLOCK] == target)[0])


def common(one: bytes | None, other: bytes | None) -> int:
    """Prefixes that two paths share; -1 if there is no other path, so not even the root is shared."""
    if one is None or other is None:
        return -1
    low, high = 0, min(len(one), len(other)) // KEY
    while low < high:
        middle = (low + high + 1) // 2
        if one[: middle * KEY] == other[: middle * KEY]:
            low = middle
        else:
            high = middle - 1
    return low


NODE = pa.schema(
    [("key", pa.binary()), ("parent_key", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves")]
    + [("saved_tokens", pa.int64()), ("ends", pa.int64()), ("copies", pa.int64())]
    + [("spine", pa.bool_()), ("parent_spine", pa.bool_())]
)


def encode(shard: pa.Table, before: bytes | None, after: bytes | None) -> pa.Table:
    """The nodes of a shard of sorted paths, between the last path before it and the first after it.

    What a node holds is counted in this shard only; nodes that a neighbour has as well are marked as
    spine, and their counts add up over the shards: a node counts as a child, and its own bytes are
    taken off, in the first shard that has it.
    """
    shard = shard.sort_by("path")
    columns = ("path", "sizes", "conv_id", "copies", "below", "longer")
    paths, sizes, ids, copies, below, longer = (shard[c].to_pylist() for c in columns)
    opens, parents, places, ends = bytearray(b"\1"), [-1], [0], []
    keys, size, branch = [b""], [0], [0]
    last = b""
    for path, own_sizes in zip(paths, sizes):
        shared, depth = common(last, path), len(path) // KEY
        opens += b"\0" * (len(last) // KEY - shared)
        del branch[shared + 1 :]
        for d in range(shared, depth):
            parents.append(branch[-1])
            branch.append(len(keys))
            keys.append(path[d * KEY : (d + 1) * KEY])
            size.append(own_sizes[d])
            places.append(len(opens))
            opens += b"\1"
        ends.append(branch[-1])
        last = path
    opens += b"\0" * (len(last) // KEY + 1)

    nodes = len(keys)
    is_open = np.frombuffer(bytes(opens), np.uint8) == 1
    trie = Parentheses(is_open)
    place = np.array(places)
    close = np.array([trie.findclose(p) for p in places])
    # Nodes are numbered as they open, so a subtree is a range of numbers.
    first, stop = np.arange(nodes), np.arange(nodes) + (close - place + 1) // 2
    depth, parent, size = trie.excess[place] - 1, np.array(parents), np.array(size)

    on_left, on_right = np.zeros(nodes, bool), np.zeros(nodes, bool)
    _mark(on_left, parent, ends[0], depth, common(before, paths[0]))
    _mark(on_right, parent, ends[-1], depth, common(paths[-1], after))
    owned = ~on_left
    leaf_pairs = np.append(is_open[:-1] & ~is_open[1:], False)
    if on_right[ends[-1]]:  # the next shard goes on below it
        leaf_pairs[place[ends[-1]]] = False
    leaves = np.append(0, np.cumsum(leaf_pairs))

    def below_each(values: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(values))
        return sums[stop] - sums[first]

    weight, tail, has_tail = (np.zeros(nodes, np.int64) for _ in range(3))
    weight[ends], tail[ends], has_tail[ends] = copies, below, [n > 0 for n in longer]
    n_convs = below_each(weight)
    saved = below_each(n_convs * size - owned * size + (weight - 1) * tail)
    children = has_tail.copy()
    np.add.at(children, parent[1:], owned[1:].astype(np.int64))
    smallest = np.full(nodes, np.iinfo(np.int64).max)
    smallest[ends] = ids
    for node in range(nodes - 1, 0, -1):
        up = parents[node]
        if smallest[node] < smallest[up]:
            smallest[up] = smallest[node]
    ended = (weight > 0) & (has_tail == 0)
    end_ids = np.zeros(nodes, np.int64)
    end_ids[ends] = ids
    up = np.maximum(parent, 0)
    spine = on_left | on_right
    is_root = parent < 0
    return pa.table(
        [
            pa.array(keys), pa.array([keys[p] if p >= 0 else None for p in parents], pa.binary()),
            depth, smallest, pa.array(smallest[up], mask=is_root), n_convs, children,
            leaves[close + 1] - leaves[place], saved, pa.array(end_ids, mask=~ended),
            pa.array(weight, mask=~ended), spine, spine[up] & ~is_root,
        ],
        schema=NODE,
    )


def _mark(marked: np.ndarray, parent: np.ndarray, end: int, depth: np.ndarray, shared: int) -> None:
    """Mark the nodes on the way to ``end`` that are no deeper than what is shared."""
    while end >= 0:
        marked[end] = depth[end] <= shared
        end = parent[end]


def _paths(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """The keys of each conversation's turns that need a tree, as one sequence of bytes that sorts like
    the trie: those that another conversation shares, and one more."""
    code = F.concat(*[F.lpad(F.hex(c), KEY, "0") for c in ("x", "y")])
    listed = F.array_sort(F.collect_list(F.struct("depth", code.alias("code"), "size")))
    held = rows.groupBy("conv_id").agg(listed.alias("t"))
    held = held.select(
        "conv_id", F.unhex(F.array_join("t.code", "")).alias("path"), F.col("t.size").alias("sizes")
    )
    nothing = F.array().cast("array<bigint>")
    joined = reps.join(held, "conv_id", "left").withColumns(
        {"path": F.coalesce("path", F.unhex(F.lit(""))), "sizes": F.coalesce("sizes", nothing)}
    )
    top = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda total, size: total + size)
    return joined.select(
        "conv_id", "copies", "path", "sizes", (F.col("bytes") - top).alias("below"),
        (F.col("turns") - F.size("sizes")).alias("longer"),
    )


def _tree_nodes(paths: DataFrame, shards: int) -> DataFrame:
    """The nodes of all paths: sorted and cut into shards, each encoded, and shared spines merged."""
    sorted_paths = paths.repartitionByRange(shards, "path").sortWithinPartitions("path")
    stored = written(sorted_paths.withColumn("shard", F.spark_partition_id()), "shards")
    edges = stored.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    # One row per shard.
    in_order = Window.orderBy("shard")
    edges = edges.select(
        "shard", F.lag("last").over(in_order).alias("before"), F.lead("first").over(in_order).alias("after")
    )

    def nodes(shard: pa.Table, edge: pa.Table) -> pa.Table:
        return encode(shard, edge["before"][0].as_py(), edge["after"][0].as_py())

    columns = ", ".join(f"{f.name} {_TYPES[f.type]}" for f in NODE)
    both = stored.groupBy("shard").cogroup(edges.groupBy("shard"))
    made = written(both.applyInArrow(nodes, columns), "trie")
    spine = made.filter("spine").groupBy("key", "parent_key", "depth", "parent_spine").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"), F.max("copies").alias("copies"),
    )
    spine = written(spine, "spine")
    whole = made.filter("NOT spine")
    merged = whole.drop("spine").unionByName(
        spine.withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    )
    # Children of a spine learn its smallest member from the merged rows.
    small = broadcast_if_small(
        spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_member")), 64
    )
    under = merged.filter("parent_spine").drop("parent_conv_id").join(small, "parent_key", "left")
    rest = merged.filter("NOT parent_spine")
    return rest.unionByName(under.withColumnRenamed("_member", "parent_conv_id")).drop(
        "key", "parent_key", "parent_spine"
    )


_TYPES = {pa.binary(): "binary", pa.int64(): "long", pa.bool_(): "boolean"}


def _digests(members: DataFrame) -> DataFrame:
    """``ends`` and ``digest``: the SHA-256 of the ids in ``conv_id``, ascending and joined by commas, of
    every ``ends``.

    Ids are sorted over all tasks and joined there into texts of up to CHUNK_IDS; only these meet in the
    task that feeds them to the digest one after the other, so a group may be of any size.
    """
    members = written(members, "members")
    parts = max(1, -(-members.count() // SLICE_IDS))
    order = ["ends", "conv_id"]
    ordered = members.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, ids = batch["ends"].to_numpy(), batch["conv_id"].to_pylist()
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            spans = [
                (at, min(at + CHUNK_IDS, stop))
                for start, stop in zip(cuts, cuts[1:])
                for at in range(start, stop, CHUNK_IDS)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(group[at]) for at, _ in spans], pa.int64()),
                    pa.array([ids[at] for at, _ in spans], pa.int64()),
                    pa.array([",".join(map(str, ids[at:stop])) for at, stop in spans], pa.string()),
                ],
                names=["ends", "first", "ids"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, digest = None, hashlib.sha256()

        def row() -> pa.RecordBatch:
            values = [pa.array([group], pa.int64()), pa.array([digest.hexdigest()], pa.string())]
            return pa.RecordBatch.from_arrays(values, names=["ends", "digest"])

        for batch in batches:
            for ends, ids in zip(batch["ends"].to_pylist(), batch["ids"].to_pylist()):
                if ends != group:
                    if group is not None:
                        yield row()
                    group, digest = ends, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if group is not None:
            yield row()

    joined = ordered.select(*order).mapInArrow(chunks, "ends long, first long, ids string")
    gathered = joined.repartition("ends").sortWithinPartitions("ends", "first")
    return gathered.select("ends", "ids").mapInArrow(digests, "ends long, digest string")


def prefix_trie(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations' turns: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    ``turns`` has what ``placed_turns`` gives, ``conv_ids`` the members, also those without turns. A node
    is a distinct sequence of first turns, compared by a digest of role and text; its members are the
    conversations that begin with it, the root's are all. ``saved_tokens`` adds up over the subtree the
    bytes of a node's last text for every member but one; ``ends_sha256`` is the digest of the ids of the
    members that end there. Without conversations there are no nodes.

    Equal conversations are one path with a number of copies. Turns that no other path shares form a
    chain below the tree, whose figures follow from the conversation alone; so a shard holds the shared
    turns of its conversations only, 32 bytes or so each.
    """
    keyed = written(_prefixes(turns), "prefixes")
    found = keyed.groupBy("conv_id").agg(
        F.max_by(F.struct("x", "y", "bytes"), "depth").alias("_last"), F.max("depth").alias("turns")
    )
    zero = F.lit(0).cast("bigint")
    last = [F.coalesce(F.col(f"_last.{c}"), zero).alias(c) for c in ("x", "y", "bytes")]
    members = conv_ids.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint")).distinct()
    members = members.join(found, "conv_id", "left").select(
        "conv_id", F.coalesce("turns", zero).alias("turns"), *last
    )
    members = written(members, "conversations")
    same = ["x", "y", "turns", "bytes"]
    copies = members.groupBy(*same).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    reps = written(copies, "paths")
    first_copies = reps.select("conv_id")
    rows = written(lookup_all(keyed, [(first_copies, ["conv_id"])]), "path-turns")

    # How deep each path runs together with another one.
    shared = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    shared = written(shared.select("x", "y", F.lit(True).alias("_shared")), "shared")
    deepest = lookup_all(rows.select("conv_id", "depth", "x", "y"), [(shared, ["x", "y"])])
    deepest = deepest.groupBy("conv_id").agg(F.max("depth").alias("_deepest"))
    reps = written(reps.join(deepest, "conv_id", "left").fillna(0, ["_deepest"]), "paths")
    known = reps.select(
        "conv_id", "copies", "_deepest", F.col("turns").alias("_turns"), F.col("bytes").alias("_bytes")
    )
    rows = written(lookup_all(rows, [(known, ["conv_id"])]), "path-turns")

    top = rows.filter("depth <= _deepest + 1")
    shards = max(1, -(-reps.count() // SHARD_ROWS))
    tree = _tree_nodes(_paths(top, reps.drop("_deepest", "x", "y")), shards)
    is_end = F.col("depth") == F.col("_turns")
    chains = rows.filter("depth > _deepest + 1").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.col("copies").alias("n_convs"),
        F.when(is_end, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        ((F.col("copies") - 1) * (F.col("_bytes") - F.col("bytes") + F.col("size"))).alias("saved_tokens"),
        F.when(is_end, F.col("conv_id")).alias("ends"), F.when(is_end, F.col("copies")).alias("copies"),
    )
    nodes = written(tree.unionByName(chains), "nodes")

    several = reps.filter("copies > 1").select(*same, F.col("conv_id").alias("ends"))
    digests = _digests(lookup_all(members, [(several, same)]).select("ends", "conv_id"))
    ended = F.coalesce(F.col("copies"), zero)
    one = F.sha2(F.when(ended == 0, F.lit("")).otherwise(F.col("ends").cast("string")), 256)
    plain = nodes.filter(ended <= 1).withColumn("ends_sha256", one)
    many = nodes.filter(ended > 1).join(digests, "ends").withColumnRenamed("digest", "ends_sha256")
    return plain.unionByName(many).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    )
