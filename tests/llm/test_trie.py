import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermill.llm import trie as t

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """Turns of every conversation in their order, as (role, text)."""
    held = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            held[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(turns)] for c, turns in held.items()}


def headed(held):
    """The contract's rebuilding: heads of the first conversation of five."""
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = held.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(held):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in held.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(
        (
            min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs), children.get(node, 0),
            leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def built(turns, ids):
    got = [tuple(r) for r in t.prefix_trie(turns, ids).collect()]
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in got)


def found(spark, rows, contract=False):
    given = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit("clash")).withColumn("a", F.lit(0))
    turns = t.placed_turns(given)
    if contract:
        heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
        turns = t.with_heads(turns, F.expr("conv_id - conv_id % 5"), heads, 8)
    return built(turns, given.select("conv_id"))


def bushy(count, seed, kinds=3, longest=7):
    """Conversations with few different turns, so that many prefixes and whole ones are shared."""
    r = random.Random(seed)
    rows = []
    for c in range(count):
        for turn in range(r.randrange(1, longest)):
            role = r.choice(["user", "assistant"]) if turn % 3 == 0 else "user"
            rows.append((c * r.choice([1, 1, 1, 3]) if turn < 0 else c, turn, role, "é" * r.randrange(kinds)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_rows", [1, 3, 8192])
def test_equals_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(t, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(t, "CHUNK_IDS", 2)
    monkeypatch.setattr(t, "SLICE_IDS", 5)
    rows = bushy(60, shard_rows)
    assert found(spark, rows) == brute(sequences(rows))
    assert found(spark, rows, contract=True) == brute(headed(sequences(rows)))


def test_long_conversations_are_added_up_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(t, "BLOCK_TURNS", 4)
    monkeypatch.setattr(t, "SHARD_ROWS", 2)
    long_one = [(7, i, "user", f"text {i}") for i in range(30)]
    copy = [(9, i, "user", f"text {i}") for i in range(30)]
    other = [(8, i, "user", f"text {i}" if i < 11 else f"other {i}") for i in range(25)]
    rows = long_one + copy + other + [(1, 0, "user", "text 0")]
    assert found(spark, rows) == brute(sequences(rows))


def test_hot_groups_are_cut_into_slices(spark, monkeypatch):
    monkeypatch.setattr("tiermill.operators.numbering.HOT_GROUP_ROWS", 20)
    rows = bushy(20, 3) + [(77, i, "user", f"{i % 4}") for i in range(120)]
    rows += [(c, i, "user", f"{i}") for c in range(100, 160) for i in range(2)]
    assert found(spark, rows) == brute(sequences(rows))


def test_order_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z"),
        (2, None, "", ""), (2, 0, "assistant", "z"), (2, 0, "user", "a"), (2, 1, "user", "b"),
        (3, 5, "user", "a"), (3, 5, "user", "a"), (4, 5, "user", "a"), (4, 6, "user", "a"),
        (None, 0, "user", "nobody"), (5, None, "x", "2"), (5, None, "x", "1"), (-6, 0, "x", "1"),
        (8, 0, "ab", "c"), (9, 0, "a", "bc"),
    ]
    assert found(spark, rows) == brute(sequences(rows))


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(4, 0, "user", "a"), (6, 0, "user", "b")]  # neither 0 nor 5 is there
    held = headed(sequences(rows))
    assert [] in held.values()
    assert found(spark, rows, contract=True) == brute(held)
    turns = t.placed_turns(spark.createDataFrame(rows, SCHEMA))
    ids = spark.createDataFrame([(4,), (6,), (2,), (2,), (None,)], "conv_id long")
    assert built(turns, ids) == brute({4: [("user", "a")], 6: [("user", "b")], 2: []})


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [], contract=True) == []


def test_a_large_group_of_copies_is_one_path(spark, monkeypatch):
    monkeypatch.setattr(t, "CHUNK_IDS", 100)
    rows = [(c, i, "user", f"{i}") for c in range(1500) for i in range(2)] + [(5000, 0, "user", "0")]
    assert found(spark, rows) == brute(sequences(rows))


@pytest.mark.parametrize("seed", range(6))
def test_findclose_equals_matching_with_a_stack(seed):
    r = random.Random(seed)
    opens, depth = [1], 1
    for _ in range([3, 60, 700, 5000, 30_000, 100_000][seed]):
        step = 1 if depth == 1 or r.random() < 0.52 else 0
        opens.append(step)
        depth += 1 if step else -1
    opens += [0] * depth
    held, closes = [], {}
    for place, one in enumerate(opens):
        if one:
            held.append(place)
        else:
            closes[held.pop()] = place
    tree = t.Parentheses(np.array(opens) == 1)
    some = r.sample(sorted(closes), min(len(closes), 3000))
    assert all(tree.findclose(p) == closes[p] for p in [0, *some])


def test_common_prefixes():
    a, b, c = (bytes([n]) * t.KEY for n in range(3))
    assert t.common(None, a) == t.common(a, None) == -1
    assert [t.common(x, y) for x, y in ((b"", a), (a, a), (a + b, a + c), (a + b + c, a + b), (a, b))] == [0, 1, 1, 2, 0]
