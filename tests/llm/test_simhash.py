import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tests_llm_text import edge_docs, no_docs  # noqa: F401
from tiermill.llm import simhash
from tiermill.llm.components import components
from tiermill.llm.queries import op8_simhash
from tiermill.llm.simhash import block_masks, fingerprint, keep_one, simhash_components

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text, shingle=4):
    low = (text or "").encode().translate(simhash.LOWER)
    words = low.split()
    if not words:
        return 0
    parts = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(b" ".join(p), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, distance):
    """Component ids by comparing all fingerprints."""
    prints = sorted({f for _, f in pairs})
    up = {f: f for f in prints}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= distance:
            up[root(a)] = root(b)
    low = {}
    for i, f in pairs:
        if i is not None:
            low[root(f)] = min(i, low.get(root(f), i))
    return Counter((i, f, low.get(root(f))) for i, f in pairs)


def result(df):
    found = df.select("doc_id", "fp", "component_id").collect()
    return Counter((r[0], r[1] % 2**64, r[2]) for r in found)


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a b c", "a b c d", "A a\x0bA a a", "é " * 900])
def test_fingerprint_equals_bit_by_bit_count(text):
    assert fingerprint(text, 4) % 2**64 == plain_fingerprint(text)


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    pairs = [(d["doc_id"], plain_fingerprint(d["text"])) for d in docs]
    want = Counter((i, f"{f:016x}", c) for (i, f, c) in brute_components(pairs, 4).elements())
    assert Counter(map(tuple, op8_simhash(spark, SF_DIR).collect())) == want


def test_edge_rows(spark, edge_docs):
    rows = edge_docs.select("doc_id", "text").collect()
    pairs = [(r[0], plain_fingerprint(r[1])) for r in rows]
    assert result(simhash_components(edge_docs)) == brute_components(pairs, 4)


def test_no_rows(spark, no_docs):
    assert simhash_components(no_docs).count() == 0
    assert keep_one(no_docs).count() == 0


def test_one_row_of_each_component_stays(spark, edge_docs):
    found = simhash_components(edge_docs).collect()
    kept = keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len({r["component"] for r in found})


@pytest.mark.parametrize("group_rows", [50, 4096])
def test_dense_clusters_and_cut_groups(spark, monkeypatch, group_rows):
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    rng, prints = random.Random(5), []
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(120):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randrange(7)))
            prints.append(centre ^ flips)
    prints += [rng.getrandbits(64) for _ in range(300)]
    signed = sorted({p - 2**64 if p >> 63 else p for p in prints})
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r[0]: r[1] for r in components(simhash.near_fingerprints(fps, 4)).collect()}
    ours = Counter()
    for p in signed:
        ours[found.get(p, p)] += 1
    pairs = [(k, p % 2**64) for k, p in enumerate(signed)]
    theirs = Counter(c for _, _, c in brute_components(pairs, 4).elements())
    assert sorted(ours.values()) == sorted(theirs.values())


@pytest.mark.parametrize("rows", [10, 10**8, 10**10])
def test_masks_hold_one_equal_part_for_any_difference(rows):
    masks = block_masks(4, rows)
    rng = random.Random(rows)
    for _ in range(300):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flips & m for m in masks)
    assert rows < 10**9 or min(m.bit_count() for m in masks) >= 20


def test_gray_rank_orders_the_gray_sequence():
    n = np.arange(1000, dtype=np.uint64)
    assert (simhash._gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(40)]
    hub = [(100, 100 + i) for i in range(1, 60)]
    edges = spark.createDataFrame([*path, *hub, (7, 7), (41, 40), (101, 100)], "u long, v long")
    found = {r[0]: r[1] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(1, 42)} | {100 + i: 100 for i in range(1, 60)}
