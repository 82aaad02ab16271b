import random
from itertools import combinations

import numpy as np
import pytest
from tests_llm_text import edge_docs, no_docs, prose  # noqa: F401

from tiermill.llm import substring
from tiermill.llm.queries import op1_substring
from tiermill.llm.substring import (
    chains,
    cut_repeats,
    passages_of,
    repeated_passages,
    seeds_of,
    without_words,
    word_hashes,
)

SF_DIR = "/root/testdata/sf0.001"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def longest_runs(docs, least):
    """Pairs of documents with a run of at least ``least`` equal words, by comparing all places."""
    where = {}
    for i, text in docs:
        words = (text or "").lower().split()
        for p in range(len(words) - least + 1):
            where.setdefault(tuple(words[p : p + least]), set()).add(i)
    return {pair for ids in where.values() for pair in combinations(sorted(ids), 2)}


def linked(pairs, ids):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        up[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}


def test_query_against_all_places(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    words = {i: (t or "").lower().split() for i, t in docs}
    found = op1_substring(spark, SF_DIR).collect()
    assert found
    for r in found:  # every passage is what it says
        a = words[r["doc_id"]][r["start"] : r["stop"]]
        b = words[r["source_doc_id"]][r["source_start"] : r["source_stop"]]
        assert r["source_doc_id"] < r["doc_id"] and len(a) >= 45 and r["similarity"] >= 0.8
        assert r["equal_words"] <= lcs(a, b)
        assert r["similarity"] == r["equal_words"] / max(len(a), len(b))
    # Every document with a run of 50 words of an earlier one has a passage, and all are connected.
    pairs = longest_runs(docs, 50)
    assert {b for _, b in pairs} <= {r["doc_id"] for r in found}
    ours = linked([(r["doc_id"], r["source_doc_id"]) for r in found], words)
    assert all(ours[a] == ours[b] for a, b in pairs)


@pytest.fixture(scope="module")
def planted():
    passage = prose(100, 60).split()
    fuzzy = [*passage[:28], "changed", *passage[29:]]
    grown = [*passage[:30], "put", "in", *passage[30:]]
    whole = prose(101, 200)
    docs = [
        (1, f"{prose(1, 90)} {' '.join(passage)}\n{prose(2, 40)}"),
        (2, f"{prose(3, 30)}  {' '.join(fuzzy).upper()} {prose(4, 9000)}"),
        (3, f"{' '.join(grown)}"),
        (4, whole),
        (5, whole),
        (5, whole),
        (6, f"{prose(5, 20)} {' '.join(passage[:20])} {prose(6, 80)}"),
        (7, None),
        (8, ""),
        (None, whole),
        (9, prose(7, 400)),
        (10, " ".join(["again and again"] * 40)),
        (11, " ".join(["again and again"] * 40) + " end"),
    ]
    return docs


def test_planted_passages(spark, planted):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in planted], "doc_id long, text string, seed string, source int")
    found = repeated_passages(df).collect()
    by = {r["doc_id"]: r for r in found}
    assert set(by) == {2, 3, 5, 11}
    assert (by[2]["start"], by[2]["stop"], by[2]["source_doc_id"]) == (30, 90, 1)
    assert (by[2]["source_start"], by[2]["source_stop"], by[2]["equal_words"]) == (90, 150, 59)
    assert (by[3]["start"], by[3]["stop"], by[3]["equal_words"]) == (0, 62, 60)
    assert (by[5]["start"], by[5]["stop"], by[5]["source_doc_id"]) == (0, 200, 4)
    assert len(found) == len(by)


def test_cut_leaves_the_first_copy(spark, planted):
    rows = [(i, t, len(t or ""), "x", 1) for i, t in planted]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, _id string, start int")
    kept = cut_repeats(df)
    assert kept.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    before = dict(planted)
    for i in (1, 4, 6, 7, 8, 9, 10, None):
        assert texts[i] == before[i]
    assert 5 not in texts and 3 not in texts
    assert texts[2] == f"{prose(3, 30)}  {prose(4, 9000)}"
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept.collect())


def test_empty_table(spark, no_docs):
    assert repeated_passages(no_docs).count() == 0
    assert cut_repeats(no_docs).count() == 0


def test_edge_rows(spark, edge_docs):
    found = repeated_passages(edge_docs).collect()
    assert {(r["doc_id"], r["source_doc_id"]) for r in found} >= {(1, 0), (2, 0), (10, 9)}
    assert cut_repeats(edge_docs).columns == edge_docs.columns


@pytest.mark.parametrize("text", ["", " ", "a", "A b\tc\n\x0bd", "é ü 語", "x" * 9000 + " y"])
def test_words_are_those_between_white_space(text):
    import re

    words = re.findall("[^ \t-\r]+", text.lower())
    hashes = word_hashes(text)
    assert len(hashes) == len(words)
    assert [np.where(hashes == h)[0][0] for h in hashes] == [words.index(w) for w in words]
    assert (word_hashes(" \n" + text.upper().lower() + " q")[:-1] == hashes).all()


def test_any_long_common_run_shares_a_seed():
    rng = np.random.default_rng(3)
    least = substring.SEED_WORDS + substring.WINDOW - 1
    for _ in range(200):
        common = rng.integers(0, 2**63, least).astype(np.uint64)
        a, b = (
            np.concatenate([rng.integers(0, 2**63, n).astype(np.uint64) for n in (rng.integers(0, 40),)] + [common])
            for _ in range(2)
        )
        assert set(seeds_of(a)[0]) & set(seeds_of(b)[0])


def test_chains_equal_the_quadratic_recurrence():
    rng = random.Random(4)
    for _ in range(100):
        found = sorted({(rng.randrange(200), rng.randrange(200), rng.randrange(8, 30)) for _ in range(25)})
        segments = np.array(found)
        score = []
        for x, y, n in found:
            gains = [
                s - substring.GAP_COST * (x - x0 - n0 + y - y0 - n0)
                for s, (x0, y0, n0) in zip(score, found)
                if x0 + n0 <= x and y0 + n0 <= y
            ]
            score.append(n + max([0, *gains]))
        first = chains(segments)[0]
        total = sum(found[i][2] for i in first)
        for i, j in zip(first, first[1:]):
            (x0, y0, n0), (x, y, _) = found[i], found[j]
            assert x0 + n0 <= x and y0 + n0 <= y
            total -= substring.GAP_COST * (x - x0 - n0 + y - y0 - n0)
        assert total == max(score)


def test_ends_go_over_changes():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**32, 80).astype(np.uint32)
    b = a.copy()
    b[[6, 74]] = 0
    matches = np.array([[40, 40]])
    assert passages_of(a, b, matches, 45, 0.8) == [(0, 80, 0, 80, 78, 78 / 80)]


def test_spans_may_overlap():
    assert without_words("a b  c d e\n", [1, 2], [3, 4]) == "a e\n"
    assert without_words(" a b", [0], [2]) == " "


def covered(found):
    return {i for start, stop, *_ in found for i in range(start, stop)}


def all_matches(a, b):
    return np.array([(i, j) for i in range(len(a) - 7) for j in range(len(b) - 7) if (a[i : i + 8] == b[j : j + 8]).all()])


def test_passages_that_begin_in_another_are_reported():
    rng = np.random.default_rng(6)
    p1, y, p2, between = (rng.integers(0, 2**32, n).astype(np.uint32) for n in (80, 12, 60, 300))
    a, b = np.concatenate([p1, y, p2]), np.concatenate([p1, y, between, y, p2])
    found = passages_of(a, b, all_matches(a, b), 45, 0.8)
    assert covered(found) == set(range(len(a)))
    # 40 words beyond the shared line are under 45 alone.
    found = passages_of(a[:132], b, all_matches(a[:132], b), 45, 0.8)
    assert covered(found) == set(range(132))
    assert len(passages_of(b, b, all_matches(b, b), 45, 0.8)) == 1


def test_chains_that_are_not_alike_are_split():
    rng = np.random.default_rng(7)
    p1, p2, p3, gap, other = (rng.integers(0, 2**32, n).astype(np.uint32) for n in (100, 60, 92, 45, 30))
    a, b = np.concatenate([p1, p2, p3]), np.concatenate([p1, gap, p2, other, p3])
    matches = all_matches(a, b)
    assert len(chains(substring._segments(a, b, matches))) == 1
    assert covered(passages_of(a, b, matches, 45, 0.8)) == set(range(len(a)))


def test_ends_that_lower_the_similarity_are_left():
    rng = np.random.default_rng(8)
    core, tail = (rng.integers(0, 2**32, n).astype(np.uint32) for n in (45, 4000))
    b = np.concatenate([core, tail[np.arange(4000) % 4 > 0]])
    found = passages_of(np.concatenate([core, tail]), b, np.array([[0, 0]]), 45, 0.8)
    assert found == [(0, 45, 0, 45, 45, 1.0)]


def test_first_holders_of_parts_do_not_hide_a_passage(spark):
    passage = prose(200, 60).split()
    head, tail = " ".join(passage[:30]), " ".join(passage[25:])
    twice = prose(201, 60).split()
    docs = [
        (1, f"{prose(210, 50)} {head} {prose(211, 50)}"),
        (2, f"{prose(212, 50)} {tail} {prose(213, 50)}"),
        (3, f"{prose(214, 40)} {' '.join(passage)} {prose(215, 70)}"),
        (4, f"{prose(216, 70)} {' '.join(passage)} {prose(217, 20)}"),
        # The source itself has the parts before the whole passage.
        (5, " ".join([*twice[:30], prose(218, 60), *twice[25:], prose(219, 60), *twice, prose(220, 9)])),
        (6, f"{prose(221, 33)} {' '.join(twice)} {prose(222, 44)}"),
    ]
    found = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    rows = {(r["doc_id"], r["source_doc_id"], r["start"], r["stop"], r["source_start"]) for r in found}
    assert rows == {(4, 3, 70, 130, 40), (6, 5, 33, 93, 30 + 60 + 35 + 60)}


def test_long_common_runs_share_a_taken_run():
    rng = np.random.default_rng(9)
    for _ in range(100):
        common = rng.integers(0, 2**32, 50).astype(np.uint64)
        a, b = (
            np.concatenate([rng.integers(0, 2**32, rng.integers(0, 40)).astype(np.uint64), common])
            for _ in range(2)
        )
        (x, p), (y, q) = (substring.runs_of(w, np.zeros(0, int), np.zeros(0, int), 45) for w in (a, b))
        assert set(x) & set(y)
        assert not len(substring.runs_of(a, np.arange(len(a)), np.zeros(0, int), 45)[0])
