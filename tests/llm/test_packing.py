import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests_llm_text import edge_docs, no_docs  # noqa: F401
from tiermill.llm import packing
from tiermill.llm.packing import Encoder, Places, pack, plan
from tiermill.llm.queries import TOKENIZER, op10_packing

SF_DIR = "/root/testdata/sf0.01"
PATH = public_tokenizers.path(TOKENIZER)
TOKENS = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)


def ids(text):
    return TOKENS.encode(text or "", add_special_tokens=False).ids + [1]


def check(texts, found, length):
    """Every piece holds its part of the ids, and sequences are filled without gaps."""
    want = Counter()
    for i, text in texts:
        whole = ids(text)
        for at in range(0, len(whole), length):
            part = whole[at : at + length]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            want[(i, at // length, at, len(part), crc)] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        ends = [o + n for o, n in parts]
        assert [o for o, _ in parts] == [0, *ends[:-1]] and ends[-1] <= length
    return len(sequences)


def digest(df):
    return df.selectExpr(
        "doc_id", "piece", "start", "length", "crc32(ids)", "sequence_id", "offset"
    ).collect()


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = op10_packing(spark, SF_DIR).collect()
    used = check([tuple(d) for d in docs], found, 4096)
    total = sum(r["length"] for r in found)
    assert used <= -(-total // 4096) + 1


@pytest.mark.parametrize("length", [7, 4096])
def test_edge_rows(spark, edge_docs, no_docs, length):
    texts = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    check(texts, digest(pack(edge_docs, PATH, length)), length)
    assert pack(no_docs, PATH, length).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40) | st.text("aΣİ<|endoftxstar> \n\x1c'é́.1", max_size=30))
def test_ids_equal_the_whole_text(text):
    assert ENCODER(text) == np.array(ids(text)[:-1], "<u4").tobytes()


def test_forgetting_does_not_change_ids(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    monkeypatch.setattr(packing, "REMEMBERED_CHUNKS", 2)
    text = "one, two three. four FIVE six seven one two three nine, ten eleven"
    assert Encoder(PATH)(text) == np.array(ids(text)[:-1], "<u4").tobytes()


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([5, 40, 100]) if seed % 2 else rng.randrange(1, 101) for _ in range(2000))
    sequences = plan(counts, 100)
    used = Counter()
    for times, content in sequences:
        assert sum(content) <= 100 and times > 0
        for size in content:
            used[size] += times
    assert used == counts
    total = sum(size * n for size, n in counts.items())
    least = max(-(-total // 100), sum(n for size, n in counts.items() if size > 50))
    assert seed % 2 or sum(t for t, _ in sequences) <= 1.02 * least + 1


def test_exact_complements_are_used_first():
    assert sorted(plan({60: 2, 40: 1, 25: 1, 15: 1}, 100)) == [(1, (60, 25, 15)), (1, (60, 40))]
    assert plan({70: 1, 10: 3}, 100) == [(1, (70, 10, 10, 10))]
    assert plan({34: 2, 33: 2}, 100) == [(1, (34, 33, 33)), (1, (34,))]


def test_places_cover_runs():
    places = Places([(2, (60, 20, 20)), (1, (60,))])
    sequence, offset = places(np.array([20, 60, 20, 60, 20, 20, 60]), np.array([0, 0, 1, 1, 2, 3, 2]))
    assert sequence.tolist() == [0, 0, 1, 1, 0, 1, 2]
    assert offset.tolist() == [60, 0, 60, 0, 80, 80, 0]
