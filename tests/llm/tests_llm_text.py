"""Texts and tables that several of these tests use."""

import random

import pytest


def prose(seed: int, words: int) -> str:
    """Words that hardly repeat from seed to seed."""
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(words))


CLASHES = "fp component component_id size shard slot place class piece start length ids _file _row u v row _id _md5 _cut text_md5 _starts _stops count key"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids and texts, empty, blank and long texts, repeated rows, ties and clashing columns."""
    long = prose(1, 6000)
    near = long.split()
    near[3000] = "changed"
    texts = [
        (0, long),
        (1, " ".join(near)),
        (2, long),
        (2, long),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (None, long),
        (None, prose(2, 50)),
        (None, prose(2, 50)),
        (None, None),
        (6, "one two"),
        (7, "One  TWO"),
        (8, "Ünï ΣΑΣ İx <|endoftext|> é 'll 12"),
        (9, prose(3, 80)),
        (9, prose(4, 80)),
        (10, prose(3, 80)),
    ]
    names = CLASHES.split()
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(i, t, *("x" for _ in names)) for i, t in texts], schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
