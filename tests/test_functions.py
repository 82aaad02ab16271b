from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiermill.functions import predicates as p
from tiermill.functions.comments import DEFAULT_COMMENT, normalize_comment, quality_score

COMMENTS = [
    # text, cleaned, score, cleaned with strict_blank
    (None, DEFAULT_COMMENT, 0.8, DEFAULT_COMMENT),
    ("", DEFAULT_COMMENT, 0.8, DEFAULT_COMMENT),
    ("   ", DEFAULT_COMMENT, 0.8, DEFAULT_COMMENT),
    ("\n", "\n", 1.0, DEFAULT_COMMENT),
    ("\t", "\t", 1.0, DEFAULT_COMMENT),
    ("   \n   ", "\n", 1.0, DEFAULT_COMMENT),
    ("\U0001f600\U0001f485", "", 1.0, DEFAULT_COMMENT),
    ("café", "caf", 1.0, "caf"),
    ("<b>Great!</b>", "bGreat!b", 1.0, "bGreat!b"),
    ("  nice, really? - yes.  ", "nice, really? - yes.", 1.0, "nice, really? - yes."),
    ("bad\x00\x07 bell", "bad bell", 1.0, "bad bell"),
    (DEFAULT_COMMENT, DEFAULT_COMMENT, 0.8, DEFAULT_COMMENT),
]


def test_comment_normaliser(spark):
    df = spark.createDataFrame(list(enumerate(c[0] for c in COMMENTS)), "i int, comment string")
    cleaned = df.withColumn("clean", normalize_comment("comment"))
    got = cleaned.select("i", "clean", quality_score("clean"), normalize_comment("comment", True))
    assert rows(got) == sorted(((i, *c[1:]) for i, c in enumerate(COMMENTS)), key=repr)


def test_comment_keeps_letters_of_all_scripts_on_request(spark):
    df = spark.createDataFrame([("café Ωμέγα",)], "comment string")
    assert rows(df.select(normalize_comment("comment", unicode_words=True))) == [("café Ωμέγα",)]


@pytest.mark.parametrize(
    "value, kept",
    [
        (np.nextafter(np.float32(1), np.float32(0)), False),
        (np.float32(1), True),
        (np.float32(5), True),
        (np.nextafter(np.float32(5), np.float32(6)), False),
        (float("inf"), False),
        (float("-inf"), False),
        (float("nan"), False),
        (None, False),
    ],
)
def test_rating_range(spark, value, kept):
    df = spark.createDataFrame([(value if value is None else float(value),)], "rating_value float")
    assert (df.filter(p.rating_in_range()).count() == 1) == kept


def test_time_bounds_are_inclusive(spark):
    now = datetime(2025, 6, 1)
    times = [now, now + timedelta(seconds=1), now - p.LOOKBACK]
    times.append(now - p.LOOKBACK - timedelta(microseconds=1))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, timestamp timestamp")
    kept = df.filter(p.not_future("timestamp", now) & p.not_older("timestamp", now))
    assert rows(kept, "i") == [(0,), (2,)]


def test_any_and_all_null(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (None, None)], "a int, b int")
    got = df.select(p.any_null(["a", "b"]), p.all_present(["a", "b"]))
    assert sorted(tuple(r) for r in got.collect()) == [(False, True), (True, False), (True, False)]
    assert df.filter(F.lit(True)).count() == 3
