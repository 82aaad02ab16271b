"""Joins from a large table to a dimension whose size is not known beforehand."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.functions.predicates import any_null
from tiermill.session import written

# A dimension is broadcast only if it was measured to be within both bounds.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024

# Beyond them, keys with more fact rows than this are spread over several join tasks. The list of
# such keys is broadcast. It is bounded by arithmetic: a key counts as hot only if it also has more
# than the total divided by MAX_HOT_KEYS rows, which fewer than MAX_HOT_KEYS keys can have.
HOT_KEY_ROWS = 5_000_000
MAX_HOT_KEYS = 100_000
NULL_SALTS = 1 << 20

Lookup = tuple[DataFrame, list[str]]


def lookup_all(
    fact: DataFrame,
    lookups: list[Lookup],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_key_rows: int = HOT_KEY_ROWS,
    reused: bool = False,
) -> DataFrame:
    """Join ``fact`` to each (dimension, key columns) pair; the columns of the result are in the order
    of the joins.

    All dimensions are measured in one job. Those within the bounds are broadcast; the others are
    joined by shuffle, with the hot keys of ``fact`` salted. The broadcasts come first, so that inner
    joins thin the rows out before any shuffle. If the result is ``reused`` by several steps, it is
    written after a join by shuffle, which would otherwise run once for each of them.
    """
    small = _measured_small([dim for dim, _ in lookups], broadcast_rows)
    large = [lookup for lookup, fits in zip(lookups, small) if not fits]
    for dim, keys in [lookup for lookup, fits in zip(lookups, small) if fits]:
        fact = fact.join(F.broadcast(dim), keys, how)
    if large:
        # Counting the keys and joining both read the fact; written once, it is computed once.
        fact = written(fact, "fact")
    hot = [hot_keys(fact, keys, hot_key_rows) for _, keys in large]
    for (dim, keys), frequent in zip(large, hot):
        fact = salted_join(fact, dim, keys, frequent, how)
    return written(fact, "looked-up") if large and reused else fact


def colocated_join(
    fact: DataFrame, dim: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join two sides that lie in the same buckets of ``keys``: sorted and merged bucket by bucket, without
    a shuffle. Sides that do not are shuffled first; the rows are the same."""
    return fact.join(dim.hint("merge"), keys, how)


def _length(field: T.StructField) -> Column:
    """Bytes of a column beyond its fixed width."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(field.name)))
    return F.lit(0)


def _measured_small(dims: list[DataFrame], broadcast_rows: int) -> list[bool]:
    measures = []
    for i, dim in enumerate(dims):
        lengths = reduce(
            lambda total, length: total + F.coalesce(length, F.lit(0)),
            map(_length, dim.schema.fields),
            F.lit(0).cast("bigint"),
        )
        width = 16 * (len(dim.columns) + 1)
        measures.append(
            dim.agg(
                F.lit(i).alias("i"),
                F.count("*").alias("n"),
                F.coalesce(F.sum(lengths + F.lit(width)), F.lit(0)).alias("size"),
            )
        )
    sizes = reduce(DataFrame.unionAll, measures).collect() if measures else []
    return [
        row["n"] <= broadcast_rows and row["size"] <= BROADCAST_BYTES
        for row in sorted(sizes, key=lambda row: row["i"])
    ]


def hot_keys(fact: DataFrame, keys: list[str], hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """All keys with more than ``hot_key_rows`` rows (and more than one in MAX_HOT_KEYS of all rows),
    and into how many parts to split each. Counted once and written (runs a job), as both sides of a
    join use it."""
    counts = fact.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n"))
    counts = written(counts.filter(F.col("_n") > hot_key_rows), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    most = max(hot_key_rows, total // MAX_HOT_KEYS)
    salts = F.ceil(F.col("_n") / max(most, 1)).cast("int").alias("_salts")
    return written(counts.filter(F.col("_n") > most).select(*keys, salts), "hot-keys")


def salted_join(
    fact: DataFrame, dim: DataFrame, keys: list[str], hot: DataFrame, how: str = "inner"
) -> DataFrame:
    """Shuffle join in which the fact rows of a key in ``hot`` are split over several tasks.

    Every fact row of a hot key gets one of its salts and the matching dimension rows are repeated
    once per salt, so the result is that of the plain join. Fact rows without a key match nothing
    and get any salt. The salt depends only on the row and on the task that holds it, so a recomputed
    task sends its rows to the same places.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join is inner or left")
    salts = F.when(any_null(keys), F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    row_salt = F.pmod(F.xxhash64(*fact.columns), salts) + F.spark_partition_id()
    salted_fact = (
        fact.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.pmod(row_salt, salts).cast("int"))
        .drop("_salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - F.lit(1))
    salted_dim = (
        dim.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_salts")
    )
    return salted_fact.join(salted_dim, [*keys, "_salt"], how).drop("_salt")
