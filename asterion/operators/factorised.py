"""Joins of two long sides kept as blocks instead of pairs.

Two tables with many rows of one key each have a product of pairs. Here each side is kept as
ordered arrays of at most ``SIZE`` rows, numbered inside their key, and the result holds the blocks of both
sides for every key that they share: as many items as the two tables have rows, whatever their
product. :func:`expand` makes the pairs where they are wanted, for instance after a filter on
the key. Rows are numbered by month and carried over its borders, so no key has to fit in one task or
in one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import month_bucket, with_running_sum

SIZE = 1000


def blocks(df: DataFrame, *, key: str, time: str, order: list[str], columns: list[str], side: str, size: int = SIZE) -> DataFrame:
    """(key, side, block, n, items): rows in the order of (time, order), ``size`` to a block; rows without key or time come in no block."""
    d = df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_k"), F.col(time).alias("_t"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        F.struct(*[F.col(c) for c in columns]).alias("_row"))
    ordering = ["_t", *[f"_o{i}" for i in range(len(order))]]
    for c in ordering[1:]:  # NULLs come first, as a flag of their own
        d = d.withColumn(c, F.struct(F.col(c).isNotNull().alias("set"), F.col(c).alias("value")))
    d = with_running_sum(d, keys=["_k"], order=ordering, bucket=month_bucket("_t"), value=F.lit(1), name="_n")
    return d.groupBy(F.col("_k").alias(key), F.floor((F.col("_n") - 1) / size).alias("block")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("_n", "_row"))).alias("_items")).select(
        key, F.lit(side).alias("side"), "block", "n", F.transform("_items", lambda x: x["_row"]).alias("items"))


def shared(left: DataFrame, right: DataFrame, *, key: str) -> tuple[DataFrame, DataFrame]:
    """The blocks of both sides for the keys that both have."""
    return left.join(right.select(key).distinct(), key, "left_semi"), right.join(left.select(key).distinct(), key, "left_semi")


def linear(left: DataFrame, right: DataFrame, *, key: str) -> DataFrame:
    """Both sides under one schema: (key, side, block, n, the items of one side, the items of the other)."""
    a, b = left.schema["items"].dataType, right.schema["items"].dataType

    def as_columns(d: DataFrame, first: Column, second: Column) -> DataFrame:
        return d.select(key, "side", "block", "n", first.alias("left_items"), second.alias("right_items"))
    return as_columns(left, F.col("items"), F.lit(None).cast(b)).unionByName(as_columns(right, F.lit(None).cast(a), F.col("items")))


def expand(left: DataFrame, right: DataFrame, *, key: str) -> DataFrame:
    """The pairs: block meets block, then row meets row."""
    pairs = left.select(key, F.col("items").alias("_a")).join(right.select(key, F.col("items").alias("_b")), key)
    return pairs.select(key, F.explode("_a").alias("_x"), "_b").select(key, "_x", F.explode("_b").alias("_y")).select(key, "_x.*", "_y.*")
