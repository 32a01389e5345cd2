"""Ordered work inside a key that may be arbitrarily large.

A plain ``Window.partitionBy(key)`` sorts a whole key in one task. These helpers
cut a key into buckets that are monotone in the order (a day, a month, a block of
positions), run the window per (key, bucket), and carry only one row per bucket
across bucket borders. The result is the same as that of the plain window. Keys
and order columns must not be NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_B = "_bucket"


def with_previous(df: DataFrame, *, keys: list[str], order: list[str], bucket: Column,
                  columns: list[str], prefix: str = "prev_") -> DataFrame:
    """Add the preceding row's columns (NULL on the first row of a key)."""
    d = df.withColumn(_B, bucket)
    inside = Window.partitionBy(*keys, _B).orderBy(*order)
    d = d.withColumn("_in", F.lag(F.struct(*columns)).over(inside))
    edges = d.groupBy(*keys, _B).agg(
        F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    edges = edges.select(*keys, _B, F.lag("_last").over(
        Window.partitionBy(*keys).orderBy(_B)).alias("_edge"))
    both = F.coalesce(F.col("_in"), F.col("_edge"))
    return d.join(edges, [*keys, _B], "left").select(
        *df.columns, *[both[c].alias(prefix + c) for c in columns])


def with_running_sum(df: DataFrame, *, keys: list[str], order: list[str], bucket: Column,
                     value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of a key up to and including this one."""
    d = df.withColumn(_B, bucket).withColumn("_v", value)
    inside = Window.partitionBy(*keys, _B).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    d = d.withColumn("_in", F.sum("_v").over(inside))
    totals = d.groupBy(*keys, _B).agg(F.sum("_v").alias("_t"))
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, _B, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    return d.join(totals, [*keys, _B], "left").select(
        *df.columns, (F.col("_in") + F.col("_off")).alias(name))


def with_carried(df: DataFrame, *, keys: list[str], order: list[str], bucket: Column,
                 value: str, name: str, forward: bool = True) -> DataFrame:
    """Add the last non-NULL ``value`` at or before this row (or first at or after)."""
    d = df.withColumn(_B, bucket)
    # Looking ahead is looking back in descending order: a frame that ends unbounded
    # would be evaluated anew for every row.
    sort = [F.col(c).asc() if forward else F.col(c).desc() for c in order]
    buckets = F.col(_B).asc() if forward else F.col(_B).desc()
    upto = Window.partitionBy(*keys, _B).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(buckets).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.last(value, ignorenulls=True).over(upto)
    rank = F.when(F.col(value).isNotNull(), F.struct(*order))
    edge = (F.max_by if forward else F.min_by)(F.col(value), rank)
    carried = F.last("_e", ignorenulls=True).over(before)
    d = d.withColumn("_in", inside)
    edges = d.groupBy(*keys, _B).agg(edge.alias("_e"))
    edges = edges.select(*keys, _B, carried.alias("_edge"))
    return d.join(edges, [*keys, _B], "left").select(
        *df.columns, F.coalesce("_in", "_edge").alias(name))


def with_position(df: DataFrame, *, order: list[str], bucket: Column, name: str = "position") -> DataFrame:
    """Add the place of each row in an order of the whole table, from 1.

    Rows are numbered inside buckets that are monotone in the order, and one row per bucket carries
    the numbers on.
    """
    d = with_running_sum(df.withColumn("_one", F.lit(0)), keys=["_one"], order=order, bucket=bucket, value=F.lit(1), name=name)
    return d.drop("_one")


def month_bucket(t) -> Column:
    """Months since year zero; monotone in time."""
    c = F.col(t) if isinstance(t, str) else t
    return F.year(c) * 12 + F.month(c)


def position_bucket(pos: str, size: int = 10_000) -> Column:
    return F.floor(F.col(pos) / F.lit(size))


def cumulative(df: DataFrame, *, order: str, value: str, name: str, by: list[str] | None = None,
               ) -> DataFrame:
    """Running total of an already aggregated, small table (one row per bin)."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(order).rangeBetween(
        Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(w))
