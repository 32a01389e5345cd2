"""Top rows, ranks and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from asterion.functions import orbit
from asterion.functions.common import share
from asterion.functions.timeconv import month_of


def top_n_per_group(df: DataFrame, *, group: list, order: list, n: int) -> DataFrame:
    """First n rows of each group. Spark limits the groups on the map side before
    shuffling, so a large group never travels whole."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def top_k(df: DataFrame, *, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def period_change(df: DataFrame, *, time: str, value: str) -> DataFrame:
    """Monthly count and mean, the month before, and the change."""
    m = df.groupBy(month_of(time).alias("mo")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    w = Window.partitionBy(F.lit(0)).orderBy("mo")  # one row per month
    before = F.lag("mean").over(w)
    return m.select("mo", "n", F.round("mean", 6).alias("mean"), F.round(before, 6).alias("prev_mean"),
                    F.round(F.col("mean") - before, 6).alias("delta"))


def share_of_total(df: DataFrame, *, value: str, name: str = "pct", digits: int = 2) -> DataFrame:
    """Percentage of the column's total, which a scalar subquery supplies."""
    return df.withColumn(name, share(value, df.agg(F.sum(value)).scalar(), digits))


def sample_rows(df: DataFrame, *, n: int, key: str, seed: int = 0) -> DataFrame:
    """A reproducible random sample of n rows: the lowest hashes of the key."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def enum_order(df: DataFrame, *, code: str) -> DataFrame:
    return df.orderBy(orbit.orbit_rank(code), code)


def year_label_key(label) -> Column:
    """Sort key of year labels: '<1971' comes before every year."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c.startswith("<"), F.lit("0000")).otherwise(c)


def cumulative_counts(df: DataFrame, *, by: list[str], order: str, value: str) -> DataFrame:
    """Running total over an aggregated table, per series."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0)
    return df.withColumn("cumulative", F.sum(value).over(w))
