"""Completeness, distributions and consistency of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from asterion.functions import orbit
from asterion.functions.common import count_if, share
from asterion.functions.timeconv import mjd_to_date, month_of

from .filters import json_fields
from .quantiles import percentiles, with_percentiles

JSON_KEYS = ["CAR", "COM", "epoch_data", "system_data", "software_data", "categorization",
             "magnitude_data", "designation_data", "moid_data", "non_grav_booleans",
             "orbit_fit_statistics"]


def null_rates(df: DataFrame, *, cols: list[str]) -> DataFrame:
    """Nulls per column from one pass over the table."""
    one = df.agg(F.count("*").alias("total"), *[F.count(c).alias(f"_{c}") for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("total"),
                              (F.col("total") - F.col(f"_{c}")).alias("null_count")) for c in cols])
    return one.select(F.explode(rows).alias("r")).select("r.*").withColumn(
        "null_pct", share("null_count", "total", 2))


def histogram(df: DataFrame, *, col, n: int, lo: float | None = None, hi: float | None = None,
              cap: float | None = None) -> DataFrame:
    """Equal-width histogram, between given bounds or the column's own extremes.

    ``cap`` leaves out values at or above it before the extremes are taken. Values
    outside given bounds are not counted.
    """
    x = F.col(col) if isinstance(col, str) else col
    d = df.select(x.cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if cap is not None:
        d = d.where(F.col("_x") < cap)
    if lo is not None and hi is not None:
        d = d.withColumns({"_lo": F.lit(float(lo)), "_hi": F.lit(float(hi)), "_edge": F.lit(float(hi))})
    else:
        b = d.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
        d = d.withColumns({"_lo": b["lo"], "_hi": b["hi"], "_edge": b["hi"] + F.lit(1e-10)})
    bucket = F.width_bucket("_x", "_lo", "_edge", F.lit(n))
    d = d.groupBy(bucket.alias("bucket"), "_lo", "_hi").agg(F.count("*").alias("count")).where(
        F.col("bucket").between(1, n))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(n))
    return d.select(F.col("bucket").cast("int").alias("bucket"),
                    (F.col("_lo") + (F.col("bucket") - 1) * step).alias("bin_lo"),
                    (F.col("_lo") + F.col("bucket") * step).alias("bin_hi"), "count")


def uncertainty_log_hist(df: DataFrame, *, cols: list[str], width: float = 0.5) -> DataFrame:
    """Counts per log10 bin of every positive uncertainty, from one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(F.col(c) > 0, F.floor(
        F.log10(c) / F.lit(width)) * F.lit(width)).alias("log_bin")) for c in cols])
    return df.select(F.explode(cells).alias("r")).select("r.*").where(
        F.col("log_bin").isNotNull()).groupBy("column_name", "log_bin").agg(F.count("*").alias("n"))


def stored_and_computed(orbits: DataFrame) -> DataFrame:
    a = F.coalesce(F.col("a"), orbit.semi_major_axis("q", "e"))
    return orbits.withColumn("computed_type", orbit.classify_orbit("q", "e", "i", a))


def classification_agreement(orbits: DataFrame) -> DataFrame:
    """Confusion counts of stored against computed class, with the overall rate."""
    d = stored_and_computed(orbits.where(F.col("orbit_type_int").isNotNull()))
    cells = d.groupBy("orbit_type_int", "computed_type").agg(F.count("*").alias("n"))
    same = F.sum(F.when(F.col("orbit_type_int") == F.col("computed_type"), F.col("n")).otherwise(F.lit(0)))
    rate = cells.agg(F.round(F.lit(100.0) * same / F.sum("n"), 4)).scalar()
    return cells.select(
        orbit.orbit_long_name("orbit_type_int").alias("db_class"),
        orbit.orbit_long_name("computed_type").alias("computed_class"), "n", rate.alias("agreement_pct"))


def class_recovery(orbits: DataFrame) -> DataFrame:
    """Class counts recovered from the elements where none is stored."""
    d = stored_and_computed(orbits.where(F.col("orbit_type_int").isNull()))
    name = F.when(F.col("computed_type").isNull(), F.lit("Still unclassified")).otherwise(
        orbit.orbit_long_name("computed_type"))
    return d.groupBy(name.alias("recovered_class")).agg(F.count("*").alias("n"))


def residual_stats(orbits: DataFrame) -> DataFrame:
    """Count, mean, spread and quartiles of q - a(1-e)."""
    d = orbits.select((F.col("q") - F.col("a") * (F.lit(1.0) - F.col("e"))).alias("r")).where(
        F.col("r").isNotNull())
    main = d.agg(F.count("*").alias("n"), F.avg("r").alias("mean"), F.stddev("r").alias("std"),
                 F.min("r").alias("min"), F.max("r").alias("max"))
    return with_percentiles(main, d, wanted={"p25": ("r", 0.25), "p50": ("r", 0.5), "p75": ("r", 0.75)})


def json_mismatch(orbits: DataFrame, *, tolerance: float = 0.01) -> DataFrame:
    """Flat H against the H of the orbit document."""
    doc = F.try_variant_get(F.try_parse_json("mpc_orb_jsonb"), "$.magnitude_data.H", "double")
    d = orbits.select((F.col("h") - doc).alias("d")).where(F.col("d").isNotNull())
    return d.agg(F.count("*").alias("n"), count_if(F.abs("d") > tolerance).alias("mismatches"),
                 F.round(F.max(F.abs("d")), 6).alias("max_diff"))


def json_key_presence(df: DataFrame, *, column: str = "mpc_orb_jsonb",
                      keys: list[str] = JSON_KEYS) -> DataFrame:
    """Share of documents that hold each top-level key, from one pass."""
    present = F.json_object_keys(column)
    one = df.select(present.alias("_k")).agg(
        F.count("*").alias("total"),
        *[count_if(F.array_contains("_k", k)).alias(f"_{k}") for k in keys])
    rows = F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(f"_{k}").alias("present"),
                              F.col("total")) for k in keys])
    return one.select(F.explode(rows).alias("r")).select("r.*").withColumn(
        "pct", share("present", "total", 1))


def temporal_completeness(df: DataFrame, *, time: str = "updated_at", cols: list[str]) -> DataFrame:
    """Per month of update: rows and share populated of each column."""
    return df.where(F.col(time).isNotNull()).groupBy(month_of(time).alias("month")).agg(
        F.count("*").alias("n_rows"),
        *[share(F.count(c), F.count("*"), 1).alias(f"pct_{c}") for c in cols])


def null_agreement(df: DataFrame, *, column: str = "orbit_type_int",
                   path: str = "$.categorization.orbit_type_int") -> DataFrame:
    """Two by two: is the flat column missing, is the document's value missing."""
    doc = F.try_variant_get(F.try_parse_json("mpc_orb_jsonb"), path, "int")
    return df.where(F.col("mpc_orb_jsonb").isNotNull()).groupBy(
        F.col(column).isNull().alias("top_null"), doc.isNull().alias("json_null")).agg(
        F.count("*").alias("n"))


def epoch_years(df: DataFrame, *, column: str = "epoch_mjd") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(
        F.year(mjd_to_date(column)).alias("epoch_year")).agg(F.count("*").alias("n"))


def difference_summary(df: DataFrame, *, a: str, b: str, close: float = 0.1) -> DataFrame:
    """Exact, close and differing counts of two columns at 1e-6; median and largest."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.round(F.abs(F.col(a) - F.col(b)), 6).alias("_d"))
    main = d.agg(F.count("*").alias("n"), count_if(F.col("_d") == 0).alias("exact"),
                 count_if(F.col("_d") < close).alias("close"),
                 count_if(F.col("_d") >= close).alias("differ"), F.max("_d").alias("max_diff"))
    return with_percentiles(main, d, wanted={"median_diff": ("_d", 0.5)}).select(
        "n", "exact", "close", "differ", F.round("median_diff", 4).alias("median_diff"), "max_diff")


def largest_differences(df: DataFrame, *, key: str, a: str, b: str, at_least: float = 1.0,
                        n: int = 15) -> DataFrame:
    d = F.abs(F.col(a) - F.col(b))
    return df.where(d >= at_least).select(key, a, b, F.round(F.col(a) - F.col(b), 6).alias("diff")) \
        .orderBy(F.abs("diff").desc(), key).limit(n)


def full_table_stats(df: DataFrame, *, count_col: str, spread_col: str, time: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.round(F.avg(count_col), 6).alias("avg"),
                  F.round(F.stddev(spread_col), 6).alias("stddev"), F.min(time).alias("min_ts"),
                  F.max(time).alias("max_ts"))


def selective_count(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition).agg(F.count("*").alias("n"))


def monthly_stats(df: DataFrame, *, time: str, value: str) -> DataFrame:
    return df.groupBy(month_of(time).alias("mo")).agg(
        F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean"))


def percentiles_disc(df: DataFrame, *, value: str, fractions=(0.25, 0.5, 0.75, 0.95, 0.99)) -> DataFrame:
    """Discrete percentiles of a whole column."""
    return percentiles(df, keys=[], wanted={f"p{round(100 * p):02d}": (value, p) for p in fractions}, discrete=True)


def json_table(df: DataFrame, *, keys: list[str]) -> DataFrame:
    return json_fields(df, keys=keys)
