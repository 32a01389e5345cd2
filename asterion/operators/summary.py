"""Per-object summaries and catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from asterion.functions import orbit
from asterion.functions.timeconv import day_of, days_between

from .filters import derived_elements, with_object_key
from .identity import PACKED, UNPACKED, earliest_discovery, or_key_join, with_numbering


def _span_aggs(time="obstime"):
    return [F.min(time).cast("date").alias("first_obs"), F.max(time).cast("date").alias("last_obs"),
            days_between(F.min(time), F.max(time)).alias("arc_days"), F.count("*").alias("nobs")]


def _disc_by():
    return F.min(F.when(F.col("disc") == "*", F.col("stn"))).alias("disc_by")


def obs_summary_all(obs: DataFrame, *, key: str | None = None) -> DataFrame:
    """Per object: first and last date, arc, count, discovery station.

    An object's key is its number or else its designation, or the given column.
    """
    rows = with_object_key(obs) if key is None else obs.withColumn("primary_desig", F.col(key))
    return rows.groupBy("primary_desig").agg(*_span_aggs(), _disc_by())


def obs_summary(wide: DataFrame, obs: DataFrame) -> DataFrame:
    """The same for listed objects under number or designation, with stations."""
    rows = or_key_join(wide.select("primary_desig", "permid"), obs,
                       columns=["obsid", "obstime", "stn", "disc"])
    return rows.groupBy("primary_desig").agg(
        *_span_aggs(), F.countDistinct("stn").alias("n_stns"), _disc_by())


def lifetime_followup(targets: DataFrame, obs: DataFrame) -> DataFrame:
    """Per (object, station): observations, tracklets, first and last, nights."""
    rows = or_key_join(targets.select("primary_desig", "permid"), obs,
                       columns=["obsid", "obstime", "stn", "trkid"])
    return rows.groupBy("primary_desig", "stn").agg(
        F.count("*").alias("nobs"), F.countDistinct("trkid").alias("n_tracklets"),
        F.countDistinct(day_of("obstime")).alias("n_nights"),
        F.min("obstime").alias("first_obs"), F.max("obstime").alias("last_obs"))


def detection_daily(obs: DataFrame) -> DataFrame:
    """Per (designation, station, day): observations, tracklets, any discovery."""
    return obs.where(F.col("provid").isNotNull()).groupBy(
        "provid", "stn", day_of("obstime").alias("obs_date")).agg(
        F.count("*").alias("n_obs"), F.countDistinct("trkid").alias("n_tracklets"),
        F.bool_or(F.col("disc") == "*").alias("disc_flag"))


def object_catalog(orbits: DataFrame, ni: DataFrame, obs: DataFrame) -> DataFrame:
    """One row per orbit: classes, derived elements, flags, discovery place and date.

    A discovery observation may carry the object's number, its designation or both.
    """
    code = F.coalesce("orbit_type_int", orbit.classify_orbit("q", "e", "i"))
    numbered = with_numbering(orbits, ni)
    d = derived_elements(numbered.withColumn("_code", code))
    ext = orbit.classify_extended("_code", "q", "e", F.col("a"))
    first = earliest_discovery(numbered, obs).select(
        F.col("packed_desig").alias(PACKED), F.col("unpacked_desig").alias("provid"), F.col("stn").alias("discovery_stn"), F.col("obstime").cast("date").alias("discovery_date"))
    d = d.select(
        PACKED, F.col(UNPACKED).alias("provid"), F.col("permid"), F.col("_code").alias("orbit_class_int"),
        ext.alias("boxscore_class"), orbit.extended_name(ext).alias("ext_name"),
        orbit.coarse_group(ext).alias("coarse_class"), "h", "a", "e", "i", "q",
        F.col("aphelion_q").alias("big_q"), "tisserand_j", "earth_moid",
        F.coalesce(F.col("_code").isin(0, 1, 2, 3), F.lit(False)).alias("neo"),
        orbit.is_pha_by_moid("earth_moid", "h").alias("pha"),
        (F.coalesce(F.col("i"), F.lit(0.0)) >= 90).alias("retrograde"))
    # By both names, which the search keeps unique: without its columns the search itself is left out.
    return d.join(first, [PACKED, "provid"], "left").drop(PACKED)


def boxscore_objects(orbits: DataFrame, ni: DataFrame) -> DataFrame:
    """Orbit catalogue with numbers, the box score's raw input."""
    return orbits.join(ni.select(PACKED, "permid"), PACKED, "left").select(
        F.col(UNPACKED).alias("provid"), "permid", "orbit_type_int", "q", "e", "i", "h")


def row_drift_check(counts: DataFrame, manifest: DataFrame, *, tolerance: float = 0.20) -> DataFrame:
    """Problems of (name, n) against the last manifest; new names pass."""
    d = counts.join(manifest.select("name", F.col("n").alias("prior")), "name")
    change = F.abs(F.col("n") - F.col("prior")) / F.nullif("prior", F.lit(0))
    return d.withColumns({
        "pct_change": F.round(F.lit(100.0) * change, 1),
        "problem": F.when(F.col("prior") <= 0, F.lit("invalid manifest"))
        .when((change > tolerance) & (F.col("n") > F.col("prior")), F.lit("grew"))
        .when(change > tolerance, F.lit("shrank"))}).where(F.col("problem").isNotNull())


def product_check(product: DataFrame, *, min_rows: int, n_columns: int) -> DataFrame:
    """One row: row count, column count, and whether both are as expected."""
    cols = len(product.columns)
    return product.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(cols).alias("n_columns"),
        ((F.col("n_rows") >= min_rows) & F.lit(cols == n_columns)).alias("ok"))
