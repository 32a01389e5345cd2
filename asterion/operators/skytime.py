"""Joins and aggregations on sky position and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from asterion.functions import sky, tables as T
from asterion.functions.common import count_if, share
from asterion.functions.eclipse_table import LUNAR_ECLIPSES
from asterion.functions.formats import elongation_bin_label

from .filters import date_window
from .quantiles import with_percentiles

CONTACTS = ["P1", "U1", "U2", "greatest", "U3", "U4", "P4"]
ECLIPSE_NAMES = {1: "Penumbral eclipse", 2: "Partial eclipse", 3: "Total eclipse"}


def lunar_eclipses(spark: SparkSession) -> DataFrame:
    """The fixed catalogue of 87 lunar eclipses as a table."""
    rows = [line.split(",") for line in LUNAR_ECLIPSES.strip().splitlines()]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["type", *CONTACTS]))
    return raw.select("type", *[F.nullif(c, F.lit("")).try_cast("timestamp_ntz").alias(c)
                                for c in CONTACTS])


def eclipse_overlap(obs: DataFrame, eclipses: DataFrame, *, time: str = "obstime",
                    moon_alt: str = "moon_alt", satellite: str = "is_satellite",
                    key: str = "obsid") -> DataFrame:
    """Deepest eclipse phase under way at each instant, '' without one.

    From the ground the Moon must be above the horizon. Eclipses last under seven
    hours, so both sides join on the calendar day (an eclipse offers itself to the
    one or two days it touches) and the exact contacts are checked afterwards;
    eclipses never overlap, so at most one row matches.
    """
    days = F.sequence(F.col("P1").cast("date"), F.col("P4").cast("date"))
    ecl = eclipses.where(F.col("P1").isNotNull() & F.col("P4").isNotNull()).select(
        "*", F.explode(days).alias("_day"))
    t = F.col(time)
    d = obs.withColumn("_day", t.cast("date"))
    joined = d.join(ecl, (d["_day"] == ecl["_day"]) & (t >= F.col("P1")) & (t <= F.col("P4")),
                    "left").drop("_day")
    phase = (F.when((F.col("type") == "T") & (t >= F.col("U2")) & (t <= F.col("U3")), F.lit(3))
             .when(F.col("type").isin("T", "P") & (t >= F.col("U1")) & (t <= F.col("U4")), F.lit(2))
             .otherwise(F.lit(1)))
    seen = F.col("P1").isNotNull() & (F.coalesce(F.col(satellite), F.lit(False))
                                      | F.coalesce(F.col(moon_alt) > 0, F.lit(False)))
    name = F.when(phase == 3, F.lit(ECLIPSE_NAMES[3])).when(phase == 2, F.lit(ECLIPSE_NAMES[2])) \
        .otherwise(F.lit(ECLIPSE_NAMES[1]))
    return joined.withColumns({
        "eclipse_class": F.when(seen, name).otherwise(F.lit("")),
        "eclipse_date": F.when(seen, F.col("greatest").cast("date").cast("string"))
        .otherwise(F.lit(""))}).drop("type", *CONTACTS)


def sun_days(spark: SparkSession, *, start: str, end: str, model: str) -> DataFrame:
    """(obs_date, sun_ra, sun_dec) for every day of a range."""
    ra, dec = sky.sun_ra_dec_daily("obs_date", model)
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("obs_date")).select(
        "obs_date", ra.alias("sun_ra"), dec.alias("sun_dec"))


def daily_sun_join(obs: DataFrame, *, start: str, end: str, model: str = "histogram") -> DataFrame:
    """Observations of a date range with the Sun's place of their day.

    The day table is a bounded dimension (one row per day); observations stay put.
    """
    d = date_window(obs, time="obstime", start=start, end=end).where(
        F.col("ra").isNotNull() & F.col("dec").isNotNull())
    days = sun_days(obs.sparkSession, start=start, end=end, model=model)
    return d.withColumn("obs_date", F.col("obstime").cast("date")).join(days, "obs_date")


def solar_elongation_histogram(obs: DataFrame, *, station: str, start: str, end: str,
                               width: int = 5) -> DataFrame:
    """Signed-elongation bins of a station: label, count, share, running share."""
    from .ordered import cumulative
    d = daily_sun_join(obs.where(F.col("stn") == station), start=start, end=end)
    binned = F.floor(sky.signed_elongation("ra", "dec", "sun_ra", "sun_dec") / F.lit(width))
    counts = d.groupBy(binned.cast("int").alias("bin_num")).agg(F.count("*").alias("n_obs"))
    total = counts.agg(F.sum("n_obs")).scalar()
    shares = counts.select("bin_num", "n_obs", share("n_obs", total, 2).alias("bin_pct"))
    return cumulative(shares, order="bin_num", value="bin_pct", name="_cum").select(
        elongation_bin_label("bin_num", width).alias("bin_label"), "n_obs", "bin_pct",
        F.round("_cum", 2).alias("cum_pct"))


def solar_elongation_stats(obs: DataFrame, *, station: str, start: str, end: str) -> DataFrame:
    """Count, extremes, mean, median and east/west counts of signed elongation."""
    d = daily_sun_join(obs.where(F.col("stn") == station), start=start, end=end, model="stats")
    d = d.select(sky.signed_elongation("ra", "dec", "sun_ra", "sun_dec").alias("elong"))
    main = d.agg(
        F.count("*").alias("total_observations"),
        F.round(F.min("elong"), 2).alias("min_signed_elong"),
        F.round(F.max("elong"), 2).alias("max_signed_elong"),
        F.round(F.avg("elong"), 2).alias("mean_signed_elong"),
        count_if(F.col("elong") > 0).alias("east_count"),
        count_if(F.col("elong") < 0).alias("west_count"))
    return with_percentiles(main, d, wanted={"median_signed_elong": ("elong", 0.5)}).select(
        F.lit(station).alias("station_code"), F.lit(start).cast("date").alias("start_date"),
        F.lit(end).cast("date").alias("end_date"), "total_observations", "min_signed_elong",
        "max_signed_elong", "mean_signed_elong", F.round("median_signed_elong", 2).alias("median_signed_elong"),
        "east_count", "west_count")


def circumstance_summary(circ: DataFrame) -> DataFrame:
    """Count and percentage of discoveries per twilight class."""
    n = circ.groupBy("twilight_class").agg(F.count("*").alias("n"))
    return n.select("twilight_class", "n", share("n", n.agg(F.sum("n")).scalar(), 2).alias("pct"))


def eclipse_discoveries(circ: DataFrame) -> DataFrame:
    return circ.where(F.col("eclipse_class") != "").select(
        "primary_designation", "discovery_site_code", "eclipse_class", "eclipse_date",
        "lunar_elong_deg")


def elongation_range(circ: DataFrame) -> DataFrame:
    """Minimum, median and maximum lunar elongation (one decimal, so few values)."""
    counts = circ.groupBy("lunar_elong_deg").agg(F.count("lunar_elong_deg").alias("_n"))
    return counts.agg(F.min("lunar_elong_deg").alias("min_elong"),
                      F.percentile("lunar_elong_deg", F.lit(0.5), F.col("_n")).alias("median_elong"),
                      F.max("lunar_elong_deg").alias("max_elong"))


def lunar_phase_histogram(df: DataFrame, *, time: str) -> DataFrame:
    """Counts per whole day from the nearest mean full moon."""
    d = df.where(F.col(time).isNotNull()).select(
        F.floor(sky.days_from_full_moon(time)).cast("int").alias("days_from_full"))
    return d.groupBy("days_from_full").agg(F.count("*").alias("n"))


def lunar_phase_suppression(df: DataFrame, *, time: str) -> DataFrame:
    """Discoveries within a day of full and of new moon against a uniform rate."""
    x = sky.days_from_full_moon(time)
    half = T.SYNODIC_MONTH_DAYS / 2
    d = df.where(F.col(time).isNotNull()).select(F.abs(x).alias("_x"))
    return d.agg(F.count("*").alias("total"), count_if(F.col("_x") <= 1).alias("near_full"),
                 count_if(F.col("_x") >= half - 1).alias("near_new")).select(
        "total", "near_full", "near_new", share("near_full", "total", 2).alias("pct_full"),
        share("near_new", "total", 2).alias("pct_new"),
        F.lit(round(200 / T.SYNODIC_MONTH_DAYS, 2)).alias("pct_uniform"))
