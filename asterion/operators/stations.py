"""Per-station statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from asterion.functions import circular, orbit, photometry
from asterion.functions.common import count_if
from asterion.functions.timeconv import year_of

from .filters import date_window, neo_rule, object_key, ref_class
from .identity import UNPACKED, earliest_discovery, with_numbering
from .quantiles import with_percentiles


def full_outer_counts(*tables: DataFrame, key: str) -> DataFrame:
    """Merge per-key tables on a key any of them may lack."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, key, "full")
    return out


def station_discovery_profile(orbits: DataFrame, ni: DataFrame, obs: DataFrame) -> DataFrame:
    """Objects discovered per station: all, near-Earth by q, near-Earth by type."""
    every = obs.where(F.col("disc") == "*").groupBy("stn").agg(
        F.countDistinct(object_key()).alias("disc_all"))
    # One search for the objects of either rule; which rules an object meets goes along with it.
    meets = {rule: F.coalesce(select, F.lit(False)) for rule, select in (("_q", neo_rule("iau")), ("_class", neo_rule("class")))}
    either = orbits.withColumns(meets).where("_q OR _class")
    first = earliest_discovery(with_numbering(either, ni), obs, carry=["_q", "_class"])
    year = F.when(F.col("_q"), F.year("obstime"))
    near = first.groupBy("stn").agg(
        F.nullif(count_if("_q"), F.lit(0)).alias("disc_neo_q"), F.nullif(count_if("_class"), F.lit(0)).alias("disc_neo_class"),
        F.min(year).alias("first_neo_year"), F.max(year).alias("last_neo_year"))
    return full_outer_counts(every, near, key="stn").select(
        "stn", "disc_all", "disc_neo_q", "disc_neo_class", "first_neo_year", "last_neo_year")


def nulls_last_order(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in columns])


def station_obs_profile(obs: DataFrame, *, distinct: str | None = None) -> DataFrame:
    """Observations, first and last per station; optionally distinct tracklets and
    objects, exact or by sketch."""
    if distinct not in (None, "exact", "approx"):
        raise ValueError(distinct)
    aggs = [F.count("*").alias("n_obs"), F.min("obstime").alias("first_obs"),
            F.max("obstime").alias("last_obs")]
    if distinct:
        count = F.countDistinct if distinct == "exact" else F.approx_count_distinct
        aggs += [count("trkid").alias("n_tracklets"), count(object_key()).alias("n_objects")]
    return obs.groupBy("stn").agg(*aggs)


#: log2 of a sketch's registers; its relative standard error is 0.8326 / sqrt(4096) or less, and exact while few.
REGISTERS = 12
SKETCH_ERROR = 3 * 0.8326 / 2 ** (REGISTERS / 2)


def daily_sketches(obs: DataFrame) -> DataFrame:
    """Per (station, day): observations, first and last, and mergeable sketches of tracklets and objects.

    A few kilobytes a row at most, so a table of them answers for any window without the observations.
    """
    d = obs.withColumn("_object", object_key())
    return d.groupBy("stn", F.col("obstime").cast("date").alias("obs_date")).agg(
        F.count("*").alias("n_obs"), F.min("obstime").alias("first_obs"), F.max("obstime").alias("last_obs"),
        F.hll_sketch_agg("trkid", REGISTERS).alias("tracklets"), F.hll_sketch_agg("_object", REGISTERS).alias("objects"))


def profile_from_sketches(sketches: DataFrame, *, start=None, end=None) -> DataFrame:
    """The station profile of a window of days, merged from stored sketches; distinct numbers within ``SKETCH_ERROR``."""
    d = sketches
    if start is not None:
        d = d.where(F.col("obs_date") >= F.lit(start).cast("date"))
    if end is not None:
        d = d.where(F.col("obs_date") < F.lit(end).cast("date"))
    return d.groupBy("stn").agg(
        F.sum("n_obs").alias("n_obs"), F.min("first_obs").alias("first_obs"), F.max("last_obs").alias("last_obs"),
        F.hll_sketch_estimate(F.hll_union_agg("tracklets")).alias("n_tracklets"),
        F.hll_sketch_estimate(F.hll_union_agg("objects")).alias("n_objects"))


def neo_flag_join(obs: DataFrame, neo_obs: DataFrame, *, id: str = "id") -> DataFrame:
    """Add ``is_neo``: the row is in the near-Earth subset."""
    flag = neo_obs.select(id).withColumn("_neo", F.lit(True))
    return obs.join(flag, id, "left").withColumn(
        "is_neo", F.col("_neo").isNotNull()).drop("_neo")


def station_report(obs: DataFrame, neo_obs: DataFrame, orbits: DataFrame, *, site: str,
                   start=None, end=None) -> DataFrame:
    """A station's observations by year, near-Earth flag and orbit class."""
    o = date_window(obs.where(F.col("stn") == site), time="obstime", start=start, end=end)
    o = neo_flag_join(o.select("id", "provid", "trkid", "disc", year_of("obstime").alias("obs_year")),
                      neo_obs.where(F.col("stn") == site))
    label = orbits.select(F.col(UNPACKED).alias("provid"),
                          orbit.orbit_label(orbit.classify_orbit("q", "e", "i")).alias("_class"))
    d = o.join(label, "provid", "left")
    star = F.col("disc") == "*"
    return d.groupBy("obs_year", "is_neo",
                     F.coalesce("_class", F.lit("Unclassified")).alias("orbit_class")).agg(
        F.count("*").alias("obs_count"), F.countDistinct("trkid").alias("tracklet_count"),
        F.countDistinct("provid").alias("object_count"), count_if(star).alias("discovery_obs"),
        F.countDistinct(F.when(star, F.col("provid"))).alias("discovery_objects"))


def summarize_report(report: DataFrame, *, by_neo: bool = False) -> DataFrame:
    """Headline totals of a report; the distinct counts add up bucket counts."""
    grouped = report.groupBy("is_neo") if by_neo else report.groupBy()
    return grouped.agg(
        F.sum("obs_count").alias("obs_count"), F.sum("tracklet_count").alias("tracklet_count_approx"),
        F.sum("object_count").alias("object_count_approx"),
        F.sum("discovery_obs").alias("discovery_obs"),
        F.sum("discovery_objects").alias("discovery_objects_approx"),
        F.min("obs_year").alias("year_min"), F.max("obs_year").alias("year_max"))


def site_mag_stats(obs: DataFrame) -> DataFrame:
    """Depth per station in V: count, mean, spread, median, upper percentiles, faintest, and
    two depths: one standard deviation above the mean and a robust one above the median,
    1.4826 times the median absolute deviation.
    """
    d = obs.select("stn", photometry.to_v("mag", "band").alias("_v")).where(F.col("_v").isNotNull())
    main = d.groupBy("stn").agg(F.count("*").alias("n_mag"), F.avg("_v").alias("mean_v"),
                                F.stddev("_v").alias("sigma_v"), F.max("_v").alias("faintest_v"))
    out = with_percentiles(main, d, keys=["stn"], wanted={
        "median_v": ("_v", 0.5), "p90_v": ("_v", 0.9), "p95_v": ("_v", 0.95)})
    off = d.join(out.select(F.col("stn").alias("_stn"), "median_v"), F.col("stn").eqNullSafe(F.col("_stn"))).select(
        "stn", F.abs(F.col("_v") - F.col("median_v")).alias("_off"))
    out = with_percentiles(out, off, keys=["stn"], wanted={"mad_v": ("_off", 0.5)})
    return out.withColumns({"depth_sigma_v": F.col("mean_v") + F.col("sigma_v"),
                            "depth_mad_v": F.col("median_v") + F.lit(1.4826) * F.col("mad_v")})


def top_stations(disc: DataFrame, *, n: int = 20) -> DataFrame:
    """Stations with most discoveries, split by size class."""
    size = orbit.size_class("h")
    return disc.groupBy("station_code").agg(
        F.count("*").alias("neos"), count_if(size == "1km").alias("n_1km"),
        count_if(size == "140m").alias("n_140m"), count_if(size == "small").alias("n_small"),
    ).orderBy(F.desc("neos"), "station_code").limit(n)


def station_year_coverage(obs: DataFrame, *, since: str, permids: list[str] | None = None) -> DataFrame:
    d = obs.where(F.col("obstime") > F.lit(since).cast("timestamp_ntz")).where(
        F.col("permid").isNotNull())
    if permids is not None:
        d = d.where(F.col("permid").isin(*permids))
    return d.groupBy("permid", "stn").agg(
        F.count("*").alias("n_obs"), F.min("obstime").cast("date").alias("first_obs"),
        F.max("obstime").cast("date").alias("last_obs"))


def reference_by_year(disc: DataFrame) -> DataFrame:
    """Per year of discovery: rows by kind of current and of previous reference."""
    now, before = ref_class("ref"), ref_class("prev_ref")
    return disc.where(F.col("disc") == "*").groupBy(year_of("obstime").alias("disc_year")).agg(
        F.count("*").alias("n_rows"),
        *[count_if(now == k).alias(f"ref_{k.lower()}") for k in ("MPEC", "MPS", "other", "none")],
        count_if(before != "none").alias("with_prev_ref"),
        *[count_if(before == k).alias(f"prev_{k.lower()}") for k in ("MPEC", "MPS", "other")])


def null_flag_summary(obs: DataFrame, *, column: str = "trksub") -> DataFrame:
    """How many discovery observations lack a tracklet label."""
    missing = F.col(column).isNull()
    return obs.where(F.col("disc") == "*").agg(
        F.count("*").alias("total_disc_obs"), count_if(missing).alias("null_trksub"),
        count_if(~missing).alias("has_trksub")).withColumn(
        "pct_null", F.round(F.lit(100.0) * F.col("null_trksub") / F.col("total_disc_obs"), 1))


def keying_summary(obs: DataFrame) -> DataFrame:
    """How observations are keyed: by number, by designation only, distinct of each."""
    perm = F.col("permid").isNotNull() & (F.col("permid") != "")
    prov = F.col("provid").isNotNull() & (F.col("provid") != "")
    return obs.agg(
        F.count("*").alias("total"), count_if(perm).alias("with_permid"),
        count_if(~F.coalesce(perm, F.lit(False)) & prov).alias("only_provid"),
        F.countDistinct(F.when(perm, F.col("permid"))).alias("distinct_permids"),
        F.countDistinct(F.when(prov, F.col("provid"))).alias("distinct_provids"))


def astrometric_quality(obs: DataFrame) -> DataFrame:
    """Per station and year: median residuals, and how they go with seeing and exposure."""
    keys = ["stn", "obs_year"]
    d = obs.withColumn("obs_year", year_of("obstime"))
    rest = d.groupBy(*keys).agg(
        F.count("*").alias("n_obs"),
        F.round(F.corr("rmsfit", "seeing"), 4).alias("corr_seeing"),
        F.round(F.corr("rmsfit", "exp"), 4).alias("corr_exp"))
    return with_percentiles(rest, d, keys=keys, wanted={f"median_{m}": (m, 0.5) for m in ("rmsra", "rmsdec", "rmsfit")})


def circular_stats(circulars: DataFrame, *, year: int) -> DataFrame:
    """Circulars per station, issue year and kind. Input columns: title, pre_text.

    A circular counts once for every station that observes in it.
    """
    lines = F.filter(F.split(F.coalesce("_s.observations", F.lit("")), "\n"),
                     lambda x: F.length(x) >= 80)
    d = circular.with_sections(circulars, "pre_text", "_s").select(
        circular.circular_type("title", "pre_text", year).alias("type"),
        F.regexp_extract("pre_text", r"Issued\s+(\d{4})", 1).try_cast("int").alias("year"),
        F.explode(F.array_distinct(F.transform(
            lines, lambda x: F.trim(F.substring(x, 78, 3))))).alias("stn"))
    return d.groupBy("stn", "year", "type").agg(F.count("*").alias("n"))


def project_of(stn, projects: DataFrame | None = None) -> Column:
    """Survey project of a station code from the fixed map; others are 'Others'."""
    from asterion.functions.common import lookup
    from asterion.functions.tables import STATION_PROJECTS
    return lookup(stn, STATION_PROJECTS, "Others")
