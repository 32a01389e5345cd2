"""Who else saw an object around its discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from asterion.functions.common import count_if, share
from asterion.functions.timeconv import day_of, days_between, seconds_between

from .filters import select_neos
from .identity import earliest_discovery, observation_keys, with_numbering
from .quantiles import with_percentiles
from .stations import project_of


def discoveries(orbits: DataFrame, ni: DataFrame, obs: DataFrame, *, rule: str = "iau") -> DataFrame:
    """One discovery per object of a rule, with the object's two identifiers."""
    neos = with_numbering(select_neos(orbits, rule=rule), ni).withColumn(
        "provid_key", F.coalesce("provisional_desig", "num_provid"))
    return earliest_discovery(neos, obs, carry=["permid", "provid_key"])


def apparition_rows(disc: DataFrame, obs: DataFrame, *, days: int, columns: list[str]) -> DataFrame:
    """Observations within the window around discovery, each once per object.

    An observation may match by both of its identifiers: the designation branch
    drops rows whose number is the object's own.
    """
    head = ["unpacked_desig", F.col("obstime").alias("disc_obstime"), F.col("stn").alias("disc_stn"),
            F.col("permid").alias("_number")]
    pairs = F.array(F.struct(F.lit("permid").alias("kind"), F.col("permid").alias("key")),
                    F.struct(F.lit("provid").alias("kind"), F.col("provid_key").alias("key")))
    keys = disc.select(*head, F.explode(pairs).alias("_k")).select(
        "unpacked_desig", "disc_obstime", "disc_stn", "_number", "_k.kind", "_k.key").where(
        F.col("key").isNotNull())
    rows = observation_keys(obs.withColumn("_own", F.col("permid")), "_own", *columns)
    again = (F.col("kind") == "provid") & F.coalesce(F.col("_own") == F.col("_number"), F.lit(False))
    gap = F.abs(seconds_between("disc_obstime", "obstime"))
    return keys.join(rows, ["kind", "key"]).where(~again & (gap <= days * 86400))


def apparition_reach(disc: DataFrame, obs: DataFrame, *, days: int = 200) -> DataFrame:
    """Per (object, station): first observation, and first at or after discovery.

    ``disc`` comes from :func:`discoveries`; its station passes through.
    """
    rows = apparition_rows(disc, obs, days=days, columns=["stn", "obstime"])
    return rows.groupBy(F.col("unpacked_desig").alias("designation"),
                        F.col("stn").alias("station_code"), "disc_obstime", "disc_stn").agg(
        F.min("obstime").alias("first_obs"),
        F.min(F.when(F.col("obstime") >= F.col("disc_obstime"), F.col("obstime")))
        .alias("first_post_disc"))


def apparition_tracklets(disc: DataFrame, obs: DataFrame, *, days: int = 200) -> DataFrame:
    """Tracklets of each object's discovery apparition, by trkid or station-night."""
    rows = apparition_rows(disc, obs, days=days, columns=["stn", "obstime", "trkid"])
    trk = F.nullif("trkid", F.lit(""))
    rows = rows.withColumns({
        "_trk": trk, "_night": F.when(trk.isNull(), F.concat_ws(
            "|", "stn", day_of("obstime").cast("string")))})
    d = rows.groupBy("unpacked_desig", "_trk", "_night", "disc_obstime", "disc_stn").agg(
        F.min("stn").alias("station_code"), F.min("obstime").alias("first_obs"),
        F.max("obstime").alias("last_obs"), F.count("*").alias("nobs"))
    return d.select(F.col("unpacked_desig").alias("designation"), F.col("_trk").alias("trkid"),
                    "station_code", project_of("station_code").alias("project"), "first_obs",
                    "last_obs", "nobs", "disc_obstime", "disc_stn",
                    F.round(days_between("disc_obstime", "first_obs"), 6).alias("days_from_disc"))


def tracklet_summaries(obs: DataFrame) -> DataFrame:
    """Tracklets of exchange rows: span, count, median magnitude, references."""
    key = F.coalesce(F.nullif("trkID", F.lit("")), F.col("obsTime"))
    d = obs.withColumn("_k", key)
    part = d.groupBy("_k", F.col("mag").alias("_mag")).agg(
        F.count("*").alias("_n"), F.count("mag").alias("_nm"),
        F.min(F.struct("obsTime", "stn", "band")).alias("_first"), F.max("obsTime").alias("_last"),
        F.collect_set(F.nullif("ref", F.lit(""))).alias("_refs"),
        F.bool_or(F.coalesce(F.col("disc") == "*", F.lit(False))).alias("_disc"))
    return part.groupBy("_k").agg(
        F.min("_first").alias("_f"), F.max("_last").alias("last_obs"), F.sum("_n").alias("n_obs"),
        F.round(F.percentile("_mag", F.lit(0.5), F.col("_nm")), 1).alias("mag_median"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_refs")))).alias("refs"),
        F.bool_or("_disc").alias("is_discovery")).select(
        F.col("_k").alias("trkID"), F.col("_f.stn").alias("stn"),
        project_of("_f.stn").alias("project"), F.col("_f.obsTime").alias("first_obs"), "last_obs",
        "n_obs", "mag_median", F.col("_f.band").alias("band"), "refs", "is_discovery")


def survey_sets(tracklets: DataFrame, *, survey: str = "project", eligible: DataFrame | None = None,
                post_discovery_only: bool = True) -> DataFrame:
    """Distinct (designation, survey) pairs, optionally of eligible objects only."""
    d = tracklets
    if post_discovery_only:
        d = d.where(F.col("days_from_disc") >= 0)
    if eligible is not None:
        d = d.join(eligible.select("designation"), "designation", "left_semi")
    return d.select("designation", F.col(survey).alias("survey")).distinct()


def venn_regions(sets: DataFrame, *, surveys: list[str]) -> DataFrame:
    """Objects in every combination of two or three surveys."""
    flags = [F.bool_or(F.col("survey") == s).alias(f"in_{k + 1}") for k, s in enumerate(surveys)]
    names = [f"in_{k + 1}" for k in range(len(surveys))]
    per = sets.where(F.col("survey").isin(*surveys)).groupBy("designation").agg(*flags)
    return per.groupBy(*names).agg(F.count("*").alias("n"))


def object_bitmaps(sets: DataFrame, *, surveys: list[str] | None = None) -> DataFrame:
    """(block, survey, words): which of a block's ``BLOCK`` objects each survey saw, a bit per object.

    Objects are numbered inside parts of their names' hashes, so that numbering needs no task with all of them.
    """
    d = sets if surveys is None else sets.where(F.col("survey").isin(surveys))
    d = d.where(F.col("designation").isNotNull() & F.col("survey").isNotNull())
    d = d.withColumn("_part", F.pmod(F.xxhash64("designation"), F.lit(PARTS)))
    nth = F.dense_rank().over(Window.partitionBy("_part").orderBy("designation")) - 1
    d = d.withColumn("_n", nth).select(
        "survey", F.struct("_part", F.floor(F.col("_n") / BLOCK).alias("run")).alias("block"), (F.col("_n") % BLOCK).alias("_at"))
    bit = F.expr("shiftleft(1L, CAST(_at % 64 AS INT))")
    words = d.groupBy("block", "survey", F.floor(F.col("_at") / 64).cast("int").alias("_w")).agg(F.bit_or(bit).alias("_b"))
    held = words.groupBy("block", "survey").agg(F.map_from_entries(F.collect_list(F.struct("_w", "_b"))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BLOCK // 64 - 1)), lambda w: F.coalesce(F.try_element_at("_m", w), F.lit(0).cast("bigint")))
    return held.select("block", "survey", dense.alias("words"))


PARTS, BLOCK = 64, 4096


def pairwise_codetection(sets: DataFrame, *, surveys: list[str] | None = None) -> DataFrame:
    """For each ordered pair of surveys, the share of the first's objects the second
    also saw; the diagonal carries totals.

    A block of objects is one row with a bitmap per survey; pairs of surveys are counted by intersecting bitmaps,
    4,096 objects at a time, so pairs are formed per block, never per object or per
    combination of surveys. Surveys may be given; otherwise all are taken.
    """
    blocks = object_bitmaps(sets, surveys=surveys).groupBy("block").agg(F.array_sort(F.collect_list(F.struct("survey", "words"))).alias("_s"))

    def common(a, b):
        both = F.zip_with(a["words"], b["words"], lambda x, y: F.bit_count(x.bitwiseAND(y)).cast("bigint"))
        return F.aggregate(both, F.lit(0).cast("bigint"), lambda n, x: n + x)

    def with_later(a):
        later = F.filter("_s", lambda b: b["survey"] >= a["survey"])
        return F.transform(later, lambda b: F.struct(a["survey"].alias("a"), b["survey"].alias("b"), common(a, b).alias("n")))

    pairs = blocks.select(F.explode(F.flatten(F.transform("_s", with_later))).alias("_p")).select("_p.*")
    n = pairs.groupBy("a", "b").agg(F.sum("n").alias("n_both")).where(F.col("n_both") > 0)
    one = n.select(F.col("a").alias("survey_i"), F.col("b").alias("survey_j"), "n_both")
    other = n.where(F.col("a") != F.col("b")).select(F.col("b").alias("survey_i"), F.col("a").alias("survey_j"), "n_both")
    total = n.where(F.col("a") == F.col("b")).select(F.col("a").alias("survey_i"), F.col("n_both").alias("n_i"))
    return one.unionByName(other).join(total, "survey_i").select(
        "survey_i", "survey_j", "n_both", "n_i", share("n_both", "n_i", 2).alias("pct"))


def survey_reach(sets: DataFrame) -> DataFrame:
    return sets.groupBy("survey").agg(F.count("*").alias("n_objects"))


def multiplicity_summary(sets: DataFrame) -> DataFrame:
    """Objects seen by one, two, three or more surveys; mean and median number."""
    hist = sets.groupBy("designation").agg(F.count("*").alias("_k")).groupBy("_k").agg(
        F.count("*").alias("_n"))
    n = F.sum("_n")
    def of(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0))
    return hist.agg(
        n.alias("n_objects"), of(F.col("_k") == 1).alias("seen_by_1"),
        of(F.col("_k") == 2).alias("seen_by_2"), of(F.col("_k") >= 3).alias("seen_by_3plus"),
        F.round(F.sum(F.col("_k") * F.col("_n")) / n, 4).alias("mean_surveys"),
        F.percentile("_k", F.lit(0.5), F.col("_n")).alias("median_surveys"))


def response_times(reach: DataFrame, *, survey=project_of) -> DataFrame:
    """Days from discovery to the first later observation by each other survey.

    ``survey`` maps a station column to its survey.
    """
    d = reach.where(F.col("first_post_disc").isNotNull()).select(
        "designation", "disc_obstime", survey("disc_stn").alias("disc_project"),
        survey("station_code").alias("project"), "first_post_disc")
    return d.where(F.col("project") != F.col("disc_project")).groupBy(
        "designation", "disc_obstime", "disc_project", "project").agg(
        F.min("first_post_disc").alias("_first")).select(
        "designation", "disc_obstime", "disc_project", "project",
        days_between("disc_obstime", "_first").alias("days"))


def response_summary(responses: DataFrame, *, by: list[str]) -> DataFrame:
    """Distribution of response days, reported at 1e-6 of a day."""
    main = responses.groupBy(*by).agg(F.count("*").alias("n"), F.min("days").alias("min_days"), F.max("days").alias("max_days"))
    out = with_percentiles(main, responses, keys=by, wanted={"p50": ("days", 0.5), "p90": ("days", 0.9)})
    return out.select(*by, "n", *[F.round(c, 6).alias(c) for c in ("p50", "p90", "min_days", "max_days")])


def response_curve(responses: DataFrame, *, horizon: int = 200) -> DataFrame:
    """Per project and whole day: followed-up objects so far, and their share."""
    n = responses.where(F.col("days") <= horizon).groupBy(
        "project", F.floor("days").cast("int").alias("day")).agg(F.count("*").alias("_n"))
    w = Window.partitionBy("project")  # one row per day
    so_far = F.sum("_n").over(w.orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    return n.select("project", "day", so_far.alias("n_so_far"),
                    share(so_far, F.sum("_n").over(w), 2).alias("pct"))


def site_followup_volume(tracklets: DataFrame, *, n: int | None = 20, years=None, metric: str = "tracklets",
                         within_days: float | None = None, precoveries: bool = True, scope: str = "others") -> DataFrame:
    """Stations by follow-up of objects: tracklets, observations and objects, ordered by one of them.

    ``within_days`` keeps what lies that near to the discovery, ``precoveries`` tells whether
    what was seen before it counts, ``scope`` whether objects discovered by ``others`` than the station,
    by itself (``own``), or ``all`` are looked at.
    """
    measures = {"tracklets": "n_tracklets", "observations": "n_observations", "objects": "n_objects"}
    own = F.col("station_code") == F.col("disc_stn")
    scopes = {"others": ~own, "own": own, "all": F.lit(True)}
    if metric not in measures or scope not in scopes:
        raise ValueError(f"metric {metric!r}, scope {scope!r}")
    d = tracklets.where(scopes[scope])
    if years is not None:
        d = d.where(F.year("first_obs").between(*years))
    if within_days is not None:
        d = d.where(F.abs("days_from_disc") <= within_days)
    if not precoveries:
        d = d.where(F.col("days_from_disc") >= 0)
    out = d.groupBy("station_code").agg(
        F.count("*").alias("n_tracklets"), F.sum("nobs").alias("n_observations"), F.countDistinct("designation").alias("n_objects")
    ).orderBy(F.desc(measures[metric]), "station_code")
    return out if n is None else out.limit(n)


def precovery_counts(tracklets: DataFrame) -> DataFrame:
    return tracklets.groupBy("project").agg(
        count_if(F.col("days_from_disc") < 0).alias("precovery"),
        count_if(F.col("days_from_disc") >= 0).alias("follow_up"))
