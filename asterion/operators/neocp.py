"""Candidates on the confirmation page."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from asterion.functions import obs80
from asterion.functions.common import blank_to_null, with_isolated
from asterion.functions.timeconv import seconds_between

from .identity import UNPACKED
from .factorised import SIZE, blocks, shared
from .quantiles import with_percentiles


def ades_export_rows(neocp: DataFrame) -> DataFrame:
    """Candidate observations decoded to exchange columns."""
    p = obs80.with_obs80(neocp, "obs80")
    return p.select(
        F.col("desig").alias("trkSub"), "mode", "stn", F.col("obs_time").alias("obsTime"),
        F.col("ra_deg").alias("ra"), F.col("dec_deg").alias("dec"), F.col("ast_cat").alias("astCat"),
        "disc", "prog", "notes", "mag", "band", F.col("rmsra").alias("rmsRA"),
        F.col("rmsdec").alias("rmsDec"), F.col("rmscorr").alias("rmsCorr"),
        F.col("rmstime").alias("rmsTime"), "trkid", F.col("created_at").alias("db_created"))


def add_uncertainties(lines: DataFrame, neocp: DataFrame) -> DataFrame:
    """Submitted lines with the catalogue's uncertainties spliced in.

    Lines match on designation, mode to position, and station.
    """
    def parts(d):
        return d.withColumns({"_k1": F.substring("obs80", 1, 12), "_k2": F.substring("obs80", 15, 42),
                              "_k3": F.substring("obs80", 78, 3)})
    d = parts(neocp).join(parts(lines).select("_k1", "_k2", "_k3"), ["_k1", "_k2", "_k3"])
    return d.select(obs80.splice_uncertainty("obs80", "rmsra", "rmsdec").alias("obs80"))


def lifecycle_sides(prev_des: DataFrame, archive: DataFrame, events: DataFrame, *, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """Everything recorded for each candidate, without pairs: its observations and its events as ordered blocks.

    ``factorised.expand`` of both gives what :func:`lifecycle` gives, without the candidate's own columns.
    """
    seen = blocks(archive, key="desig", time="created_at", order=["obs80", "rmsra", "rmsdec"], columns=["obs80", "rmsra", "rmsdec"], side="observations", size=size)
    done = blocks(events, key="desig", time="created_at", order=["event_type", "event_text", "event_user"],
                  columns=["event_type", "event_text", "event_user"], side="events", size=size)
    known = prev_des.where(F.col("desig").isNotNull()).select("desig").distinct()
    return shared(seen.join(known, "desig", "left_semi"), done, key="desig")


def bridge_sides(archive: DataFrame, obs: DataFrame, *, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """Candidate and published observations of each tracklet as ordered blocks, the factors of :func:`tracklet_bridge`."""
    a = blocks(archive.where(blank_to_null("trkid").isNotNull()).select("desig", "trkid", F.col("obs80").alias("neocp_obs80"), F.col("created_at").alias("neocp_time")),
               key="trkid", time="neocp_time", order=["neocp_obs80", "desig"], columns=["desig", "neocp_obs80", "neocp_time"], side="candidates", size=size)
    b = blocks(obs.where(blank_to_null("trkid").isNotNull()).select("trkid", "obsid", F.col("created_at").alias("sbn_time")),
               key="trkid", time="sbn_time", order=["obsid"], columns=["obsid", "sbn_time"], side="published", size=size)
    return shared(a, b, key="trkid")


def lifecycle(prev_des: DataFrame, archive: DataFrame, events: DataFrame) -> DataFrame:
    """Everything recorded for a candidate: observation by event."""
    return (prev_des.select("desig", "iau_desig", "status")
            .join(archive.select("desig", "obs80", "rmsra", "rmsdec"), "desig")
            .join(events.select("desig", "event_type", "event_text", "event_user"), "desig"))


def candidate_orbits(prev_des: DataFrame, orbits: DataFrame) -> DataFrame:
    named = prev_des.where(blank_to_null("iau_desig").isNotNull()).select(
        F.col("desig").alias("neocp_desig"), "iau_desig")
    return named.join(orbits.select(F.col(UNPACKED).alias("iau_desig"), "q", "e", "i",
                                    "orbit_type_int"), "iau_desig")


def tracklet_bridge(archive: DataFrame, obs: DataFrame) -> DataFrame:
    """Candidate observations next to the published ones of the same tracklet."""
    a = archive.where(blank_to_null("trkid").isNotNull()).select(
        "desig", "trkid", F.col("obs80").alias("neocp_obs80"), F.col("created_at").alias("neocp_time"))
    return a.join(obs.select("trkid", "obsid", F.col("created_at").alias("sbn_time")), "trkid")


def outcomes(prev_des: DataFrame) -> DataFrame:
    outcome = (F.when(blank_to_null("iau_desig").isNotNull(), F.lit("designated"))
               .when(F.col("status") == "lost", F.lit("lost"))
               .when(F.col("status") == "dne", F.lit("does not exist"))
               .otherwise(F.concat(F.lit("other ("), F.coalesce("status", F.lit("null")), F.lit(")"))))
    return prev_des.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def throughput(archive: DataFrame, *, n: int = 20) -> DataFrame:
    return archive.groupBy(F.substring("obs80", 78, 3).alias("stn")).agg(
        F.count("*").alias("nobs"), F.countDistinct("desig").alias("n_objects")).orderBy(
        F.desc("nobs"), "stn").limit(n)


def object_counts(archive: DataFrame, *, n: int = 20) -> DataFrame:
    return archive.groupBy("desig").agg(
        F.count("*").alias("nobs"), F.min("created_at").alias("first_seen"),
        F.max("created_at").alias("last_seen")).orderBy(F.desc("nobs"), "desig").limit(n)


def time_on_page(prev_des: DataFrame, events: DataFrame) -> DataFrame:
    """First posting to first removal of each designated object, in one pass."""
    def first(kind):
        return F.min(F.when(F.col("event_type") == kind, F.col("created_at")))
    ev = events.groupBy("desig").agg(first("ADDOBJ").alias("posted"), first("REMOBJ").alias("removed"))
    named = prev_des.where(blank_to_null("iau_desig").isNotNull()).select("desig", "iau_desig")
    return named.join(ev, "desig").where(
        F.col("posted").isNotNull() & F.col("removed").isNotNull()).withColumn(
        "duration_s", seconds_between("posted", "removed").cast("double"))


def ingest_latency(archive: DataFrame) -> DataFrame:
    """Minutes from observation to ingestion: extremes and upper percentiles."""
    d = with_isolated(archive.select("obs80", "created_at"), {"t": obs80.observed_at("obs80")})
    d = d.select((seconds_between("t", "created_at").cast("double") / 60.0).alias("m")).where(
        F.col("m").isNotNull())
    main = d.agg(F.count("*").alias("n"), F.min("m").alias("min_m"), F.max("m").alias("max_m"))
    out = with_percentiles(main, d, wanted={"p50": ("m", 0.5), "p90": ("m", 0.9), "p95": ("m", 0.95)})
    return out.select("n", *[F.round(c, 4).alias(c) for c in ("min_m", "p50", "p90", "p95", "max_m")])


def event_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", "event_user").agg(F.count("*").alias("n"))
