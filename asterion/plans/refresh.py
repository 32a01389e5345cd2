"""Refreshing the membership table from the institutions' lists, and the object list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from asterion.operators import compare, consensus, identity, summary
from asterion.operators.identity import PACKED, UNPACKED

DETAILS = ["nf_q", "nf_neo_prob", "nf_u"]


def canonical_rows(raw: DataFrame, ni: DataFrame, orbits: DataFrame) -> DataFrame:
    """Canonical membership rows of a list with a ``raw`` column, details passing through."""
    d = identity.canonicalize(raw, ni, orbits, raw="raw")
    for c in DETAILS:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("float"))
    return d.select("primary_desig", "packed_desig", "permid", "raw_string", "desig_parsed",
                    "orbit_in_mpc", "is_comet", *DETAILS)


def catalog_rows(orbits: DataFrame, ni: DataFrame) -> DataFrame:
    """The orbit catalogue itself as a source: elliptic near-Earth asteroids."""
    from asterion.operators.filters import select_neos
    d = select_neos(orbits, rule="asteroid").join(ni.select(PACKED, "permid"), PACKED, "left")
    return d.select(F.col(UNPACKED).alias("primary_desig"), F.col(PACKED).alias("packed_desig"), "permid",
                    F.col(UNPACKED).alias("raw_string"), F.lit(True).alias("desig_parsed"),
                    F.lit(True).alias("orbit_in_mpc"), F.lit(False).alias("is_comet"),
                    *[F.lit(None).cast("float").alias(c) for c in DETAILS])


def refresh_source(members: DataFrame, raw: DataFrame, ni: DataFrame, orbits: DataFrame, *,
                   source: str, now) -> DataFrame:
    """The member table after one list was read."""
    return consensus.membership_upsert(members, canonical_rows(raw, ni, orbits), source=source, now=now)


def unresolved(raw: DataFrame, ni: DataFrame, orbits: DataFrame) -> DataFrame:
    """List entries that name nothing known."""
    good = identity.canonicalize(raw, ni, orbits, raw="raw").select(F.col("raw_string").alias("raw"))
    return raw.join(good.distinct(), "raw", "left_anti")


def consensus_view(members: DataFrame, obs: DataFrame, *, sources: list[str]) -> DataFrame:
    """Presence per source next to each object's observation summary."""
    wide = consensus.membership_wide(members, sources=sources)
    return wide.join(summary.obs_summary(wide, obs), "primary_desig", "left")


def neo_list(list_a: DataFrame, list_b: DataFrame) -> DataFrame:
    """One object list out of two curated ones.

    ``list_a`` has the columns of :func:`sources.readers.parse_mpcorb`, ``list_b``
    of :func:`sources.readers.parse_sbdb_json`. Numbered objects meet by number.
    """
    a = list_a.select(F.coalesce("number", "unpacked_desig").alias("designation"),
                      *[F.col(c).alias(f"{c}_mpc") for c in ("h", "a", "e", "q")])
    b = list_b.select(F.col("pdes").alias("designation"), F.col("H").alias("h_jpl"),
                      *[F.col(c).alias(f"{c}_jpl") for c in ("a", "e", "q")])
    return compare.cross_match_lists(a, b)
