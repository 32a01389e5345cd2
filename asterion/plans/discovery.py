"""The discovery product as a job over tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from asterion import storage
from asterion.operators import discovery, identity, summary
from asterion.operators.filters import select_neos


def run_discovery_product(orbits: DataFrame, ni: DataFrame, obs: DataFrame, obscodes: DataFrame, path: str, *,
                          rule: str = "wide", hours: float = 12.0, min_rows: int = 1) -> DataFrame:
    """Write a version of the product and return it; refuses a product that is too small.

    Two passes over the observations. The first finds the discoveries, one row per
    object, and settles them: with their size known, the second pass, which collects
    the tracklets, need not shuffle the observations when the discoveries fit a
    broadcast, and still works as a shuffle join when they do not.
    """
    neos = identity.with_numbering(select_neos(orbits, rule=rule), ni)
    disc = storage.settle(identity.earliest_discovery(neos, obs, carry=["permid"]), "discoveries")
    product = discovery.product_columns(discovery.stats_of(disc, obs, hours=hours, carry=["permid"]), obscodes)
    product = storage.settle(product, "product")
    check = summary.product_check(product, min_rows=min_rows, n_columns=12).first()
    if not check.ok:
        raise ValueError(f"product has {check.n_rows} rows and {check.n_columns} columns")
    return storage.write_snapshot(product, path)


def near_earth_subset(obs: DataFrame, orbits: DataFrame, ni: DataFrame, ci: DataFrame, path: str, *,
                      max_age_seconds: float | None = None) -> DataFrame:
    """The observations of near-Earth objects under any name, kept as a table.

    Everything that only concerns near-Earth objects reads this in place of the full
    table; it is written by year so that date ranges skip files.
    """
    from pyspark.sql import functions as F
    keys = storage.settle(identity.alias_keys(orbits, ci, ni), "near_earth_keys")
    d = identity.semi_join_keys(obs, keys).withColumn("obs_year", F.year("obstime"))
    return storage.write_snapshot(d, path, max_age_seconds=max_age_seconds, partition_by=["obs_year"])
