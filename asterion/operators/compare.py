"""Comparing lists, tables and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from asterion.functions import orbit
from asterion.functions.common import count_if

from .identity import PACKED


def cross_match_lists(a: DataFrame, b: DataFrame, *, key: str = "designation") -> DataFrame:
    """Two curated lists merged to one row per object.

    ``a`` is keyed by number or designation with h_mpc, a_mpc, e_mpc, q_mpc,
    ``b`` likewise with the ``_jpl`` columns. H prefers the first list, elements
    prefer the second.
    """
    d = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), key, "full")
    in_a, in_b = F.coalesce("_a", F.lit(False)), F.coalesce("_b", F.lit(False))
    best = {c: F.coalesce(f"{c}_jpl", f"{c}_mpc") for c in ("a", "e", "q")}
    return d.select(
        F.col(key).alias("designation"),
        F.when(F.col(key).rlike("^[0-9]+$"), F.col(key)).alias("number"),
        in_a.alias("in_mpc"), in_b.alias("in_jpl"),
        F.when(in_a & in_b, F.lit("both")).when(in_a, F.lit("mpc")).otherwise(F.lit("jpl")).alias("source"),
        F.coalesce("h_mpc", "h_jpl").alias("h_best"),
        orbit.neo_class(best["a"], best["e"], best["q"]).alias("orbit_class"),
        F.round(F.abs(F.col("h_mpc") - F.col("h_jpl")), 6).alias("h_diff"),
        F.round(F.abs(F.col("q_mpc") - F.col("q_jpl")), 6).alias("q_diff"))


def cross_match_summary(merged: DataFrame) -> DataFrame:
    return merged.agg(F.count("*").alias("n"), count_if(F.col("source") == "both").alias("n_both"),
                      count_if(F.col("source") == "mpc").alias("n_mpc_only"),
                      count_if(F.col("source") == "jpl").alias("n_jpl_only"),
                      count_if(F.col("h_diff") > 0.5).alias("n_h_differs"),
                      F.count("h_diff").alias("n_both_h"))


def match_catalog(neo_list: DataFrame, orbits: DataFrame, ni: DataFrame):
    """(matched, list_only, catalog_only) of a list against the orbit catalogue.

    Numbered entries go through the numbered list, others by packed designation.
    List columns: packed_desig, is_numbered, number, h_list.
    """
    names = ni.select(F.col("permid").alias("number"), F.col(PACKED).alias("match_key"))
    numbered = F.coalesce(F.col("is_numbered"), F.lit(False))
    unnamed = neo_list.where(numbered & F.col("number").isNull()).withColumn("match_key", F.lit(None).cast("string"))
    columns = [*neo_list.columns, "match_key"]
    keyed = (neo_list.where(numbered & F.col("number").isNotNull()).join(names, "number", "left").select(*columns)
             .unionByName(neo_list.where(~numbered).withColumn("match_key", F.col("packed_desig")))
             .unionByName(unnamed))
    cat = orbits.withColumnRenamed(PACKED, "match_key")
    has, own = F.col("match_key").isNotNull(), cat.where(F.col("match_key").isNotNull())
    # Entries and orbits without a key match nothing; they do not go through the joins.
    matched = keyed.where(has).join(own, "match_key")
    list_only = keyed.where(has).join(own.select("match_key"), "match_key", "left_anti").select(*columns).unionByName(keyed.where(~has))
    catalog_only = own.join(keyed.where(has).select("match_key"), "match_key", "left_anti").select(*cat.columns).unionByName(
        cat.where(F.col("match_key").isNull()))
    return matched, list_only, catalog_only


def self_join_count(df: DataFrame, *, key: str, probe) -> DataFrame:
    """Rows of a self equi join, from counts per key instead of the pairs."""
    n = df.groupBy(key).agg(F.count("*").alias("_all"), count_if(probe).alias("_probe"))
    return n.where(F.col(key).isNotNull()).agg(
        F.coalesce(F.sum(F.col("_all") * F.col("_probe")), F.lit(0)).alias("n"))


def group_mean_lookup(df: DataFrame, *, key: str, value: str, probe) -> DataFrame:
    """Mean over probe rows of their key's mean value, from one aggregation."""
    g = df.groupBy(key).agg(F.avg(value).alias("_mean"), count_if(probe).alias("_probe"))
    return g.where(F.col("_mean").isNotNull()).agg(F.round(
        F.sum(F.col("_mean") * F.col("_probe")) / F.sum("_probe"), 6).alias("mean_of_means"))


def table_schema(df: DataFrame, name: str) -> DataFrame:
    """(table_name, position, column_name, data_type) of a table."""
    rows = [(name, i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, is_nullable boolean")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [d.agg(F.count("*").alias("n")).select(F.lit(k).alias("table_name"), "n")
             for k, d in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def boundary_values(df: DataFrame, *, name: str, columns: list[str]) -> DataFrame:
    """(label, value) of the smallest and largest value of each column, one pass."""
    one = df.agg(*[f(c).cast("string").alias(f"{p}_{c}") for c in columns
                   for p, f in (("min", F.min), ("max", F.max))])
    rows = F.array(*[F.struct(F.lit(f"{name}.{p}_{c}").alias("label"), F.col(f"{p}_{c}").alias("value"))
                     for c in columns for p in ("min", "max")])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def element_delta(a: DataFrame, b: DataFrame, *, key: str, thresholds: dict[str, tuple[float, float]]) -> DataFrame:
    """Element by element difference of two orbit sets, graded near, moderate, far.

    ``thresholds`` gives each element its two limits.
    """
    d = a.select(key, *[F.col(c).alias(f"_a_{c}") for c in thresholds]).join(
        b.select(key, *[F.col(c).alias(f"_b_{c}") for c in thresholds]), key)
    rows = F.array(*[F.struct(
        F.lit(c).alias("element"), F.col(f"_a_{c}").alias("value_a"), F.col(f"_b_{c}").alias("value_b"),
        (F.col(f"_b_{c}") - F.col(f"_a_{c}")).alias("delta"), F.lit(lo).alias("_lo"),
        F.lit(hi).alias("_hi")) for c, (lo, hi) in thresholds.items()])
    out = d.select(key, F.explode(rows).alias("r")).select(key, "r.*")
    gap = F.abs("delta")
    return out.withColumn("grade", F.when(gap < F.col("_lo"), F.lit("near"))
                          .when(gap < F.col("_hi"), F.lit("moderate"))
                          .when(gap.isNotNull(), F.lit("far"))).drop("_lo", "_hi")
