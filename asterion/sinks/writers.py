"""Results to files, written in parallel and in order where the format has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from asterion.functions import designation as D, formats, obs80, tables as T
from asterion.functions.common import with_isolated
from asterion.operators.discovery import designation_order
from asterion.operators.identity import alias_link_lines


def write_product_csv(product: DataFrame, path: str) -> None:
    """The discovery product as CSV with header, numbered objects first."""
    designation_order(product).write.mode("overwrite").option("header", True).csv(path)


def write_ades_xml(df: DataFrame, path: str, *, fields: dict | None = None, order: str = "obsTime") -> None:
    """An ADES document of ``<optical>`` elements, NULL children left out.

    Each part file is a document of its own; ``fields`` maps element names to columns.
    """
    fields = fields or {f: f for f in T.ADES_OPTICAL_EXPORT if f in df.columns}
    d = df.orderBy(order) if order in df.columns else df
    d.select(formats.optical_struct(fields).alias("o")).select("o.*").write.mode("overwrite") \
        .format("xml").option("rowTag", "optical").option("rootTag", f'ades version="{T.ADES_VERSION}"') \
        .option("declaration", 'version="1.0" encoding="UTF-8"').save(path)


def optical_rows(obs: DataFrame) -> DataFrame:
    """Catalogue observations as one ``<optical>`` element each, in the full field order."""
    names = {f.lower(): f for f in T.ADES_OPTICAL_ROW}
    fields = {names[c.lower()]: F.col(c) for c in obs.columns if c.lower() in names}
    if "obsTime" in fields:
        fields["obsTime"] = formats.iso_micros(fields["obsTime"])
    struct = F.struct(*[fields[f].cast("string").alias(f) for f in T.ADES_OPTICAL_ROW if f in fields])
    xml = F.regexp_replace(F.to_xml(struct, {"rowTag": "optical"}), r"\n\s*", "")
    return obs.select("id", "obstime", xml.alias("xml"))


def write_psv(df: DataFrame, path: str, *, fields: dict, order: str) -> None:
    """Pipe-separated records after version and header lines, sorted by ``order``."""
    head = df.sparkSession.createDataFrame(
        [(0, f"# version={T.ADES_VERSION}"), (1, ""), (2, formats.psv_header())], "_k int, value string")
    head = head.select("_k", F.lit(None).cast("string").alias("_o"), "value")
    body = df.select(F.lit(3).alias("_k"), F.col(order).cast("string").alias("_o"),
                     formats.psv_line(fields).alias("value"))
    head.unionByName(body).orderBy("_k", "_o").select("value").write.mode("overwrite").text(path)


def obs80_lines(df: DataFrame) -> DataFrame:
    """Lines with uncertainties in file order. The trailing newline is the file's."""
    line = obs80.splice_uncertainty("obs80", "rmsra", "rmsdec")
    return df.orderBy(*obs80.line_order("obs80")).select(
        F.regexp_replace(line, "\\n$", "").alias("value"))


def write_obs80(df: DataFrame, path: str) -> None:
    obs80_lines(df).write.mode("overwrite").text(path)


def export_obs80(obs: DataFrame, keys: DataFrame) -> DataFrame:
    """Exportable lines of the listed objects: published, of good quality, distinct.

    ``keys`` holds (key, kind); each observation is taken once however many keys hit.
    """
    from asterion.operators.filters import published_active, quality_gate
    from asterion.operators.identity import semi_join_keys
    return quality_gate(semi_join_keys(published_active(obs), keys))


def write_alias_links(lists: DataFrame, path: str, *, kind: str) -> None:
    """One line of aliases per primary."""
    d = alias_link_lines(lists).where(F.col("kind") == kind)
    key = F.col("primary_key") if kind == "numbered" else F.col("primary_key").desc()
    d.orderBy(key).select(F.col("links").alias("value")).write.mode("overwrite").text(path)


def subset_source_lines(lines: DataFrame, keys: DataFrame, *, col: str = "value") -> DataFrame:
    """The original list lines of a set of objects.

    ``keys`` holds primary_desig and permid; a line is found by its unpacked
    designation, a numbered one by its number.
    """
    name = D.unpack_designation(F.rtrim(F.substring(col, 1, 7)))
    wanted = keys.select(F.explode(F.array("primary_desig", "permid")).alias("_name")).where(
        F.col("_name").isNotNull()).distinct()
    return with_isolated(lines, {"_name": name}).join(wanted, "_name", "left_semi").select(col)


def count_skipped(lines: DataFrame, keys: DataFrame, *, col: str = "value") -> DataFrame:
    """How many objects have no line in the list."""
    name = D.unpack_designation(F.rtrim(F.substring(col, 1, 7)))
    held = with_isolated(lines, {"_name": name}).select("_name").distinct().withColumn(
        "_held", F.lit(True))
    by_name = keys.join(held.withColumnRenamed("_name", "primary_desig"), "primary_desig", "left")
    both = by_name.join(held.select(F.col("_name").alias("permid"), F.col("_held").alias("_num")), "permid", "left")
    found = F.col("_held").isNotNull() | F.col("_num").isNotNull()
    return both.agg(F.count("*").alias("n"), F.count(F.when(~found, 1)).alias("n_skipped"))
