"""Records of one large JSON document, read by byte ranges.

A document in one line cannot be parsed in parts by itself. But text split at commas can be read
from any byte on, and a piece between two commas says how many quotes and brackets it has. Whether a
piece starts inside a string follows from the quotes before it, and how deep it is nested from
the brackets outside strings; both are running sums. Each range of the file sums up its own pieces,
for either state it may start in, the few range totals are carried from range to range, and
then every piece knows its depth. A record is what opens at a given depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from asterion.functions.common import with_isolated

STRING = r'"(?:[^"\\]++|\\.)*+"'


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, id, value): the text between commas, in the order of (split, id)."""
    return spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), "value")


def with_counts(d: DataFrame) -> DataFrame:
    """Quotes of a piece, and its opening and closing brackets if it starts outside (0) or inside (1) a string."""
    clean = F.regexp_replace("value", r"(?s)\\.", "__")  # escaped characters neither end a string nor count
    d = with_isolated(d, {"_clean": clean})
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, '"[^"]*"', ""), '(?s)".*$', "")
    d = with_isolated(d, {"quotes": F.length("_clean") - F.length(F.translate("_clean", '"', "")), "_b0": bare(F.col("_clean")),
                          "_b1": bare(F.regexp_replace("_clean", '(?s)^[^"]*"?', ""))}, keep=[c for c in d.columns if c != "_clean"])
    many = lambda c, signs: F.length(c) - F.length(F.translate(c, signs, ""))
    return d.select(*[c for c in d.columns if c not in ("_b0", "_b1")], *[
        many(f"_b{s}", signs).alias(f"{name}{s}") for s in (0, 1) for name, signs in (("open", "[{"), ("close", "]}"))])


def nested(spark: SparkSession, path: str) -> DataFrame:
    """Pieces with ``inside`` (starts in a string), ``before`` and ``top`` and ``after``: the depth before, at its deepest, and after a piece."""
    along = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(along), F.lit(0))
    d = with_counts(pieces(spark, path)).withColumn("_r", so_far("quotes") % 2)
    pick = lambda name, if_even: F.when(F.col("_r") == 0, F.col(f"{name}{if_even}")).otherwise(F.col(f"{name}{1 - if_even}"))
    d = d.select("file", "split", "id", "value", "quotes", "_r", *[pick(n, s).alias(f"_{n}{s}") for s in (0, 1) for n in ("open", "close")])
    d = d.withColumns({f"_sum{s}": so_far(F.col(f"_open{s}") - F.col(f"_close{s}")) for s in (0, 1)})
    # One row per range of the file: its quotes, and its change of depth for either state at its start.
    ranges = d.groupBy("file", "split").agg(F.sum("quotes").alias("_q"), *[F.sum(F.col(f"_open{s}") - F.col(f"_close{s}")).alias(f"_d{s}") for s in (0, 1)])
    over = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_state", F.coalesce(F.sum("_q").over(over), F.lit(0)) % 2)
    ranges = ranges.withColumn("_delta", F.when(F.col("_state") == 0, F.col("_d0")).otherwise(F.col("_d1")))
    ranges = ranges.select("file", "split", "_state", F.coalesce(F.sum("_delta").over(over), F.lit(0)).alias("_depth"))
    d = d.join(ranges, ["file", "split"])
    real = lambda name: F.when(F.col("_state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    before = F.col("_depth") + real("_sum")
    return d.select("file", "split", "id", "value", ((F.col("_state") + F.col("_r")) % 2).alias("inside"), "quotes", before.alias("before"),
                    (before + real("_open")).alias("top"), (before + real("_open") - real("_close")).alias("after"))


def json_records(spark: SparkSession, path: str, *, depth: int) -> tuple[DataFrame, DataFrame]:
    """(file, record, text) of what opens inside ``depth`` brackets, with its key if it has one, and (file, text) of
    the document around the records.

    Nothing else may open at that depth. A record may lie across ranges; its pieces meet by its number.
    """
    d = nested(spark, path)
    begins = (F.col("before") <= depth) & (F.col("top") > depth)
    # A key with a comma in it: pieces that end inside a string and belong to the record that opens when the string ends.
    # If the string ends without one (``shut``), it was no key, and what stands before it is left out.
    flat, open_end = F.col("top") <= depth, (F.col("inside") + F.col("quotes")) % 2 == 1
    shut = flat & (F.col("inside") == 1) & ~open_end
    d = d.withColumns({"_begins": begins, "_key": (flat & open_end & (F.col("after") == depth)) | shut, "_shut": shut})
    along = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    over = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ranges = d.groupBy("file", "split").agg(F.sum(F.col("_begins").cast("bigint")).alias("_n"))
    ranges = ranges.select("file", "split", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_base"))
    d = d.withColumn("_nth", F.sum(F.col("_begins").cast("bigint")).over(along)).join(ranges, ["file", "split"])
    d = d.withColumn("record", F.col("_base") + F.col("_nth") + F.col("_key").cast("int"))
    mine = d.where((F.col("top") > depth) | F.col("_key")).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("split", "id", "value", "before", "top", "after", "_shut"))).alias("_p"))
    mine = mine.where(F.exists("_p", lambda x: x["top"] > depth))
    last_shut = F.array_max(F.transform("_p", lambda x, i: F.when(x["_shut"], i + 1).otherwise(0)))
    mine = mine.withColumn("_p", F.slice("_p", last_shut + 1, F.size("_p")))
    mine = mine.select("file", "record", joined("_p").alias("_text"), (F.lit(depth) - F.col("_p")[0]["before"]).alias("_outer"),
                       (F.lit(depth) - F.element_at("_p", -1)["after"]).alias("_closed"))
    opening = F.concat(F.lit(r'(?s)^(?:[^"\[{]*+(?:' + STRING + r'[^"\[{]*+)*+[\[{]){'), F.greatest("_outer", F.lit(0)), F.lit("}"))
    closing = F.concat(F.lit(r"(?:\s*[\]}]\s*){"), F.greatest("_closed", F.lit(0)), F.lit("}$"))
    records = mine.select("file", "record", F.trim(F.regexp_replace(F.regexp_replace("_text", opening, F.lit("")), closing, F.lit(""))).alias("text"))
    around = d.where(((F.col("top") <= depth) & ~F.col("_key")) | (F.col("_begins") & (F.col("record") == 1)))
    head = around.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("split", "id", "value"))).alias("_p"))
    return records, head.select("file", joined("_p").alias("text"))


def joined(parts: str) -> Column:
    return F.array_join(F.transform(parts, lambda x: x["value"]), ",")
