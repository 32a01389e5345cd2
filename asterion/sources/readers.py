"""Files to typed DataFrames.

Each text format has two parts: a ``parse_*`` operator over a DataFrame that holds
the text, which runs distributed on any number of rows, and a ``read_*`` reader
that gets the text from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from asterion.functions import circular, designation as D
from asterion.functions.common import blank_to_null
from asterion.functions.obs80 import with_obs80

from .json_records import json_records
from .schemas import SCHEMAS


def read_table(spark: SparkSession, dir: str, name: str, *, format: str = "parquet") -> DataFrame:
    """A catalogue table with its declared schema."""
    reader = spark.read.schema(SCHEMAS[name])
    path = f"{dir.rstrip('/')}/{name}"
    if format == "parquet":
        return reader.parquet(f"{path}.parquet")
    if format == "csv":
        flat = ", ".join(p if "array<" not in p else p.replace("array<string>", "string")
                         for p in SCHEMAS[name].split(", "))
        d = spark.read.schema(flat).option("header", True).csv(f"{path}.csv")
        arrays = [p.split()[0] for p in SCHEMAS[name].split(", ") if "array<" in p]
        return d.withColumns({a: F.split(F.regexp_replace(a, r"^\{|\}$", ""), ",") for a in arrays})
    raise ValueError(format)


# -- fixed-width object lists ------------------------------------------------------

# Columns (start, length) of the object list line.
LIST_COLUMNS = {"h": (9, 5), "g": (15, 5), "mean_anom": (27, 9), "arg_peri": (38, 9),
                "long_node": (49, 9), "i": (60, 9), "e": (71, 9), "a": (93, 11)}


def parse_mpcorb(lines: DataFrame, *, col: str = "value") -> DataFrame:
    """Object list lines to columns; short and blank lines are skipped."""
    s = F.col(col)
    d = lines.where((F.length(s) >= 103) & (F.trim(F.substring(s, 1, 1)) != ""))
    num = {k: F.trim(F.substring(s, a, n)).try_cast("double") for k, (a, n) in LIST_COLUMNS.items()}
    packed = F.rtrim(F.substring(s, 1, 7))
    numbered = D.numbered_packed(packed)
    readable = F.trim(F.substring(s, 167, 28))
    e, a = num["e"], num["a"]
    unpacked = D.unpack_designation(packed)
    return d.select(
        packed.alias("packed_desig"), F.when(~numbered, unpacked).alias("unpacked_desig"),
        numbered.alias("is_numbered"), F.when(numbered, unpacked).alias("number"),
        readable.alias("readable_desig"),
        F.when((num["h"] <= 90) & (num["h"] > 0), num["h"]).alias("h"), num["g"].alias("g"),
        a.alias("a"), e.alias("e"), num["i"].alias("i"),
        F.when(e < 1, a * (F.lit(1.0) - e)).alias("q"),
        F.when(e < 1, a * (F.lit(1.0) + e)).alias("cap_q"),
        *[num[k].alias(k) for k in ("mean_anom", "arg_peri", "long_node")])


def read_mpcorb(spark: SparkSession, path: str) -> DataFrame:
    return parse_mpcorb(spark.read.text(path))


def parse_list_identity(lines: DataFrame, ni: DataFrame, *, col: str = "value") -> DataFrame:
    """Identity columns of a list from its readable field: '(433) Eros' or '2024 AA'."""
    s = F.col(col)
    name = F.trim(F.substring(s, 167, 28))
    number = blank_to_null(F.regexp_extract(name, r"^\(([0-9]+)\)", 1))
    d = lines.where((F.length(s) >= 167) & (F.trim(s) != "") & ~s.startswith("-")).select(
        F.trim(F.substring(s, 1, 7)).alias("packed_desig"), name.alias("unpacked_desig"),
        number.isNotNull().alias("is_numbered"), number.alias("asteroid_number"),
        F.when(number.isNull(), name).alias("provisional_desig"))
    names = ni.select(F.col("permid").alias("asteroid_number"),
                      F.col("unpacked_primary_provisional_designation").alias("num_provid"))
    return d.join(names, "asteroid_number", "left").select(
        "packed_desig", "unpacked_desig", "is_numbered", "asteroid_number", "provisional_desig", "num_provid")


def parse_astorb(lines: DataFrame, *, col: str = "value", q_max: float = 1.3) -> DataFrame:
    """Designations of near-Earth rows of the orbit file: the number, else the name."""
    s = F.col(col)
    d = lines.where(F.trim(s) != "").select(
        F.trim(F.substring(s, 159, 10)).try_cast("double").alias("e"),
        F.trim(F.substring(s, 170, 12)).try_cast("double").alias("a"),
        F.coalesce(blank_to_null(F.trim(F.substring(s, 1, 6))),
                   blank_to_null(F.trim(F.substring(s, 8, 18)))).alias("raw"))
    keep = (F.col("e") < 1) & (F.col("a") * (F.lit(1.0) - F.col("e")) <= q_max)
    return d.where(keep & F.col("raw").isNotNull())


def count_unparseable(lines: DataFrame, *, col: str = "value") -> DataFrame:
    s = F.col(col)
    bad = (F.trim(F.substring(s, 159, 10)).try_cast("double").isNull()
           | F.trim(F.substring(s, 170, 12)).try_cast("double").isNull())
    return lines.where(F.trim(s) != "").agg(F.count("*").alias("n_lines"),
                                            F.count(F.when(bad, 1)).alias("n_skipped"))


def read_astorb(spark: SparkSession, path: str, *, observation=None) -> DataFrame:
    """``observation`` (pyspark.sql.Observation) collects line and skip counts on the way."""
    lines = spark.read.text(path)
    if observation is not None:
        bad = F.trim(F.substring("value", 159, 10)).try_cast("double").isNull()
        lines = lines.observe(observation, F.count("*").alias("n_lines"),
                              F.count(F.when(bad & (F.trim("value") != ""), 1)).alias("n_skipped"))
    return parse_astorb(lines)


def parse_neocc_list(lines: DataFrame, *, col: str = "value") -> DataFrame:
    """First word of each line: a number, or a designation with its blank restored."""
    first = F.get(F.split(F.trim(F.col(col)), r"\s+"), F.lit(0))
    return lines.select(first.alias("_f")).where(F.col("_f") != "").select(
        D.spaced_designation("_f").alias("raw"),
        F.when(F.col("_f").rlike("^[0-9]+$"), F.col("_f")).alias("permid"))


def read_neocc_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_neocc_list(spark.read.text(path))


def parse_key_list(lines: DataFrame, *, col: str = "value") -> DataFrame:
    """One designation per line, typed by whether it contains a blank."""
    s = F.trim(F.col(col))
    return lines.where(s != "").select(s.alias("key"), D.key_kind(s).alias("kind"))


def read_key_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_key_list(spark.read.text(path))


# -- JSON ----------------------------------------------------------------------------

SBDB_NUMERIC = ["H", "e", "a", "q", "i", "om", "w", "moid"]


def parse_sbdb_json(docs: DataFrame, *, col: str = "value", fields: list[str]) -> DataFrame:
    """``{"fields": [...], "data": [[...]]}`` documents to rows of the wanted fields.

    Positions come from each document's own field list. Numeric fields are coerced;
    ``alt_desig`` is the name in parentheses, which keeps an ``A/`` prefix.
    """
    doc = F.from_json(F.col(col), "fields array<string>, data array<array<string>>")
    return sbdb_columns(docs.select(doc.alias("_d")).select("_d.fields", F.explode("_d.data").alias("_row")), fields)


def sbdb_columns(d: DataFrame, fields: list[str]) -> DataFrame:
    """The wanted fields from rows of (fields, _row)."""
    def field(name):
        at = F.array_position("fields", name)
        v = F.get("_row", (at - 1).cast("int"))
        return v.try_cast("double") if name in SBDB_NUMERIC else v

    d = d.select(*[F.when(F.array_contains("fields", f), field(f)).alias(f) for f in fields])
    if "full_name" in fields:
        d = d.withColumn("alt_desig", F.trim(blank_to_null(
            F.regexp_extract("full_name", r"\(([^)]+)\)", 1))))
    if "pdes" in fields:
        d = d.where(F.coalesce(F.col("pdes"), F.lit("")) != "").withColumn(
            "is_numbered", F.col("pdes").rlike(r"^\d+$"))
    return d


def read_sbdb_json(spark: SparkSession, path: str, *, fields: list[str]) -> DataFrame:
    """A document of any size, its rows read by byte ranges; the field list comes from around them."""
    records, head = json_records(spark, path, depth=2)
    listed = F.regexp_extract("text", r'"fields"\s*:\s*(\[[^\]]*\])', 1)
    head = head.select("file", F.from_json(listed, "array<string>").alias("fields"))
    return sbdb_columns(records.join(head, "file").select("fields", F.from_json("text", "array<string>").alias("_row")), fields)


def recovered_designation(df: DataFrame) -> DataFrame:
    """Add ``raw``: pdes when it reads as a designation, else the name in parentheses."""
    ok = D.designation_kind("pdes").isNotNull()
    return df.withColumn("raw", F.when(ok, F.col("pdes")).otherwise(F.coalesce("alt_desig", "pdes")))


def parse_target_map_json(docs: DataFrame, *, col: str = "value") -> DataFrame:
    """A target service's answer, a map keyed by packed designation, to rows."""
    schema = ("result struct<objects: map<string, "
              "struct<q: double, neo: double, u: double, neocp: boolean>>>")
    return target_columns(docs.select(F.explode(F.from_json(F.col(col), schema)["result"]["objects"])))


def target_columns(d: DataFrame) -> DataFrame:
    return d.select(F.col("key").alias("packed_desig"), F.col("value.q").alias("q"),
                    F.col("value.neo").alias("neo_prob"), F.col("value.u").alias("u"),
                    F.coalesce("value.neocp", F.lit(False)).alias("neocp"))


def read_target_map_json(spark: SparkSession, path: str) -> DataFrame:
    """An answer of any size, its objects read by byte ranges."""
    records, _ = json_records(spark, path, depth=3)
    one = F.from_json(F.concat(F.lit("{"), F.col("text"), F.lit("}")), "map<string, struct<q: double, neo: double, u: double, neocp: boolean>>")
    return target_columns(records.select(F.explode(one)))


def solid_targets(targets: DataFrame, orbits: DataFrame, ni: DataFrame) -> DataFrame:
    """Targets with the verdict on their perihelion; confirmation-page ones are out.

    Catalogue q is found under the packed designation and the packed number.
    """
    from asterion.operators.filters import q_solidity_verdict
    from asterion.operators.identity import PACKED
    cat = orbits.where(F.col("q").isNotNull() & (F.col("e") < 1)).select(PACKED, F.col("q").alias("catalog_q"))
    numbered = ni.join(cat, PACKED).select(D.pack_number("permid").alias("packed_desig"), "catalog_q")
    lookup = cat.select(F.col(PACKED).alias("packed_desig"), "catalog_q").unionByName(numbered)
    d = targets.where(~F.col("neocp")).join(lookup, "packed_desig", "left")
    return d.withColumn("verdict", q_solidity_verdict("q", "catalog_q"))


# -- circulars and report pages --------------------------------------------------------

def parse_circulars(pages: DataFrame, *, text: str = "pre_text", title: str = "title", year: int) -> DataFrame:
    """Circular texts to one structured row each. Other columns pass through.

    A discovery without observations is a recovery.
    """
    d = circular.with_sections(pages, text, "_s")
    obs, elements = F.col("_s.observations"), F.col("_s.orbital_elements")
    kind = circular.circular_type(title, text, year)
    desig = F.coalesce(circular.circular_designation(text), blank_to_null(title))
    n_obs, arc = circular.observation_span(obs, elements)
    comparison = r"(?s)(?:^|\n)(First and last observations.*)"
    details = F.col("_s.observer_details")
    return d.select(
        *pages.columns, desig.alias("designation"),
        F.when((kind == "discovery") & desig.isNotNull() & obs.isNull(), F.lit("recovery"))
        .otherwise(kind).alias("type"),
        circular.issue_date(F.col("_s.header")).alias("date"),
        circular.satellite_parent(text).alias("satellite_of"), n_obs.alias("n_obs"), arc.alias("arc_days"),
        circular.parse_elements(F.coalesce(elements, F.lit(""))).alias("elements"),
        F.rtrim(F.regexp_replace(details, comparison, "")).alias("observers"),
        F.trim(blank_to_null(F.regexp_extract(details, comparison, 1))).alias("comparison"),
        F.col("_s").alias("sections"))


def parse_circular_index(pages: DataFrame, *, col: str = "html") -> DataFrame:
    """Listing pages to (circular_id, path, title, date) rows."""
    form = (r'(?s)<a\s+href="(/mpec/[^"]+)"><i>MPEC</i>\s*([^<]+)</a>'
            r"\s*\(([^)]+)\).*?<li>([^<]+)")
    groups = F.arrays_zip(*[F.regexp_extract_all(F.col(col), F.lit(form), F.lit(k)).alias(n)
                            for k, n in ((1, "path"), (2, "id"), (3, "date"), (4, "title"))])
    return pages.select(*[c for c in pages.columns if c != col], F.explode(groups).alias("r")).select(
        *[c for c in pages.columns if c != col],
        F.concat(F.lit("MPEC "), F.trim("r.id")).alias("circular_id"), F.trim("r.path").alias("path"),
        F.trim("r.title").alias("title"), F.trim("r.date").alias("date"))


def parse_year_blocks(pages: DataFrame, *, col: str = "html", since: int | None = None) -> DataFrame:
    """Report pages of year blocks to (year_label, code, 13 counts) rows.

    The text is cut at the year headers, so each line comes with its year and
    nothing has to be carried down.
    """
    from asterion.operators.boxscore import COUNTS
    body = F.regexp_extract(F.col(col), r"(?s)<pre>(.*?)</pre>", 1)
    pieces = F.split(body, r"<b>")
    blocks = F.transform(
        F.slice(pieces, F.lit(2), F.size(pieces)),
        lambda x: F.struct(F.trim(F.substring_index(x, "</b>", 1)).alias("year"),
                           F.split(F.substring_index(x, "</b>", -1), "\n").alias("lines")))
    keep = [c for c in pages.columns if c != col]
    d = pages.select(*keep, F.explode(blocks).alias("_b")).select(
        *keep, F.col("_b.year").alias("_y"), F.explode("_b.lines").alias("_line"))
    if since is not None:
        d = d.where(F.col("_y").try_cast("int") >= since)
    triple = r"\d+/\s*\d+/\s*\d+"
    form = rf"^\s*\S+\s+\d+\s+{triple}\s+{triple}\s+{triple}\s+{triple}"
    line = F.trim("_line")
    d = d.where(line.rlike(form) & ~line.startswith("Total") & ~line.startswith("Code"))
    label = F.when(F.col("_y") == "Before 1971", F.lit("<1971")).otherwise(F.col("_y"))
    # A line that matches is its code followed by the thirteen numbers.
    code = F.substring_index(line, " ", 1)
    numbers = F.regexp_extract_all(line.substr(F.length(code) + 1, F.length(line)), F.lit(r"\d+"), F.lit(0))
    d = d.select(*keep, label.alias("year_label"), code.alias("code"), numbers.alias("_n"))
    return d.select(*keep, "year_label", "code",
                    *[F.col("_n")[k].cast("bigint").alias(c) for k, c in enumerate(COUNTS)])


# -- exchange XML and logs -----------------------------------------------------------

ADES_FIELDS = ("permID string, provID string, trkSub string, obsID string, trkID string, mode string, "
               "stn string, obsTime string, ra double, dec double, rmsRA double, rmsDec double, "
               "astCat string, mag double, band string, ref string, disc string, notes string")


def read_ades_xml(spark: SparkSession, path: str, *, schema: str = ADES_FIELDS) -> DataFrame:
    """``<optical>`` elements, at any depth, to observation rows."""
    return spark.read.format("xml").option("rowTag", "optical").option(
        "ignoreNamespace", True).schema(schema).load(path)


def parse_ades_elements(df: DataFrame, *, col: str, schema: str = ADES_FIELDS) -> DataFrame:
    """Single ``<optical>`` elements held in a column."""
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.from_xml(F.col(col), schema).alias("_x")).select(*keep, "_x.*")


def parse_request_log(lines: DataFrame, *, col: str = "value") -> DataFrame:
    """Request lines to (host, outcome), suppression lines to their key."""
    s = F.col(col)
    return lines.where(s.startswith("APIREQ") | s.contains("API neg-cache")).select(
        F.when(s.startswith("APIREQ"), blank_to_null(F.regexp_extract(s, r"host=([^ ]+)", 1))).alias("host"),
        F.when(s.startswith("APIREQ"), blank_to_null(F.regexp_extract(s, r"outcome=([^ ]+)", 1))).alias("outcome"),
        blank_to_null(F.regexp_extract(s, r"API neg-cache \[([^\]]+)\]", 1)).alias("suppressed_key"))


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_request_log(spark.read.text(path))


def log_summary(log: DataFrame) -> DataFrame:
    """Requests per host and outcome, per host, and in all."""
    return log.where(F.col("host").isNotNull()).rollup("host", "outcome").agg(
        F.count("*").alias("n"), F.grouping_id("host", "outcome").alias("_g")).select(
        F.when(F.col("_g") == 3, F.lit("ALL")).otherwise(F.col("host")).alias("host"),
        F.when(F.col("_g") >= 1, F.lit("ALL")).otherwise(F.col("outcome")).alias("outcome"), "n")


def top_suppressed(log: DataFrame, *, n: int = 10) -> DataFrame:
    return log.where(F.col("suppressed_key").isNotNull()).groupBy("suppressed_key").agg(
        F.count("*").alias("n")).orderBy(F.desc("n"), "suppressed_key").limit(n)


def decode_observations(df: DataFrame, *, col: str = "obs80") -> DataFrame:
    """80-column lines to the thirteen decoded columns, next to the others."""
    return with_obs80(df, col)
