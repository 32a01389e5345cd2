"""Sinks, streams and whole jobs over the given tables."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import functions as F

from asterion import storage
from asterion.bucketed import BucketTable
from asterion.operators import consensus
from asterion.operators.identity import PACKED as P, UNPACKED as U
from asterion.plans import refresh
from asterion.sinks import writers
from asterion.streaming import streams

from . import oracle_parts as S
from .q_consensus import SOURCES, WIDE_SQL
from .q_discovery import PRODUCT_SQL
from .q_text import SPLICE
from .registry import query


BATCHES = 3


def work_dir(t) -> str:
    """A fresh folder below the cluster's shared one; where none is named, below the warehouse, which is shared too."""
    base = t.spark.conf.get("spark.checkpoint.dir", None) or f"{t.spark.conf.get('spark.sql.warehouse.dir')}/shared"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stream_events(t, text: list[str], *, in_order: bool = False):
    """The event table as a stream of several micro-batches, with a view's columns.

    Each batch holds rows of every time and object, or with ``in_order`` the next stretch of time.
    """
    folder = f"{work_dir(t)}/events"
    rows = t.events
    if in_order:
        cuts = rows.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
        span = F.timestamp_diff("MICROSECOND", "a", "b") + 1
        rows = rows.join(F.broadcast(cuts)).withColumn("_part", F.floor(
            F.timestamp_diff("MICROSECOND", F.col("a"), F.col("ts")) * BATCHES / span)).drop("a", "b")
    else:
        rows = rows.withColumn("_part", F.col("event_id") % BATCHES)
    for k in range(BATCHES):
        rows.where(F.col("_part") == k).drop("_part").coalesce(1).write.mode("append").parquet(folder)
    d = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return d.selectExpr(*text)


OBS_STREAM = [
    "cast(event_id as string) AS obsid", "CASE WHEN user_id % 3 = 0 THEN cast(user_id as string) END AS permid",
    "CASE WHEN user_id % 3 <> 0 AND event_id % 17 = 0 THEN concat('S', cast(user_id as string)) "
    "WHEN user_id % 3 <> 0 OR event_id % 5 = 0 THEN concat('U', cast(user_id as string)) END AS provid",
    "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '' "
    "ELSE concat(cast(user_id as string), '-', cast(cast(ts as date) as string)) END AS trkid",
    "event_type AS stn", "ts AS obstime", "cast(event_id * 7919 % 358900 AS double) / 997D AS ra", "cast(event_id * 104729 % 179000 AS double) / 1009D - 88D AS dec",
    "CASE WHEN event_id % 19 <> 0 THEN 14D + value / 39D END AS mag",
    "CASE event_id % 8 WHEN 0 THEN 'V' WHEN 1 THEN 'G' WHEN 2 THEN 'o' WHEN 3 THEN 'r' WHEN 4 THEN '' WHEN 6 THEN 'X' WHEN 7 THEN 'w' END AS band", "CASE WHEN event_id % 7 = 0 THEN '*' END AS disc",
    "ts + INTERVAL 45 MINUTE AS created_at", "user_id"]


def finished(query, t, path):
    """Run a stream over what is there now and read what it wrote."""
    q = query.trigger(availableNow=True).start()
    q.awaitTermination()
    return t.spark.read.parquet(path)


def append_stream(d, t):
    w = work_dir(t)
    writer = d.writeStream.format("parquet").option("path", f"{w}/out").option("checkpointLocation", f"{w}/cp")
    return finished(writer, t, f"{w}/out")


def maintained(stream, key, combine, t, updates=lambda batch: batch):
    """A bucketed table that the stream keeps, after its last batch."""
    w = work_dir(t)
    table = BucketTable(t.spark, f"{w}/table", key, buckets=16)
    q = streams.maintain_buckets(stream, table, combine, checkpoint=f"{w}/cp", updates=updates).trigger(availableNow=True).start()
    q.awaitTermination()
    return table.read()


@query("stream_new_discoveries", "SELECT obsid, stn, provid FROM obs WHERE disc = '*'")
def _(t):
    d = streams.new_discoveries(stream_events(t, OBS_STREAM, in_order=True))
    return append_stream(d, t).select("obsid", "stn", "provid")


#: Some events of numbered objects carry the designation alone, some nothing.
HALF_KEYED = "CASE WHEN provid IS NULL AND cast(obsid AS bigint) % 10 <> 3 OR cast(obsid AS bigint) % 3 = 0 THEN permid END"


@query("stream_enrich", f"""WITH b AS (SELECT * REPLACE ({HALF_KEYED} AS permid) FROM obs WHERE disc = '*'),
hit AS (SELECT obsid, arg_min(p, rank) AS p FROM (SELECT obsid, n.{P} AS p, 1 AS rank FROM b JOIN ni n ON n.permid = b.permid UNION ALL
  SELECT obsid, o.{P}, 2 FROM b JOIN orbits o ON o.{U} = b.provid) GROUP BY obsid)
SELECT b.obsid, CASE WHEN hit.p IS NOT NULL THEN {S.label('coalesce(o.orbit_type_int, ' + S.CLASSIFY + ')', "'Unclassified'", 'Other (Unusual)')} END AS orbit_class, CASE WHEN hit.p IS NOT NULL THEN coalesce(o.earth_moid, 999) <= 0.05 AND coalesce(o.h, 99) <= 22 END AS pha,
  replace(trim(c.name), chr(92) || '''', '''') AS site_name FROM b LEFT JOIN hit USING (obsid) LEFT JOIN orbits o ON o.{P} = hit.p LEFT JOIN obscodes c ON c.obscode = b.stn""")
def _(t):
    events = stream_events(t, OBS_STREAM).where("disc = '*'").withColumn("permid", F.expr(HALF_KEYED))
    d = streams.enrich(events, t.orbits, t.ni, t.obscodes)
    return append_stream(d, t).select("obsid", "orbit_class", "pha", "site_name")


@query("stream_detection_daily", """SELECT provid, stn, CAST(obstime AS DATE) AS obs_date, count(*) AS n_obs, count(DISTINCT trkid) AS n_tracklets, bool_or(coalesce(disc = '*', FALSE)) AS disc_flag
FROM obs WHERE provid IS NOT NULL GROUP BY 1, 2, 3""")
def _(t):
    d = maintained(stream_events(t, OBS_STREAM), ["provid", "stn", "obs_date"], streams.add_daily_tracklets, t, streams.daily_tracklets)
    return d.groupBy("provid", "stn", "obs_date").agg(F.sum("n_obs").alias("n_obs"), F.count("trkid").alias("n_tracklets"),
                                                      F.bool_or("disc_flag").alias("disc_flag"))


@query("stream_known_set", f"WITH p AS ({PRODUCT_SQL}) SELECT primary_designation, {P}, nobs, median_v_magnitude FROM p")
def _(t):
    w = work_dir(t)
    known = streams.KnownSet(t.spark, f"{w}/known", t.orbits, t.ni, t.obscodes, buckets=4)
    known.start(stream_events(t, OBS_STREAM), f"{w}/cp").trigger(availableNow=True).start().awaitTermination()
    return known.product.read().select("primary_designation", P, "nobs", "median_v_magnitude")


@query("stream_element_updates", "SELECT provid, arg_max(stn, (obstime, obsid)) AS stn, max(obstime) AS obstime FROM obs WHERE provid IS NOT NULL GROUP BY 1")
def _(t):
    d = stream_events(t, OBS_STREAM).where("provid IS NOT NULL").select("provid", "obstime", "obsid", "stn")
    newest = partial(streams.latest_by_key, key=["provid"], order=["obstime", "obsid"])
    return maintained(d, ["provid"], newest, t).select("provid", "stn", "obstime")


@query("stream_members", "SELECT 's1' AS source, 'U' || user_id AS primary_desig, TIMESTAMP '2024-02-01' AS first_seen FROM (SELECT DISTINCT user_id FROM events)")
def _(t):
    d = stream_events(t, ["concat('U', cast(user_id as string)) AS primary_desig", "concat('PU', cast(user_id as string)) AS packed_desig",
                          "cast(user_id as string) AS raw_string", "false AS is_comet"])
    d = maintained(d, ["primary_desig"], streams.members_step("s1", "2024-02-01 00:00:00"), t)
    return d.select("source", "primary_desig", "first_seen")


@query("stream_arc_sessions", """WITH l AS (SELECT provid, obstime, lag(obstime) OVER (PARTITION BY provid ORDER BY obstime) AS p FROM obs WHERE provid IS NOT NULL),
a AS (SELECT provid, obstime, sum(CASE WHEN p IS NULL OR epoch_us(obstime) - epoch_us(p) > 172800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY provid ORDER BY obstime) AS k FROM l),
s AS (SELECT provid AS "key", min(obstime) AS start, max(obstime) AS "end", count(*) AS n FROM a GROUP BY provid, k)
SELECT "key", start, "end", n, epoch_us((SELECT max("end") FROM s)) - epoch_us("end") <= 172800000000 AS is_open FROM s""")
def _(t):
    arcs = maintained(stream_events(t, OBS_STREAM), ["key"], streams.join_arcs(days=2), t, partial(streams.arc_pieces, days=2))
    return streams.with_open_flag(arcs, days=2)


# A day's window comes out once the watermark has passed its end.
@query("stream_daily_windows", """WITH d AS (SELECT provid, stn, CAST(obstime AS DATE) AS obs_date, count(*) AS n_obs, bool_or(coalesce(disc = '*', FALSE)) AS disc_flag FROM obs WHERE provid IS NOT NULL GROUP BY 1, 2, 3)
SELECT * FROM d WHERE obs_date + INTERVAL 1 DAY <= (SELECT max(obstime) FROM obs WHERE provid IS NOT NULL) - INTERVAL 2 DAY""")
def _(t):
    d = streams.detection_daily(stream_events(t, OBS_STREAM, in_order=True), late="2 days")
    return append_stream(d, t).select("provid", "stn", "obs_date", "n_obs", "disc_flag")


@query("new_discovery_notices", f"WITH p AS ({PRODUCT_SQL}) SELECT primary_designation FROM p WHERE nobs < 2")
def _(t):
    from asterion.operators.discovery import discovery_tracklets
    d = discovery_tracklets(t.orbits, t.ni, t.obs, t.obscodes)
    return streams.new_only(d.where(F.col("nobs") >= 2), d).select("primary_designation")


@query("list_augment", """SELECT c_custkey AS designation, 'both' AS source FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT DISTINCT o_custkey, 'circular' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""")
def _(t):
    now = t.customer.where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("designation"), F.lit("both").alias("source"))
    return streams.list_augment(now, t.orders.select(F.col("o_custkey").alias("designation")))


@query("run_ledger", """SELECT source, started_at, arg_max(status, coalesce(finished_at, started_at)) AS status FROM (
  SELECT source, started_at, NULL AS finished_at, 'running' AS status FROM runs UNION ALL SELECT source, started_at, finished_at, status FROM runs WHERE finished_at IS NOT NULL) GROUP BY 1, 2""")
def _(t):
    runs = t.runs
    begun = runs.select("source", "started_at", F.lit(None).cast("timestamp_ntz").alias("finished_at"), F.lit("running").alias("status"))
    ended = runs.where(F.col("finished_at").isNotNull()).select("source", "started_at", "finished_at", "status")
    return streams.ledger(begun.unionByName(ended)).select("source", "started_at", "status")


# -- sinks -----------------------------------------------------------------------------------------

@query("snapshot_near_earth", f"SELECT id, stn FROM obs WHERE provid IN (SELECT {U} FROM orbits WHERE q <= 1.30)")
def _(t):
    near = t.obs.join(t.orbits.where(F.col("q") <= 1.30).select(F.col(U).alias("provid")), "provid", "left_semi")
    path = work_dir(t)
    storage.write_snapshot(near.select("id", "stn"), path)
    return storage.write_snapshot(near.select("id", "stn"), path, max_age_seconds=3600)


@query("product_csv", f"WITH p AS ({PRODUCT_SQL}) SELECT primary_designation, nobs, median_v_magnitude, discovery_site_code FROM p")
def _(t):
    from asterion.operators.discovery import discovery_tracklets
    path = work_dir(t)
    writers.write_product_csv(discovery_tracklets(t.orbits, t.ni, t.obs, t.obscodes), path)
    d = t.spark.read.option("header", True).csv(path)
    return d.select("primary_designation", F.col("nobs").cast("bigint").alias("nobs"),
                    F.col("median_v_magnitude").cast("double").alias("median_v_magnitude"), "discovery_site_code")


@query("ades_xml_file", """SELECT obsid AS "obsID", stn, round(ra, 6) AS ra, round(mag, 2) AS mag FROM obs WHERE disc = '*'""")
def _(t):
    from asterion.sources.readers import read_ades_xml
    path = work_dir(t)
    d = t.obs.where(F.col("disc") == "*").withColumnsRenamed({"obsid": "obsID", "obstime": "obsTime"})
    writers.write_ades_xml(d.select("obsID", "stn", "obsTime", "ra", "dec", "mag"), path)
    return read_ades_xml(t.spark, path).select("obsID", "stn", "ra", "mag")


@query("psv_file", "SELECT count(*) + 2 AS n_lines, count(*) AS n_records FROM obs WHERE disc = '*'")
def _(t):
    path = work_dir(t)
    writers.write_psv(t.obs.where(F.col("disc") == "*"), path, order="obstime",
                      fields={"stn": "stn", "ra": "ra", "dec": "dec", "mag": "mag", "obsTime": F.col("obstime").cast("string")})
    d = t.spark.read.text(path)
    return d.where(F.col("value") != "").agg(F.count("*").alias("n_lines"), F.count(F.when(
        F.col("value").contains("|") & ~F.col("value").contains("permID"), 1)).alias("n_records"))


@query("export_obs80", f"""WITH k AS (SELECT DISTINCT obs80, rmsra, rmsdec FROM neocp WHERE id % 23 <> 0 AND id % 29 <> 0 AND CAST(substr(desig, 2) AS INTEGER) % 3 = 0 AND (rmsra IS NULL OR rmsra < 5) AND (rmsdec IS NULL OR rmsdec < 5) AND substr(obs80, 15, 1) NOT IN ('X', 'x'))
SELECT rtrim({SPLICE}, chr(10)) AS value FROM k""")
def _(t):
    k = F.col("id")
    d = t.neocp.withColumns({"permid": F.expr("substr(desig, 2)"), "provid": F.concat(F.lit("U"), F.expr("substr(desig, 2)")),
                             "status": F.when(k % 23 == 0, F.lit("X")).otherwise(F.lit("p")), "deprecated": F.when(k % 29 == 0, F.lit("Y"))})
    perm = d.where(F.col("permid").cast("int") % 3 == 0).select(F.col("permid").alias("key"), F.lit("permid").alias("kind")).distinct()
    prov = d.where(F.col("permid").cast("int") % 6 == 0).select(F.col("provid").alias("key"), F.lit("provid").alias("kind")).distinct()
    return writers.obs80_lines(writers.export_obs80(d, perm.unionByName(prov)))


@query("subset_source_lines", "SELECT value FROM list_lines WHERE (k % 4 = 0 AND k % 8 = 0 AND k > 0) OR (k % 4 <> 0 AND k % 5 = 0)")
def _(t):
    from .adapters import _readable
    keys = t.sql(f"SELECT {_readable('p_partkey')} AS primary_desig, CAST(p_partkey AS VARCHAR(20)) AS permid, p_partkey AS k FROM {{part}}")
    keys = keys.where("(k % 8 = 0 AND k > 0) OR (k % 4 <> 0 AND k % 5 = 0)")
    keys = keys.select(F.when(F.col("k") % 4 != 0, F.col("primary_desig")).alias("primary_desig"), F.when(F.col("k") % 4 == 0, F.col("permid")).alias("permid"))
    return writers.subset_source_lines(t.list_lines, keys).select("value")


@query("optical_rows", """SELECT id, '<optical>' || coalesce('<permID>' || permid || '</permID>', '') || coalesce('<provID>' || provid || '</provID>', '') || coalesce('<trkSub>' || trksub || '</trkSub>', '') || '<obsID>' || obsid || '</obsID><stn>' || stn || '</stn></optical>' AS xml FROM obs""")
def _(t):
    return writers.optical_rows(t.obs.select("id", "permid", "provid", "trksub", "obsid", "stn", "obstime").withColumn(
        "obstime", F.lit(None).cast("timestamp_ntz"))).select("id", "xml")


# -- whole jobs --------------------------------------------------------------------------------------

@query("consensus_view", f"""WITH {WIDE_SQL}, mo AS (SELECT w.primary_desig, o.* FROM wide w JOIN obs o ON o.permid = w.permid UNION SELECT w.primary_desig, o.* FROM wide w JOIN obs o ON o.provid = w.primary_desig),
s AS (SELECT primary_desig, count(*) AS nobs, count(DISTINCT stn) AS n_stns, min(stn) FILTER (WHERE disc = '*') AS disc_by FROM mo GROUP BY 1)
SELECT w.primary_desig, in_s1, in_s4, nobs, n_stns, disc_by FROM wide w LEFT JOIN s USING (primary_desig)""")
def _(t):
    return refresh.consensus_view(t.members, t.obs, sources=SOURCES).select("primary_desig", "in_s1", "in_s4", "nobs", "n_stns", "disc_by")


@query("refresh_source", f"""WITH b AS (SELECT o.{U} AS d FROM orbits o WHERE q <= 1.3 AND e < 1), m AS (SELECT * FROM members WHERE source = 's3')
SELECT coalesce(m.primary_desig, b.d) AS primary_desig, coalesce(m.first_seen, TIMESTAMP '2003-01-01') AS first_seen, CASE WHEN b.d IS NOT NULL THEN TIMESTAMP '2003-01-01' ELSE m.last_seen END AS last_seen FROM m FULL JOIN b ON b.d = m.primary_desig""")
def _(t):
    rows = refresh.catalog_rows(t.orbits, t.ni)
    d = consensus.membership_upsert(t.members.where(F.col("source") == "s3"), rows, source="s3", now="2003-01-01 00:00:00")
    return d.select("primary_desig", "first_seen", "last_seen")


@query("unresolved_entries", "SELECT c_custkey AS k FROM customer WHERE c_custkey % 4 = 3 AND c_custkey % 8 <> 3")
def _(t):
    from .q_text import _REAL
    return refresh.unresolved(t.sql(_REAL["raw"]), t.sql(_REAL["ni"]), t.sql(_REAL["orbits"])).select("k")


@query("neo_list", """WITH a AS (SELECT p_partkey AS k FROM part), lb AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 4 IN (2, 3))
SELECT CASE WHEN lb.k IS NULL THEN 'mpc' ELSE 'both' END AS source, count(*) AS n FROM a LEFT JOIN lb USING (k) GROUP BY 1""")
def _(t):
    from asterion.sources import readers
    from .q_text import _SBDB
    a = readers.parse_mpcorb(t.list_lines)
    b = readers.parse_sbdb_json(t.sql(_SBDB), fields=["pdes", "full_name", "H", "e", "a", "q"]).where(
        ~F.col("is_numbered") & (F.col("pdes") != "odd"))
    return refresh.neo_list(a, b).groupBy("source").agg(F.count("*").alias("n"))


