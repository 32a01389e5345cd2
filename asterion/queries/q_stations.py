"""Per-station, per-object and cross-tabulated statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from asterion.functions import orbit
from asterion.operators import boxscore, discovery, filters, identity, stations, summary
from asterion.operators.ordered import with_position
from asterion.operators.ranking import (cumulative_counts, enum_order, period_change, sample_rows,
                                        share_of_total, top_n_per_group, year_label_key)

from . import oracle_parts as S
from .q_discovery import rounded
from .registry import query

P, U = identity.PACKED, identity.UNPACKED

PROFILE_SQL = "WITH " + ",\n".join([
    S.objects("iau", "nq"), S.sightings("nq", "dq"), S.firsts("dq", "iq"),
    S.objects("class", "nc"), S.sightings("nc", "dc"), S.firsts("dc", "ic")]) + f""",
a AS (SELECT stn, count(DISTINCT {S.KEY}) AS disc_all FROM obs WHERE disc = '*' GROUP BY stn),
q AS (SELECT stn, count(*) AS disc_neo_q, CAST(min(year(obstime)) AS INTEGER) AS first_neo_year, CAST(max(year(obstime)) AS INTEGER) AS last_neo_year FROM iq GROUP BY stn),
c AS (SELECT stn, count(*) AS disc_neo_class FROM ic GROUP BY stn)
SELECT coalesce(a.stn, q.stn, c.stn) AS stn, disc_all, disc_neo_q, disc_neo_class, first_neo_year, last_neo_year
FROM a FULL JOIN q ON q.stn = a.stn FULL JOIN c ON c.stn = coalesce(a.stn, q.stn)"""


@query("station_discovery_profile", PROFILE_SQL)
def _(t):
    return stations.station_discovery_profile(t.orbits, t.ni, t.obs)


@query("station_profile_ordered", PROFILE_SQL + " ORDER BY disc_neo_q DESC NULLS LAST, disc_all DESC NULLS LAST LIMIT 3")
def _(t):
    return stations.nulls_last_order(stations.station_discovery_profile(t.orbits, t.ni, t.obs),
                                     "disc_neo_q", "disc_all").limit(3)


@query("station_profile_ordered_all", f"SELECT *, row_number() OVER (ORDER BY disc_neo_q DESC NULLS LAST, disc_all DESC NULLS LAST, stn) AS position FROM ({PROFILE_SQL})")
def _(t):
    d = stations.station_discovery_profile(t.orbits, t.ni, t.obs)
    # A station is a row; NULLs come last as the least of all values.
    d = d.withColumns({"_q": -F.coalesce("disc_neo_q", F.lit(-1)), "_a": -F.coalesce("disc_all", F.lit(-1))})
    d = with_position(d, order=["_q", "_a", "stn"], bucket=F.col("_q")).drop("_q", "_a")
    return stations.nulls_last_order(d, "disc_neo_q", "disc_all")


@query("full_outer_counts", """
SELECT coalesce(a.stn, b.stn) AS stn, n_mag, n_disc FROM
 (SELECT stn, count(*) AS n_mag FROM detections WHERE mag > 49 AND obstime < '1995-03-01' GROUP BY stn) a FULL JOIN
 (SELECT stn, count(*) AS n_disc FROM detections WHERE disc = '*' AND obstime > '2001-09-01' GROUP BY stn) b ON a.stn = b.stn""")
def _(t):
    d = t.detections
    return stations.full_outer_counts(
        d.where((F.col("mag") > 49) & (F.col("obstime") < F.lit("1995-03-01").cast("timestamp_ntz"))).groupBy("stn").agg(F.count("*").alias("n_mag")),
        d.where((F.col("disc") == "*") & (F.col("obstime") > F.lit("2001-09-01").cast("timestamp_ntz"))).groupBy("stn").agg(F.count("*").alias("n_disc")),
        key="stn")


@query("station_obs_profile", "SELECT stn, count(*) AS n_obs, min(obstime) AS first_obs, max(obstime) AS last_obs FROM detections GROUP BY stn")
def _(t):
    return stations.station_obs_profile(t.detections)


@query("station_obs_profile_exact", f"""
SELECT stn, count(*) AS n_obs, min(obstime) AS first_obs, max(obstime) AS last_obs, count(DISTINCT trkid) AS n_tracklets,
  count(DISTINCT {S.KEY}) AS n_objects FROM detections GROUP BY stn""")
def _(t):
    return stations.station_obs_profile(t.detections, distinct="exact")


# Estimates themselves are not SQL's; that each lies within its stated error of the exact number is.
@query("station_obs_profile_approx", f"""
SELECT stn, count(*) AS n_obs, count(DISTINCT trkid) AS n_tracklets, count(DISTINCT {S.KEY}) AS n_objects, TRUE AS tracklets_within, TRUE AS objects_within FROM detections GROUP BY stn""")
def _(t):
    return _within(stations.station_obs_profile(t.detections, distinct="exact"), stations.station_obs_profile(t.detections, distinct="approx"), 0.15)


@query("station_sketch_profile", f"""
SELECT stn, count(*) AS n_obs, count(DISTINCT trkid) AS n_tracklets, count(DISTINCT {S.KEY}) AS n_objects, TRUE AS tracklets_within, TRUE AS objects_within
FROM detections WHERE obstime >= '1995-01-01' AND obstime < '1997-07-01' GROUP BY stn""")
def _(t):
    d = t.detections.where("obstime >= '1995-01-01' AND obstime < '1997-07-01'")
    merged = stations.profile_from_sketches(stations.daily_sketches(t.detections), start="1995-01-01", end="1997-07-01")
    return _within(stations.station_obs_profile(d, distinct="exact"), merged, stations.SKETCH_ERROR)


def _within(exact, estimate, error):
    e = estimate.select("stn", F.col("n_obs").alias("e_obs"), F.col("n_tracklets").alias("e_trk"), F.col("n_objects").alias("e_obj"))
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * error
    return exact.join(e, "stn").select("stn", F.col("e_obs").alias("n_obs"), "n_tracklets", "n_objects", close("e_trk", "n_tracklets").alias("tracklets_within"),
                                       close("e_obj", "n_objects").alias("objects_within"))


REPORT_SQL = f"""WITH neo AS (SELECT b.id FROM obs b WHERE EXISTS (SELECT 1 FROM orbits o WHERE o.q <= 1.30 AND o.{U} = b.provid)),
s AS (SELECT b.*, n.id IS NOT NULL AS is_neo FROM obs b LEFT JOIN neo n ON n.id = b.id
  WHERE b.stn = 'click' AND b.obstime >= '2024-01-02' AND b.obstime < '2024-01-29'),
c AS (SELECT {U} AS provid, {S.label(S.CLASSIFY)} AS lbl FROM orbits),
rep AS (SELECT CAST(year(s.obstime) AS INTEGER) AS obs_year, s.is_neo, coalesce(c.lbl, 'Unclassified') AS orbit_class, count(*) AS obs_count,
  count(DISTINCT trkid) AS tracklet_count, count(DISTINCT s.provid) AS object_count,
  count(*) FILTER (WHERE disc = '*') AS discovery_obs, count(DISTINCT s.provid) FILTER (WHERE disc = '*') AS discovery_objects
FROM s LEFT JOIN c ON c.provid = s.provid GROUP BY 1, 2, 3)"""


def _report(t):
    obs, orbits = t.obs, t.orbits
    near = obs.join(orbits.where(F.col("q") <= 1.30).select(F.col(U).alias("provid")), "provid", "left_semi")
    return stations.station_report(obs, near, orbits, site="click", start="2024-01-02", end="2024-01-28")


@query("station_report", REPORT_SQL + " SELECT * FROM rep")
def _(t):
    return _report(t)


@query("summarize_report", REPORT_SQL + """
SELECT is_neo, CAST(sum(obs_count) AS BIGINT) AS obs_count, CAST(sum(tracklet_count) AS BIGINT) AS tracklet_count_approx,
  CAST(sum(object_count) AS BIGINT) AS object_count_approx, CAST(sum(discovery_obs) AS BIGINT) AS discovery_obs,
  CAST(sum(discovery_objects) AS BIGINT) AS discovery_objects_approx, min(obs_year) AS year_min, max(obs_year) AS year_max FROM rep GROUP BY is_neo""")
def _(t):
    return stations.summarize_report(_report(t), by_neo=True)


@query("neo_flag_join", f"SELECT id, coalesce(provid IN (SELECT {U} FROM orbits WHERE q <= 1.30), FALSE) AS is_neo FROM obs")
def _(t):
    obs = t.obs
    near = obs.join(t.orbits.where(F.col("q") <= 1.30).select(F.col(U).alias("provid")), "provid", "left_semi")
    return stations.neo_flag_join(obs, near).select("id", "is_neo")


@query("with_site", """
SELECT o.id, replace(trim(c.name), chr(92) || '''', '''') AS site_name, c.longitude, round(degrees(atan2(c.rhosinphi, c.rhocosphi)), 6) AS latitude
FROM obs o LEFT JOIN obscodes c ON c.obscode = o.stn""")
def _(t):
    return discovery.with_site(t.obs, t.obscodes).select("id", "site_name", "longitude", F.round("latitude", 6).alias("latitude"))


@query("site_mag_stats", f"""WITH v AS (SELECT stn, {S.V_MAG} AS v FROM obs WHERE mag IS NOT NULL),
m AS (SELECT stn, count(*) AS n_mag, avg(v) AS mean_v, stddev(v) AS sigma_v, max(v) AS faintest_v, quantile_cont(v, 0.5) AS median_v, quantile_cont(v, 0.9) AS p90_v, quantile_cont(v, 0.95) AS p95_v FROM v GROUP BY stn),
d AS (SELECT v.stn, quantile_cont(abs(v - median_v), 0.5) AS mad_v FROM v JOIN m ON m.stn IS NOT DISTINCT FROM v.stn GROUP BY v.stn)
SELECT m.stn, n_mag, round(mean_v, 8) AS mean_v, round(sigma_v, 8) AS sigma_v, round(faintest_v, 8) AS faintest_v, round(median_v, 8) AS median_v, round(p90_v, 8) AS p90_v, round(p95_v, 8) AS p95_v,
  round(mad_v, 8) AS mad_v, round(mean_v + sigma_v, 8) AS depth_sigma_v, round(median_v + 1.4826 * mad_v, 8) AS depth_mad_v FROM m JOIN d ON d.stn IS NOT DISTINCT FROM m.stn""")
def _(t):
    return rounded(stations.site_mag_stats(t.obs), **dict.fromkeys(("mean_v", "sigma_v", "faintest_v", "median_v", "p90_v", "p95_v", "mad_v", "depth_sigma_v", "depth_mad_v"), 8))


@query("top_stations", S.chain("iau", stats=False) + """
SELECT d.stn AS station_code, count(*) AS neos, count(*) FILTER (WHERE h < 17.75) AS n_1km,
  count(*) FILTER (WHERE h >= 17.75 AND h <= 22) AS n_140m, count(*) FILTER (WHERE h > 22) AS n_small
FROM firsts d JOIN objs l USING (unpacked_desig) GROUP BY d.stn ORDER BY neos DESC, station_code LIMIT 3""")
def _(t):
    neos = identity.with_numbering(filters.select_neos(t.orbits), t.ni)
    d = identity.earliest_discovery(neos, t.obs, carry=["h"]).withColumnRenamed("stn", "station_code")
    return stations.top_stations(d, n=3)


@query("station_year_coverage", """
SELECT permid, stn, count(*) AS n_obs, CAST(min(obstime) AS DATE) AS first_obs, CAST(max(obstime) AS DATE) AS last_obs
FROM obs WHERE obstime > '2024-01-10' AND permid IS NOT NULL GROUP BY permid, stn""")
def _(t):
    return stations.station_year_coverage(t.obs, since="2024-01-10")


def _cls(c):
    return f"CASE WHEN nullif({c}, '') IS NULL THEN 'none' WHEN {c} LIKE 'MPEC%' THEN 'MPEC' WHEN {c} LIKE 'MPS%' THEN 'MPS' ELSE 'other' END"


@query("reference_by_year", f"""
SELECT CAST(year(obstime) AS INTEGER) AS disc_year, count(*) AS n_rows, count(*) FILTER (WHERE r = 'MPEC') AS ref_mpec, count(*) FILTER (WHERE r = 'MPS') AS ref_mps,
  count(*) FILTER (WHERE r = 'other') AS ref_other, count(*) FILTER (WHERE r = 'none') AS ref_none, count(*) FILTER (WHERE p <> 'none') AS with_prev_ref,
  count(*) FILTER (WHERE p = 'MPEC') AS prev_mpec, count(*) FILTER (WHERE p = 'MPS') AS prev_mps, count(*) FILTER (WHERE p = 'other') AS prev_other
FROM (SELECT obstime, {_cls('ref')} AS r, {_cls('prev_ref')} AS p FROM obs WHERE disc = '*') GROUP BY 1""")
def _(t):
    return stations.reference_by_year(t.obs)


@query("null_flag_summary", """
SELECT count(*) AS total_disc_obs, count(*) FILTER (WHERE trksub IS NULL) AS null_trksub, count(trksub) AS has_trksub,
  round(100.0 * count(*) FILTER (WHERE trksub IS NULL) / count(*), 1) AS pct_null FROM obs WHERE disc = '*'""")
def _(t):
    return stations.null_flag_summary(t.obs)


@query("keying_summary", """
SELECT count(*) AS total, count(*) FILTER (WHERE permid <> '') AS with_permid,
  count(*) FILTER (WHERE (permid IS NULL OR permid = '') AND provid <> '') AS only_provid,
  count(DISTINCT permid) FILTER (WHERE permid <> '') AS distinct_permids, count(DISTINCT provid) FILTER (WHERE provid <> '') AS distinct_provids FROM obs""")
def _(t):
    return stations.keying_summary(t.obs)


@query("astrometric_quality", """
SELECT stn, CAST(year(obstime) AS INTEGER) AS obs_year, count(*) AS n_obs, round(corr(rmsfit, seeing), 4) AS corr_seeing, round(corr(rmsfit, exp), 4) AS corr_exp,
  round(quantile_cont(rmsra / 7, 0.5), 9) AS median_rmsra, round(quantile_cont(rmsdec / 7, 0.5), 9) AS median_rmsdec, round(quantile_cont(rmsfit, 0.5), 9) AS median_rmsfit
FROM obs GROUP BY 1, 2""")
def _(t):
    finer = t.obs.withColumns({c: F.col(c) / 7 for c in ("rmsra", "rmsdec")})
    return rounded(stations.astrometric_quality(finer), median_rmsra=9, median_rmsdec=9, median_rmsfit=9)


# -- summaries ---------------------------------------------------------------------------

@query("obs_summary_all", f"""
SELECT {S.KEY} AS primary_desig, CAST(min(obstime) AS DATE) AS first_obs, CAST(max(obstime) AS DATE) AS last_obs,
  round((epoch_us(max(obstime)) - epoch_us(min(obstime))) / {S.DAY_US}, 6) AS arc_days, count(*) AS nobs, min(stn) FILTER (WHERE disc = '*') AS disc_by
FROM detections WHERE {S.KEY} IS NOT NULL GROUP BY 1""")
def _(t):
    return rounded(summary.obs_summary_all(t.detections), arc_days=6)


OBS_OF_MEMBERS = """wide AS (SELECT primary_desig, max(permid) AS permid FROM members WHERE NOT is_comet GROUP BY primary_desig),
mo AS (SELECT w.primary_desig, o.* FROM wide w JOIN detections o ON o.permid = w.permid
  UNION SELECT w.primary_desig, o.* FROM wide w JOIN detections o ON o.provid = w.primary_desig)"""


def _wide(t):
    return t.members.where(~F.col("is_comet")).groupBy("primary_desig").agg(F.max("permid").alias("permid"))


@query("obs_summary", f"""WITH {OBS_OF_MEMBERS}
SELECT primary_desig, CAST(min(obstime) AS DATE) AS first_obs, CAST(max(obstime) AS DATE) AS last_obs,
  round((epoch_us(max(obstime)) - epoch_us(min(obstime))) / {S.DAY_US}, 6) AS arc_days, count(*) AS nobs, count(DISTINCT stn) AS n_stns,
  min(stn) FILTER (WHERE disc = '*') AS disc_by FROM mo GROUP BY 1""")
def _(t):
    return rounded(summary.obs_summary(_wide(t), t.detections), arc_days=6)


@query("lifetime_followup", f"""WITH {OBS_OF_MEMBERS}
SELECT primary_desig, stn, count(*) AS nobs, count(DISTINCT trkid) AS n_tracklets, count(DISTINCT CAST(obstime AS DATE)) AS n_nights,
  min(obstime) AS first_obs, max(obstime) AS last_obs FROM mo GROUP BY 1, 2""")
def _(t):
    return summary.lifetime_followup(_wide(t), t.detections)


@query("detection_daily", """
SELECT provid, stn, CAST(obstime AS DATE) AS obs_date, count(*) AS n_obs, count(DISTINCT trkid) AS n_tracklets, bool_or(disc = '*') AS disc_flag
FROM detections WHERE provid IS NOT NULL GROUP BY 1, 2, 3""")
def _(t):
    return summary.detection_daily(t.detections)


EXT_SQL = """CASE WHEN code = 3 AND q <= 1.15 THEN 30 WHEN code = 3 THEN 31
  WHEN code = 11 AND coalesce(a, CASE WHEN e < 1 THEN q / (1 - e) END) < 2.06 THEN 110 WHEN code = 11 AND coalesce(a, CASE WHEN e < 1 THEN q / (1 - e) END) < 2.5 THEN 111
  WHEN code = 11 AND coalesce(a, CASE WHEN e < 1 THEN q / (1 - e) END) < 2.82 THEN 112 WHEN code = 11 AND coalesce(a, CASE WHEN e < 1 THEN q / (1 - e) END) IS NOT NULL THEN 113
  WHEN code = 11 THEN 111 WHEN code = 30 THEN 300 WHEN code = 31 THEN 310 ELSE code END"""
COARSE_SQL = """CASE WHEN ext IN (0, 1, 2, 30, 31, 9) THEN 'NEO' WHEN ext = 10 THEN 'Mars Crosser' WHEN ext IN (110, 111, 112, 113) THEN 'Main Belt'
  WHEN ext IN (12, 19, 20) THEN 'Jupiter Region' WHEN ext IN (21, 22, 23) THEN 'Outer Solar System' WHEN ext IN (300, 310) THEN 'Hyperbolic/Parabolic' ELSE 'Unclassified' END"""
CATALOG_SQL = f"""code AS (SELECT *, coalesce(orbit_type_int, {S.CLASSIFY}) AS code FROM orbits),
cat AS (SELECT *, {COARSE_SQL} AS coarse_class FROM (SELECT *, {EXT_SQL} AS ext FROM code))"""


#: Some observations of numbered objects carry the designation alone.
UNNUMBERED = "CASE WHEN provid IS NULL OR id % 3 = 0 THEN permid END"


@query("object_catalog", f"""WITH {CATALOG_SQL},
ob AS (SELECT * REPLACE ({UNNUMBERED} AS permid) FROM obs WHERE disc = '*'),
ids AS (SELECT o.{P} AS p, n.permid AS id, 'number' AS kind FROM orbits o JOIN ni n USING ({P}) UNION ALL SELECT {P}, {U}, 'name' FROM orbits),
hits AS (SELECT p, stn, obstime, obsid FROM ids JOIN (SELECT permid AS id, 'number' AS kind, stn, obstime, obsid FROM ob UNION ALL SELECT provid, 'name', stn, obstime, obsid FROM ob) USING (id, kind)),
dsc AS (SELECT p, arg_min(stn, (obstime, obsid)) AS stn, min(obstime) AS obstime FROM hits GROUP BY p)
SELECT c.{U} AS provid, n.permid, code AS orbit_class_int, ext AS boxscore_class, coarse_class,
  round(coalesce(a, CASE WHEN e < 1 THEN q / (1 - e) END), 6) AS a, coalesce(code IN (0, 1, 2, 3), FALSE) AS neo,
  coalesce(earth_moid, 999) <= 0.05 AND coalesce(h, 99) <= 22 AS pha, coalesce(i, 0) >= 90 AS retrograde,
  d.stn AS discovery_stn, CAST(d.obstime AS DATE) AS discovery_date
FROM cat c LEFT JOIN ni n ON n.{P} = c.{P} LEFT JOIN dsc d ON d.p = c.{P}""")
def _(t):
    obs = t.obs.withColumn("permid", F.expr(UNNUMBERED))
    return summary.object_catalog(t.orbits, t.ni, obs).select(
        "provid", "permid", "orbit_class_int", "boxscore_class", "coarse_class", F.round("a", 6).alias("a"),
        "neo", "pha", "retrograde", "discovery_stn", "discovery_date")


@query("boxscore_objects", f"SELECT o.{U} AS provid, n.permid, o.orbit_type_int, round(o.q, 6) AS q, round(o.e, 6) AS e, round(o.i, 6) AS i, round(o.h, 6) AS h FROM orbits o LEFT JOIN ni n ON n.{P} = o.{P}")
def _(t):
    return rounded(summary.boxscore_objects(t.orbits, t.ni), q=6, e=6, i=6, h=6)


FACT_SQL = f"""{CATALOG_SQL}, fact AS (SELECT provid, stn, CAST(obstime AS DATE) AS obs_date, count(*) AS n_obs, count(DISTINCT trkid) AS n_tracklets,
  bool_or(disc = '*') AS disc_flag FROM detections GROUP BY 1, 2, 3),
j AS (SELECT f.*, coalesce(c.coarse_class, 'Unclassified') AS cls, c.h, CAST(year(obs_date) AS VARCHAR) AS yr FROM fact f LEFT JOIN cat c ON c.{U} = f.provid)"""


def _fact_catalog(t):
    return summary.detection_daily(t.detections), summary.object_catalog(t.orbits, t.ni, t.obs)


@query("boxscore", f"""WITH {FACT_SQL},
cells AS (SELECT CASE WHEN grouping(yr) = 1 THEN 'Total' ELSE yr END AS time_bin, CASE WHEN grouping(cls) = 1 THEN 'total' ELSE cls END AS cls,
  count(DISTINCT provid) AS v FROM j GROUP BY CUBE (yr, cls))
SELECT time_bin, {", ".join(f"coalesce(max(v) FILTER (WHERE cls = '{c}'), 0) AS " + chr(34) + c + chr(34) for c in boxscore.class_names("coarse") + ["total"])}
FROM cells GROUP BY time_bin""")
def _(t):
    return boxscore.boxscore(*_fact_catalog(t), metric="objects", time="year", grouping="coarse")


@query("boxscore_cells_monthly", f"""WITH {FACT_SQL}
SELECT CASE WHEN grouping(m) = 1 THEN 'Total' ELSE m END AS time_bin, CASE WHEN grouping(cls) = 1 THEN 'total' ELSE cls END AS "class", CAST(sum(n_obs) AS BIGINT) AS value
FROM (SELECT *, substr(CAST(obs_date AS VARCHAR), 1, 7) AS m FROM j WHERE stn = '7') GROUP BY CUBE (m, cls)""")
def _(t):
    return boxscore.boxscore_cells(*_fact_catalog(t), metric="observations", time="month", grouping="coarse", site="7")


_BINS = {"year": "yr", "month": "substr(CAST(obs_date AS VARCHAR), 1, 7)", "date": "CAST(obs_date AS VARCHAR)",
         "lunation": "CAST(CAST(floor((epoch_us(CAST(obs_date AS TIMESTAMP)) - epoch_us(TIMESTAMP '2000-01-21 04:40:00')) / 86400000000.0 / 29.5306) AS INTEGER) AS VARCHAR)"}
_METRICS = {"observations": "CAST(sum(n_obs) AS BIGINT)", "tracklets": "CAST(sum(n_tracklets) AS BIGINT)", "objects": "count(DISTINCT provid)",
            "discoveries": "count(DISTINCT provid) FILTER (WHERE disc_flag)"}


# Every metric over every bin, and over the catalogue's own classes.
@query("boxscore_combinations", f"WITH {FACT_SQL}, g AS (SELECT j.*, coalesce({S.label('c.code')}, 'Unclassified') AS std FROM j LEFT JOIN cat c ON c.{U} = j.provid)\n" + " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, '{b}' AS bins, '{g}' AS grouping_name, CASE WHEN grouping(t) = 1 THEN 'Total' ELSE t END AS time_bin,
  CASE WHEN grouping(k) = 1 THEN 'total' ELSE k END AS "class", {e} AS value FROM (SELECT *, {x} AS t, {c} AS k FROM g) GROUP BY CUBE (t, k)"""
    for b, x in _BINS.items() for g, c in (("coarse", "cls"), ("standard", "std")) if g == "coarse" or b == "year" for m, e in _METRICS.items()))
def _(t):
    fact, catalog = _fact_catalog(t)
    parts = [boxscore.boxscore_cells(fact, catalog, metric=list(_METRICS), time=b, grouping=g).select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(b).alias("bins"), F.lit(g).alias("grouping_name"), "time_bin", "class", F.col(m).alias("value"))
                           for m in _METRICS])))
        for b in _BINS for g in ("coarse", "standard") if g == "coarse" or b == "year"]
    return reduce(DataFrame.unionByName, parts)


@query("boxscore_advanced", f"""WITH {FACT_SQL},
per AS (SELECT yr, cls, provid, any_value(h) AS h, bool_or(disc_flag) AS dsc, sum(n_obs) AS nobs FROM j GROUP BY 1, 2, 3)
SELECT yr AS time_bin, cls AS "class", count(*) AS n_objects, round(quantile_cont(h, 0.5), 4) AS median_h, count(*) FILTER (WHERE h < 22) AS n_h22,
  count(*) FILTER (WHERE h < 17.75) AS n_1km, round(sum(nobs) / count(*), 4) AS obs_per_object,
  round(1.0 - count(*) FILTER (WHERE dsc) / count(*), 4) AS others_share FROM per GROUP BY 1, 2""")
def _(t):
    return boxscore.boxscore_advanced(*_fact_catalog(t))


DISC_TABLE = f"""{CATALOG_SQL}, x AS (SELECT o.stn, {COARSE_SQL.replace('ext', 'c.ext')} AS cls, coalesce(code IN (0, 1, 2, 3), FALSE) AS neo,
  coalesce(c.earth_moid, 999) <= 0.05 AND coalesce(c.h, 99) <= 22 AS pha, c.h FROM cat c JOIN (SELECT provid, stn FROM (
   SELECT provid, stn, row_number() OVER (PARTITION BY provid ORDER BY obstime, obsid) AS rn FROM obs WHERE disc = '*' AND provid IS NOT NULL) WHERE rn = 1) o ON o.provid = c.{U})"""


def _disc_table(t):
    first = discovery.earliest_per_key(
        t.obs.where((F.col("disc") == "*") & F.col("provid").isNotNull()).select("provid", "obstime", "obsid", "stn"),
        key="provid", order="obstime", tie="obsid")
    code = F.coalesce("orbit_type_int", orbit.classify_orbit("q", "e", "i"))
    cat = t.orbits.withColumn("_c", code).select(
        F.col(U).alias("provid"), orbit.coarse_group(orbit.classify_extended("_c", "q", "e", F.col("a"))).alias("class"),
        F.coalesce(F.col("_c").isin(0, 1, 2, 3), F.lit(False)).alias("neo"), orbit.is_pha_by_moid("earth_moid", "h").alias("pha"), "h")
    return cat.join(first.select("provid", F.col("stn").alias("station_code")), "provid")


@query("discovery_stats_by_site", f"""WITH {DISC_TABLE}, k AS (SELECT CASE WHEN neo THEN 'NEO' ELSE 'Non-NEO' END AS kind, cls, stn FROM x)
SELECT kind, cls AS "class", stn AS station_code, count(*) AS n FROM k GROUP BY 1, 2, 3
UNION ALL SELECT kind, cls, 'ALL', count(*) FROM k GROUP BY 1, 2
UNION ALL SELECT kind, 'subtotal', stn, count(*) FROM k GROUP BY 1, 3
UNION ALL SELECT kind, 'subtotal', 'ALL', count(*) FROM k GROUP BY 1
UNION ALL SELECT 'TOTAL', 'subtotal', stn, count(*) FROM k GROUP BY 3
UNION ALL SELECT 'TOTAL', 'subtotal', 'ALL', count(*) FROM k""")
def _(t):
    return boxscore.discovery_stats_by_site(_disc_table(t))


@query("discovery_subsets_by_site", f"""WITH {DISC_TABLE}
SELECT stn AS station_code, count(*) FILTER (WHERE pha) AS phas, count(*) FILTER (WHERE h < 17.75) AS km1, count(*) FILTER (WHERE h <= 22) AS m140 FROM x WHERE neo GROUP BY 1
UNION ALL SELECT 'ALL', count(*) FILTER (WHERE pha), count(*) FILTER (WHERE h < 17.75), count(*) FILTER (WHERE h <= 22) FROM x WHERE neo""")
def _(t):
    return boxscore.discovery_subsets_by_site(_disc_table(t))


def _yearly(t):
    """Year-block rows straight from the order table: code, year_label, counts."""
    k = F.col("o_orderkey")
    code = F.when(k % 9 == 0, F.lit("G96")).when(k % 9 == 1, F.lit("703")).when(k % 9 == 2, F.lit("W68")) \
        .otherwise(F.concat(F.lit("S"), (F.col("o_custkey") % 50).cast("string")))
    year = F.year("o_orderdate") + F.when(F.col("o_custkey") % 50 < 20, F.lit(-8)).otherwise(F.lit(20))
    label = F.when(F.col("o_custkey") % 97 == 0, F.lit("<1971")).otherwise(year.cast("string"))
    return t.orders.groupBy(code.alias("code"), label.alias("year_label")).agg(
        F.count("*").alias("nea_all"), *[F.sum((k % (i + 2) == 0).cast("bigint")).alias(c)
                                        for i, c in enumerate(boxscore.COUNTS) if c != "nea_all"])


YEARLY_SQL = """yb AS (SELECT CASE o_orderkey % 9 WHEN 0 THEN 'G96' WHEN 1 THEN '703' WHEN 2 THEN 'W68' ELSE 'S' || (o_custkey % 50) END AS code,
  CASE WHEN o_custkey % 97 = 0 THEN '<1971' ELSE CAST(year(o_orderdate) + CASE WHEN o_custkey % 50 < 20 THEN -8 ELSE 20 END AS VARCHAR) END AS year_label,
  count(*) AS nea_all, """ + ", ".join(
    f"count(*) FILTER (WHERE o_orderkey % {i + 2} = 0) AS {c}" for i, c in enumerate(boxscore.COUNTS) if c != "nea_all") + """
  FROM orders GROUP BY 1, 2)"""
_YKEY = "CASE WHEN {0} LIKE '<%' THEN '0000' ELSE {0} END"
TOTALS_SQL = f"""{YEARLY_SQL}, tot AS (SELECT code, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in boxscore.COUNTS)},
  arg_min(year_label, {_YKEY.format('year_label')}) AS first_year, arg_max(year_label, {_YKEY.format('year_label')}) AS last_year FROM yb GROUP BY code)"""
PROJECT_SQL = f"""{TOTALS_SQL}, mx AS (SELECT max(TRY_CAST(year_label AS INTEGER)) AS m FROM yb),
ind AS (SELECT DISTINCT code FROM yb, mx WHERE TRY_CAST(year_label AS INTEGER) > m - 3 AND nea_all > 10),
lab AS (SELECT *, CASE WHEN code IN ('G96', '703') THEN 'Catalina Survey' WHEN code = 'W68' THEN 'ATLAS'
  WHEN code IN (SELECT code FROM ind) THEN 'Independent Surveys' WHEN last_year LIKE '<%' OR TRY_CAST(last_year AS INTEGER) <= 1999 THEN 'Historical' ELSE 'Others' END AS project FROM tot)"""


@query("station_totals", f"WITH {TOTALS_SQL} SELECT * FROM tot")
def _(t):
    return boxscore.station_totals(_yearly(t))


@query("project_rollup", f"""WITH {PROJECT_SQL}
SELECT project, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in boxscore.COUNTS)}, arg_min(first_year, {_YKEY.format('first_year')}) AS first_year,
  arg_max(last_year, {_YKEY.format('last_year')}) AS last_year, string_agg(code, ',' ORDER BY code) AS stations FROM lab GROUP BY project""")
def _(t):
    return boxscore.project_rollup(_yearly(t))


@query("year_label_order", f"WITH {YEARLY_SQL} SELECT code, year_label, nea_all FROM yb ORDER BY {_YKEY.format('year_label')}, code LIMIT 40")
def _(t):
    return _yearly(t).select("code", "year_label", "nea_all").orderBy(year_label_key("year_label"), "code").limit(40)


@query("year_label_order_all", f"WITH {YEARLY_SQL} SELECT code, year_label, nea_all, row_number() OVER (ORDER BY {_YKEY.format('year_label')}, code) AS position FROM yb")
def _(t):
    d = _yearly(t).select("code", "year_label", "nea_all", year_label_key("year_label").alias("_y"))
    return with_position(d, order=["_y", "code"], bucket=F.col("_y").cast("int")).select("code", "year_label", "nea_all", "position").orderBy("position")


@query("projects_by_first_year", f"""WITH {PROJECT_SQL}
SELECT project, arg_min(first_year, {_YKEY.format('first_year')}) AS first_year, CAST(sum(nea_all) AS BIGINT) AS nea_all FROM lab GROUP BY project
ORDER BY {_YKEY.format(f"arg_min(first_year, {_YKEY.format('first_year')})")}, nea_all DESC LIMIT 2""")
def _(t):
    return boxscore.sort_projects(boxscore.project_rollup(_yearly(t)), "first").select(
        "project", "first_year", "nea_all").limit(2)


@query("projects_by_first_year_all", f"""WITH {PROJECT_SQL}
SELECT project, arg_min(first_year, {_YKEY.format('first_year')}) AS first_year, CAST(sum(nea_all) AS BIGINT) AS nea_all FROM lab GROUP BY project""")
def _(t):
    return boxscore.sort_projects(boxscore.project_rollup(_yearly(t)), "first").select("project", "first_year", "nea_all")


_PROJECT_KEYS = {"total": "nea_all DESC", "pha": "pha DESC", "1km": "nea_1km DESC", "140m": "nea_h22 DESC",
                 "first": f"coalesce({_YKEY.format('first_year')}, '9999')", "last": f"coalesce({_YKEY.format('last_year')}, '0000')"}


@query("projects_by_every_key", f"""WITH {PROJECT_SQL},
p AS (SELECT project, CAST(sum(nea_all) AS BIGINT) AS nea_all, CAST(sum(pha) AS BIGINT) AS pha, CAST(sum(nea_1km) AS BIGINT) AS nea_1km, CAST(sum(nea_h22) AS BIGINT) AS nea_h22,
  arg_min(first_year, {_YKEY.format('first_year')}) AS first_year, arg_max(last_year, {_YKEY.format('last_year')}) AS last_year FROM lab GROUP BY project)
""" + " UNION ALL ".join(f"SELECT '{k}' AS sorted_by, project, CAST(row_number() OVER (ORDER BY {e}, nea_all DESC, project) AS INTEGER) AS position FROM p" for k, e in _PROJECT_KEYS.items()))
def _(t):
    projects = boxscore.project_rollup(_yearly(t))
    parts = [boxscore.with_project_position(projects, k).select(F.lit(k).alias("sorted_by"), "project", "position") for k in boxscore.SORTS]
    return reduce(DataFrame.unionByName, parts)


@query("year_change", f"""WITH {YEARLY_SQL}, c AS (SELECT code, coalesce(CAST(sum(nea_all) FILTER (WHERE year_label = '2018') AS BIGINT), 0) AS n_cur,
  coalesce(CAST(sum(nea_all) FILTER (WHERE year_label = '2017') AS BIGINT), 0) AS n_prev FROM yb GROUP BY code)
SELECT code, n_cur, n_prev, CASE WHEN n_cur + n_prev < 5 THEN '' WHEN n_prev = 0 THEN CASE WHEN n_cur > 0 THEN '+' ELSE '' END
  WHEN n_cur / (200 / 365.0) / n_prev > 1.15 THEN '+' WHEN n_cur / (200 / 365.0) / n_prev < 0.85 THEN '-' ELSE '' END AS change FROM c""")
def _(t):
    return boxscore.year_change(_yearly(t), label="code", year=2018, day_of_year=200)


@query("count_comparison", f"""WITH {YEARLY_SQL}, l AS (SELECT code, CAST(sum(nea_all) AS BIGINT) AS n_listed FROM yb WHERE code <> 'S3' GROUP BY code),
c AS (SELECT code, CAST(sum(nea_all) FILTER (WHERE year_label <> '2018') AS BIGINT) + length(code) * 3 - 6 AS n_counted FROM yb WHERE code NOT IN ('S4', 'S24') GROUP BY code)
SELECT coalesce(l.code, c.code) AS code, n_listed, n_counted, CASE WHEN n_listed IS NULL THEN 'missing'
  WHEN n_counted IS NULL OR (n_counted = 0 AND n_listed > 0) THEN '0' WHEN n_listed = n_counted THEN ''
  WHEN abs(n_counted - n_listed) / n_listed < 0.01 THEN ''
  WHEN n_counted > n_listed THEN CASE WHEN n_counted / n_listed > 1.25 AND n_counted - n_listed >= 5 THEN '>>>' WHEN n_counted / n_listed > 1.05 AND n_counted - n_listed >= 3 THEN '>>' ELSE '>' END
  ELSE CASE WHEN n_counted / n_listed < 0.75 AND n_listed - n_counted >= 5 THEN '<<<' WHEN n_counted / n_listed < 0.95 AND n_listed - n_counted >= 3 THEN '<<' ELSE '<' END END AS indicator
FROM l FULL JOIN c ON l.code = c.code""")
def _(t):
    y = _yearly(t)
    listed = y.where(F.col("code") != "S3").groupBy("code").agg(F.sum("nea_all").alias("n"))
    counted = y.where(~F.col("code").isin("S4", "S24")).groupBy("code").agg(
        (F.sum(F.when(F.col("year_label") != "2018", F.col("nea_all"))) + F.length(F.col("code")) * 3 - 6).alias("n"))
    return boxscore.count_comparison(listed, counted)


MODEL_SQL = """model AS (SELECT * FROM (VALUES """ + ", ".join(
    f"({h}::DOUBLE, {n}::DOUBLE)" for h, n in {
        15.0: 50, 16.0: 130, 17.0: 430, 17.75: 936, 18.0: 1100, 19.0: 2600, 19.75: 4550, 20.0: 5500, 20.37: 7300, 21.0: 11000,
        21.75: 16000, 22.0: 20000, 22.25: 24000, 22.75: 30000, 23.0: 38000, 24.0: 130000, 24.75: 290000, 25.0: 380000,
        25.37: 500000, 26.0: 1200000, 27.0: 3800000, 27.75: 9120000, 28.0: 12000000}.items()) + """) m(h2, n_cum)),
bins AS (SELECT lag(h2) OVER (ORDER BY h2) AS h1, h2, n_cum, lag(n_cum) OVER (ORDER BY h2) AS n_before FROM model)"""


@query("size_completeness", f"""WITH {MODEL_SQL}, n AS (SELECT h1, h2, n_cum, (SELECT count(*) FROM orbits o WHERE o.h < b.h2) AS discovered FROM bins b WHERE h1 IS NOT NULL)
SELECT h1, h2, h2 AS h_plot, discovered, n_cum AS model, round(100.0 * discovered / n_cum, 4) AS completeness FROM n""")
def _(t):
    return boxscore.size_completeness(t.orbits, boxscore.population_model(t.spark))


@query("size_completeness_differential", f"""WITH {MODEL_SQL}, n AS (SELECT *, (SELECT count(*) FROM orbits o WHERE o.h < b.h2 AND o.h >= b.h1) AS discovered FROM bins b WHERE h1 IS NOT NULL)
SELECT h1, h2, (h1 + h2) / 2 AS h_plot, discovered, n_cum - n_before AS model, round(100.0 * discovered / (n_cum - n_before), 4) AS completeness FROM n""")
def _(t):
    return boxscore.size_completeness(t.orbits, boxscore.population_model(t.spark), mode="differential")


@query("population_model_at", f"""WITH {MODEL_SQL}
SELECT o.id, round(n_before + (o.h - h1) / (h2 - h1) * (n_cum - n_before), 4) AS model_n FROM orbits o LEFT JOIN bins b ON o.h >= b.h1 AND o.h < b.h2""")
def _(t):
    return boxscore.model_at(t.orbits.select("id", "h"), boxscore.population_model(t.spark)).select("id", "model_n")


# -- windows and ranking ---------------------------------------------------------------------

@query("top_n_per_group", """
SELECT mo, id FROM (SELECT CAST(date_trunc('month', obstime) AS DATE) AS mo, id, row_number() OVER (PARTITION BY date_trunc('month', obstime) ORDER BY value DESC, id) AS rn FROM detections) WHERE rn <= 10""")
def _(t):
    d = t.detections.select(F.trunc(F.col("obstime").cast("date"), "month").alias("mo"), "id", "value")
    return top_n_per_group(d, group=["mo"], order=[F.desc("value"), "id"], n=10).select("mo", "id")


@query("period_change", """
WITH m AS (SELECT CAST(date_trunc('month', obstime) AS DATE) AS mo, count(*) AS n, avg(value) AS mean FROM detections GROUP BY 1)
SELECT mo, n, round(mean, 6) AS mean, round(lag(mean) OVER (ORDER BY mo), 6) AS prev_mean, round(mean - lag(mean) OVER (ORDER BY mo), 6) AS delta FROM m""")
def _(t):
    return period_change(t.detections, time="obstime", value="value")


@query("share_of_total", "SELECT stn, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM obs GROUP BY stn")
def _(t):
    return share_of_total(t.obs.groupBy("stn").agg(F.count("*").alias("n")), value="n")


@query("cumulative_counts", "SELECT stn, y, n, CAST(sum(n) OVER (PARTITION BY stn ORDER BY y) AS BIGINT) AS cumulative FROM (SELECT stn, CAST(year(obstime) AS INTEGER) AS y, count(*) AS n FROM detections GROUP BY 1, 2)")
def _(t):
    d = t.detections.groupBy("stn", F.year("obstime").alias("y")).agg(F.count("*").alias("n"))
    return cumulative_counts(d, by=["stn"], order="y", value="n")


# Which rows a seed picks is Spark's hash; that they are rows of the table, as many as asked and no other ones next time, is SQL's.
@query("sample_rows", "SELECT least(100, count(*)) AS n, least(100, count(*)) AS n_distinct, least(100, count(*)) AS n_in_table, least(100, count(*)) AS n_again FROM obs")
def _(t):
    obs = t.obs.select("id", "stn")
    one, again = sample_rows(obs, n=100, key="id", seed=7), sample_rows(obs.repartition(7), n=100, key="id", seed=7)
    both = one.select("id", "stn", F.lit(0).alias("k")).unionByName(obs.select("id", "stn", F.lit(1).alias("k"))).unionByName(again.select("id", "stn", F.lit(2).alias("k")))
    seen = both.groupBy("id", "stn").agg(*[F.sum(F.when(F.col("k") == k, 1).otherwise(0)).alias(f"k{k}") for k in range(3)])
    return seen.where("k0 > 0").agg(F.sum("k0").alias("n"), F.count("*").alias("n_distinct"), F.sum(F.when(F.col("k1") > 0, 1).otherwise(0)).alias("n_in_table"),
                                    F.sum(F.when(F.col("k2") > 0, 1).otherwise(0)).alias("n_again"))


@query("enum_order", """SELECT id, orbit_type_int FROM orbits WHERE orbit_type_int IS NOT NULL ORDER BY CASE orbit_type_int WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2
 WHEN 3 THEN 3 WHEN 10 THEN 5 WHEN 11 THEN 6 WHEN 20 THEN 9 ELSE 20 END, orbit_type_int, id LIMIT 30""")
def _(t):
    d = t.orbits.where(F.col("orbit_type_int").isNotNull()).select("id", "orbit_type_int")
    return d.orderBy(orbit.orbit_rank("orbit_type_int"), "orbit_type_int", "id").limit(30)


@query("enum_order_all", """SELECT id, orbit_type_int, row_number() OVER (ORDER BY CASE orbit_type_int WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2
 WHEN 3 THEN 3 WHEN 10 THEN 5 WHEN 11 THEN 6 WHEN 20 THEN 9 ELSE 20 END, orbit_type_int NULLS FIRST, id) AS position FROM orbits""")
def _(t):
    d = t.orbits.select("id", "orbit_type_int", orbit.orbit_rank("orbit_type_int").alias("_r"), F.coalesce("orbit_type_int", F.lit(-1)).alias("_c"))
    return enum_order(with_position(d, order=["_r", "_c", "id"], bucket=F.col("_r") * 1000 + F.col("_c")), code="orbit_type_int").select("id", "orbit_type_int", "position")
