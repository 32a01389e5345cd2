"""Apparitions, timelines and sky position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from asterion.functions import sky
from asterion.functions.timeconv import days_between
from asterion.operators import apparition as A, skytime, timeline

from . import oracle_parts as S
from .q_discovery import ALT_SQL, SUN_SQL, rounded
from .registry import query

KEYS_SQL = """keys AS (SELECT d.unpacked_desig, d.obstime AS disc_obstime, d.stn AS disc_stn, l.number AS permid, l.listed_as AS provid
  FROM firsts d JOIN objs l USING (unpacked_desig)),
rows_in AS (SELECT k.unpacked_desig AS designation, k.disc_obstime, k.disc_stn, o.stn, o.obstime, o.trkid FROM keys k JOIN obs o ON o.permid = k.permid OR o.provid = k.provid
  WHERE o.obstime BETWEEN k.disc_obstime - INTERVAL {days} DAY AND k.disc_obstime + INTERVAL {days} DAY)"""


def apparition_sql(days=200):
    return S.chain("iau", stats=False) + ",\n" + KEYS_SQL.format(days=days)


REACH_SQL = apparition_sql() + """, reach AS (SELECT designation, stn AS station_code, disc_obstime, disc_stn, min(obstime) AS first_obs,
  min(obstime) FILTER (WHERE obstime >= disc_obstime) AS first_post_disc FROM rows_in GROUP BY 1, 2, 3, 4)"""


def disc(t):
    return A.discoveries(t.orbits, t.ni, t.obs)


@query("apparition_reach", REACH_SQL + " SELECT * FROM reach")
def _(t):
    return A.apparition_reach(disc(t), t.obs)


@query("apparition_reach_short", apparition_sql(5) + """ SELECT designation, stn AS station_code, disc_obstime, disc_stn, min(obstime) AS first_obs,
  min(obstime) FILTER (WHERE obstime >= disc_obstime) AS first_post_disc FROM rows_in GROUP BY 1, 2, 3, 4""")
def _(t):
    return A.apparition_reach(disc(t), t.obs, days=5)


TRK_SQL = apparition_sql() + f""", trk AS (SELECT designation, nullif(trkid, '') AS trkid, CASE WHEN nullif(trkid, '') IS NULL THEN stn || '|' || CAST(obstime AS DATE) END AS night,
  min(stn) AS station_code, 'Others' AS project, min(obstime) AS first_obs, max(obstime) AS last_obs, count(*) AS nobs, disc_obstime, disc_stn,
  round((epoch_us(min(obstime)) - epoch_us(disc_obstime)) / {S.DAY_US}, 6) AS days_from_disc FROM rows_in GROUP BY designation, 2, 3, disc_obstime, disc_stn)"""


def tracklets(t):
    return A.apparition_tracklets(disc(t), t.obs)


@query("apparition_tracklets", TRK_SQL + " SELECT * EXCLUDE (night) FROM trk")
def _(t):
    return tracklets(t)


SETS_SQL = TRK_SQL + ", sets AS (SELECT DISTINCT designation, station_code AS survey FROM trk WHERE days_from_disc >= 0)"


def sets(t):
    return A.survey_sets(tracklets(t), survey="station_code")


@query("survey_sets", SETS_SQL + " SELECT * FROM sets")
def _(t):
    return sets(t)


@query("survey_sets_eligible", TRK_SQL + " SELECT DISTINCT designation, station_code AS survey FROM trk WHERE designation LIKE 'U1%'")
def _(t):
    trk = tracklets(t)
    return A.survey_sets(trk, survey="station_code", post_discovery_only=False,
                         eligible=trk.where(F.col("designation").startswith("U1")).select("designation"))


@query("venn_regions", SETS_SQL + """, f AS (SELECT designation, bool_or(survey = 'click') AS in_1, bool_or(survey = 'error') AS in_2, bool_or(survey = 'view') AS in_3 FROM sets
  WHERE survey IN ('click', 'error', 'view') GROUP BY 1) SELECT in_1, in_2, in_3, count(*) AS n FROM f GROUP BY 1, 2, 3""")
def _(t):
    return A.venn_regions(sets(t), surveys=["click", "error", "view"])


@query("pairwise_codetection", SETS_SQL + """, tot AS (SELECT survey, count(*) AS n FROM sets GROUP BY 1)
SELECT a.survey AS survey_i, b.survey AS survey_j, count(*) AS n_both, t.n AS n_i, round(100.0 * count(*) / t.n, 2) AS pct
FROM sets a JOIN sets b USING (designation) JOIN tot t ON t.survey = a.survey GROUP BY a.survey, b.survey, t.n""")
def _(t):
    return A.pairwise_codetection(sets(t))


@query("station_codetection", """WITH sets AS (SELECT DISTINCT provid AS designation, stn AS survey FROM detections WHERE CAST(stn AS INTEGER) <= 100), tot AS (SELECT survey, count(*) AS n FROM sets GROUP BY 1)
SELECT a.survey AS survey_i, b.survey AS survey_j, count(*) AS n_both, t.n AS n_i, round(100.0 * count(*) / t.n, 2) AS pct
FROM sets a JOIN sets b USING (designation) JOIN tot t ON t.survey = a.survey GROUP BY a.survey, b.survey, t.n""")
def _(t):
    seen = t.detections.select(F.col("provid").alias("designation"), F.col("stn").alias("survey")).distinct()
    return A.pairwise_codetection(seen, surveys=[str(k) for k in range(101)])


@query("survey_reach", SETS_SQL + " SELECT survey, count(*) AS n_objects FROM sets GROUP BY 1")
def _(t):
    return A.survey_reach(sets(t))


@query("multiplicity_summary", SETS_SQL + """, k AS (SELECT designation, count(*) AS k FROM sets GROUP BY 1)
SELECT count(*) AS n_objects, count(*) FILTER (WHERE k = 1) AS seen_by_1, count(*) FILTER (WHERE k = 2) AS seen_by_2, count(*) FILTER (WHERE k >= 3) AS seen_by_3plus,
  round(avg(k), 4) AS mean_surveys, quantile_cont(k, 0.5) AS median_surveys FROM k""")
def _(t):
    return A.multiplicity_summary(sets(t))


RESP_SQL = REACH_SQL + f""", resp AS (SELECT designation, disc_obstime, disc_stn AS disc_project, station_code AS project, (epoch_us(min(first_post_disc)) - epoch_us(disc_obstime)) / {S.DAY_US} AS days
  FROM reach WHERE first_post_disc IS NOT NULL AND station_code <> disc_stn GROUP BY 1, 2, 3, 4)"""


def responses(t):
    return A.response_times(A.apparition_reach(disc(t), t.obs), survey=F.col)


@query("response_times", RESP_SQL + " SELECT * REPLACE (round(days, 6) AS days) FROM resp")
def _(t):
    return rounded(responses(t), days=6)


@query("response_summary", RESP_SQL + """
SELECT disc_project, project, count(*) AS n, round(quantile_cont(days, 0.5), 6) AS p50, round(quantile_cont(days, 0.9), 6) AS p90, round(min(days), 6) AS min_days, round(max(days), 6) AS max_days FROM resp GROUP BY 1, 2""")
def _(t):
    return A.response_summary(responses(t), by=["disc_project", "project"])


@query("response_by_year", RESP_SQL + """
SELECT CAST(year(disc_obstime) AS INTEGER) AS disc_year, project, count(*) AS n, round(quantile_cont(days, 0.5), 6) AS p50, round(quantile_cont(days, 0.9), 6) AS p90, round(min(days), 6) AS min_days, round(max(days), 6) AS max_days FROM resp GROUP BY 1, 2""")
def _(t):
    d = responses(t).withColumn("disc_year", F.year("disc_obstime"))
    return A.response_summary(d, by=["disc_year", "project"])


@query("response_curve", RESP_SQL + """, n AS (SELECT project, CAST(floor(days) AS INTEGER) AS day, count(*) AS k FROM resp WHERE days <= 200 GROUP BY 1, 2)
SELECT project, day, CAST(sum(k) OVER (PARTITION BY project ORDER BY day) AS BIGINT) AS n_so_far,
  round(100.0 * sum(k) OVER (PARTITION BY project ORDER BY day) / sum(k) OVER (PARTITION BY project), 2) AS pct FROM n""")
def _(t):
    return A.response_curve(responses(t))


@query("site_followup_volume", TRK_SQL + """ SELECT station_code, count(*) AS n_tracklets, CAST(sum(nobs) AS BIGINT) AS n_observations, count(DISTINCT designation) AS n_objects FROM trk
WHERE station_code <> disc_stn AND year(first_obs) BETWEEN 2020 AND 2024 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def _(t):
    return A.site_followup_volume(tracklets(t), years=(2020, 2024))


_VOLUME = {"tracklets": "n_tracklets", "observations": "n_observations", "objects": "n_objects"}


@query("followup_volume_controls", TRK_SQL + " " + " UNION ALL ".join(
    f"""SELECT '{scope}' AS scope, '{metric}' AS metric, station_code, count(*) AS n_tracklets, CAST(sum(nobs) AS BIGINT) AS n_observations, count(DISTINCT designation) AS n_objects,
  row_number() OVER (ORDER BY {dict(tracklets='count(*)', observations='sum(nobs)', objects='count(DISTINCT designation)')[metric]} DESC, station_code) AS position
FROM trk WHERE {cond} AND abs(days_from_disc) <= 9.5 AND days_from_disc >= 0 GROUP BY station_code"""
    for scope, cond in (("others", "station_code <> disc_stn"), ("own", "station_code = disc_stn"), ("all", "TRUE")) for metric in _VOLUME))
def _(t):
    d = tracklets(t)
    parts = [A.site_followup_volume(d, n=None, metric=m, within_days=9.5, precoveries=False, scope=s).select(
        F.lit(s).alias("scope"), F.lit(m).alias("metric"), "*", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(c), "station_code")).alias("position"))
        for s in ("others", "own", "all") for m, c in _VOLUME.items()]
    return reduce(DataFrame.unionByName, parts)


@query("precovery_counts", TRK_SQL + " SELECT project, count(*) FILTER (WHERE days_from_disc < 0) AS precovery, count(*) FILTER (WHERE days_from_disc >= 0) AS follow_up FROM trk GROUP BY 1")
def _(t):
    return A.precovery_counts(tracklets(t))


@query("exchange_tracklets", """
WITH x AS (SELECT id, CAST(obstime AS VARCHAR) AS t, trkid, stn, mag, band, nullif(ref, '') AS ref, disc FROM obs)
SELECT coalesce(nullif(trkid, ''), t) AS "trkID", arg_min(stn, (t, stn)) AS stn, 'Others' AS project, min(t) AS first_obs, max(t) AS last_obs, count(*) AS n_obs,
  round(quantile_cont(mag, 0.5), 1) AS mag_median, coalesce(string_agg(DISTINCT ref, ',' ORDER BY ref), '') AS refs, bool_or(coalesce(disc = '*', FALSE)) AS is_discovery FROM x GROUP BY 1""")
def _(t):
    d = t.obs.select(F.col("trkid").alias("trkID"), "stn", F.col("obstime").cast("string").alias("obsTime"), "mag", "band", "ref", "disc")
    return A.tracklet_summaries(d).drop("band").withColumn("refs", F.array_join("refs", ","))


# -- arcs, grids and sites --------------------------------------------------------------------

def arcs_sql(gap, wrap):
    jump = "OR abs(fmod(ra - 180 + 180 + 360, 360) - 180 - (fmod(pra - 180 + 180 + 360, 360) - 180)) > 180" if wrap else ""
    return f"""WITH l AS (SELECT {S.KEY} AS k, obsid, obstime, ra, lag(obstime) OVER w AS pt, lag(ra) OVER w AS pra FROM obs WHERE {S.KEY} IS NOT NULL WINDOW w AS (PARTITION BY {S.KEY} ORDER BY obstime, obsid)),
f AS (SELECT *, CASE WHEN (epoch_us(obstime) - epoch_us(pt)) / {S.DAY_US} > {gap} {jump} THEN 1 ELSE 0 END AS new FROM l),
a AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY obstime, obsid) AS arc_id FROM f)
SELECT k AS primary_desig, CAST(arc_id AS BIGINT) AS arc_id, min(obstime) AS start, max(obstime) AS "end", count(*) AS n FROM a GROUP BY 1, 2"""


@query("segment_arcs", arcs_sql(1.5, False))
def _(t):
    from asterion.operators.filters import with_object_key
    return timeline.segment_arcs(with_object_key(t.obs), key="primary_desig", gap_days=1.5)


@query("segment_arcs_wrapped", arcs_sql(1.5, True))
def _(t):
    from asterion.operators.filters import with_object_key
    return timeline.segment_arcs(with_object_key(t.obs), key="primary_desig", gap_days=1.5, ra="ra")


@query("nearest_in_time", """
WITH g AS (SELECT stn, TIMESTAMP '2024-01-01 12:00:00' + d * INTERVAL 1 DAY AS obstime FROM (SELECT DISTINCT stn FROM obs) s, range(0, 31) r(d)),
x AS (SELECT g.stn, g.obstime, (SELECT max((o.obstime, o.obsid)) FROM obs o WHERE o.stn = g.stn AND o.obstime < g.obstime) AS b,
  (SELECT min((o.obstime, o.obsid)) FROM obs o WHERE o.stn = g.stn AND o.obstime >= g.obstime) AS a FROM g)
SELECT stn, obstime, CASE WHEN b IS NULL THEN a[1] WHEN a IS NULL THEN b[1] WHEN obstime - b[1] < a[1] - obstime THEN b[1] ELSE a[1] END AS nearest_obstime FROM x""")
def _(t):
    obs = t.obs
    grid = obs.select("stn").distinct().select("stn", F.explode(F.sequence(
        F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"), F.lit("2024-01-31 12:00:00").cast("timestamp_ntz"),
        F.expr("INTERVAL 1 DAY"))).alias("obstime"))
    return timeline.nearest_in_time(grid, obs, key="stn", time="obstime", columns=["ra"]).select(
        "stn", "obstime", "nearest_obstime")


@query("observability_segments")
def _(t):
    from asterion.operators.filters import with_object_key
    return timeline.observability_segments(with_object_key(t.obs), key="primary_desig", step_days=3)


@query("site_groups", """WITH top AS (SELECT stn FROM obs GROUP BY stn ORDER BY count(*) DESC, stn LIMIT 3)
SELECT id, CASE WHEN stn IN (SELECT stn FROM top) THEN stn ELSE 'Others' END AS site_group FROM obs""")
def _(t):
    return timeline.site_groups(t.obs, top_n=3).select("id", "site_group")


MEEUS_SQL = """sm AS (SELECT *, radians(l0 + (1.914602 - 0.004817 * c - 0.000014 * c * c) * sin(m) + (0.019993 - 0.000101 * c) * sin(2 * m) + 0.000289 * sin(3 * m)) AS lon, radians(23.43929111 - 0.0130041667 * c) AS eps FROM (
  SELECT *, 280.46646 + 36000.76983 * c + 0.0003032 * c * c AS l0, radians(357.52911 + 35999.05029 * c - 0.0001537 * c * c) AS m FROM (
    SELECT *, (floor(epoch_us(obstime) / 1000000.0) / 86400.0 + 2440587.5 - 2451545.0) / 36525.0 AS c FROM obs)))"""
_SEP = "degrees(acos(greatest(-1.0, least(1.0, sin(radians(dec)) * sin({d}) + cos(radians(dec)) * cos({d}) * cos(radians(ra) - {r})))))"
_MEEUS_ELONG = _SEP.format(d="asin(sin(eps) * sin(lon))", r="atan2(cos(eps) * sin(lon), cos(lon))")


@query("observation_history", f"""WITH {MEEUS_SQL} SELECT obstime, stn, round(ra, 6) AS ra, round({_MEEUS_ELONG}, 6) AS elong,
  round(mag + CASE WHEN band IS NULL THEN -0.8 ELSE {S.BAND} END, 6) AS v_mag, coalesce(band, '') AS band_norm FROM sm WHERE permid = '3'""")
def _(t):
    return rounded(timeline.observation_history(t.obs, permid="3").select("obstime", "stn", "ra", "elong", "v_mag", "band_norm"),
                   ra=6, elong=6, v_mag=6)


@query("observation_histories", f"""WITH {MEEUS_SQL} SELECT obstime, stn, round({_MEEUS_ELONG}, 6) AS elong FROM sm""")
def _(t):
    return rounded(timeline.history_columns(t.obs).select("obstime", "stn", "elong"), elong=6)


@query("carry_forward", """
SELECT conv_id, turn, last_value(h IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS header_filled FROM (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN substr(text, 1, 10) END AS h FROM conversations)""")
def _(t):
    d = t.conversations.select("conv_id", "turn", F.when(F.col("role") == "user", F.substring("text", 1, 10)).alias("header"))
    return timeline.carry_forward(d, keys=["conv_id"], position="turn", value="header").select("conv_id", "turn", "header_filled")


# -- Sun and Moon -----------------------------------------------------------------------------

def daily_sun_sql(model):
    c = "(CAST(d AS DATE) - DATE '2000-01-01') / 36525.0"
    if model == "histogram":
        lon = f"280.466 + 36000.77 * {c} + 1.915 * sin(radians(357.529 + 35999.05 * {c}))"
        eps = f"23.439 - 0.013 * {c}"
    else:
        lon = (f"280.46646 + 36000.76983 * {c} + (1.914602 - 0.004817 * {c}) * sin(radians(357.52911 + 35999.05029 * {c}))"
               f" + 0.019993 * sin(2 * radians(357.52911 + 35999.05029 * {c}))")
        eps = f"23.439291 - 0.0130042 * {c}"
    return f"""sp AS (SELECT CAST(d AS DATE) AS obs_date, fmod(degrees(atan2(cos(radians({eps})) * sin(radians({lon})), cos(radians({lon})))) + 360, 360) AS sun_ra,
   degrees(asin(sin(radians({eps})) * sin(radians({lon})))) AS sun_dec FROM generate_series(DATE '2024-01-03', DATE '2024-01-27', INTERVAL 1 DAY) g(d))"""


SIGNED = """CASE WHEN fmod(ra - sun_ra + 360, 360) <= 180 THEN 1 ELSE -1 END * degrees(acos(greatest(-1.0, least(1.0,
   sin(radians(dec)) * sin(radians(sun_dec)) + cos(radians(dec)) * cos(radians(sun_dec)) * cos(radians(ra - sun_ra))))))"""
_RANGE = "o.stn = 'click' AND o.obstime >= '2024-01-03' AND o.obstime < '2024-01-28'"


@query("solar_elongation_histogram", f"""WITH {daily_sun_sql('histogram')},
h AS (SELECT CAST(floor({SIGNED} / 5) AS INTEGER) AS b, count(*) AS n_obs FROM obs o JOIN sp ON sp.obs_date = CAST(o.obstime AS DATE) WHERE {_RANGE} GROUP BY 1),
p AS (SELECT b, n_obs, round(100.0 * n_obs / sum(n_obs) OVER (), 2) AS bin_pct FROM h)
SELECT CASE WHEN b >= 0 THEN lpad(CAST(b * 5 AS VARCHAR), 4, ' ') || '° to ' || lpad(CAST((b + 1) * 5 AS VARCHAR), 4, ' ') || '° E'
  ELSE lpad(CAST((b + 1) * -5 AS VARCHAR), 4, ' ') || '° to ' || lpad(CAST(b * -5 AS VARCHAR), 4, ' ') || '° W' END AS bin_label, n_obs, bin_pct, round(sum(bin_pct) OVER (ORDER BY b), 2) AS cum_pct FROM p""")
def _(t):
    return skytime.solar_elongation_histogram(t.obs, station="click", start="2024-01-03", end="2024-01-27")


@query("solar_elongation_stats", f"""WITH {daily_sun_sql('stats')}, x AS (SELECT {SIGNED} AS s FROM obs o JOIN sp ON sp.obs_date = CAST(o.obstime AS DATE) WHERE {_RANGE})
SELECT 'click' AS station_code, DATE '2024-01-03' AS start_date, DATE '2024-01-27' AS end_date, count(*) AS total_observations, round(min(s), 2) AS min_signed_elong, round(max(s), 2) AS max_signed_elong,
  round(avg(s), 2) AS mean_signed_elong, round(quantile_cont(s, 0.5), 2) AS median_signed_elong, count(*) FILTER (WHERE s > 0) AS east_count, count(*) FILTER (WHERE s < 0) AS west_count FROM x""")
def _(t):
    return skytime.solar_elongation_stats(t.obs, station="click", start="2024-01-03", end="2024-01-27")


@query("daily_sun_join", f"""WITH {daily_sun_sql('histogram')} SELECT id, obs_date, round(sun_ra, 6) AS sun_ra, round(sun_dec, 6) AS sun_dec FROM obs o JOIN sp ON sp.obs_date = CAST(o.obstime AS DATE)
WHERE o.obstime >= '2024-01-03' AND o.obstime < '2024-01-28'""")
def _(t):
    return rounded(skytime.daily_sun_join(t.obs, start="2024-01-03", end="2024-01-27").select("id", "obs_date", "sun_ra", "sun_dec"),
                   sun_ra=6, sun_dec=6)


@query("sun_altitude", f"""WITH base AS (SELECT o.id, o.obstime, o.ra, o.dec, c.longitude, atan2(c.rhosinphi, c.rhocosphi) AS lat FROM obs o JOIN obscodes c ON c.obscode = o.stn), {SUN_SQL}
SELECT id, round(sun_ra, 6) AS sun_ra, round(sun_dec, 6) AS sun_dec, round({ALT_SQL}, 5) AS sun_alt, round({_SEP.format(d='radians(sun_dec)', r='radians(sun_ra)')}, 6) AS elong FROM sun""")
def _(t):
    from asterion.operators.discovery import with_site
    d = with_site(t.obs, t.obscodes).where(F.col("site_name").isNotNull())
    d = sky.with_sun(d, "obstime")
    return d.select("id", F.round("sun_ra", 6).alias("sun_ra"), F.round("sun_dec", 6).alias("sun_dec"),
                    F.round(sky.altitude("obstime", "longitude", "latitude", "sun_ra", "sun_dec"), 5).alias("sun_alt"),
                    F.round(sky.angular_separation("ra", "dec", "sun_ra", "sun_dec"), 6).alias("elong"))


def moon_sql():
    from asterion.functions.tables import MOON_LATITUDE_TERMS, MOON_LONGITUDE_TERMS

    def ser(terms):
        return " + ".join(f"({a}) * sin({d} * dd + {m} * mm + {mp} * mp + {f} * ff)" for d, m, mp, f, a in terms)
    return f"""moon AS (SELECT *, fmod(degrees(atan2(sin(lon) * cos(eps) - tan(lat) * sin(eps), cos(lon))) + 360, 360) AS moon_ra,
   degrees(asin(sin(lat) * cos(eps) + cos(lat) * sin(eps) * sin(lon))) AS moon_dec FROM (
  SELECT *, radians(lp + {ser(MOON_LONGITUDE_TERMS)}) AS lon, radians({ser(MOON_LATITUDE_TERMS)}) AS lat, radians(23.439291 - 0.0130042 * c) AS eps FROM (
   SELECT *, fmod(218.3164477 + 481267.88123421 * c - 0.0015786 * c * c, 360) AS lp, radians(fmod(297.8501921 + 445267.1114034 * c - 0.0018819 * c * c, 360)) AS dd,
     radians(fmod(357.5291092 + 35999.0502909 * c - 0.0001536 * c * c, 360)) AS mm, radians(fmod(134.9633964 + 477198.8675055 * c + 0.0087414 * c * c, 360)) AS mp,
     radians(fmod(93.2720950 + 483202.0175233 * c - 0.0036539 * c * c, 360)) AS ff FROM (SELECT *, (epoch_us(obstime) - 946728000000000) / 86400000000.0 / 36525.0 AS c FROM obs))))"""


@query("moon_position", f"WITH {moon_sql()} SELECT id, round(moon_ra, 6) AS moon_ra, round(moon_dec, 6) AS moon_dec, round({_SEP.format(d='radians(moon_dec)', r='radians(moon_ra)')}, 5) AS lunar_elong FROM moon")
def _(t):
    d = sky.with_moon(t.obs, "obstime")
    return d.select("id", F.round("moon_ra", 6).alias("moon_ra"), F.round("moon_dec", 6).alias("moon_dec"),
                    F.round(sky.angular_separation("ra", "dec", "moon_ra", "moon_dec"), 5).alias("lunar_elong"))


def eclipse_sql():
    from asterion.functions.eclipse_table import LUNAR_ECLIPSES
    rows = []
    for line in LUNAR_ECLIPSES.strip().splitlines():
        kind, *times = line.split(",")
        rows.append("(" + ", ".join([f"'{kind}'"] + [f"TIMESTAMP '{x}:00'" if x else "NULL" for x in times]) + ")")
    return "ecl AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") e(type, p1, u1, u2, greatest, u3, u4, p4))"


# Order times spread over the clock so that some fall inside eclipses of 1995-2001.
_INSTANT = "o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 1440)"


@query("eclipse_overlap", f"""WITH {eclipse_sql()}, x AS (SELECT o_orderkey, {_INSTANT} AS obstime, o_custkey % 3 = 0 AS sat, CAST(o_custkey % 7 AS DOUBLE) - 2 AS alt FROM orders)
SELECT o_orderkey, CASE WHEN type IS NULL OR NOT (sat OR alt > 0) THEN '' WHEN type = 'T' AND obstime BETWEEN u2 AND u3 THEN 'Total eclipse'
  WHEN type IN ('T', 'P') AND obstime BETWEEN u1 AND u4 THEN 'Partial eclipse' ELSE 'Penumbral eclipse' END AS eclipse_class,
  CASE WHEN type IS NULL OR NOT (sat OR alt > 0) THEN '' ELSE CAST(CAST(greatest AS DATE) AS VARCHAR) END AS eclipse_date
FROM x LEFT JOIN ecl ON obstime BETWEEN p1 AND p4""")
def _(t):
    d = t.orders.select("o_orderkey", (F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("o_orderkey") % 1440).cast("int"))).alias("obstime"),
        (F.col("o_custkey") % 3 == 0).alias("is_satellite"), ((F.col("o_custkey") % 7).cast("double") - 2).alias("moon_alt"))
    return skytime.eclipse_overlap(d, skytime.lunar_eclipses(t.spark), key="o_orderkey").select(
        "o_orderkey", "eclipse_class", "eclipse_date")


_PHASE = "fmod((epoch_us(obstime) - 948429600000000) / 86400000000.0 + 14.7653 + 29.5306 * 1000, 29.5306) - 14.7653"


@query("lunar_phase_histogram", f"SELECT CAST(floor({_PHASE}) AS INTEGER) AS days_from_full, count(*) AS n FROM obs GROUP BY 1")
def _(t):
    return skytime.lunar_phase_histogram(t.obs, time="obstime")


@query("lunar_phase_suppression", f"""WITH x AS (SELECT abs({_PHASE}) AS x FROM obs)
SELECT count(*) AS total, count(*) FILTER (WHERE x <= 1) AS near_full, count(*) FILTER (WHERE x >= 13.7653) AS near_new,
  round(100.0 * count(*) FILTER (WHERE x <= 1) / count(*), 2) AS pct_full, round(100.0 * count(*) FILTER (WHERE x >= 13.7653) / count(*), 2) AS pct_new, CAST(6.77 AS DOUBLE) AS pct_uniform FROM x""")
def _(t):
    return skytime.lunar_phase_suppression(t.obs, time="obstime")


@query("sky_latitudes", """SELECT id, round(degrees(asin(cos(radians(dec)) * cos(radians(ra)) * -0.867666136 + cos(radians(dec)) * sin(radians(ra)) * -0.198076390 + sin(radians(dec)) * 0.455983776)), 6) AS gal_lat,
  round(degrees(asin(sin(radians(dec)) * cos(radians(23.43929111)) - cos(radians(dec)) * sin(radians(23.43929111)) * sin(radians(ra)))), 6) AS ecl_lat FROM obs""")
def _(t):
    return t.obs.select("id", F.round(sky.galactic_latitude("ra", "dec"), 6).alias("gal_lat"),
                        F.round(sky.ecliptic_latitude("ra", "dec"), 6).alias("ecl_lat"))


@query("angular_motion", """WITH p AS (SELECT id, ra, dec, lag(ra) OVER w AS ra0, lag(dec) OVER w AS dec0, (epoch_us(obstime) - epoch_us(lag(obstime) OVER w)) / 86400000000.0 AS dd FROM obs WHERE permid IS NOT NULL WINDOW w AS (PARTITION BY permid ORDER BY obstime, obsid))
SELECT id, round(2 * degrees(asin(sqrt(pow(sin(radians(dec - dec0) / 2), 2) + cos(radians(dec0)) * cos(radians(dec)) * pow(sin(radians(ra - ra0) / 2), 2)))), 6) AS arc,
  round(fmod(360 + degrees(atan2(sin(radians(ra - ra0)) * cos(radians(dec)), cos(radians(dec0)) * sin(radians(dec)) - sin(radians(dec0)) * cos(radians(dec)) * cos(radians(ra - ra0)))), 360), 6) AS pa,
  round(dd, 6) AS days FROM p WHERE ra0 IS NOT NULL""")
def _(t):
    from asterion.operators.ordered import month_bucket, with_previous
    d = with_previous(t.obs.where(F.col("permid").isNotNull()), keys=["permid"], order=["obstime", "obsid"],
                      bucket=month_bucket("obstime"), columns=["ra", "dec", "obstime"]).where(F.col("prev_ra").isNotNull())
    return d.select("id", F.round(sky.great_circle_deg("prev_ra", "prev_dec", "ra", "dec"), 6).alias("arc"),
                    F.round(sky.position_angle_deg("prev_ra", "prev_dec", "ra", "dec"), 6).alias("pa"),
                    F.round(days_between("prev_obstime", "obstime"), 6).alias("days"))
