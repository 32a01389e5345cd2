"""Membership of objects in the institutions' lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from asterion.functions import orbit
from asterion.operators import consensus as C, filters, identity, summary

from . import oracle_parts as S
from .q_discovery import rounded
from .registry import query

P, U = identity.PACKED, identity.UNPACKED
SOURCES = ["s1", "s2", "s3", "s4", "s5"]

WIDE_SQL = "wide AS (SELECT primary_desig, max(packed_desig) AS packed_desig, max(permid) AS permid, " + ", ".join(
    f"bool_or(source = '{s}') AS in_{s}" for s in SOURCES) + ", " + ", ".join(
    f"max(last_refreshed) FILTER (WHERE source = '{s}') AS {s}_refreshed_at" for s in SOURCES) + """,
  max(nf_q) AS nf_q, max(nf_neo_prob) AS nf_neo_prob, max(nf_u) AS nf_u FROM members WHERE NOT is_comet GROUP BY primary_desig)"""
TOTAL = " + ".join(f"in_{s}::INT" for s in SOURCES)


def lacking(s):
    return " AND ".join(f"{'NOT ' if x == s else ''}in_{x}" for x in SOURCES)


def alone(s):
    return " AND ".join(f"{'' if x == s else 'NOT '}in_{x}" for x in SOURCES)


def wide(t):
    return C.membership_wide(t.members, sources=SOURCES)


@query("membership_wide", f"WITH {WIDE_SQL} SELECT * REPLACE (round(nf_q, 6) AS nf_q) FROM wide")
def _(t):
    return rounded(wide(t), nf_q=6)


@query("source_health", """
WITH l AS (SELECT source, max(started_at) AS last_run_started FROM runs GROUP BY source), k AS (SELECT source, max(started_at) AS last_ok_started FROM runs WHERE status = 'ok' GROUP BY source)
SELECT l.source, last_run_started, last_ok_started, a.status AS last_status, b.finished_at AS last_ok_finished, b.n_rows AS last_ok_n_rows, b.n_unresolved AS last_ok_n_unresolved,
  CAST(epoch(TIMESTAMP '2002-01-01' - b.finished_at) AS DOUBLE) AS seconds_since_ok
FROM l LEFT JOIN k USING (source) LEFT JOIN runs a ON a.source = l.source AND a.started_at = last_run_started LEFT JOIN runs b ON b.source = l.source AND b.started_at = last_ok_started""")
def _(t):
    from asterion.functions.timeconv import seconds_between
    d = C.source_health(t.runs, now="2002-01-01")
    return d.withColumn("seconds_since_ok", seconds_between(
        "last_ok_finished", F.lit("2002-01-01").cast("timestamp_ntz")).cast("double")).drop("time_since_last_ok")


@query("disagreement_patterns", f"WITH {WIDE_SQL} SELECT " + ", ".join(f"in_{s}::INT AS in_{s}" for s in SOURCES) + f""", count(*) AS n FROM wide
WHERE {TOTAL} < 5 GROUP BY ALL ORDER BY n DESC, {", ".join(f"in_{s}" for s in SOURCES)} LIMIT 20""")
def _(t):
    return C.disagreement_patterns(wide(t), sources=SOURCES)


@query("disagreement_matrix", f"WITH {WIDE_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS source_a, " + ", ".join("CAST(0 AS BIGINT) AS vs_" + b if a == b else f"count(*) FILTER (WHERE in_{a} AND NOT in_{b}) AS vs_{b}" for b in SOURCES)
    + f", count(*) FILTER (WHERE in_{a}) AS total FROM wide" for a in SOURCES))
def _(t):
    return C.disagreement_matrix(wide(t), sources=SOURCES)


@query("pair_divergence", f"WITH {WIDE_SQL} SELECT count(*) FILTER (WHERE in_s1 AND NOT in_s5) AS only_a, count(*) FILTER (WHERE in_s5 AND NOT in_s1) AS only_b, count(*) FILTER (WHERE in_s1 AND in_s5) AS both FROM wide")
def _(t):
    return C.pair_divergence(wide(t), a="s1", b="s5")


@query("missing_profile", f"""WITH {WIDE_SQL} SELECT count(*) AS n, round(min(o.q), 3) AS q_min, round(max(o.q), 3) AS q_max, round(quantile_cont(o.q, 0.5), 3) AS q_median,
  count(*) FILTER (WHERE o.q > 1.29) AS n_q_gt_129, round(quantile_cont(o.h, 0.5), 1) AS h_median, count(*) FILTER (WHERE o.h >= 27) AS n_h_ge_27
FROM wide w JOIN orbits o ON o.{U} = w.primary_desig WHERE {lacking('s4')}""")
def _(t):
    return C.missing_profile(wide(t), t.orbits, sources=SOURCES, source="s4")


@query("only_profile", f"""WITH {WIDE_SQL} SELECT count(*) AS n, round(avg(nf_q), 3) AS q_avg, count(*) FILTER (WHERE nf_q > 1.30) AS listed_q_gt_130, count(*) FILTER (WHERE o.q > 1.30) AS catalog_q_gt_130
FROM wide w LEFT JOIN orbits o ON o.{U} = w.primary_desig WHERE {alone('s4')}""")
def _(t):
    return C.only_profile(wide(t), t.orbits, sources=SOURCES, source="s4")


@query("collapse_simulation", f"""WITH b AS (SELECT source, primary_desig, packed_desig FROM members WHERE NOT is_comet),
k AS (SELECT b.source, coalesce(c.{U}, b.primary_desig) AS canon FROM b LEFT JOIN ci c ON c.packed_secondary_provisional_designation = b.packed_desig),
x AS (SELECT 'before' AS view, primary_desig AS d, count(DISTINCT source) AS n FROM b GROUP BY 2 UNION ALL SELECT 'after collapse', canon, count(DISTINCT source) FROM k GROUP BY 2)
SELECT view, count(*) AS n_primaries, count(*) FILTER (WHERE n = 5) AS all_agree, count(*) FILTER (WHERE n < 5) AS disagreements FROM x GROUP BY view""")
def _(t):
    return C.collapse_simulation(t.members, t.ci, n_sources=5)


TOGETHER, APART = [("s2", "s4"), ("s1", "s3"), ("s1", "s2", "s5")], [("s3", "s5")]


def exactly(holders):
    return " AND ".join(f"{'' if x in holders else 'NOT '}in_{x}" for x in SOURCES)


def categories(t):
    return C.disagreement_categories(wide(t), sources=SOURCES, together=TOGETHER, apart=APART)


CATS_SQL = WIDE_SQL + ", cats AS (SELECT primary_desig, CASE " + " ".join(
    f"WHEN {lacking(s)} THEN 'missing only {s}' WHEN {alone(s)} THEN 'only {s}'" for s in SOURCES) + " " + " ".join(
    f"WHEN {exactly(set(SOURCES) - set(g))} THEN 'missing {'+'.join(g)}'" for g in TOGETHER) + " " + " ".join(
    f"WHEN {exactly(g)} THEN 'only {'+'.join(g)}'" for g in APART) + " END AS cat FROM wide)"
OBSALL_SQL = f"""osa AS (SELECT provid AS primary_desig, min(obstime)::DATE AS first_obs, max(obstime)::DATE AS last_obs,
  (epoch_us(max(obstime)) - epoch_us(min(obstime))) / {S.DAY_US} AS arc_days, count(*) AS nobs, min(stn) FILTER (WHERE disc = '*') AS disc_by FROM detections GROUP BY 1)"""


def _cats_summary(t):
    # Lists name objects by designation, numbered ones too.
    return categories(t), summary.obs_summary_all(t.detections, key="provid")


@query("disagreement_categories", f"WITH {CATS_SQL} SELECT primary_desig, cat FROM cats WHERE cat IS NOT NULL")
def _(t):
    return categories(t)


@query("category_characteristics", f"""WITH {CATS_SQL}, {OBSALL_SQL}
SELECT cat, count(*) AS n, round(avg(nobs), 0) AS nobs_avg, CAST(round(quantile_cont(nobs, 0.5), 0) AS INTEGER) AS nobs_p50, round(avg(arc_days), 0) AS arc_avg,
  CAST(round(quantile_cont(arc_days, 0.5), 0) AS INTEGER) AS arc_p50, count(*) FILTER (WHERE arc_days < 1) AS one_night, count(*) FILTER (WHERE arc_days < 30) AS arc_lt_30d,
  min(first_obs) AS earliest_disc, max(last_obs) AS most_recent_obs FROM cats JOIN osa USING (primary_desig) WHERE cat IS NOT NULL GROUP BY cat""")
def _(t):
    return C.category_characteristics(*_cats_summary(t))


@query("top_category_stations", f"""WITH {CATS_SQL}, {OBSALL_SQL}, ds AS (SELECT cat, disc_by, count(*) AS n_in_cat FROM cats JOIN osa USING (primary_desig) WHERE cat IS NOT NULL AND disc_by IS NOT NULL GROUP BY 1, 2)
SELECT cat, disc_by, CAST(NULL AS VARCHAR) AS station_name, n_in_cat FROM (SELECT *, row_number() OVER (PARTITION BY cat ORDER BY n_in_cat DESC, disc_by) AS rn FROM ds) WHERE rn <= 6""")
def _(t):
    return C.top_category_stations(*_cats_summary(t), t.obscodes)


@query("single_site_counts", f"""WITH {CATS_SQL}, per AS (SELECT cat, c.primary_desig, count(DISTINCT d.stn) AS k FROM cats c LEFT JOIN detections d ON d.provid = c.primary_desig WHERE cat IS NOT NULL GROUP BY 1, 2)
SELECT cat, count(*) AS n, count(*) FILTER (WHERE k = 1) AS single_site, count(*) FILTER (WHERE k <= 2) AS stns_le_2, round(avg(k), 1) AS n_stns_avg FROM per GROUP BY cat""")
def _(t):
    return C.single_site_counts(categories(t), t.detections)


RESOLVED_SQL = f"""rm AS (SELECT m.source, m.primary_desig AS reported_primary, m.packed_desig AS reported_packed, c.{U} AS true_primary, c.{P} AS true_primary_packed, c.object_type
  FROM members m LEFT JOIN ci c ON c.packed_secondary_provisional_designation = m.packed_desig)"""


@query("resolution_counts", f"WITH {RESOLVED_SQL} SELECT count(*) AS rows_total, count(*) FILTER (WHERE true_primary IS NULL) AS no_ci_match, count(*) FILTER (WHERE true_primary = reported_primary) AS self_match, count(*) FILTER (WHERE true_primary <> reported_primary) AS aliased FROM rm")
def _(t):
    return C.resolution_counts(C.resolution_map(t.members, t.ci))


@query("alias_report", f"""WITH {RESOLVED_SQL}, h AS (SELECT primary_desig, string_agg(DISTINCT source, ',' ORDER BY source) AS s FROM members GROUP BY 1)
SELECT source, reported_primary, reported_packed, true_primary, true_primary_packed, object_type,
  CASE WHEN regexp_matches(true_primary, '^[PCDXAI]/') THEN 'D_comet' WHEN EXISTS (SELECT 1 FROM members x WHERE x.primary_desig = rm.true_primary) THEN 'B_primary_in_consensus' ELSE 'AC_primary_absent' END AS case_class,
  a.s AS sources_holding_primary, b.s AS sources_holding_alias
FROM rm LEFT JOIN h a ON a.primary_desig = rm.true_primary LEFT JOIN h b ON b.primary_desig = rm.reported_primary WHERE true_primary <> reported_primary""")
def _(t):
    members = t.members
    return C.alias_report(C.resolution_map(members, t.ci), members)


@query("unresolved_by_source", f"WITH {RESOLVED_SQL} SELECT source, count(*) AS n_unresolved FROM rm WHERE true_primary IS NULL GROUP BY source")
def _(t):
    return C.unresolved_by_source(C.resolution_map(t.members, t.ci))


@query("common_to_all", f"""WITH {WIDE_SQL}, md AS (SELECT primary_desig, primary_desig AS designation, 'primary' AS kind FROM members
  UNION SELECT m.primary_desig, c.unpacked_secondary_provisional_designation, 'secondary' FROM members m JOIN ci c ON c.{P} = m.packed_desig
  UNION SELECT m.primary_desig, n.permid, 'permid' FROM members m JOIN ni n ON n.{P} = m.packed_desig)
SELECT md.* FROM md JOIN wide w USING (primary_desig) WHERE {TOTAL} = 5""")
def _(t):
    members = t.members
    return C.common_to_all(wide(t), identity.member_designations(members, t.ci, t.ni), sources=SOURCES).select(
        "primary_desig", "designation", "kind")


@query("difference_of_lists", "SELECT DISTINCT primary_desig FROM members WHERE source = 's1' AND primary_desig NOT IN (SELECT primary_desig FROM members WHERE source = 's2')")
def _(t):
    m = t.members
    return C.difference_of(m.where(F.col("source") == "s1").select("primary_desig"),
                           m.where(F.col("source") == "s2").select("primary_desig"), key="primary_desig")


FILTER_SQL = f"""{WIDE_SQL}, j AS (SELECT w.*, {S.label(S.CLASSIFY)} AS orbit_class, o.q, o.h, n.iau_name FROM wide w JOIN orbits o ON o.{U} = w.primary_desig LEFT JOIN ni n ON n.permid = w.permid)"""


@query("consensus_filter", f"""WITH {FILTER_SQL} SELECT primary_desig, orbit_class FROM j WHERE in_s1 AND NOT in_s2 OR FALSE""".replace(" OR FALSE", "") +
       " AND orbit_class IN ('Apollo', 'Amor', 'Aten') AND orbit_class NOT IN ('Aten') AND q >= 0.3 AND q <= 1.3 AND NOT (" + " AND ".join(f"in_{s}" for s in SOURCES) + ")")
def _(t):
    d = wide(t).join(t.orbits.select(F.col(U).alias("primary_desig"), "q", "h", orbit.orbit_label(
        orbit.classify_orbit("q", "e", "i")).alias("orbit_class")), "primary_desig")
    return filters.consensus_filter(d, sources=SOURCES, include=["s1"], exclude=["s2"], classes_in=["Apollo", "Amor", "Aten"],
                                    classes_out=["Aten"], ranges={"q": (0.3, 1.3)}, hide_all_agree=True).select("primary_desig", "orbit_class")


@query("consensus_filter_named", f"""WITH {FILTER_SQL} SELECT primary_desig, iau_name FROM j WHERE permid IS NOT NULL AND iau_name IS NOT NULL AND h <= 25""")
def _(t):
    d = wide(t).join(t.orbits.select(F.col(U).alias("primary_desig"), "h"), "primary_desig").join(
        t.ni.select("permid", "iau_name"), "permid", "left")
    return filters.consensus_filter(d, sources=SOURCES, ranges={"h": (None, 25)}, numbered=True, named=True).select("primary_desig", "iau_name")


@query("membership_upsert", """
WITH b AS (SELECT DISTINCT primary_desig, permid FROM members WHERE source = 's5'), s AS (SELECT * FROM members WHERE source IN ('s1', 's2'))
SELECT coalesce(s.source, 's1') AS source, coalesce(s.primary_desig, b.primary_desig) AS primary_desig, CASE WHEN b.primary_desig IS NOT NULL THEN b.permid ELSE s.permid END AS permid,
  coalesce(s.first_seen, TIMESTAMP '2003-01-01') AS first_seen, CASE WHEN b.primary_desig IS NOT NULL THEN TIMESTAMP '2003-01-01' ELSE s.last_seen END AS last_seen
FROM (SELECT * FROM s WHERE source = 's1') s FULL JOIN b ON s.primary_desig = b.primary_desig
UNION ALL SELECT source, primary_desig, permid, first_seen, last_seen FROM s WHERE source = 's2'""")
def _(t):
    m = t.members
    batch = m.where(F.col("source") == "s5").select("primary_desig", "packed_desig", "permid", "raw_string", "desig_parsed",
                                                     "orbit_in_mpc", "is_comet", "nf_q", "nf_neo_prob", "nf_u")
    return C.membership_upsert(m.where(F.col("source").isin("s1", "s2")), batch, source="s1", now="2003-01-01 00:00:00").select(
        "source", "primary_desig", "permid", "first_seen", "last_seen")


@query("raw_designation_kinds", "SELECT source, 'numbered' AS kind, count(*) AS n FROM members GROUP BY source")
def _(t):
    return C.kinds_of_members(t.members)


