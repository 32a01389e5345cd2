"""Data quality, comparisons, scans and the confirmation page."""

from __future__ import annotations

from pyspark.sql import functions as F

from asterion.functions import orbit
from asterion.operators import compare, factorised, neocp, quality, replicas
from asterion.operators.identity import PACKED as P, UNPACKED as U

from . import oracle_parts as S
from .q_discovery import rounded
from .registry import query

NULL_COLS = ["orbit_type_int", "q", "e", "i", "a", "h", "earth_moid", "q_unc", "mpc_orb_jsonb"]


@query("null_rates", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS total, count(*) - count({c}) AS null_count, round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct FROM orbits" for c in NULL_COLS))
def _(t):
    return quality.null_rates(t.orbits, cols=NULL_COLS)


def hist_sql(x, lo, hi, edge, n, where, table):
    return f"""SELECT CAST(floor((x - {lo}) / (({edge}) - {lo}) * {n}) + 1 AS INTEGER) AS bucket, count(*) AS "count" FROM (SELECT {x} AS x FROM {table}) v, b WHERE x IS NOT NULL {where} AND x >= {lo} AND x < ({edge}) GROUP BY 1"""


@query("histogram", "WITH b AS (SELECT 0.3::DOUBLE AS lo, 1.61::DOUBLE AS hi), h AS (" + hist_sql("q", "lo", "hi", "hi", 13, "", "orbits") + """)
SELECT bucket, round(0.3 + (bucket - 1) * (1.61 - 0.3) / 13, 9) AS bin_lo, round(0.3 + bucket * (1.61 - 0.3) / 13, 9) AS bin_hi, "count" FROM h""")
def _(t):
    return rounded(quality.histogram(t.orbits, col="q", n=13, lo=0.3, hi=1.61), bin_lo=9, bin_hi=9)


@query("histogram_auto", f"""WITH d AS (SELECT coalesce(a, CASE WHEN e < 1 THEN q / (1 - e) END) AS x FROM orbits), b AS (SELECT min(x) AS lo, max(x) AS hi FROM d WHERE x < 100),
h AS ({hist_sql('x', 'lo', 'hi', 'hi + 1e-10', 100, 'AND x < 100', 'd')})
SELECT bucket, round(lo + (bucket - 1) * (hi - lo) / 100.0, 6) AS bin_lo, round(lo + bucket * (hi - lo) / 100.0, 6) AS bin_hi, "count" FROM h, b""")
def _(t):
    a = F.coalesce(F.col("a"), orbit.semi_major_axis("q", "e"))
    return rounded(quality.histogram(t.orbits, col=a, n=100, cap=100.0), bin_lo=6, bin_hi=6)


@query("uncertainty_log_hist", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, floor(log10({c}) / 0.5) * CAST(0.5 AS DOUBLE) AS log_bin, count(*) AS n FROM orbits WHERE {c} > 0 GROUP BY 2" for c in ("q_unc", "e_unc")))
def _(t):
    return quality.uncertainty_log_hist(t.orbits, cols=["q_unc", "e_unc"])


COMP_SQL = S.CLASSIFY.replace("q/(1-e)", "aa")
COMPUTED = f"comp AS (SELECT *, {COMP_SQL} AS ct FROM (SELECT *, coalesce(a, q/(1-e)) AS aa FROM orbits))"


@query("classification_agreement", f"""WITH {COMPUTED} SELECT {S.label('orbit_type_int', "'Unclassified'", 'Other (Unusual)')} AS db_class, {S.label('ct', "'Unclassified'", 'Other (Unusual)')} AS computed_class, count(*) AS n,
  (SELECT round(100.0 * count(*) FILTER (WHERE orbit_type_int = ct) / count(*), 4) FROM comp WHERE orbit_type_int IS NOT NULL) AS agreement_pct FROM comp WHERE orbit_type_int IS NOT NULL GROUP BY orbit_type_int, ct""")
def _(t):
    return quality.classification_agreement(t.orbits)


@query("class_recovery", f"""WITH {COMPUTED} SELECT CASE WHEN ct IS NULL THEN 'Still unclassified' ELSE {S.label('ct', "'Unclassified'", 'Other (Unusual)')} END AS recovered_class, count(*) AS n FROM comp WHERE orbit_type_int IS NULL GROUP BY 1""")
def _(t):
    return quality.class_recovery(t.orbits)


@query("residual_stats", """WITH r AS (SELECT q - a * (1 - e) AS r FROM orbits WHERE q IS NOT NULL AND a IS NOT NULL)
SELECT count(*) AS n, round(avg(r), 9) AS mean, round(stddev(r), 9) AS std, round(min(r), 9) AS min, round(max(r), 9) AS max, round(quantile_cont(r, 0.25), 9) AS p25, round(quantile_cont(r, 0.5), 9) AS p50, round(quantile_cont(r, 0.75), 9) AS p75 FROM r""")
def _(t):
    return rounded(quality.residual_stats(t.orbits), mean=9, std=9, min=9, max=9, p25=9, p50=9, p75=9)


_JS = "CASE WHEN json_valid(mpc_orb_jsonb) THEN mpc_orb_jsonb END"


@query("json_mismatch", f"""WITH d AS (SELECT h - TRY_CAST(json_extract_string({_JS}, '$.magnitude_data.H') AS DOUBLE) AS d FROM orbits)
SELECT count(d) AS n, count(*) FILTER (WHERE abs(d) > 0.01) AS mismatches, round(max(abs(d)), 6) AS max_diff FROM d""")
def _(t):
    return quality.json_mismatch(t.orbits)


JSON_KEYS = ["CAR", "COM", "magnitude_data", "categorization", "orbit_fit_statistics"]


@query("json_key_presence", " UNION ALL ".join(
    f"SELECT '{k}' AS key_name, count(*) FILTER (WHERE json_exists({_JS}, '$.{k}')) AS present, count(*) AS total, round(100.0 * count(*) FILTER (WHERE json_exists({_JS}, '$.{k}')) / count(*), 1) AS pct FROM orbits" for k in JSON_KEYS))
def _(t):
    return quality.json_key_presence(t.orbits, keys=JSON_KEYS)


@query("temporal_completeness", """SELECT CAST(date_trunc('month', updated_at) AS DATE) AS month, count(*) AS n_rows, round(100.0 * count(orbit_type_int) / count(*), 1) AS pct_orbit_type_int,
  round(100.0 * count(a) / count(*), 1) AS pct_a, round(100.0 * count(earth_moid) / count(*), 1) AS pct_earth_moid FROM orbits GROUP BY 1""")
def _(t):
    return quality.temporal_completeness(t.orbits, cols=["orbit_type_int", "a", "earth_moid"])


@query("null_agreement", f"""SELECT orbit_type_int IS NULL AS top_null, json_extract_string({_JS}, '$.categorization.orbit_type_int') IS NULL AS json_null, count(*) AS n
FROM orbits WHERE mpc_orb_jsonb IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return quality.null_agreement(t.orbits)


@query("epoch_years", "SELECT CAST(year(DATE '1858-11-17' + CAST(epoch_mjd AS INTEGER)) AS INTEGER) AS epoch_year, count(*) AS n FROM orbits GROUP BY 1")
def _(t):
    return quality.epoch_years(t.orbits)


def _pairs(t):
    return t.orbits.select(F.col(U).alias("key"), F.col("h").alias("x"), (F.col("h") + F.when(F.col("id") % 5 == 0, 0.0).otherwise(
        (F.col("id") % 97).cast("double") / 61)).alias("y"))


PAIRS_SQL = f"pr AS (SELECT {U} AS key, h AS x, h + CASE WHEN id % 5 = 0 THEN 0 ELSE (id % 97) / 61.0 END AS y FROM orbits)"


@query("difference_summary", f"""WITH {PAIRS_SQL}, d AS (SELECT round(abs(x - y), 6) AS d FROM pr WHERE x IS NOT NULL)
SELECT count(*) AS n, count(*) FILTER (WHERE d = 0) AS exact, count(*) FILTER (WHERE d < 0.1) AS close, count(*) FILTER (WHERE d >= 0.1) AS differ, round(quantile_cont(d, 0.5), 4) AS median_diff, max(d) AS max_diff FROM d""")
def _(t):
    return quality.difference_summary(_pairs(t), a="x", b="y")


@query("largest_differences", f"WITH {PAIRS_SQL} SELECT key, round(x, 6) AS x, round(y, 6) AS y, round(x - y, 6) AS diff FROM pr WHERE abs(x - y) >= 1 ORDER BY abs(round(x - y, 6)) DESC, key LIMIT 15")
def _(t):
    return rounded(quality.largest_differences(_pairs(t), key="key", a="x", b="y"), x=6, y=6)


# -- scans at the size of the largest table -------------------------------------------------------

@query("full_table_stats", "SELECT count(*) AS n, round(avg(mag), 6) AS avg, round(stddev(value), 6) AS stddev, min(obstime) AS min_ts, max(obstime) AS max_ts FROM detections")
def _(t):
    return quality.full_table_stats(t.detections, count_col="mag", spread_col="value", time="obstime")


@query("selective_count", "SELECT count(*) AS n FROM lineitem WHERE l_partkey < 20 AND l_shipdate >= '1997-01-01' AND l_shipdate < '1998-01-01'")
def _(t):
    return quality.selective_count(t.lineitem, (F.col("l_partkey") < 20) & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                                   & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")))


@query("distinct_count", "SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def _(t):
    return t.lineitem.agg(F.countDistinct("l_partkey").alias("n"))


@query("monthly_stats", "SELECT CAST(date_trunc('month', obstime) AS DATE) AS mo, count(*) AS n, round(avg(value), 6) AS mean FROM detections GROUP BY 1")
def _(t):
    return quality.monthly_stats(t.detections, time="obstime", value="value")


@query("percentiles_disc", "SELECT " + ", ".join(f"quantile_disc(l_extendedprice, {p}) AS p{round(100 * p):02d}" for p in (0.25, 0.5, 0.75, 0.95, 0.99)) + " FROM lineitem")
def _(t):
    return quality.percentiles_disc(t.lineitem, value="l_extendedprice")


@query("self_join_count", "SELECT count(*) AS n FROM lineitem a JOIN lineitem b USING (l_partkey) WHERE a.l_orderkey < 1000")
def _(t):
    return compare.self_join_count(t.lineitem, key="l_partkey", probe=F.col("l_orderkey") < 1000)


@query("group_mean_lookup", "SELECT round(avg(g), 6) AS mean_of_means FROM lineitem a JOIN (SELECT l_partkey, avg(l_extendedprice) AS g FROM lineitem GROUP BY 1) b USING (l_partkey) WHERE a.l_orderkey < 1000")
def _(t):
    return compare.group_mean_lookup(t.lineitem, key="l_partkey", value="l_extendedprice", probe=F.col("l_orderkey") < 1000)


@query("snapshot_fingerprint", f"""SELECT count(*) AS nrows, sum(CAST('0x' || substr(md5({U}), 1, 16) AS UBIGINT)::HUGEINT)::VARCHAR || ':' || sum(CAST('0x' || substr(md5({U}), 17, 16) AS UBIGINT)::HUGEINT)::VARCHAR AS content_hash, min(created_at) AS min_time, max(created_at) AS max_time FROM orbits""")
def _(t):
    return replicas.snapshot_fingerprint(t.orbits, key=U, time="created_at")


@query("table_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in ("orders", "lineitem", "events")))
def _(t):
    return compare.table_counts({n: t.table(n) for n in ("orders", "lineitem", "events")})


@query("table_schema")
def _(t):
    return compare.table_schema(t.obs, "obs")


@query("boundary_values", "SELECT * FROM (SELECT 'orders.min_o_orderkey' AS label, CAST(min(o_orderkey) AS VARCHAR) AS value FROM orders UNION ALL SELECT 'orders.max_o_orderkey', CAST(max(o_orderkey) AS VARCHAR) FROM orders UNION ALL SELECT 'orders.min_o_custkey', CAST(min(o_custkey) AS VARCHAR) FROM orders UNION ALL SELECT 'orders.max_o_custkey', CAST(max(o_custkey) AS VARCHAR) FROM orders)")
def _(t):
    return compare.boundary_values(t.orders, name="orders", columns=["o_orderkey", "o_custkey"])


@query("replica_diff", "SELECT event_id, event_type, 'a' AS side FROM events WHERE event_id % 10 = 3 UNION ALL SELECT event_id, event_type, 'b' FROM events WHERE event_id % 10 = 7")
def _(t):
    e = t.events.select("event_id", "event_type")
    return replicas.replica_diff(e.where(F.col("event_id") % 10 != 7), e.where(F.col("event_id") % 10 != 3), key="event_id")


# One copy lacks a stretch of rows, holds others twice, has one row changed and rows without a key.
@query("replica_diff_ranges", """WITH e AS (SELECT event_id, event_type, value, ts FROM events), m AS (SELECT max(event_id) AS m FROM e),
b AS (SELECT * FROM e, m WHERE event_id NOT BETWEEN m // 4 AND m // 4 + 9 UNION ALL SELECT * FROM e, m WHERE event_id BETWEEN m // 2 AND m // 2 + 4
  UNION ALL SELECT NULL, event_type, value, ts, m FROM e, m WHERE event_id = 3),
c AS (SELECT event_id, event_type, CASE WHEN event_id = m - 1 THEN -1.5 ELSE value END AS value, ts FROM b)
SELECT event_id, event_type, value, ts, 'a' AS side FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM c) UNION ALL SELECT event_id, event_type, value, ts, 'b' FROM (SELECT * FROM c EXCEPT ALL SELECT * FROM e)""")
def _(t):
    a = t.events.select("event_id", "event_type", "value", "ts")
    m = a.agg(F.max("event_id")).first()[0]
    b = a.where(~F.col("event_id").between(m // 4, m // 4 + 9)).unionAll(a.where(F.col("event_id").between(m // 2, m // 2 + 4)))
    b = b.unionAll(a.where(F.col("event_id") == 3).withColumn("event_id", F.lit(None).cast("bigint")))
    b = b.withColumn("value", F.when(F.col("event_id") == m - 1, F.lit(-1.5)).otherwise(F.col("value")))
    return replicas.replica_diff(a, b, key="event_id")


@query("element_delta", f"""WITH b AS (SELECT {U} AS key, q + CASE id % 3 WHEN 0 THEN 0.000004 WHEN 1 THEN 0.004 ELSE 0.4 END AS q, CASE WHEN id % 4 <> 0 THEN e END AS e FROM orbits)
SELECT key, element, round(value_a, 6) AS value_a, round(value_b, 6) AS value_b, round(value_b - value_a, 6) AS delta,
  CASE WHEN abs(value_b - value_a) < lo THEN 'near' WHEN abs(value_b - value_a) < hi THEN 'moderate' WHEN value_b - value_a IS NOT NULL THEN 'far' END AS grade FROM (
 SELECT o.{U} AS key, 'q' AS element, o.q AS value_a, b.q AS value_b, 0.00001 AS lo, 0.01 AS hi FROM orbits o JOIN b ON b.key = o.{U}
 UNION ALL SELECT o.{U}, 'e', o.e, b.e, 0.0001, 0.1 FROM orbits o JOIN b ON b.key = o.{U})""")
def _(t):
    a = t.orbits.select(F.col(U).alias("key"), "q", "e", "id")
    m = F.col("id") % 3
    b = a.select("key", (F.col("q") + F.when(m == 0, 0.000004).when(m == 1, 0.004).otherwise(0.4)).alias("q"),
                 F.when(F.col("id") % 4 != 0, F.col("e")).alias("e"))
    return rounded(compare.element_delta(a, b, key="key", thresholds={"q": (0.00001, 0.01), "e": (0.0001, 0.1)}),
                   value_a=6, value_b=6, delta=6)


# -- list against list --------------------------------------------------------------------------------

LISTS_SQL = f"""la AS (SELECT {P} AS designation, h AS h_mpc, coalesce(a, q / nullif(1 - e, 0)) AS a_mpc, e AS e_mpc, q AS q_mpc FROM orbits WHERE id % 4 <> 1),
lb AS (SELECT {P} AS designation, CASE WHEN id % 6 <> 0 THEN h + (id % 10) / 9.7 END AS h_jpl, CASE WHEN id % 5 <> 0 THEN coalesce(a, q / nullif(1 - e, 0)) END AS a_jpl, e AS e_jpl, q + 0.001 AS q_jpl FROM orbits WHERE id % 4 <> 2)"""
XM_SQL = f"""{LISTS_SQL}, j AS (SELECT *, coalesce(la.designation, lb.designation) AS d, la.designation IS NOT NULL AS ia, lb.designation IS NOT NULL AS ib, coalesce(a_jpl, a_mpc) AS ab, coalesce(e_jpl, e_mpc) AS eb, coalesce(q_jpl, q_mpc) AS qb
  FROM la FULL JOIN lb ON la.designation = lb.designation),
xm AS (SELECT d AS designation, CAST(NULL AS VARCHAR) AS number, ia AS in_mpc, ib AS in_jpl, CASE WHEN ia AND ib THEN 'both' WHEN ia THEN 'mpc' ELSE 'jpl' END AS source, coalesce(h_mpc, h_jpl) AS h_best,
  CASE WHEN ab IS NULL OR eb IS NULL OR eb >= 1 THEN 'Unclassified' WHEN ab < 1 AND ab * (1 + eb) < 0.983 THEN 'Atira' WHEN ab < 1 THEN 'Aten' WHEN coalesce(qb, ab * (1 - eb)) < 1.017 THEN 'Apollo' WHEN coalesce(qb, ab * (1 - eb)) < 1.3 THEN 'Amor' ELSE 'Other' END AS orbit_class,
  round(abs(h_mpc - h_jpl), 6) AS h_diff, round(abs(q_mpc - q_jpl), 6) AS q_diff FROM j)"""


def _lists(t):
    o = t.orbits
    a0 = F.coalesce(F.col("a"), F.col("q") / F.nullif(F.lit(1.0) - F.col("e"), F.lit(0.0)))
    a = o.where(F.col("id") % 4 != 1).select(F.col(P).alias("designation"), F.col("h").alias("h_mpc"), a0.alias("a_mpc"), F.col("e").alias("e_mpc"), F.col("q").alias("q_mpc"))
    b = o.where(F.col("id") % 4 != 2).select(
        F.col(P).alias("designation"), F.when(F.col("id") % 6 != 0, F.col("h") + (F.col("id") % 10) / 9.7).alias("h_jpl"),
        F.when(F.col("id") % 5 != 0, a0).alias("a_jpl"), F.col("e").alias("e_jpl"), (F.col("q") + 0.001).alias("q_jpl"))
    return a, b


@query("cross_match_lists", f"WITH {XM_SQL} SELECT * REPLACE (round(h_best, 6) AS h_best) FROM xm")
def _(t):
    return rounded(compare.cross_match_lists(*_lists(t)), h_best=6)


@query("cross_match_summary", f"WITH {XM_SQL} SELECT count(*) AS n, count(*) FILTER (WHERE source = 'both') AS n_both, count(*) FILTER (WHERE source = 'mpc') AS n_mpc_only, count(*) FILTER (WHERE source = 'jpl') AS n_jpl_only, count(*) FILTER (WHERE h_diff > 0.5) AS n_h_differs, count(h_diff) AS n_both_h FROM xm")
def _(t):
    return compare.cross_match_summary(compare.cross_match_lists(*_lists(t)))


def _neo_list(t):
    k = F.col("p_partkey")
    text = k.cast("string")
    return t.part.select(F.concat(F.lit("PU"), text).alias("packed_desig"), (k % 3 == 0).alias("is_numbered"),
                         F.when(k % 3 == 0, text).alias("number"), F.col("p_size").cast("double").alias("h_list"))


NLIST_SQL = f"""nl AS (SELECT 'PU' || p_partkey AS packed_desig, p_partkey % 3 = 0 AS is_numbered, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR) END AS number, CAST(p_size AS DOUBLE) AS h_list FROM part),
k AS (SELECT nl.*, CASE WHEN is_numbered THEN n.{P} ELSE packed_desig END AS match_key FROM nl LEFT JOIN ni n ON n.permid = nl.number)"""


@query("match_catalog_matched", f"WITH {NLIST_SQL} SELECT match_key, h_list, round(o.h, 6) AS h FROM k JOIN orbits o ON o.{P} = k.match_key")
def _(t):
    return rounded(compare.match_catalog(_neo_list(t), t.orbits, t.ni)[0].select("match_key", "h_list", "h"), h=6)


@query("match_catalog_list_only", f"WITH {NLIST_SQL} SELECT packed_desig, is_numbered FROM k WHERE match_key IS NULL OR match_key NOT IN (SELECT {P} FROM orbits)")
def _(t):
    return compare.match_catalog(_neo_list(t), t.orbits, t.ni)[1].select("packed_desig", "is_numbered")


@query("match_catalog_catalog_only", f"WITH {NLIST_SQL} SELECT {P} AS match_key FROM orbits WHERE id % 5 <> 0 AND {P} NOT IN (SELECT match_key FROM k WHERE match_key IS NOT NULL AND h_list > 20)")
def _(t):
    d = _neo_list(t).where(F.col("h_list") > 20)
    return compare.match_catalog(d, t.orbits.where(F.col("id") % 5 != 0), t.ni)[2].select("match_key")


# -- confirmation page -----------------------------------------------------------------------------------

@query("neocp_lifecycle", "SELECT p.desig, p.iau_desig, p.status, n.obs80, e.event_type, e.event_user FROM neocp_prev p JOIN neocp n USING (desig) JOIN neocp_events e USING (desig) WHERE p.desig IN ('T4', 'T9')")
def _(t):
    p = t.neocp_prev.where(F.col("desig").isin("T4", "T9"))
    return neocp.lifecycle(p, t.neocp, t.neocp_events).select("desig", "iau_desig", "status", "obs80", "event_type", "event_user")


@query("candidate_orbits", f"SELECT p.desig AS neocp_desig, p.iau_desig, round(o.q, 6) AS q, o.orbit_type_int FROM neocp_prev p JOIN orbits o ON o.{U} = p.iau_desig WHERE p.iau_desig <> ''")
def _(t):
    return rounded(neocp.candidate_orbits(t.neocp_prev, t.orbits).select("neocp_desig", "iau_desig", "q", "orbit_type_int"), q=6)


@query("tracklet_bridge", "SELECT a.desig, a.trkid, o.obsid, a.created_at AS neocp_time, o.created_at AS sbn_time FROM neocp a JOIN obs o ON o.trkid = a.trkid WHERE a.trkid <> ''")
def _(t):
    return neocp.tracklet_bridge(t.neocp, t.obs).select("desig", "trkid", "obsid", "neocp_time", "sbn_time")


@query("neocp_outcomes", "SELECT CASE WHEN iau_desig IS NOT NULL AND iau_desig <> '' THEN 'designated' WHEN status = 'lost' THEN 'lost' WHEN status = 'dne' THEN 'does not exist' ELSE 'other (' || coalesce(status, 'null') || ')' END AS outcome, count(*) AS n FROM neocp_prev GROUP BY 1")
def _(t):
    return neocp.outcomes(t.neocp_prev)


@query("neocp_throughput", "SELECT substr(obs80, 78, 3) AS stn, count(*) AS nobs, count(DISTINCT desig) AS n_objects FROM neocp GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _(t):
    return neocp.throughput(t.neocp)


@query("neocp_object_counts", "SELECT desig, count(*) AS nobs, min(created_at) AS first_seen, max(created_at) AS last_seen FROM neocp GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _(t):
    return neocp.object_counts(t.neocp)


@query("time_on_page", """SELECT p.desig, p.iau_desig, min(a.created_at) AS posted, min(r.created_at) AS removed, epoch_us(min(r.created_at)) / 1e6 - epoch_us(min(a.created_at)) / 1e6 AS d
FROM neocp_prev p JOIN neocp_events a ON a.desig = p.desig AND a.event_type = 'ADDOBJ' JOIN neocp_events r ON r.desig = p.desig AND r.event_type = 'REMOBJ' WHERE p.iau_desig <> '' GROUP BY 1, 2""".replace(
    "epoch_us(min(r.created_at)) / 1e6 - epoch_us(min(a.created_at)) / 1e6 AS d", "round((epoch_us(min(r.created_at)) - epoch_us(min(a.created_at))) / 1000000.0, 3) AS duration_s"))
def _(t):
    return rounded(neocp.time_on_page(t.neocp_prev, t.neocp_events), duration_s=3)


_OBSERVED = "(epoch_us(CAST(replace(substr(obs80, 16, 10), ' ', '-') AS TIMESTAMP)) + CAST(substr(obs80, 27, 6) AS BIGINT) * 86400)"


def _block_rows(sides, key, first):
    d = factorised.linear(*sides, key=key)
    least = F.when(F.col("side") == first[0], F.col(f"left_items.{first[1]}")[0]).otherwise(F.col(f"right_items.{first[2]}")[0])
    return d.select(key, "side", "block", "n", least.alias("first_item"))


def _block_sql(key, side, table, order, item):
    return f"""SELECT {key}, '{side}' AS side, CAST((rn - 1) // 7 AS BIGINT) AS block, count(*) AS n, arg_min({item}, rn) AS first_item FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}) GROUP BY 1, 2, 3"""


# Rows in the order of their blocks, seven to a block; as many as both tables have, not their product.
@query("neocp_lifecycle_blocks", f"""WITH k AS (SELECT desig FROM neocp_prev INTERSECT SELECT desig FROM neocp INTERSECT SELECT desig FROM neocp_events),
a AS (SELECT * FROM neocp SEMI JOIN k USING (desig)), e AS (SELECT * FROM neocp_events SEMI JOIN k USING (desig))
{_block_sql('desig', 'observations', 'a', 'created_at, obs80, rmsra NULLS FIRST, rmsdec NULLS FIRST', 'obs80')} UNION ALL
{_block_sql('desig', 'events', 'e', 'created_at, event_type, event_text, event_user', 'event_type')}""")
def _(t):
    sides = neocp.lifecycle_sides(t.neocp_prev, t.neocp, t.neocp_events, size=7)
    return _block_rows(sides, "desig", ("observations", "obs80", "event_type"))


@query("tracklet_bridge_blocks", f"""WITH a AS (SELECT * FROM neocp WHERE nullif(trkid, '') IS NOT NULL AND trkid IN (SELECT trkid FROM obs)), b AS (SELECT * FROM obs WHERE nullif(trkid, '') IS NOT NULL AND trkid IN (SELECT trkid FROM neocp))
{_block_sql('trkid', 'candidates', 'a', 'created_at, obs80, desig', 'obs80')} UNION ALL {_block_sql('trkid', 'published', 'b', 'created_at, obsid', 'obsid')}""")
def _(t):
    return _block_rows(neocp.bridge_sides(t.neocp, t.obs, size=7), "trkid", ("candidates", "neocp_obs80", "obsid"))


@query("ingest_latency", f"""WITH m AS (SELECT (epoch_us(created_at) - {_OBSERVED}) / 60000000.0 AS m FROM neocp)
SELECT count(*) AS n, round(min(m), 4) AS min_m, round(quantile_cont(m, 0.5), 4) AS p50, round(quantile_cont(m, 0.9), 4) AS p90, round(quantile_cont(m, 0.95), 4) AS p95, round(max(m), 4) AS max_m FROM m""")
def _(t):
    return neocp.ingest_latency(t.neocp)


@query("event_distribution", "SELECT event_type, event_user, count(*) AS n FROM neocp_events GROUP BY 1, 2")
def _(t):
    return neocp.event_distribution(t.neocp_events)
