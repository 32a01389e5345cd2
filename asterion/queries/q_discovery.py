"""Discovery products, identity joins and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from asterion.operators import discovery, filters, identity, skytime, summary
from asterion.operators.ordered import with_position
from asterion.operators.ranking import top_k

from . import oracle_parts as S
from .registry import query

P = identity.PACKED
U = identity.UNPACKED

PRODUCT_SQL = S.chain("wide") + f"""
SELECT coalesce(l.number, s.unpacked_desig) AS primary_designation,
  s.packed_desig AS {P}, round(avg_mjd, 6) AS avg_mjd_discovery_tracklet,
  round(avg_ra_deg, 5) AS avg_ra_deg, round(avg_dec_deg, 5) AS avg_dec_deg,
  round(median_v_mag, 2) AS median_v_magnitude, nobs, round(span_hours, 4) AS span_hours,
  {S.RATE} AS rate_deg_per_day, {S.PA} AS position_angle_deg, d.stn AS discovery_site_code,
  replace(trim(c.name), chr(92) || '''', '''') AS discovery_site_name
FROM firsts d JOIN stats s USING (unpacked_desig) JOIN objs l USING (unpacked_desig)
LEFT JOIN obscodes c ON c.obscode = d.stn"""


@query("discovery_tracklets", PRODUCT_SQL)
def _(t):
    return discovery.discovery_tracklets(t.orbits, t.ni, t.obs, t.obscodes)


@query("load_discoveries", S.chain("iau") + """
SELECT d.unpacked_desig AS designation, CAST(year(d.obstime) AS INTEGER) AS disc_year,
  CAST(month(d.obstime) AS INTEGER) AS disc_month, CAST(d.obstime AS DATE) AS disc_date, d.obstime AS disc_obstime,
  d.stn AS station_code, round(l.h, 6) AS h, l.orbit_type_int, round(l.q, 6) AS q, round(l.e, 6) AS e, round(l.i, 6) AS i,
  round(avg_ra_deg, 5) AS avg_ra_deg, round(avg_dec_deg, 5) AS avg_dec_deg, round(median_v_mag, 4) AS median_v_mag,
  nobs AS tracklet_nobs
FROM firsts d JOIN objs l USING (unpacked_desig) LEFT JOIN stats s USING (unpacked_desig)""")
def _(t):
    d = discovery.load_discoveries(t.orbits, t.ni, t.obs, t.obscodes)
    return rounded(d.drop("stn_longitude", "stn_rhocosphi", "stn_rhosinphi", "stn_type"),
                   h=6, q=6, e=6, i=6, avg_ra_deg=5, avg_dec_deg=5, median_v_mag=4)


def rounded(df, **digits):
    """Round columns for display."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("discovery_tracklet_stats", S.chain("wide") + """
SELECT unpacked_desig, packed_desig, round(avg_mjd, 6) AS avg_mjd, round(avg_ra_deg, 5) AS avg_ra_deg,
  round(avg_dec_deg, 5) AS avg_dec_deg, round(median_v_mag, 4) AS median_v_mag, nobs, round(span_hours, 6) AS span_hours,
  round(span_days, 6) AS span_days, round(first_ra, 6) AS first_ra, round(first_dec, 6) AS first_dec,
  round(last_ra, 6) AS last_ra, round(last_dec, 6) AS last_dec FROM stats""")
def _(t):
    neos = identity.with_numbering(filters.select_neos(t.orbits, rule="wide"), t.ni)
    obs = t.obs
    d = discovery.tracklet_members(identity.earliest_discovery(neos, obs), obs)
    return rounded(discovery.discovery_tracklet_stats(d), avg_mjd=6, avg_ra_deg=5, avg_dec_deg=5,
                   median_v_mag=4, span_hours=6, span_days=6, first_ra=6, first_dec=6, last_ra=6, last_dec=6)


@query("tracklet_members", S.chain("iau") + """
SELECT unpacked_desig, packed_desig, obsid, obstime, round(ra, 6) AS ra, round(dec, 6) AS dec, round(mag, 6) AS mag, band FROM tracklet""")
def _(t):
    neos = identity.with_numbering(filters.select_neos(t.orbits, rule="iau"), t.ni)
    obs = t.obs
    d = discovery.tracklet_members(identity.earliest_discovery(neos, obs), obs)
    return rounded(d, ra=6, dec=6, mag=6)


@query("tracklet_first_last", S.chain("iau") + f"""
SELECT unpacked_desig, round(first_ra, 6) AS first_ra, round(last_ra, 6) AS last_ra, {S.RATE} AS rate_deg_per_day,
  {S.PA} AS position_angle_deg FROM stats""")
def _(t):
    neos = identity.with_numbering(filters.select_neos(t.orbits, rule="iau"), t.ni)
    obs = t.obs
    d = discovery.discovery_tracklet_stats(
        discovery.tracklet_members(identity.earliest_discovery(neos, obs), obs))
    m = discovery.motion_columns()
    return d.select("unpacked_desig", F.round("first_ra", 6).alias("first_ra"), F.round("last_ra", 6).alias("last_ra"),
                    F.round(m["rate_deg_per_day"], 4).alias("rate_deg_per_day"),
                    F.round(m["position_angle_deg"], 2).alias("position_angle_deg"))


@query("yearly_breakdown", S.chain("iau", stats=False) + """,
w AS (SELECT d.stn, d.obstime, l.h, l.q, l.e, CASE WHEN l.e < 1 THEN l.q / (1.0 - l.e) END AS a,
    CASE WHEN l.e < 1 THEN l.q * (1.0 + l.e) / (1.0 - l.e) END AS cap_q
  FROM firsts d JOIN objs l USING (unpacked_desig))
SELECT stn, CAST(year(obstime) AS INTEGER) AS disc_year, count(*) AS neos,
  count(*) FILTER (WHERE h < 17.75) AS neos_1km, count(*) FILTER (WHERE h <= 22.0) AS neos_h22,
  count(*) FILTER (WHERE a < 1 AND cap_q < 0.983) AS n_atira, count(*) FILTER (WHERE a < 1 AND cap_q >= 0.983) AS n_aten,
  count(*) FILTER (WHERE a >= 1 AND q < 1.017) AS n_apollo, count(*) FILTER (WHERE a >= 1 AND q >= 1.017) AS n_amor,
  count(*) FILTER (WHERE a IS NULL OR e >= 1) AS n_unclass
FROM w GROUP BY stn, year(obstime)""")
def _(t):
    return discovery.yearly_breakdown(t.orbits, t.ni, t.obs)


@query("earliest_per_key", """
SELECT provid, obstime, obsid, stn FROM (
  SELECT provid, obstime, obsid, stn, row_number() OVER (PARTITION BY provid ORDER BY obstime, obsid) AS rn
  FROM obs WHERE provid IS NOT NULL) WHERE rn = 1""")
def _(t):
    d = t.obs.where(F.col("provid").isNotNull()).select("provid", "obstime", "obsid", "stn")
    return discovery.earliest_per_key(d, key="provid", order="obstime", tie="obsid")


@query("designation_order", S.chain("iau", stats=False) + """
SELECT coalesce(l.number, d.unpacked_desig) AS primary_designation, d.stn
FROM firsts d JOIN objs l USING (unpacked_desig)
ORDER BY l.number IS NULL, coalesce(lpad(l.number, 10, '0'), d.unpacked_desig) LIMIT 25""")
def _(t):
    neos = identity.with_numbering(filters.select_neos(t.orbits, rule="iau"), t.ni)
    d = identity.earliest_discovery(neos, t.obs, carry=["permid"])
    d = d.select(F.coalesce("permid", "unpacked_desig").alias("primary_designation"), "stn")
    return discovery.designation_order(d).limit(25)


@query("designation_order_all", S.chain("iau", stats=False) + """
SELECT coalesce(l.number, d.unpacked_desig) AS primary_designation, d.stn,
  row_number() OVER (ORDER BY l.number IS NULL, coalesce(lpad(l.number, 10, '0'), d.unpacked_desig)) AS position
FROM firsts d JOIN objs l USING (unpacked_desig)""")
def _(t):
    neos = identity.with_numbering(filters.select_neos(t.orbits, rule="iau"), t.ni)
    d = identity.earliest_discovery(neos, t.obs, carry=["permid"])
    name = F.coalesce("permid", "unpacked_desig")
    d = d.select(name.alias("primary_designation"), "stn", F.col("permid").isNull().cast("int").alias("_named"),
                 F.when(F.col("permid").isNull(), name).otherwise(F.lpad(name, 10, F.lit("0"))).alias("_key"))
    # Numbers by thousands, then names.
    bucket = F.when(F.col("_named") == 1, F.lit(1 << 40)).otherwise(F.floor(F.col("_key").try_cast("bigint") / 1000))
    d = with_position(d, order=["_named", "_key"], bucket=bucket)
    return discovery.designation_order(d.select("primary_designation", "stn", "position"))


@query("sky_distribution", f"""WITH p AS ({PRODUCT_SQL.replace("WITH ", "WITH ", 1)})
SELECT axis, bin_lo, bin_lo_dec, count(*) AS n FROM (
  SELECT 'v_mag' AS axis, floor(median_v_magnitude / 0.5) * CAST(0.5 AS DOUBLE) AS bin_lo, CAST(NULL AS DOUBLE) AS bin_lo_dec FROM p
  UNION ALL SELECT 'position_angle', floor(position_angle_deg / 15) * CAST(15 AS DOUBLE), NULL FROM p
  UNION ALL SELECT 'sky', floor(avg_ra_deg / 10) * CAST(10 AS DOUBLE), floor(avg_dec_deg / 10) * CAST(10 AS DOUBLE) FROM p)
WHERE bin_lo IS NOT NULL GROUP BY axis, bin_lo, bin_lo_dec""")
def _(t):
    return discovery.sky_distribution(discovery.discovery_tracklets(t.orbits, t.ni, t.obs, t.obscodes))


@query("expanded_discoveries", f"""WITH p AS ({PRODUCT_SQL})
SELECT p.primary_designation, p.{P}, p.discovery_site_code, p.nobs, TRY_CAST(n.permid AS INTEGER) AS permanent_number,
  n.iau_name AS name, round(o.h, 4) AS h,
  {S.label('coalesce(o.orbit_type_int, ' + S.CLASSIFY + ')', "'Unclassified'", 'Other (Unusual)')} AS orbit_class,
  round(o.earth_moid, 6) AS earth_moid, coalesce(o.earth_moid, 999) <= 0.05 AND coalesce(o.h, 99) <= 22 AS pha,
  c.longitude AS stn_longitude, c.observations_type AS stn_type
FROM p JOIN orbits o ON o.{P} = p.{P} LEFT JOIN ni n ON n.{P} = p.{P} LEFT JOIN obscodes c ON c.obscode = p.discovery_site_code""")
def _(t):
    d = discovery.expanded_discoveries(t.orbits, t.ni, t.obs, t.obscodes)
    return d.select("primary_designation", P, "discovery_site_code", "nobs", "permanent_number", "name",
                    F.round("h", 4).alias("h"), "orbit_class", F.round("earth_moid", 6).alias("earth_moid"),
                    "pha", "stn_longitude", "stn_type")


# -- identity joins -----------------------------------------------------------------

@query("with_numbering", f"""
SELECT o.{U} AS designation, n.permid IS NOT NULL AS is_numbered, n.permid,
  CASE WHEN n.permid IS NULL THEN o.{U} END AS provisional_desig, n.{U} AS num_provid
FROM orbits o LEFT JOIN ni n ON n.{P} = o.{P}""")
def _(t):
    return identity.with_numbering(t.orbits, t.ni).select(
        F.col(U).alias("designation"), "is_numbered", "permid", "provisional_desig", "num_provid")


@query("match_by_designation", S.chain("wide", stats=False) + " SELECT * FROM sightings")
def _(t):
    neos = identity.with_numbering(filters.select_neos(t.orbits, rule="wide"), t.ni)
    return identity.match_by_designation(neos, t.obs)


@query("or_key_join", """
SELECT m.primary_desig, o.obsid, o.obstime, o.stn
FROM (SELECT primary_desig, max(permid) AS permid FROM members WHERE NOT is_comet GROUP BY primary_desig) m
JOIN obs o ON (m.permid IS NOT NULL AND o.permid = m.permid) OR o.provid = m.primary_desig""")
def _(t):
    targets = t.members.where(~F.col("is_comet")).groupBy("primary_desig").agg(F.max("permid").alias("permid"))
    return identity.or_key_join(targets, t.obs, columns=["obsid", "obstime", "stn"])


@query("alias_semi_join", f"""
WITH prim AS (SELECT {P} AS p, {U} AS u FROM orbits WHERE q <= 1.30),
provids AS (SELECT u AS key FROM prim
  UNION SELECT c.unpacked_secondary_provisional_designation FROM ci c JOIN prim ON prim.p = c.{P}
  UNION SELECT n.{U} FROM ni n JOIN prim ON prim.p = n.{P}),
permids AS (SELECT n.permid AS key FROM ni n JOIN prim ON prim.p = n.{P})
SELECT id, obsid, permid, provid, trkid, stn, obstime, disc FROM obs
WHERE provid IN (SELECT key FROM provids) OR permid IN (SELECT key FROM permids)""")
def _(t):
    return identity.alias_semi_join(t.obs, t.orbits, t.ci, t.ni).select(
        "id", "obsid", "permid", "provid", "trkid", "stn", "obstime", "disc")


def _list_of(t):
    """Two objects in three of the catalogue, and as many that nobody observed."""
    d = t.part.select("p_partkey")
    name = F.concat(F.lit("U"), F.col("p_partkey").cast("string"))
    numbered = F.col("p_partkey") % 3 == 0
    number = F.when(numbered, F.col("p_partkey").cast("string"))
    return d.select(F.concat(F.lit("P"), name).alias("packed_desig"), name.alias("unpacked_desig"),
                    numbered.alias("is_numbered"), number.alias("asteroid_number"),
                    F.when(~numbered, name).alias("provisional_desig"),
                    F.when(numbered, name).alias("num_provid"))


_LIST_SQL = """nl AS (SELECT 'PU' || p_partkey AS packed_desig, 'U' || p_partkey AS unpacked_desig, p_partkey % 3 = 0 AS is_numbered,
    CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR) END AS asteroid_number,
    CASE WHEN p_partkey % 3 <> 0 THEN 'U' || p_partkey END AS provisional_desig,
    CASE WHEN p_partkey % 3 = 0 THEN 'U' || p_partkey END AS num_provid FROM part)"""


@query("unmatched_list_entries", f"""WITH {_LIST_SQL},
hit AS (SELECT DISTINCT unpacked_desig FROM nl JOIN obs o ON o.disc = '*' AND (
   (is_numbered AND o.permid = asteroid_number) OR (NOT is_numbered AND o.provid = provisional_desig) OR o.provid = num_provid))
SELECT packed_desig, unpacked_desig, is_numbered, coalesce(asteroid_number, '') AS asteroid_number,
  CASE WHEN is_numbered THEN asteroid_number ELSE '' END AS match_attempt_permid,
  coalesce(provisional_desig, num_provid, '') AS match_attempt_provid
FROM nl WHERE unpacked_desig NOT IN (SELECT unpacked_desig FROM hit)""")
def _(t):
    return identity.unmatched(_list_of(t), t.obs)


@query("existence_probe", f"""WITH {_LIST_SQL}
SELECT unpacked_desig, EXISTS (SELECT 1 FROM obs WHERE permid = nl.asteroid_number) AS permid_exists,
  EXISTS (SELECT 1 FROM obs WHERE provid = nl.num_provid) AS provid_exists,
  EXISTS (SELECT 1 FROM obs WHERE permid = nl.asteroid_number AND disc = '*') AS has_disc
FROM nl WHERE is_numbered""")
def _(t):
    return identity.existence_probe(_list_of(t).where("is_numbered"), t.obs).select(
        "unpacked_desig", "permid_exists", "provid_exists", "has_disc")


@query("member_designations", f"""
SELECT DISTINCT primary_desig, primary_desig AS designation, 'primary' AS kind FROM members
UNION SELECT m.primary_desig, c.unpacked_secondary_provisional_designation, 'secondary' FROM members m JOIN ci c ON c.{P} = m.packed_desig
UNION SELECT m.primary_desig, n.permid, 'permid' FROM members m JOIN ni n ON n.{P} = m.packed_desig WHERE n.permid IS NOT NULL""")
def _(t):
    return identity.member_designations(t.members, t.ci, t.ni)


_PACKNUM = """CASE WHEN CAST(n AS BIGINT) < 100000 THEN lpad(n, 5, '0') END"""


@query("alias_lists", f"""
SELECT 'numbered' AS kind, lpad(n.permid, 5, '0') AS primary_key,
  string_agg(DISTINCT c.packed_secondary_provisional_designation, ',' ORDER BY c.packed_secondary_provisional_designation) AS secondaries
FROM ci c JOIN ni n ON n.{P} = c.{P} GROUP BY n.permid
UNION ALL
SELECT 'unnumbered', {P}, string_agg(DISTINCT packed_secondary_provisional_designation, ',' ORDER BY packed_secondary_provisional_designation)
FROM ci WHERE packed_secondary_provisional_designation <> {P} AND NOT numbered GROUP BY {P}""")
def _(t):
    return identity.alias_lists(t.ci, t.ni).withColumn("secondaries", F.array_join("secondaries", ","))


@query("alias_link_lines", f"""
SELECT 'unnumbered' AS kind, {P} AS primary_key,
  '"' || {P} || '": [' || string_agg(DISTINCT '"' || packed_secondary_provisional_designation || '"', ',' ORDER BY '"' || packed_secondary_provisional_designation || '"') || '],' AS links
FROM ci WHERE packed_secondary_provisional_designation <> {P} AND NOT numbered GROUP BY {P}""")
def _(t):
    return identity.alias_link_lines(identity.alias_lists(t.ci, t.ni)).where(F.col("kind") == "unnumbered")


@query("ades_rows", """
SELECT id, permid, provid, obstime FROM obs o WHERE status IN ('P', 'p') AND deprecated IS NULL AND (permid = '3' OR
  (permid IS NULL AND provid IN (SELECT unpacked_secondary_provisional_designation FROM ci
     WHERE packed_primary_provisional_designation = 'PU4')))""")
def _(t):
    return identity.ades_rows(t.obs, t.ci, permids=["3"], packed=["PU4"]).select("id", "permid", "provid", "obstime")


_ALTER = {
    "deletions": "SELECT CAST(event_id AS VARCHAR(20)) AS obsid FROM {events} WHERE event_id % 31 = 0",
    "redesignations": "SELECT CAST(event_id AS VARCHAR(20)) AS obsid, concat('N', CAST(user_id AS VARCHAR(20))) AS unpacked_provisional_designation_to, ts + INTERVAL 40 DAY AS created_at FROM {events} WHERE event_id % 37 = 0",
    "corrections": "SELECT CAST(event_id AS VARCHAR(20)) AS obsid_old, concat('c', CAST(event_id AS VARCHAR(20))) AS obsid_new FROM {events} WHERE event_id % 41 = 0",
}


@query("apply_alterations", """
SELECT id, CASE WHEN id % 41 = 0 THEN 'c' || obsid ELSE obsid END AS obsid,
  CASE WHEN id % 37 = 0 THEN 'N' || e.user_id ELSE provid END AS provid, stn
FROM obs JOIN events e ON e.event_id = obs.id WHERE id % 31 <> 0""")
def _(t):
    return identity.apply_alterations(t.obs, *[t.sql(_ALTER[k]) for k in ("deletions", "redesignations", "corrections")]) \
        .select("id", "obsid", "provid", "stn")


@query("identification_activity", """
SELECT CAST(date_trunc('month', ts + INTERVAL 40 DAY) AS DATE) AS month, event_type AS stn, count(*) AS n,
  CAST(40 AS DOUBLE) AS mean_days FROM events WHERE event_id % 37 = 0 GROUP BY 1, 2""")
def _(t):
    return identity.identification_activity(t.sql(_ALTER["redesignations"]), t.obs)


@query("distinct_packed_neos", f"SELECT DISTINCT {P} FROM orbits WHERE q <= 1.30")
def _(t):
    return identity.distinct_packed_neos(t.orbits)


# -- filters ------------------------------------------------------------------------

@query("published_active", "SELECT id, status FROM obs WHERE status IN ('P', 'p') AND deprecated IS NULL")
def _(t):
    return filters.published_active(t.obs).select("id", "status")


@query("select_neos", "\nUNION ALL ".join(
    f"SELECT '{r}' AS rule, o.id FROM orbits o WHERE {S.RULES[r]}" for r in ("iau", "wide", "class", "asteroid")))
def _(t):
    orbits = t.orbits
    # One pass: every rule an orbit satisfies.
    rules = F.array(*[F.when(filters.neo_rule(r), F.lit(r)) for r in filters.NEO_RULES])
    return orbits.select("id", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("rule"))


@query("neo_and_pha_flags", """
SELECT id, q IS NOT NULL AND q <= 1.3 AS is_neo,
  q IS NOT NULL AND e IS NOT NULL AND h IS NOT NULL AND q <= 1.3 AND e < 1 AND h <= 22 AS is_pha,
  coalesce(earth_moid, 999) <= 0.05 AND coalesce(h, 99) <= 22 AS pha FROM orbits""")
def _(t):
    from asterion.functions import orbit
    return filters.pha_flag(t.orbits).select("id", orbit.is_neo("q").alias("is_neo"),
                                             orbit.is_pha("q", "e", "h").alias("is_pha"), "pha")


@query("pha_flag_by_list", "SELECT id, id % 6 = 0 AS pha FROM orbits")
def _(t):
    listed = t.orbits.where(F.col("id") % 6 == 0).select("id")
    return filters.pha_flag(t.orbits, listed, key="id").select("id", "pha")


@query("orbit_select", f"""
SELECT id, orbit_type_int, round(a, 6) AS a, round(q, 6) AS q, round(e, 6) AS e, round(tj, 6) AS tisserand_j FROM (
  SELECT id, orbit_type_int, h, i, q, e, coalesce(a, CASE WHEN e < 1 THEN q / (1 - e) END) AS a FROM orbits),
  LATERAL (SELECT 5.2026 / a + 2 * cos(radians(i)) * sqrt(greatest(a / 5.2026 * (1 - e * e), 0)) AS tj)
WHERE (orbit_type_int IN (1, 2, 3, 10) OR orbit_type_int IS NULL) AND h BETWEEN 15 AND 28 AND a BETWEEN 0.5 AND 20
  AND e BETWEEN 0.05 AND 0.95 AND q BETWEEN 0.3 AND 1.7 AND i BETWEEN 1 AND 170""")
def _(t):
    d = filters.orbit_select(t.orbits, columns=["id", "orbit_type_int", "a", "q", "e"], orbit_types=[1, 2, 3, 10],
                             include_unclassified=True, h_range=(15, 28), a_range=(0.5, 20), e_range=(0.05, 0.95),
                             q_range=(0.3, 1.7), i_range=(1, 170), tisserand=True)
    return rounded(d, a=6, q=6, e=6, tisserand_j=6)


@query("orbit_count", "SELECT count(*) AS n FROM orbits WHERE earth_moid <= 0.05 AND q <= 1.3")
def _(t):
    return filters.orbit_select(t.orbits, earth_moid_max=0.05, q_range=(-1e9, 1.3), count_only=True)


@query("orbit_json_fields", """
SELECT id, TRY_CAST(json_extract_string(j, '$.orbit_fit_statistics.SNR') AS DOUBLE) AS snr,
  json_extract_string(j, '$.orbit_fit_statistics.orbit_quality') AS orbit_quality
FROM (SELECT id, CASE WHEN json_valid(mpc_orb_jsonb) THEN mpc_orb_jsonb END AS j FROM orbits)""")
def _(t):
    return filters.json_fields(t.orbits, keys=["snr", "orbit_quality"]).select("id", "snr", "orbit_quality")


@query("derived_elements", """
SELECT id, round(coalesce(a, CASE WHEN e < 1 THEN q / (1 - e) END), 6) AS a,
  round(CASE WHEN e < 1 THEN coalesce(a, q / (1 - e)) * (1 + e) END, 6) AS aphelion_q,
  round(CASE WHEN e < 1 THEN pow(q / (1 - e), 1.5) END, 6) AS period_yr FROM orbits""")
def _(t):
    return rounded(filters.derived_elements(t.orbits).select("id", "a", "aphelion_q", "period_yr"),
                   a=6, aphelion_q=6, period_yr=6)


@query("object_key", f"SELECT id, {S.KEY} AS primary_desig FROM obs WHERE {S.KEY} IS NOT NULL")
def _(t):
    return filters.with_object_key(t.obs).select("id", "primary_desig")


@query("clean_site_name", "SELECT obscode, replace(trim(name), chr(92) || '''', '''') AS name FROM obscodes")
def _(t):
    return t.obscodes.select("obscode", filters.clean_site_name("name").alias("name"))


@query("date_window", "SELECT id, obstime FROM obs WHERE obstime >= '2024-01-05' AND obstime < '2024-01-11'")
def _(t):
    return filters.date_window(t.obs, time="obstime", start="2024-01-05", end="2024-01-10").select("id", "obstime")


@query("quality_gate", """
SELECT DISTINCT obs80, rmsra, rmsdec FROM neocp
WHERE (rmsra IS NULL OR rmsra < 5) AND (rmsdec IS NULL OR rmsdec < 5) AND substr(obs80, 15, 1) NOT IN ('X', 'x')""")
def _(t):
    return filters.quality_gate(t.neocp)


@query("q_solidity_verdict", """
SELECT primary_desig, CASE WHEN nf_q IS NULL THEN 'drop_q_none' WHEN nf_q <= 1.3 THEN 'keep'
  WHEN o.q IS NULL OR o.q > 1.3 THEN 'drop_solid' WHEN abs(nf_q - o.q) <= 0.02 + 1e-9 THEN 'drop_solid' ELSE 'keep_unsolid' END AS verdict
FROM members m LEFT JOIN orbits o ON o.unpacked_primary_provisional_designation = m.primary_desig WHERE m.source IN ('s3', 's4')""")
def _(t):
    d = t.members.where(F.col("source").isin("s3", "s4")).join(
        t.orbits.select(F.col(U).alias("primary_desig"), "q"), "primary_desig", "left")
    return d.select("primary_desig", filters.q_solidity_verdict("nf_q", "q").alias("verdict"))


@query("best_value", "SELECT id, round(coalesce(nullif(a, -1), q / 2), 6) AS best FROM orbits")
def _(t):
    d = t.orbits.withColumn("half", F.col("q") / 2)
    return d.select("id", F.round(filters.best_value("a", "half", sentinel=-1.0), 6).alias("best"))


@query("ref_class", """
SELECT id, CASE WHEN coalesce(nullif(ref, ''), nullif(prev_ref, '')) IS NULL THEN 'none'
  WHEN coalesce(nullif(ref, ''), nullif(prev_ref, '')) LIKE 'MPEC%' THEN 'MPEC'
  WHEN coalesce(nullif(ref, ''), nullif(prev_ref, '')) LIKE 'MPS%' THEN 'MPS' ELSE 'other' END AS ref_class FROM obs""")
def _(t):
    return t.obs.select("id", filters.ref_class("ref", "prev_ref").alias("ref_class"))


@query("neocp_select", "SELECT id, desig FROM neocp WHERE desig = 'T7'")
def _(t):
    return filters.neocp_select(t.neocp, desig="T7").select("id", "desig")


@query("neocp_archive_select", """SELECT id, desig FROM neocp WHERE desig IN (
  SELECT desig FROM neocp_prev WHERE desig = 'U9' OR iau_desig = 'U9' OR pkd_desig = 'U9') OR desig = 'U9'""")
def _(t):
    return filters.neocp_archive_select(t.neocp, t.neocp_prev, desig="U9").select("id", "desig")


# -- circumstances --------------------------------------------------------------------

def circumstances(t):
    codes = t.obscodes
    product = discovery.discovery_tracklets(t.orbits, t.ni, t.obs, codes, with_time=True)
    return discovery.discovery_circumstances(product, None, codes, skytime.lunar_eclipses(t.spark))


SUN_SQL = """sun AS (SELECT *, fmod(fmod(degrees(atan2(cos(eps) * sin(lon), cos(lon))), 360) + 360, 360) AS sun_ra,
    degrees(asin(sin(eps) * sin(lon))) AS sun_dec FROM (
  SELECT *, radians(l0 + 1.915 * sin(mm) + 0.020 * sin(2 * mm)) AS lon, radians(23.439 - 0.013 * tc) AS eps FROM (
    SELECT *, fmod(fmod(280.466 + 36000.77 * tc, 360) + 360, 360) AS l0, radians(fmod(fmod(357.529 + 35999.05 * tc, 360) + 360, 360)) AS mm FROM (
      SELECT *, (epoch_us(obstime) - 946728000000000) / 86400000000.0 AS dj, (epoch_us(obstime) - 946728000000000) / 86400000000.0 / 36525.0 AS tc FROM base))))"""

ALT_SQL = """degrees(asin(greatest(-1.0, least(1.0, sin(lat) * sin(radians(sun_dec)) + cos(lat) * cos(radians(sun_dec))
   * cos(radians(280.46061837 + 360.98564736629 * dj + 0.000387933 * tc * tc + longitude - sun_ra))))))"""

TWILIGHT_SQL = """CASE WHEN observations_type = 'satellite' THEN 'Space-based' WHEN alt < -18 THEN 'Nighttime'
   WHEN alt < -12 THEN 'Astronomical twilight' WHEN alt < -6 THEN 'Nautical twilight' WHEN alt < 0 THEN 'Civil twilight'
   WHEN alt >= 0 THEN 'Daytime' ELSE 'Unknown site' END"""

CIRC_SQL = S.chain("wide", stats=False) + f""",
base AS (SELECT coalesce(l.number, d.unpacked_desig) AS primary_designation, d.obstime,
   c.longitude, atan2(c.rhosinphi, c.rhocosphi) AS lat, c.observations_type
  FROM firsts d JOIN objs l USING (unpacked_desig) LEFT JOIN obscodes c ON c.obscode = d.stn),
{SUN_SQL}, alts AS (SELECT *, {ALT_SQL} AS alt FROM sun)"""


@query("discovery_circumstances", CIRC_SQL + f"""
SELECT primary_designation, round(alt, 2) AS sun_alt_deg, {TWILIGHT_SQL} AS twilight_class FROM alts""")
def _(t):
    return circumstances(t).select("primary_designation", "sun_alt_deg", "twilight_class")


@query("circumstance_summary", CIRC_SQL + f""", cls AS (SELECT {TWILIGHT_SQL} AS twilight_class FROM alts)
SELECT twilight_class, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM cls), 2) AS pct FROM cls GROUP BY 1""")
def _(t):
    return skytime.circumstance_summary(circumstances(t))


@query("eclipse_discoveries")
def _(t):
    return skytime.eclipse_discoveries(circumstances(t))


@query("lunar_elongation_range")
def _(t):
    return skytime.elongation_range(circumstances(t))


@query("product_check", "WITH p AS (" + PRODUCT_SQL + ") SELECT count(*) AS n_rows, 12 AS n_columns, count(*) >= 10 AS ok FROM p")
def _(t):
    return summary.product_check(discovery.discovery_tracklets(t.orbits, t.ni, t.obs, t.obscodes),
                                 min_rows=10, n_columns=12)


@query("row_drift_check", """
SELECT c.event_type AS name, c.n, p.n AS prior, round(100.0 * abs(c.n - p.n) / p.n, 1) AS pct_change,
  CASE WHEN c.n > p.n THEN 'grew' ELSE 'shrank' END AS problem
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) c
JOIN (SELECT event_type, count(*) FILTER (WHERE event_id % length(event_type) <> 0) AS n FROM events GROUP BY 1) p USING (event_type)
WHERE abs(c.n - p.n) * 1.0 / p.n > 0.20""")
def _(t):
    e = t.events
    now = e.groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("n"))
    before = e.where(F.col("event_id") % F.length("event_type") != 0).groupBy(
        F.col("event_type").alias("name")).agg(F.count("*").alias("n"))
    return summary.row_drift_check(now, before)


@query("top_k", "SELECT id, round(mag, 6) AS mag FROM obs WHERE mag IS NOT NULL ORDER BY mag DESC, id LIMIT 100")
def _(t):
    return rounded(top_k(t.obs.where(F.col("mag").isNotNull()).select("id", "mag"),
                         order=[F.desc("mag"), "id"], k=100), mag=6)
