"""Text sources, exchange formats and designations."""

from __future__ import annotations

from pyspark.sql import functions as F

from asterion.functions import circular, designation as D, formats, obs80, orbit, photometry, sky, timeconv
from asterion.operators import identity, neocp, stations
from asterion.operators.boxscore import COUNTS
from asterion.sources import readers

from . import oracle_parts as S
from .adapters import _packed, _readable
from .q_discovery import rounded
from .registry import query

P, U = identity.PACKED, identity.UNPACKED

# -- fixed-width and one-per-line lists ------------------------------------------------------

_NUM = "CAST(trim(substr(value, {0}, {1})) AS DOUBLE)"


@query("parse_mpcorb", f"""WITH x AS (SELECT rtrim(substr(value, 1, 7)) AS packed_desig, trim(substr(value, 167, 28)) AS readable_desig, {_NUM.format(9, 5)} AS h, {_NUM.format(71, 9)} AS e, {_NUM.format(93, 11)} AS a, {_NUM.format(60, 9)} AS i, {_NUM.format(27, 9)} AS mean_anom FROM list_lines)
SELECT packed_desig, readable_desig, regexp_matches(packed_desig, '^[0-9]+$|^[A-Za-z][0-9]+$|^~') AS is_numbered, CASE WHEN h > 0 AND h <= 90 THEN h END AS h, e, a, i, mean_anom,
  round(CASE WHEN e < 1 THEN a * (1 - e) END, 6) AS q, round(CASE WHEN e < 1 THEN a * (1 + e) END, 6) AS cap_q FROM x""")
def _(t):
    return rounded(readers.parse_mpcorb(t.list_lines).select(
        "packed_desig", "readable_desig", "is_numbered", "h", "e", "a", "i", "mean_anom", "q", "cap_q"), q=6, cap_q=6)


@query("parse_mpcorb_identity", f"""SELECT rtrim(substr(value, 1, 7)) AS packed_desig, CASE WHEN k % 4 = 0 THEN CASE WHEN k % 100000 = 0 THEN '' ELSE CAST(k % 100000 AS VARCHAR) END END AS number,
  CASE WHEN k % 4 <> 0 THEN {_readable('k')} END AS unpacked_desig FROM list_lines""")
def _(t):
    return readers.parse_mpcorb(t.list_lines).select("packed_desig", "number", "unpacked_desig")


@query("parse_list_identity", f"""WITH x AS (SELECT trim(substr(value, 1, 7)) AS packed_desig, trim(substr(value, 167, 28)) AS unpacked_desig FROM list_lines), y AS (SELECT *, nullif(regexp_extract(unpacked_desig, '^\\(([0-9]+)\\)', 1), '') AS num FROM x)
SELECT packed_desig, unpacked_desig, num IS NOT NULL AS is_numbered, num AS asteroid_number, CASE WHEN num IS NULL THEN unpacked_desig END AS provisional_desig, n.{U} AS num_provid FROM y LEFT JOIN ni n ON n.permid = num""")
def _(t):
    return readers.parse_list_identity(t.list_lines, t.ni)


# The orbit file's columns: number 1-6, name 8-25, e 159-168, a 170-181.
_ASTORB = """SELECT concat(CASE WHEN p_partkey % 3 = 0 THEN lpad(CAST(p_partkey % 1000000 AS VARCHAR(20)), 6, ' ') ELSE '      ' END, ' ', rpad(concat('Name ', CAST(p_partkey AS VARCHAR(20))), 18, ' '), rpad('', 133, ' '),
  CASE WHEN p_partkey % 50 = 7 THEN 'bad       ' ELSE concat(CASE WHEN p_partkey % 20 = 1 THEN '1.' ELSE '0.' END, lpad(CAST(p_partkey * 7919 % 100000000 AS VARCHAR(20)), 8, '0')) END, ' ',
  concat(lpad(CAST(1 + p_partkey % 3 AS VARCHAR(3)), 3, ' '), '.', lpad(CAST(p_partkey * 104729 % 100000000 AS VARCHAR(20)), 8, '0')), '  ') AS value FROM {part}"""
_ASTORB_SQL = "al AS (" + _ASTORB.replace("{part}", "part") + "), ax AS (SELECT TRY_CAST(trim(substr(value, 159, 10)) AS DOUBLE) AS e, TRY_CAST(trim(substr(value, 170, 12)) AS DOUBLE) AS a, coalesce(nullif(trim(substr(value, 1, 6)), ''), nullif(trim(substr(value, 8, 18)), '')) AS raw FROM al)"


@query("parse_astorb", f"WITH {_ASTORB_SQL} SELECT raw, e, a FROM ax WHERE e < 1 AND a * (1 - e) <= 1.3")
def _(t):
    return readers.parse_astorb(t.sql(_ASTORB)).select("raw", "e", "a")


@query("count_unparseable", f"WITH {_ASTORB_SQL} SELECT count(*) AS n_lines, count(*) FILTER (WHERE e IS NULL OR a IS NULL) AS n_skipped FROM ax")
def _(t):
    return readers.count_unparseable(t.sql(_ASTORB))


_COMPACT = f"SELECT concat('  ', CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR(20)) WHEN p_partkey % 40 = 1 THEN '6344P-L' ELSE replace({_readable('p_partkey')}, ' ', '') END, '   ', p_name) AS value, p_partkey FROM {{part}}"


@query("parse_neocc_list", f"SELECT CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR) WHEN p_partkey % 40 = 1 THEN '6344 P-L' ELSE {_readable('p_partkey')} END AS raw, CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR) END AS permid FROM part")
def _(t):
    return readers.parse_neocc_list(t.sql(_COMPACT))


@query("parse_key_list", f"SELECT CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE {_readable('p_partkey')} END AS key, CASE WHEN p_partkey % 4 = 0 THEN 'permid' ELSE 'provid' END AS kind FROM part")
def _(t):
    return readers.parse_key_list(t.sql(f"SELECT CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR(20)) ELSE {_readable('p_partkey')} END AS value FROM {{part}}"))


# -- JSON ------------------------------------------------------------------------------------

_SBDB = f"""SELECT concat('{{{{"fields": ["pdes", "full_name", "H", "e", "moid"], "data": [["', CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR(20)) WHEN p_partkey % 4 = 1 THEN 'odd' ELSE {_readable('p_partkey')} END,
  '", "   (A/', {_readable('p_partkey')}, ')", "', CAST(10 + p_size AS VARCHAR(20)), '.5", "0.25", ', CASE WHEN p_partkey % 5 = 0 THEN 'null' ELSE '"0.125"' END, '], [null, "x", null, "y", null]], "count": 2}}}}') AS value FROM {{part}}"""


@query("parse_sbdb_json", f"""SELECT CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR) WHEN p_partkey % 4 = 1 THEN 'odd' ELSE {_readable('p_partkey')} END AS pdes, 10.5 + p_size::DOUBLE AS "H", 0.25::DOUBLE AS e,
  CASE WHEN p_partkey % 5 <> 0 THEN 0.125::DOUBLE END AS moid, 'A/' || {_readable('p_partkey')} AS alt_desig, p_partkey % 4 = 0 AS is_numbered FROM part""")
def _(t):
    return readers.parse_sbdb_json(t.sql(_SBDB), fields=["pdes", "full_name", "H", "e", "moid"]).drop("full_name")


def _one_document(t, opening, rows, closing):
    """One JSON document in one file, a row of a table to a line."""
    from .q_jobs import work_dir
    path = work_dir(t)
    last = t.part.agg(F.max("p_partkey")).first()[0]
    lines = t.sql(rows).select("k", F.concat("value", F.when(F.col("k") < last, F.lit(",")).otherwise(F.lit(""))).alias("value"))
    ends = t.spark.createDataFrame([(-1, opening), (1 << 60, closing)], "k bigint, value string")
    lines.select(F.col("k").cast("bigint"), "value").unionByName(ends).coalesce(1).sortWithinPartitions("k").select("value").write.text(path)
    return path


@query("read_sbdb_document", f"""SELECT CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE {_readable('p_partkey')} END AS pdes, 'odd, "quoted" [name] (A/' || p_partkey || ')' AS full_name, 10.5 + p_size::DOUBLE AS "H",
  CASE WHEN p_partkey % 5 <> 0 THEN 0.125::DOUBLE END AS moid, 'A/' || p_partkey AS alt_desig, p_partkey % 4 = 0 AS is_numbered FROM part""")
def _(t):
    rows = f"""SELECT p_partkey AS k, concat('["', CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR(20)) ELSE {_readable('p_partkey')} END, '", "odd, ', chr(92), '"quoted', chr(92), '" [name] (A/', CAST(p_partkey AS VARCHAR(20)), ')", "',
      CAST(10 + p_size AS VARCHAR(20)), '.5", ', CASE WHEN p_partkey % 5 = 0 THEN 'null' ELSE '"0.125"' END, ']') AS value FROM {{part}}"""
    path = _one_document(t, '{"signature": {"source": "a, [b"}, "fields": ["pdes", "full_name", "H", "moid"], "data": [', rows, '], "count": "many"}')
    return readers.read_sbdb_json(t.spark, path, fields=["pdes", "full_name", "H", "moid"])


@query("read_target_document", """SELECT 'PU' || p_partkey || CASE WHEN p_partkey % 6 = 0 THEN ', {x' ELSE '' END AS packed_desig, CASE WHEN p_partkey % 9 <> 0 THEN 1.25::DOUBLE END AS q, (p_partkey % 101)::DOUBLE AS neo_prob, 5::DOUBLE AS u, p_partkey % 11 = 0 AS neocp FROM part""")
def _(t):
    rows = """SELECT p_partkey AS k, concat('"PU', CAST(p_partkey AS VARCHAR(20)), CASE WHEN p_partkey % 6 = 0 THEN ', {{x' ELSE '' END, '": {{"q": ', CASE WHEN p_partkey % 9 = 0 THEN 'null' ELSE '1.25' END,
      ', "neo": ', CAST(p_partkey % 101 AS VARCHAR(20)), ', "u": 5', CASE WHEN p_partkey % 11 = 0 THEN ', "neocp": true' ELSE '' END, '}}') AS value FROM {part}"""
    path = _one_document(t, '{"status": "ok, [really]", "result": {"objects": {', rows, '}, "n": 1}}')
    return readers.read_target_map_json(t.spark, path)


@query("recovered_designation", f"SELECT CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR) WHEN p_partkey % 4 = 1 THEN 'A/' || {_readable('p_partkey')} ELSE {_readable('p_partkey')} END AS raw FROM part")
def _(t):
    return readers.recovered_designation(readers.parse_sbdb_json(t.sql(_SBDB), fields=["pdes", "full_name"])).select("raw")


_TARGETS = """SELECT concat('{{"result": {{"objects": {{"PU', CAST(p_partkey AS VARCHAR(20)), '": {{"q": ', CASE WHEN p_partkey % 9 = 0 THEN 'null' ELSE concat('1.', lpad(CAST(p_partkey * 7 % 600 AS VARCHAR(20)), 3, '0')) END,
  ', "neo": ', CAST(p_partkey % 101 AS VARCHAR(20)), ', "u": 5', CASE WHEN p_partkey % 11 = 0 THEN ', "neocp": true' ELSE '' END, '}}, "x', CAST(p_partkey AS VARCHAR(20)), '": {{"q": 0.9}}}}}}}}') AS value FROM {part}"""


@query("parse_target_map_json", """SELECT 'PU' || p_partkey AS packed_desig, CASE WHEN p_partkey % 9 <> 0 THEN 1 + (p_partkey * 7 % 600) / 1000.0 END AS q, (p_partkey % 101)::DOUBLE AS neo_prob, 5::DOUBLE AS u, p_partkey % 11 = 0 AS neocp FROM part
UNION ALL SELECT 'x' || p_partkey, 0.9::DOUBLE, NULL, NULL, FALSE FROM part""")
def _(t):
    return readers.parse_target_map_json(t.sql(_TARGETS))


@query("solid_targets", f"""WITH tg AS (SELECT 'PU' || p_partkey AS packed_desig, CASE WHEN p_partkey % 9 <> 0 THEN 1 + (p_partkey * 7 % 600) / 1000.0 END AS q FROM part WHERE p_partkey % 11 <> 0 UNION ALL SELECT 'x' || p_partkey, 0.9 FROM part)
SELECT packed_desig, CASE WHEN tg.q IS NULL THEN 'drop_q_none' WHEN tg.q <= 1.3 THEN 'keep' WHEN o.q IS NULL OR o.q > 1.3 THEN 'drop_solid' WHEN abs(tg.q - o.q) <= 0.02 + 1e-9 THEN 'drop_solid' ELSE 'keep_unsolid' END AS verdict
FROM tg LEFT JOIN (SELECT {P} AS p, q FROM orbits WHERE q IS NOT NULL AND e < 1) o ON o.p = packed_desig""")
def _(t):
    return readers.solid_targets(readers.parse_target_map_json(t.sql(_TARGETS)), t.orbits, t.ni).select("packed_desig", "verdict")


# -- circulars -------------------------------------------------------------------------------

_CT = """CASE WHEN k % 9 = 0 THEN 'dou' WHEN k % 9 = 1 THEN 'retraction' WHEN k % 9 = 2 THEN 'editorial' WHEN CAST(substr({r}, 1, 4) AS INT) < 2010 THEN 'recovery' ELSE 'discovery' END""".format(r=_readable("k"))


@query("circular_type", f"SELECT k, {_CT} AS type FROM circulars")
def _(t):
    return t.circulars.select("k", circular.circular_type("title", "pre_text", 2010).alias("type"))


@query("parse_circulars", f"""SELECT k, {_readable('k')} AS designation, CASE WHEN {_CT} = 'discovery' AND k % 5 = 0 THEN 'recovery' ELSE {_CT} END AS type, (2019 + k % 6) || ' Feb ' || (1 + k % 28) || ', 12:34 UT' AS "date",
  CAST(CASE WHEN k % 5 = 0 THEN 2 + k % 50 ELSE 2 END AS INTEGER) AS n_obs, round(CASE WHEN k % 5 = 0 THEN 2 * 30.44 + (1 + k % 28) - 1 ELSE 30.44 + (10 + k % 9 + 0.5) - (1 + k % 4 + 0.25) END::DOUBLE, 1) AS arc_days,
  k % 360 + 0.5 AS m, 1.25 + k % 3 AS a, (k * 37 % 1000) / 1000.0 AS e, 15.5 + k % 10 AS h, round((1.25 + k % 3) * (1 - (k * 37 % 1000) / 1000.0), 6) AS q, (k % 10)::DOUBLE AS u FROM circulars""".replace(
    "k % 360 + 0.5 AS m", "(k % 360 + 0.5)::DOUBLE AS m").replace("1.25 + k % 3 AS a", "(1.25 + k % 3)::DOUBLE AS a").replace("15.5 + k % 10 AS h", "(15.5 + k % 10)::DOUBLE AS h"))
def _(t):
    e = "elements"
    return readers.parse_circulars(t.circulars, year=2010).select(
        "k", "designation", "type", "date", "n_obs", "arc_days", F.col(f"{e}.M").alias("m"), F.col(f"{e}.a").alias("a"),
        F.col(f"{e}.e").alias("e"), F.col(f"{e}.H").alias("h"), F.round(f"{e}.q", 6).alias("q"), F.col(f"{e}.U").alias("u"))


@query("circular_sections", "SELECT k, 'G00 Survey' AS observer_details, CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(161 AS INTEGER) END AS obs_len, ' in seconds' || chr(10) || 'x' AS residuals, 'y' AS ephemeris FROM circulars")
def _(t):
    return circular.with_sections(t.circulars, "pre_text", "s").select(
        "k", "s.observer_details", F.length("s.observations").alias("obs_len"), "s.residuals", "s.ephemeris")


@query("circular_stats", f"""WITH s AS (SELECT k, (2019 + k % 6) AS y, {_CT} AS type, 'G' || lpad(CAST(k % 3 AS VARCHAR), 2, '0') AS stn FROM circulars WHERE k % 5 <> 0 UNION ALL SELECT k, 2019 + k % 6, {_CT}, 'F' || lpad(CAST(k % 2 AS VARCHAR), 2, '0') FROM circulars WHERE k % 5 <> 0)
SELECT stn, CAST(y AS INTEGER) AS year, type, count(*) AS n FROM s GROUP BY 1, 2, 3""")
def _(t):
    return stations.circular_stats(t.circulars, year=2010)


@query("circular_path", "SELECT k, 'K24/K24A' || CASE WHEN k % 400 + 1 <= 99 THEN lpad(CAST(k % 400 + 1 AS VARCHAR), 2, '0') ELSE chr(CAST(65 + floor((k % 400 + 1 - 100) / 10) AS INTEGER)) || ((k % 400 + 1) % 10) END AS path FROM circulars")
def _(t):
    return t.circulars.select("k", circular.circular_path(F.concat(F.lit("2024-A"), (F.col("k") % 400 + 1).cast("string"))).alias("path"))


_INDEX = """SELECT page_id, concat('<html><ul><li><a href="/mpec/K24/a', CAST(page_id AS VARCHAR(20)), '.html"><i>MPEC</i> 2024-A', CAST(page_id AS VARCHAR(20)), '</a> (2024 Jan. 1)', chr(10), '<ul><li>Title ', CAST(page_id AS VARCHAR(20)), '</ul>',
  '<li><a href="/mpec/K24/b', CAST(page_id AS VARCHAR(20)), '.html"><i>MPEC</i> 2024-B', CAST(page_id AS VARCHAR(20)), '</a> (2024 Jan. 17)<ul><li>', substr(url, 1, 20), '</ul></ul>', html) AS html FROM {pages}"""


@query("parse_circular_index", """SELECT page_id, 'MPEC 2024-A' || page_id AS circular_id, '/mpec/K24/a' || page_id || '.html' AS path, 'Title ' || page_id AS title, '2024 Jan. 1' AS "date" FROM pages
UNION ALL SELECT page_id, 'MPEC 2024-B' || page_id, '/mpec/K24/b' || page_id || '.html', trim(substr(url, 1, 20)), '2024 Jan. 17' FROM pages""")
def _(t):
    return readers.parse_circular_index(t.sql(_INDEX))


def _pages_sql():
    first = {"pha": "k % 7", "nea_all": "k % 40", "nea_1km": "k % 5", "nea_h22": "k % 11", "aten": "1", "aten_1km": "0", "aten_h22": "1",
             "apollo": "2", "apollo_1km": "1", "apollo_h22": "1", "amor": "k % 3", "amor_1km": "0", "amor_h22": "0"}
    second = {"pha": "0", "nea_all": "k % 2", "nea_1km": "1", "nea_h22": "0", "aten": "0", "aten_1km": "0", "aten_h22": "0",
              "apollo": "1", "apollo_1km": "1", "apollo_h22": "0", "amor": "0", "amor_1km": "0", "amor_h22": "0"}
    def cols(d):
        return ", ".join(f"CAST({d[c]} AS BIGINT) AS {c}" for c in COUNTS)
    return f"""SELECT page_id, CAST(1990 + k % 35 AS VARCHAR) AS year_label, CASE c % 5 WHEN 0 THEN 'G96' WHEN 1 THEN '703' WHEN 2 THEN 'Q11' WHEN 3 THEN 'Z22' ELSE 'W68' END AS code, {cols(first)} FROM (SELECT o_orderkey AS page_id, o_orderkey AS k, o_custkey AS c FROM orders)
UNION ALL SELECT page_id, '<1971', 'X' || lpad(CAST(c % 10 AS VARCHAR), 2, '0'), {cols(second)} FROM (SELECT o_orderkey AS page_id, o_orderkey AS k, o_custkey AS c FROM orders)"""


@query("parse_year_blocks", _pages_sql())
def _(t):
    return readers.parse_year_blocks(t.year_pages)


@query("parse_year_blocks_since", f"SELECT page_id, code, nea_all FROM ({_pages_sql()}) WHERE TRY_CAST(year_label AS INTEGER) >= 2005")
def _(t):
    return readers.parse_year_blocks(t.year_pages, since=2005).select("page_id", "code", "nea_all")


@query("log_summary", """WITH l AS (SELECT event_type || '.example' AS host, CASE event_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'fail' ELSE 'timeout' END AS outcome FROM events WHERE event_id % 10 > 1)
SELECT host, outcome, count(*) AS n FROM l GROUP BY 1, 2 UNION ALL SELECT host, 'ALL', count(*) FROM l GROUP BY 1 UNION ALL SELECT 'ALL', 'ALL', count(*) FROM l""")
def _(t):
    return readers.log_summary(readers.parse_request_log(t.request_log))


@query("top_suppressed_keys", "SELECT 'k' || user_id AS suppressed_key, count(*) AS n FROM events WHERE event_id % 10 = 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t):
    return readers.top_suppressed(readers.parse_request_log(t.request_log))


# -- 80-column lines and exchange records ---------------------------------------------------------

_ISO = "substr(CAST(make_timestamp({us}) AS VARCHAR), 1, 10) || 'T' || substr(CAST(make_timestamp({us}) AS VARCHAR), 12, 8) || '.' || substr(lpad(CAST({us} % 1000000 AS VARCHAR), 6, '0'), 1, 1) || 'Z'"
# Six decimals of a day print one decimal of a second: tenths, rounded half up.
_TENTH = "(epoch_us(CAST(replace(substr(obs80, 16, 10), ' ', '-') AS TIMESTAMP)) + CAST(floor((CAST(substr(obs80, 27, 6) AS BIGINT) * 864000 + 500000) / 1000000) AS BIGINT) * 100000)"
DECODED = f"""dec80 AS (SELECT id, desig, trim(substr(obs80, 1, 12)) AS packed_desig, nullif(substr(obs80, 13, 1), ' ') AS disc,
  CASE WHEN substr(obs80, 14, 1) = 'K' THEN 'K' END AS notes, CASE WHEN substr(obs80, 14, 1) = '1' THEN '1' END AS prog,
  CASE substr(obs80, 15, 1) WHEN 'C' THEN 'CCD' WHEN 'S' THEN 'CCD' WHEN 'X' THEN 'CCD' ELSE 'UNK' END AS mode, {_ISO.format(us=_TENTH)} AS obs_time,
  (CAST(substr(obs80, 33, 2) AS DOUBLE) + CAST(substr(obs80, 36, 2) AS DOUBLE) / 60 + CAST(substr(obs80, 39, 6) AS DOUBLE) / 3600) * 15 AS ra_deg,
  CASE WHEN substr(obs80, 45, 1) = '-' THEN -1 ELSE 1 END * (CAST(substr(obs80, 46, 2) AS DOUBLE) + CAST(substr(obs80, 49, 2) AS DOUBLE) / 60 + CAST(substr(obs80, 52, 5) AS DOUBLE) / 3600) AS dec_deg,
  TRY_CAST(nullif(trim(substr(obs80, 66, 5)), '') AS DOUBLE) AS mag, CASE substr(obs80, 71, 1) WHEN 'V' THEN 'Vj' WHEN 'o' THEN 'Ao' WHEN 'w' THEN 'Pw' END AS band,
  CASE substr(obs80, 72, 1) WHEN 'V' THEN 'Gaia2' WHEN 'U' THEN 'Gaia1' END AS ast_cat, trim(substr(obs80, 78, 3)) AS stn, rmsra, rmsdec FROM neocp)"""


@query("decode_obs80", f"WITH {DECODED} SELECT * EXCLUDE (desig, rmsra, rmsdec) REPLACE (round(ra_deg, 6) AS ra_deg, round(dec_deg, 6) AS dec_deg) FROM dec80")
def _(t):
    d = readers.decode_observations(t.neocp.select("id", "obs80")).drop("obs80", "unpacked_desig")
    return rounded(d, ra_deg=6, dec_deg=6)


@query("ades_export_rows", f"WITH {DECODED} SELECT desig AS \"trkSub\", mode, stn, obs_time AS \"obsTime\", round(ra_deg, 6) AS ra, round(dec_deg, 6) AS dec, mag, band, ast_cat AS \"astCat\", round(rmsra, 6) AS \"rmsRA\" FROM dec80")
def _(t):
    return rounded(neocp.ades_export_rows(t.neocp).select("trkSub", "mode", "stn", "obsTime", "ra", "dec", "mag", "band", "astCat", "rmsRA"),
                   ra=6, dec=6, rmsRA=6)


# 1024ths are exact in binary, so rounding to a milliarcsecond or hundredth is the same everywhere.
SPLICE = """CASE WHEN rmsra IS NULL OR rmsdec IS NULL THEN obs80 || chr(10) ELSE substr(obs80, 1, 56) ||
  CASE WHEN rmsra >= 10 OR rmsdec >= 10 THEN lpad(CAST(CAST(round(rmsra) AS INTEGER) AS VARCHAR), 4, ' ') || lpad(CAST(CAST(round(rmsdec) AS INTEGER) AS VARCHAR), 4, ' ') || ' '
    WHEN rmsra < 1 AND rmsdec < 1 THEN ' ' || lpad(CAST(CAST(round(rmsra * 1000) AS INTEGER) AS VARCHAR), 3, '0') || ' ' || lpad(CAST(CAST(round(rmsdec * 1000) AS INTEGER) AS VARCHAR), 3, '0') || 'm'
    ELSE printf('%.2f', round(rmsra, 2)) || ' ' || printf('%.2f', round(rmsdec, 2)) END || substr(obs80, 66, 15) || chr(10) END"""


@query("splice_uncertainty", f"SELECT id, {SPLICE} AS line FROM neocp")
def _(t):
    return t.neocp.select("id", obs80.splice_uncertainty("obs80", "rmsra", "rmsdec").alias("line"))


@query("add_uncertainties", f"""SELECT {SPLICE.replace('obs80', 'n.obs80').replace('rmsra', 'n.rmsra').replace('rmsdec', 'n.rmsdec')} AS obs80 FROM neocp n
JOIN (SELECT obs80 FROM neocp WHERE id % 3 = 0) i ON substr(n.obs80, 1, 12) = substr(i.obs80, 1, 12) AND substr(n.obs80, 15, 42) = substr(i.obs80, 15, 42) AND substr(n.obs80, 78, 3) = substr(i.obs80, 78, 3)""")
def _(t):
    d = t.neocp
    return neocp.add_uncertainties(d.where(F.col("id") % 3 == 0).select("obs80"), d)


@query("tracklet_key", "SELECT id, CASE WHEN substr(obs80, 15, 1) IN ('C', 'S', 'X') THEN trim(substr(obs80, 78, 3)) END AS stn, CASE WHEN substr(obs80, 15, 1) IN ('C', 'S', 'X') THEN substr(obs80, 16, 10) END AS \"date\" FROM neocp")
def _(t):
    return t.neocp.select("id", obs80.tracklet_key("obs80").alias("k")).select("id", "k.stn", "k.date")


@query("optical_xml", f"""WITH {DECODED} SELECT id, '<optical><trkSub>' || desig || '</trkSub><stn>' || stn || '</stn><ra>' || printf('%.6f', ra_deg) || '</ra>' ||
  coalesce('<mag>' || printf('%.2f', mag) || '</mag>', '') || coalesce('<band>' || band || '</band>', '') || coalesce('<disc>' || disc || '</disc>', '') || '</optical>' AS xml FROM dec80""")
def _(t):
    d = readers.decode_observations(t.neocp.select("id", "desig", "obs80"))
    return d.select("id", formats.optical_xml({"trkSub": "desig", "stn": "stn", "ra": "ra_deg", "mag": "mag", "band": "band", "disc": "disc"}).alias("xml"))


@query("ades_xml_round_trip", f"WITH {DECODED} SELECT id, desig AS \"trkSub\", stn, round(ra_deg, 6) AS ra, mag, band FROM dec80")
def _(t):
    d = readers.decode_observations(t.neocp.select("id", "desig", "obs80"))
    xml = d.select("id", formats.optical_xml({"trkSub": "desig", "stn": "stn", "ra": "ra_deg", "mag": "mag", "band": "band"}).alias("xml"))
    return rounded(readers.parse_ades_elements(xml, col="xml").select("id", "trkSub", "stn", "ra", "mag", "band"), ra=6)


_PSV = {"trkSub": "desig", "mode": "mode", "stn": "stn", "obsTime": "obs_time", "ra": "ra_deg", "dec": "dec_deg", "mag": "mag", "band": "band", "disc": "disc"}


def _psv_sql():
    from asterion.functions.tables import PSV_COLUMNS
    num = {"ra": "%.6f", "dec": "%.6f", "mag": "%.2f"}
    cells = []
    for name, w in PSV_COLUMNS:
        if name not in _PSV:
            cells.append(f"repeat(' ', {w})")
            continue
        x = f"printf('{num[name]}', {_PSV[name]})" if name in num else _PSV[name]
        cells.append(f"CASE WHEN length(coalesce({x}, '')) >= {w} THEN {x} ELSE lpad(coalesce({x}, ''), {w}, ' ') END")
    return " || '|' || ".join(cells)


@query("psv_lines", f"WITH {DECODED} SELECT id, {_psv_sql()} AS line FROM dec80")
def _(t):
    d = readers.decode_observations(t.neocp.select("id", "desig", "obs80"))
    return d.select("id", formats.psv_line(_PSV).alias("line"))


# -- column functions --------------------------------------------------------------------------------

@query("classify_orbit", f"SELECT id, CAST({S.CLASSIFY} AS INTEGER) AS class, {S.label(S.CLASSIFY)} AS label FROM orbits")
def _(t):
    c = orbit.classify_orbit("q", "e", "i")
    return t.orbits.select("id", c.alias("class"), orbit.orbit_label(c).alias("label"))


@query("neo_class", """SELECT id, CASE WHEN a IS NULL OR e IS NULL OR e >= 1 THEN 'Unclassified' WHEN a < 1 AND a * (1 + e) < 0.983 THEN 'Atira' WHEN a < 1 THEN 'Aten'
  WHEN coalesce(q, a * (1 - e)) < 1.017 THEN 'Apollo' WHEN coalesce(q, a * (1 - e)) < 1.3 THEN 'Amor' ELSE 'Other' END AS neo_class FROM orbits""")
def _(t):
    return t.orbits.select("id", orbit.neo_class("a", "e", "q").alias("neo_class"))


@query("size_scales", """SELECT id, round(1329 / sqrt(0.14) * pow(10, -h / 5), 6) AS d_km, CASE WHEN h < 17.75 THEN '1km' WHEN h <= 22 THEN '140m' WHEN h IS NOT NULL THEN 'small' END AS size_class,
  CASE WHEN h < 18 THEN 0.15 WHEN h <= 22 THEN 0.16 WHEN h IS NOT NULL THEN 0.18 END::DOUBLE AS albedo, round(0.135 + 0.032 * (h - 20), 6) AS q_star, round(h, 6) AS h_back FROM orbits""")
def _(t):
    d = orbit.h_to_diameter_km("h")
    return t.orbits.select("id", F.round(d, 6).alias("d_km"), orbit.size_class("h").alias("size_class"), orbit.reference_albedo("h").alias("albedo"),
                           F.round(orbit.perihelion_disruption_distance("h"), 6).alias("q_star"), F.round(orbit.diameter_km_to_h(d), 6).alias("h_back"))


@query("orbit_scales", """SELECT id, round(CASE WHEN e < 1 THEN q / (1 - e) END, 6) AS a, round(CASE WHEN e < 1 THEN q * (1 + e) / (1 - e) END, 6) AS cap_q, round(CASE WHEN e < 1 THEN pow(q / (1 - e), 1.5) END, 5) AS period,
  round(CASE WHEN e < 1 THEN 5.20336301 / (q / (1 - e)) + 2 * cos(radians(i)) * sqrt(q / (1 - e) / 5.20336301 * (1 - e * e)) END, 6) AS tj FROM orbits""")
def _(t):
    a = orbit.semi_major_axis("q", "e")
    return t.orbits.select("id", F.round(a, 6).alias("a"), F.round(orbit.aphelion("q", "e"), 6).alias("cap_q"), F.round(orbit.orbital_period(a), 5).alias("period"),
                           F.round(orbit.tisserand(a, "e", "i", 5.20336301), 6).alias("tj"))


@query("to_v", f"SELECT id, round({S.V_MAG}, 6) AS v, round(mag + CASE WHEN band IS NULL THEN -0.8 ELSE {S.BAND} END, 6) AS v_blank FROM obs")
def _(t):
    return t.obs.select("id", F.round(photometry.to_v("mag", "band"), 6).alias("v"),
                        F.round(photometry.to_v("mag", "band", "as_blank"), 6).alias("v_blank"))


@query("time_scales", """SELECT id, round(epoch_us(obstime) / 86400000000.0 + 40587, 6) AS mjd, round(floor(epoch_us(obstime) / 1000000.0) / 86400.0 + 2440587.5, 7) AS jd, obstime AS back,
  DATE '1858-11-17' + CAST(floor(epoch_us(obstime) / 86400000000.0 + 40587) AS INTEGER) AS day FROM obs""")
def _(t):
    m = timeconv.mjd("obstime")
    return t.obs.select("id", F.round(m, 6).alias("mjd"), F.round(timeconv.julian_day("obstime"), 7).alias("jd"),
                        timeconv.from_epoch_micros(timeconv.epoch_micros("obstime")).alias("back"), timeconv.mjd_to_date(m).alias("day"))


@query("designation_round_trip", f"SELECT c_custkey AS k, {_packed('c_custkey')} AS packed, {_readable('c_custkey')} AS unpacked, 'provisional' AS kind FROM customer")
def _(t):
    d = t.sql(f"SELECT c_custkey AS k, {_packed('c_custkey')} AS p, {_readable('c_custkey')} AS u FROM {{customer}}")
    return d.select("k", D.pack_designation("u").alias("packed"), D.unpack_designation("p").alias("unpacked"), D.designation_kind("p").alias("kind"))


_B62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TILDE = "'~' || " + " || ".join(f"substr('{_B62}', CAST(floor((n - 620000) / {62 ** k}) AS BIGINT) % 62 + 1, 1)" for k in (3, 2, 1, 0))


@query("pack_number", f"""SELECT n, CASE WHEN n < 100000 THEN lpad(CAST(n AS VARCHAR), 5, '0') WHEN n < 620000 THEN substr('{_B62}', CAST(floor(n / 10000) AS BIGINT) + 1, 1) || lpad(CAST(n % 10000 AS VARCHAR), 4, '0') ELSE {_TILDE} END AS packed, CAST(n AS VARCHAR) AS back
FROM (SELECT c_custkey * 7919 % 2000000 + 1 AS n FROM customer)""")
def _(t):
    d = t.customer.select((F.col("c_custkey") * 7919 % 2000000 + 1).alias("n")).withColumn("packed", D.pack_number("n"))
    return d.withColumn("back", D.unpack_designation("packed"))


@query("resolve_alias", f"""WITH x AS (SELECT DISTINCT provid AS mpec_desig FROM obs WHERE provid IS NOT NULL UNION SELECT DISTINCT permid FROM obs WHERE permid IS NOT NULL),
y AS (SELECT x.*, CASE WHEN NOT regexp_matches(mpec_desig, '^[0-9]+$') THEN 'P' || mpec_desig END AS p FROM x)
SELECT mpec_desig, coalesce(c.{U}, n.{U}) AS primary_desig, CASE WHEN n.permid IS NOT NULL THEN n.permid WHEN c.numbered THEN m.permid END AS permid, CASE WHEN n.permid IS NOT NULL THEN n.iau_name WHEN c.numbered THEN m.iau_name END AS iau_name,
  coalesce(c.{P} <> y.p, FALSE) AS is_secondary, n.permid IS NOT NULL OR coalesce(c.numbered, FALSE) AS is_numbered,
  CASE WHEN o.orbit_type_int IS NOT NULL THEN {S.label('o.orbit_type_int', "'Unclassified'", 'Other (Unusual)')} WHEN o.q IS NOT NULL AND o.e IS NOT NULL THEN {S.label(S.CLASSIFY, "'Unclassified'", 'Other (Unusual)')} END AS orbit_class
FROM y LEFT JOIN ci c ON c.packed_secondary_provisional_designation = y.p LEFT JOIN ni n ON n.permid = mpec_desig LEFT JOIN ni m ON m.{P} = c.{P} LEFT JOIN orbits o ON o.{P} = coalesce(c.{P}, n.{P})""")
def _(t):
    d = t.obs.select(F.explode(F.array("provid", "permid")).alias("name")).where(F.col("name").isNotNull()).distinct()
    # The views' packed names are the readable ones with a leading P.
    ci = t.ci.withColumn("packed_secondary_provisional_designation", F.expr("substr(packed_secondary_provisional_designation, 2)"))
    return identity.resolve_alias(d, ci.withColumn(P, F.expr(f"substr({P}, 2)")), t.ni.withColumn(P, F.expr(f"substr({P}, 2)")),
                                  t.orbits.withColumn(P, F.expr(f"substr({P}, 2)")), col="name")


_REAL = {"ni": f"SELECT {_packed('c_custkey')} AS {P}, {_readable('c_custkey')} AS {U}, CAST(c_custkey AS VARCHAR(20)) AS permid FROM {{customer}} WHERE c_custkey % 2 = 1",
         "orbits": f"SELECT {_packed('c_custkey')} AS {P} FROM {{customer}} WHERE c_custkey % 3 = 0",
         "raw": f"SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN {_readable('c_custkey')} WHEN 1 THEN CAST(c_custkey AS VARCHAR(20)) WHEN 2 THEN {_packed('c_custkey')} ELSE CASE WHEN c_custkey % 8 = 3 THEN concat('C/', {_readable('c_custkey')}) ELSE 'no such thing' END END AS raw FROM {{customer}}"}


@query("canonicalize", f"""SELECT c_custkey AS k, CASE WHEN m = 3 THEN 'C/' ELSE '' END || {_readable('c_custkey')} AS primary_desig, CASE WHEN m = 3 THEN 'C/' || {_readable('c_custkey')} ELSE {_packed('c_custkey')} END AS packed_desig,
  CASE WHEN m = 1 THEN CAST(c_custkey AS VARCHAR) END AS permid, c_custkey % 3 = 0 AND m <> 3 AS orbit_in_mpc, m = 3 AS is_comet FROM (SELECT *, c_custkey % 4 AS m FROM customer) WHERE m <> 3 OR c_custkey % 8 = 3""")
def _(t):
    return identity.canonicalize(t.sql(_REAL["raw"]), t.sql(_REAL["ni"]), t.sql(_REAL["orbits"]), raw="raw").select(
        "k", "primary_desig", "packed_desig", "permid", "orbit_in_mpc", "is_comet")


@query("resolve_numbered_values", f"""SELECT CASE WHEN p_partkey % 3 = 0 THEN n.{U} ELSE 'U' || p_partkey END AS designation, p_size AS value FROM part LEFT JOIN ni n ON n.permid = CAST(p_partkey AS VARCHAR) AND p_partkey % 3 = 0 WHERE p_partkey % 3 <> 0 OR n.{U} IS NOT NULL""")
def _(t):
    k = F.col("p_partkey")
    d = t.part.select(F.when(k % 3 == 0, k.cast("string")).otherwise(F.concat(F.lit("U"), k.cast("string"))).alias("desig"), F.col("p_size").alias("value"))
    return identity.resolve_numbered_values(d, t.ni)


@query("sexagesimal", "SELECT id, round((CAST(substr(obs80, 33, 2) AS DOUBLE) + CAST(substr(obs80, 36, 2) AS DOUBLE) / 60 + CAST(substr(obs80, 39, 6) AS DOUBLE) / 3600) * 15, 5) AS ra FROM neocp")
def _(t):
    text = F.substring("obs80", 33, 12)
    return t.neocp.select("id", F.round(sky.round_to_input(sky.ra_hms_to_deg(text), text), 5).alias("ra"))
