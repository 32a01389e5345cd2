"""The scalar and table functions under SQL names, for users who write SQL.

Temporary SQL functions are expanded into the query's plan like a view, so they
optimise and compile exactly as the column builders do.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from asterion.functions import tables as T


def _map(mapping: dict) -> str:
    def lit(x):
        return "'" + x.replace("'", "\\'") + "'" if isinstance(x, str) else f"{x}D" if isinstance(x, float) else str(x)
    return "map(" + ", ".join(f"{lit(k)}, {lit(v)}" for k, v in mapping.items()) + ")"


def _sexagesimal(text: str, factor: str) -> str:
    p = f"split(trim(regexp_replace(trim({text}), '^[+-]', '')), ' +')"
    sign = f"CASE WHEN startswith(ltrim({text}), '-') THEN -1.0D ELSE 1.0D END"
    terms = " + ".join(f"try_cast(get({p}, {k}) AS DOUBLE) / {d}D" for k, d in enumerate((1, 60, 3600)))
    return f"CASE WHEN size({p}) = 3 THEN {sign} * ({terms}) * {factor} END"


def _classify(q="q", e="e", i="i") -> str:
    a, aj = f"({q} / (1 - {e}))", T.JUPITER_A
    tj = f"({aj} / {a} + 2 * cos(radians({i})) * sqrt({a} / {aj} * (1 - {e} * {e})))"
    rules = [
        (f"{q} IS NULL OR {e} IS NULL", "NULL"), (f"{e} > 1", 30), (f"{e} = 1", 31),
        (f"{a} < 1 AND {a} * (1 + {e}) < 0.983", 0), (f"{a} < 1", 1), (f"{q} < 1.017", 2), (f"{q} < 1.3", 3),
        (f"{a} < 3.2 AND {q} > 1.3 AND {q} < 1.666", 10), (f"{a} < {T.MAIN_BELT_OUTER} AND {i} < 75", 11),
        (f"{a} > 4.8 AND {a} < 5.4 AND {e} < 0.3", 12), (f"{a} > 29.8 AND {a} < 30.4", 21),
        (f"{tj} > 2 AND {tj} < 3", 20), (f"{a} >= {aj} AND {a} < {T.NEPTUNE_A}", 22),
        (f"{a} >= {T.NEPTUNE_A}", 23), (f"{a} < {aj}", 19)]
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + " ELSE 9 END"


def _base62(n: str, width: int = 4) -> str:
    return "concat(" + ", ".join(
        f"substr('{T.BASE62}', CAST(pmod(CAST(floor({n} / {62 ** k}) AS BIGINT), 62) AS INT) + 1, 1)"
        for k in range(width - 1, -1, -1)) + ")"


def _iso8601() -> str:
    p = "split(trim(date_str), ' +')"
    whole = f"substring_index(get({p}, 2), '.', 1)"
    frac = f"substring(get({p}, 2), length({whole}) + 1, 20)"
    digits = f"greatest(length({frac}) - 6, 0)"
    unit = f"pow(10D, {digits})"
    ticks = f"round(try_cast(concat('0', {frac}) AS DOUBLE) * 86400D * {unit})"
    base = f"try_cast(concat_ws('-', get({p}, 0), get({p}, 1), {whole}) AS DATE)"
    instant = f"(CAST({base} AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, CAST(floor({ticks} / {unit}) AS DECIMAL(18,6))))"
    rest = f"CAST(CAST({ticks} - floor({ticks} / {unit}) * {unit} AS BIGINT) AS STRING)"
    return (f"CASE WHEN size({p}) = 3 THEN concat(replace(CAST({instant} AS STRING), ' ', 'T'), "
            f"CASE WHEN {digits} > 0 THEN concat('.', lpad({rest}, {digits}, '0')) ELSE '' END, 'Z') END")


def _spliced() -> str:
    def whole(x, factor, width, pad):
        return f"lpad(CAST(CAST(round({x} * {factor}) AS INT) AS STRING), {width}, '{pad}')"

    def plain(x):
        return f"format_string('%.2f', CAST(CAST({x} AS DECIMAL(20,6)) AS DOUBLE))"

    a, d = "p_rmsra", "p_rmsdec"
    two = "length(p_obs80) = 160"
    tail = f"CASE WHEN {two} THEN concat('\\n', substring(p_obs80, 81, 80), '\\n') ELSE '\\n' END"
    field = (f"CASE WHEN {a} >= 10 OR {d} >= 10 THEN concat({whole(a, 1, 4, ' ')}, {whole(d, 1, 4, ' ')}, ' ') "
             f"WHEN {a} < 1 AND {d} < 1 THEN concat(' ', {whole(a, 1000, 3, '0')}, ' ', {whole(d, 1000, 3, '0')}, 'm') "
             f"ELSE concat({plain(a)}, ' ', {plain(d)}) END")
    return (f"CASE WHEN {a} IS NULL OR {d} IS NULL THEN concat(CASE WHEN {two} THEN substring(p_obs80, 1, 80) ELSE p_obs80 END, {tail}) "
            f"ELSE concat(substring(p_obs80, 1, 56), {field}, substring(p_obs80, 66, 15), {tail}) END")


def scalar_functions() -> dict[str, tuple[str, str, str]]:
    """name: (arguments, type, body)."""
    labels = {c: n[1] for c, n in T.ORBIT_CLASSES.items()} | {99: "Other"}
    b62 = T.BASE62
    s = "trim(packed)"
    century = f"CASE substr({s}, 1, 1) WHEN 'I' THEN '18' WHEN 'J' THEN '19' WHEN 'K' THEN '20' END"
    cycle = f"((instr('{b62}', substr({s}, 5, 1)) - 1) * 10 + try_cast(substr({s}, 6, 1) AS INT))"
    whole = "substring_index(get(split(trim(date_str), ' +'), 2), '.', 1)"
    frac = f"concat('0', substr(get(split(trim(date_str), ' +'), 2), length({whole}) + 1))"
    return {
        "is_published": ("p_status STRING", "BOOLEAN", "p_status IN ('P', 'p')"),
        "is_active": ("p_deprecated STRING", "BOOLEAN", "p_deprecated IS NULL"),
        "is_neo": ("p_q DOUBLE", "BOOLEAN", "p_q IS NOT NULL AND p_q <= 1.3"),
        "is_pha": ("p_q DOUBLE, p_e DOUBLE, p_h DOUBLE", "BOOLEAN",
                   "p_q IS NOT NULL AND p_e IS NOT NULL AND p_h IS NOT NULL AND p_q <= 1.3 AND p_e < 1 AND p_h <= 22"),
        "tisserand": ("p_a DOUBLE, p_e DOUBLE, p_i DOUBLE", "DOUBLE",
                      f"CASE WHEN p_a > 0 THEN {T.JUPITER_A_PRECISE} / p_a + 2 * sqrt(p_a / {T.JUPITER_A_PRECISE} * (1 - p_e * p_e)) * cos(radians(p_i)) END"),
        "classify_orbit": ("q DOUBLE, e DOUBLE, i DOUBLE", "INT", _classify()),
        "classify_orbit_label": ("q DOUBLE, e DOUBLE, i DOUBLE", "STRING", f"element_at({_map(labels)}, {_classify()})"),
        "to_v": ("mag DOUBLE, band STRING", "DOUBLE", f"mag + coalesce(element_at({_map(T.BAND_TO_V)}, band), 0.0D)"),
        "ra_hms_to_deg": ("ra_str STRING", "DOUBLE", _sexagesimal("ra_str", "15")),
        "dec_dms_to_deg": ("dec_str STRING", "DOUBLE", _sexagesimal("dec_str", "1")),
        "mpc_cat_to_ades": ("code STRING", "STRING", f"element_at({_map(T.CATALOGS)}, code)"),
        "mpc_mode_to_ades": ("code STRING", "STRING", f"CASE WHEN code IS NOT NULL THEN coalesce(element_at({_map(T.MODES)}, code), 'UNK') END"),
        "mpc_band_to_ades": ("code STRING", "STRING", f"element_at({_map(T.BANDS)}, code)"),
        "mpc_date_to_timestamp": ("date_str STRING", "TIMESTAMP_NTZ", (
            f"CAST(try_cast(concat_ws('-', get(split(trim(date_str), ' +'), 0), get(split(trim(date_str), ' +'), 1), {whole}) AS DATE) AS TIMESTAMP_NTZ) "
            f"+ make_dt_interval(0, 0, 0, CAST(round(try_cast({frac} AS DECIMAL(28,18)) * 86400, 6) AS DECIMAL(18,6)))")),
        "unpack_designation": ("packed STRING", "STRING", (
            f"CASE WHEN {s} RLIKE '^[0-9]{{1,5}}$' THEN ltrim('0', {s}) "
            f"WHEN {s} RLIKE '^[A-Za-z][0-9]{{4}}$' THEN CAST((instr('{b62}', substr({s}, 1, 1)) - 1) * 10000 + try_cast(substr({s}, 2) AS INT) AS STRING) "
            f"WHEN length({s}) >= 7 AND ({century}) IS NOT NULL AND {cycle} IS NOT NULL THEN concat({century}, substr({s}, 2, 2), ' ', substr({s}, 4, 1), substr({s}, 7, 1), "
            f"CASE WHEN {cycle} = 0 THEN '' ELSE CAST({cycle} AS STRING) END) ELSE {s} END")),
        "mpc_date_to_iso8601": ("date_str STRING", "STRING", _iso8601()),
        "format_obs80_with_uncertainty": ("p_obs80 STRING, p_rmsra DOUBLE, p_rmsdec DOUBLE", "STRING", _spliced()),
        "base62_encode": ("digits BIGINT", "STRING", f"CASE WHEN digits = 0 THEN '' ELSE ltrim('0', {_base62('digits', 6)}) END"),
        "packnum": ("number STRING", "STRING", (
            "CASE WHEN CAST(number AS BIGINT) < 100000 THEN lpad(number, 5, '0') "
            f"WHEN CAST(number AS BIGINT) < 620000 THEN concat(substr('{b62}', CAST(floor(CAST(number AS BIGINT) / 10000) AS INT) + 1, 1), lpad(CAST(CAST(number AS BIGINT) % 10000 AS STRING), 4, '0')) "
            f"ELSE concat('~', {_base62('(CAST(number AS BIGINT) - 620000)')}) END")),
    }


def register(spark: SparkSession) -> list[str]:
    """Create the temporary scalar functions; returns their names."""
    done = []
    for name, (args, kind, body) in scalar_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
        done.append(name)
    s = "rpad(p_obs80, 80, ' ')"
    fields = {
        "packed_desig": f"trim(substring({s}, 1, 12))", "unpacked_desig": f"unpack_designation(trim(substring({s}, 1, 12)))",
        "disc": f"nullif(substring({s}, 13, 1), ' ')",
        "prog": f"CASE WHEN NOT substring({s}, 14, 1) RLIKE '^[A-Za-z]$' THEN nullif(substring({s}, 14, 1), ' ') END",
        "notes": f"CASE WHEN substring({s}, 14, 1) RLIKE '^[A-Za-z]$' THEN substring({s}, 14, 1) END",
        "mode": f"mpc_mode_to_ades(substring({s}, 15, 1))", "obs_time": f"mpc_date_to_iso8601(substring({s}, 16, 17))",
        "ra_deg": f"ra_hms_to_deg(substring({s}, 33, 12))", "dec_deg": f"dec_dms_to_deg(substring({s}, 45, 12))",
        "mag": f"try_cast(trim(substring({s}, 66, 5)) AS DOUBLE)", "band": f"mpc_band_to_ades(substring({s}, 71, 1))",
        "ast_cat": f"mpc_cat_to_ades(substring({s}, 72, 1))", "stn": f"trim(substring({s}, 78, 3))"}
    kind = ", ".join(f"{k}: {'DOUBLE' if k in ('ra_deg', 'dec_deg', 'mag') else 'STRING'}" for k in fields)
    body = ", ".join(f"'{k}', {v}" for k, v in fields.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION parse_obs80(p_obs80 STRING) RETURNS STRUCT<{kind}> RETURN named_struct({body})")
    return [*done, "parse_obs80"]


def register_table_functions(spark: SparkSession, obs_view: str = "obs_sbn") -> list[str]:
    """``solar_elongation(station, start, end)``: signed elongation of a station's
    observations, one row each, over a view of observations.

    ``solar_elongation_histogram(station, start, end, width)`` bins it. Statistics
    with an exact median are the DataFrame form's: SQL's own percentile would gather
    all values of a station in one task.
    """
    c = "(datediff(CAST(obstime AS DATE), DATE'2000-01-01') / 36525.0D)"
    lon = f"radians(280.466D + 36000.77D * {c} + 1.915D * sin(radians(357.529D + 35999.05D * {c})))"
    eps = f"radians(23.439D - 0.013D * {c})"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION solar_elongation(p_station STRING, p_start DATE, p_end DATE)
        RETURNS TABLE (obsid STRING, obs_date DATE, signed_elongation DOUBLE) RETURN
        SELECT obsid, obs_date, CASE WHEN pmod(ra - sun_ra, 360) <= 180 THEN 1 ELSE -1 END * degrees(acos(greatest(-1D, least(1D,
            sin(radians(dec)) * sin(radians(sun_dec)) + cos(radians(dec)) * cos(radians(sun_dec)) * cos(radians(ra - sun_ra))))))
        FROM (SELECT obsid, ra, dec, CAST(obstime AS DATE) AS obs_date,
                pmod(degrees(atan2(cos({eps}) * sin({lon}), cos({lon}))), 360) AS sun_ra,
                degrees(asin(sin({eps}) * sin({lon}))) AS sun_dec
              FROM {obs_view}
              WHERE stn = p_station AND obstime >= p_start AND obstime < p_end + INTERVAL 1 DAY
                AND ra IS NOT NULL AND dec IS NOT NULL)""")
    lo = "CASE WHEN bin_num >= 0 THEN bin_num * p_width ELSE (bin_num + 1) * -p_width END"
    hi = "CASE WHEN bin_num >= 0 THEN (bin_num + 1) * p_width ELSE bin_num * -p_width END"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION solar_elongation_histogram(p_station STRING, p_start DATE, p_end DATE, p_width INT)
        RETURNS TABLE (bin_num INT, bin_label STRING, n_obs BIGINT, bin_pct DOUBLE, cum_pct DOUBLE) RETURN
        SELECT bin_num, concat(lpad(CAST({lo} AS STRING), 4, ' '), '° to ', lpad(CAST({hi} AS STRING), 4, ' '), '° ',
            CASE WHEN bin_num >= 0 THEN 'E' ELSE 'W' END), n_obs, bin_pct, round(sum(bin_pct) OVER (ORDER BY bin_num), 2)
        FROM (SELECT bin_num, n_obs, round(100.0D * n_obs / sum(n_obs) OVER (), 2) AS bin_pct
              FROM (SELECT CAST(floor(signed_elongation / p_width) AS INT) AS bin_num, count(*) AS n_obs
                    FROM solar_elongation(p_station, p_start, p_end) GROUP BY 1))""")
    return ["solar_elongation", "solar_elongation_histogram"]
