"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from asterion.functions import orbit, tables as T
from asterion.functions.common import blank_to_null, col

NEO_RULES = ("iau", "wide", "class", "asteroid")


def published_active(df: DataFrame) -> DataFrame:
    """Rows that are published and not superseded."""
    return df.where(F.col("status").isin("P", "p") & F.col("deprecated").isNull())


def neo_rule(rule: str) -> Column:
    """Which orbits count as near-Earth.

    ``iau``: q <= 1.30. ``wide``: q < 1.32 or a near-Earth or Jupiter-coupled
    type. ``class``: type 0-3 only. ``asteroid``: q <= 1.3, elliptic, not a comet.
    """
    q, e, kind = F.col("q"), F.col("e"), F.col("orbit_type_int")
    name = F.col("unpacked_primary_provisional_designation")
    if rule == "iau":
        return q <= 1.30
    if rule == "wide":
        return (q < 1.32) | kind.isin(0, 1, 2, 3, 20)
    if rule == "class":
        return kind.isin(0, 1, 2, 3)
    if rule == "asteroid":
        return (q <= 1.3) & (e < 1) & ~name.startswith("C/") & ~name.startswith("P/") \
            & ~name.startswith("D/")
    raise ValueError(f"rule must be one of {NEO_RULES}")


def select_neos(orbits: DataFrame, *, rule: str = "iau") -> DataFrame:
    return orbits.where(neo_rule(rule))


def pha_flag(df: DataFrame, pha_set: DataFrame | None = None, *, key: str = "provid") -> DataFrame:
    """Add ``pha``: membership of a given list, or the MOID rule without one."""
    if pha_set is None:
        return df.withColumn("pha", orbit.is_pha_by_moid("earth_moid", "h"))
    listed = pha_set.select(F.col(key)).distinct().withColumn("_listed", F.lit(True))
    return df.join(listed, key, "left").withColumn(
        "pha", F.coalesce("_listed", F.lit(False))).drop("_listed")


def derived_elements(df: DataFrame) -> DataFrame:
    """Fill a from q and e, and add aphelion, period and Tisserand parameter."""
    own = orbit.semi_major_axis("q", "e")
    a = F.coalesce(F.col("a"), own)
    period = F.when(F.col("e") < 1, F.pow(own, F.lit(1.5)))
    if "period" in df.columns:
        period = F.coalesce(F.col("period"), period)
    return df.withColumns({
        "a": a,
        "aphelion_q": F.when(F.col("e") < 1, a * (F.lit(1.0) + F.col("e"))),
        "period_yr": period,
        "tisserand_j": orbit.tisserand_guarded(a, "e", "i"),
    })


def orbit_select(orbits: DataFrame, *, columns: list[str] | None = None,
                 orbit_types: list[int] | None = None, include_unclassified: bool = False,
                 h_range=None, a_range=None, e_range=None, q_range=None, i_range=None,
                 earth_moid_max: float | None = None, tisserand: bool = False,
                 json_keys: list[str] | None = None, limit: int | None = None,
                 count_only: bool = False) -> DataFrame:
    """Catalogue query: inclusive ranges on elements, a derived where absent."""
    d = orbits
    if orbit_types is not None:
        keep = F.col("orbit_type_int").isin(*orbit_types)
        if include_unclassified:
            keep = keep | F.col("orbit_type_int").isNull()
        d = d.where(keep)
    own = orbit.semi_major_axis("q", "e")
    a = F.coalesce(F.col("a"), own)
    for c, rng in ((F.col("h"), h_range), (a, a_range), (F.col("e"), e_range),
                   (F.col("q"), q_range), (F.col("i"), i_range)):
        if rng is not None:
            d = d.where((c >= rng[0]) & (c <= rng[1]))
    if earth_moid_max is not None:
        d = d.where(F.col("earth_moid") <= earth_moid_max)
    if count_only:
        return d.agg(F.count("*").alias("n"))
    d = derived_elements(d)
    chosen = list(columns or ["packed_primary_provisional_designation",
                              "unpacked_primary_provisional_designation", "orbit_type_int",
                              "q", "e", "i", "node", "argperi", "a", "h", "earth_moid",
                              "epoch_mjd"])
    if tisserand:
        chosen.append("tisserand_j")
    if json_keys:
        d = json_fields(d, keys=json_keys)
        chosen += json_keys
    d = d.select(*chosen)
    return d if limit is None else d.limit(limit)


def json_fields(df: DataFrame, *, keys: list[str] | None = None,
                column: str = "mpc_orb_jsonb") -> DataFrame:
    """Add fields of the orbit document; absent or unparseable ones are NULL."""
    doc = F.try_parse_json(F.col(column))
    return df.withColumns({
        k: F.try_variant_get(doc, T.ORBIT_JSON_FIELDS[k][0], T.ORBIT_JSON_FIELDS[k][1])
        for k in (keys or list(T.ORBIT_JSON_FIELDS))})


def object_key(permid="permid", provid="provid") -> Column:
    """Key of an observation's object: the number if there is one."""
    return F.coalesce(blank_to_null(permid), col(provid))


def with_object_key(obs: DataFrame, name: str = "primary_desig") -> DataFrame:
    return obs.withColumn(name, object_key()).where(F.col(name).isNotNull())


def clean_site_name(name) -> Column:
    """Trim, and undo backslash-escaped apostrophes."""
    return F.replace(F.trim(col(name)), F.lit("\\'"), F.lit("'"))


def date_window(df: DataFrame, *, time: str, start=None, end=None) -> DataFrame:
    """Rows from day ``start`` to day ``end``, both included, as a half-open range
    on the bare column so the scan can skip files."""
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(time) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return df


def consensus_filter(wide: DataFrame, *, sources: list[str], include=(), exclude=(),
                     classes_in=(), classes_out=(), ranges: dict | None = None,
                     dates: dict | None = None, numbered: bool | None = None,
                     named: bool | None = None, hide_all_agree: bool = False) -> DataFrame:
    """The multi-source browser's filters, all combined with AND.

    ``ranges`` and ``dates`` map a column to an inclusive (low, high); either end
    may be None.
    """
    d = wide
    for s in include:
        d = d.where(F.col(f"in_{s}"))
    for s in exclude:
        d = d.where(~F.col(f"in_{s}"))
    if classes_in:
        d = d.where(F.col("orbit_class").isin(*classes_in))
    if classes_out:
        d = d.where(~F.col("orbit_class").isin(*classes_out))
    for c, (low, high) in {**(ranges or {}), **(dates or {})}.items():
        if low is not None:
            d = d.where(F.col(c) >= F.lit(low))
        if high is not None:
            d = d.where(F.col(c) <= F.lit(high))
    for flag, c in ((numbered, "permid"), (named, "iau_name")):
        if flag is not None:
            d = d.where(F.col(c).isNotNull() if flag else F.col(c).isNull())
    if hide_all_agree:
        agree = F.lit(True)
        for s in sources:
            agree = agree & F.col(f"in_{s}")
        d = d.where(~agree)
    return d


def q_solidity_verdict(q_listed, q_catalog, tolerance: float = 0.02) -> Column:
    """Keep or drop a listed object whose perihelion disagrees with the catalogue."""
    q, ref = col(q_listed), col(q_catalog)
    return (F.when(q.isNull(), F.lit("drop_q_none"))
            .when(q <= 1.3, F.lit("keep"))
            .when(ref.isNull() | (ref > 1.3), F.lit("drop_solid"))
            .when(F.abs(q - ref) <= tolerance + 1e-9, F.lit("drop_solid"))
            .otherwise(F.lit("keep_unsolid")))


def quality_gate(obs: DataFrame, *, limit: float = 5.0) -> DataFrame:
    """Distinct exportable lines: small or absent residuals, not a replaced position."""
    ok = ((F.col("rmsra").isNull() | (F.col("rmsra") < limit))
          & (F.col("rmsdec").isNull() | (F.col("rmsdec") < limit))
          & ~F.substring("obs80", 15, 1).isin("X", "x"))
    return obs.where(ok).select("obs80", "rmsra", "rmsdec").distinct()


def best_value(preferred, fallback, sentinel=None) -> Column:
    """First usable value; a sentinel in the preferred one counts as absent."""
    p = col(preferred)
    if sentinel is not None:
        p = F.nullif(p, F.lit(sentinel))
    return F.coalesce(p, col(fallback))


def ref_class(ref, prev_ref=None) -> Column:
    """Kind of publication: MPEC, MPS, other or none; empty refs fall back."""
    r = blank_to_null(ref)
    if prev_ref is not None:
        r = F.coalesce(r, blank_to_null(prev_ref))
    return (F.when(r.isNull(), F.lit("none")).when(r.startswith("MPEC"), F.lit("MPEC"))
            .when(r.startswith("MPS"), F.lit("MPS")).otherwise(F.lit("other")))


def neocp_select(neocp: DataFrame, *, desig: str = "") -> DataFrame:
    """Live candidate observations: all of them, or one designation's."""
    return neocp if desig == "" else neocp.where(F.col("desig") == desig)


def neocp_archive_select(archive: DataFrame, prev_des: DataFrame, *, desig: str) -> DataFrame:
    """Archived observations of an object named by any of its three designations."""
    names = prev_des.where((F.col("desig") == desig) | (F.col("iau_desig") == desig)
                           | (F.col("pkd_desig") == desig)).select("desig")
    names = names.unionByName(archive.where(F.col("desig") == desig).select("desig")).distinct()
    return archive.join(names, "desig", "left_semi")
