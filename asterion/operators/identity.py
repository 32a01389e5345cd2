"""Which observation belongs to which object.

Observations carry a permanent number, a provisional designation, or both, and
either may be an alias. Every match here is an equi join on (kind, key): an OR of
two columns would become a nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from asterion.functions import designation as D, orbit
from asterion.functions.common import blank_to_null

from .filters import select_neos

PACKED = "packed_primary_provisional_designation"
UNPACKED = "unpacked_primary_provisional_designation"


def with_numbering(orbits: DataFrame, ni: DataFrame) -> DataFrame:
    """Add permid, the numbered object's designation, and flags."""
    n = ni.select(PACKED, "permid", F.col(UNPACKED).alias("num_provid"))
    numbered = F.col("permid").isNotNull()
    return orbits.join(n, PACKED, "left").withColumns({
        "is_numbered": numbered,
        "provisional_desig": F.when(~numbered, F.col(UNPACKED)),
    })


def neo_keys(neos: DataFrame, carry: list[str] = ()) -> DataFrame:
    """(unpacked_desig, packed_desig, kind, key, carry): up to two keys per object."""
    pairs = F.array(
        F.struct(F.lit("permid").alias("kind"), F.col("permid").alias("key")),
        F.struct(F.lit("provid").alias("kind"),
                 F.coalesce("provisional_desig", "num_provid").alias("key")))
    return (neos.select(F.col(UNPACKED).alias("unpacked_desig"),
                        F.col(PACKED).alias("packed_desig"), *carry, F.explode(pairs).alias("_k"))
            .select("unpacked_desig", "packed_desig", *carry, "_k.kind", "_k.key")
            .where(F.col("key").isNotNull()))


def observation_keys(obs: DataFrame, *columns: str) -> DataFrame:
    """One row per identifier an observation carries: (kind, key, columns)."""
    pairs = F.array(
        F.struct(F.lit("permid").alias("kind"), F.col("permid").alias("key")),
        F.struct(F.lit("provid").alias("kind"), F.col("provid").alias("key")))
    return (obs.select(*columns, F.explode(pairs).alias("_k"))
            .select("_k.kind", "_k.key", *columns).where(F.col("key").isNotNull()))


def match_by_designation(neos: DataFrame, obs: DataFrame, *, disc_only: bool = True) -> DataFrame:
    """Observations of the objects, once per identifier that matches.

    ``neos`` comes from :func:`with_numbering`. An observation that carries both
    identifiers of its object appears twice, as in a union of the branches.
    """
    if disc_only:
        obs = obs.where(F.col("disc") == "*")
    keyed = observation_keys(obs, "stn", "obsid", "trkid", "obstime")
    return neo_keys(neos).join(keyed, ["kind", "key"]).select(
        "unpacked_desig", "packed_desig", "stn", "obsid", "trkid", "obstime")


def earliest_discovery(neos: DataFrame, obs: DataFrame, *, carry: list[str] = ()) -> DataFrame:
    """Earliest discovery observation of each object; ties go to the lower obsid.

    The observations are first reduced to the earliest one per identifier, so that
    neither the join nor the final step sees more than one row per key, however
    many observations an identifier holds. ``carry`` adds columns of the object,
    which saves joining back.
    """
    fields = ["obsid", "stn", "trkid"]
    disc = obs.where(F.col("disc") == "*").withColumn("trkid", blank_to_null("trkid"))
    first = observation_keys(disc, "obstime", *fields).groupBy("kind", "key").agg(
        F.min_by(F.struct("obstime", *fields), F.struct("obstime", "obsid")).alias("_r"))
    whole = F.struct(F.col("_r"), *carry)
    order = F.struct("_r.obstime", "_r.obsid")
    return (neo_keys(neos, carry).join(first, ["kind", "key"])
            .groupBy("unpacked_desig", "packed_desig").agg(F.min_by(whole, order).alias("_w"))
            .select("unpacked_desig", "packed_desig", "_w._r.obstime",
                    *[F.col(f"_w._r.{c}").alias(c) for c in fields],
                    *[F.col(f"_w.{c}").alias(c) for c in carry]))


def or_key_join(targets: DataFrame, obs: DataFrame, *, permid: str = "permid",
                provid: str = "primary_desig", columns: list[str] | None = None) -> DataFrame:
    """Observations matching a target's number or designation, once per target.

    An observation carrying both identifiers of one target would match twice. The
    designation branch therefore remembers the row's own number, and drops rows
    that the number branch already gave: no distinct over the result is needed.
    """
    columns = columns or [c for c in obs.columns if c not in (permid, provid)]
    t = targets.select(F.col(provid).alias("_target"), F.col(permid).alias("_number"))
    pairs = F.array(
        F.when(F.col("_number").isNotNull(),
               F.struct(F.lit("permid").alias("kind"), F.col("_number").alias("key"))),
        F.struct(F.lit("provid").alias("kind"), F.col("_target").alias("key")))
    keys = t.select("_target", "_number", F.explode(pairs).alias("_k")) \
        .where(F.col("_k").isNotNull()).select("_target", "_number", "_k.kind", "_k.key")
    rows = observation_keys(obs.withColumn("_own", F.col("permid")), "_own", *columns)
    again = (F.col("kind") == "provid") & F.coalesce(F.col("_own") == F.col("_number"), F.lit(False))
    return (keys.join(rows, ["kind", "key"]).where(~again)
            .select(F.col("_target").alias(provid), *columns))


def alias_keys(orbits: DataFrame, ci: DataFrame, ni: DataFrame, *, q_max: float = 1.3) -> DataFrame:
    """(kind, key) of every identifier of the near-Earth objects, each once."""
    prim = orbits.where(F.col("q") <= q_max).select(PACKED, UNPACKED)
    own = prim.select(F.lit("provid").alias("kind"), F.col(UNPACKED).alias("key"))
    second = ci.join(prim.select(PACKED), PACKED, "left_semi").select(
        F.lit("provid").alias("kind"),
        F.col("unpacked_secondary_provisional_designation").alias("key"))
    numbered = ni.join(prim.select(PACKED), PACKED, "left_semi").select(
        F.explode(F.array(
            F.struct(F.lit("provid").alias("kind"), F.col(UNPACKED).alias("key")),
            F.struct(F.lit("permid").alias("kind"), F.col("permid").alias("key")))).alias("_k")
    ).select("_k.*")
    return own.unionByName(second).unionByName(numbered).where(
        F.col("key").isNotNull()).distinct()


def alias_semi_join(obs: DataFrame, orbits: DataFrame, ci: DataFrame, ni: DataFrame, *,
                    q_max: float = 1.3) -> DataFrame:
    """Observations of near-Earth objects under any of their identifiers.

    Two joins with unique keys mark the rows, so no row is ever duplicated and no
    distinct over the observations is needed.
    """
    return semi_join_keys(obs, alias_keys(orbits, ci, ni, q_max=q_max))


def semi_join_keys(obs: DataFrame, keys: DataFrame) -> DataFrame:
    """Observations that carry any of the (kind, key) identifiers, each once.

    A row is taken by its number, or else by its designation. Rows without an identifier do not
    take part in the lookup by it, so they are not shuffled for it; what the designations find is
    few rows, and of these only those that the numbers did not take are added.
    """
    of = lambda kind: keys.where((F.col("kind") == kind) & F.col("key").isNotNull()).select(F.col("key").alias(kind)).distinct()
    numbers = of("permid")
    numbered = obs.where(F.col("permid").isNotNull()).join(numbers, "permid", "left_semi")
    named = obs.where(F.col("provid").isNotNull()).join(of("provid"), "provid", "left_semi")
    left_over = named.withColumn("_number", spread("permid", "provid")).join(
        numbers.withColumnRenamed("permid", "_number"), "_number", "left_anti")
    return numbered.select(*obs.columns).unionByName(left_over.select(*obs.columns))


def spread(key: str, *others: str) -> Column:
    """The key, or for NULL a value that nothing matches and that differs from row to row as the other columns do."""
    return F.coalesce(F.col(key), F.concat(F.lit("no key "), F.xxhash64(*others).cast("string")))


def neo_list_keys(neo_list: DataFrame) -> DataFrame:
    """(unpacked_desig, kind, key) of list entries that carry numbers or designations."""
    pairs = F.array(
        F.when(F.col("is_numbered"), F.struct(F.lit("permid").alias("kind"),
                                              F.col("asteroid_number").alias("key"))),
        F.when(~F.col("is_numbered"), F.struct(F.lit("provid").alias("kind"),
                                               F.col("provisional_desig").alias("key"))),
        F.struct(F.lit("provid").alias("kind"), F.col("num_provid").alias("key")))
    return (neo_list.select("unpacked_desig", F.explode(pairs).alias("_k"))
            .where(F.col("_k.key").isNotNull()).select("unpacked_desig", "_k.kind", "_k.key"))


def unmatched(neo_list: DataFrame, obs: DataFrame) -> DataFrame:
    """List entries without any discovery observation, with the keys tried."""
    held = observation_keys(obs.where(F.col("disc") == "*")).distinct()
    hit = neo_list_keys(neo_list).join(held, ["kind", "key"], "left_semi").select("unpacked_desig")
    return neo_list.join(hit, "unpacked_desig", "left_anti").select(
        "packed_desig", "unpacked_desig", "is_numbered",
        F.coalesce("asteroid_number", F.lit("")).alias("asteroid_number"),
        F.when(F.col("is_numbered"), F.col("asteroid_number")).otherwise(F.lit(""))
        .alias("match_attempt_permid"),
        F.coalesce("provisional_desig", "num_provid", F.lit("")).alias("match_attempt_provid"))


def existence_probe(keys: DataFrame, obs: DataFrame) -> DataFrame:
    """Whether any observation, and any discovery, exists under a target's keys."""
    seen = observation_keys(obs, "disc").groupBy("kind", "key").agg(
        F.bool_or(F.coalesce(F.col("disc") == "*", F.lit(False))).alias("_disc"))
    perm = seen.where(F.col("kind") == "permid").select(
        F.col("key").alias("asteroid_number"), F.lit(True).alias("_perm"), "_disc")
    prov = seen.where(F.col("kind") == "provid").select(
        F.col("key").alias("num_provid"), F.lit(True).alias("_prov"))
    return (keys.join(perm, "asteroid_number", "left").join(prov, "num_provid", "left")
            .select(*keys.columns, F.coalesce("_perm", F.lit(False)).alias("permid_exists"),
                    F.coalesce("_prov", F.lit(False)).alias("provid_exists"),
                    F.coalesce("_disc", F.lit(False)).alias("has_disc")))


def best_orbit_class() -> Column:
    """Class name from the stored type, or from the elements when it is missing."""
    return F.when(F.col("orbit_type_int").isNotNull(), orbit.orbit_long_name("orbit_type_int")) \
        .when(F.col("q").isNotNull() & F.col("e").isNotNull(),
              orbit.orbit_long_name(orbit.classify_orbit("q", "e", "i")))


def resolve_alias(df: DataFrame, ci: DataFrame, ni: DataFrame, orbits: DataFrame, *,
                  col: str) -> DataFrame:
    """Follow a designation through aliases and numbers to its primary and class.

    Numbers resolve by the numbered list, anything else by its packed form among
    the aliases. What resolves nowhere keeps NULLs. The catalogues are put together
    first, by their primary; the list then meets them in one join on (kind, key),
    which rows without a designation pass by.
    """
    numbers = ni.where(F.col(PACKED).isNotNull()).select(
        F.col(PACKED).alias("_prim"), F.col(UNPACKED).alias("_name"), "permid", "iau_name")
    elements = orbits.where(F.col(PACKED).isNotNull()).select(
        F.col(PACKED).alias("_prim"), best_orbit_class().alias("orbit_class"))
    by_number = numbers.where(F.col("permid").isNotNull()).join(elements, "_prim", "left").select(
        F.lit("number").alias("_kind"), F.col("permid").alias("_key"), F.struct(
            F.col("_name").alias("primary_desig"), "permid", "iau_name", F.lit(False).alias("is_secondary"),
            F.lit(True).alias("is_numbered"), "orbit_class").alias("_r"))
    alias, known = F.col("packed_secondary_provisional_designation"), F.coalesce("numbered", F.lit(False))
    by_alias = ci.where(alias.isNotNull() & F.col(PACKED).isNotNull()).select(
        alias.alias("_key"), F.col(PACKED).alias("_prim"), F.col(UNPACKED).alias("_ci_name"), known.alias("_known"))
    by_alias = by_alias.join(numbers.drop("_name"), "_prim", "left").join(elements, "_prim", "left").select(
        F.lit("packed").alias("_kind"), "_key", F.struct(
            F.col("_ci_name").alias("primary_desig"), F.when(F.col("_known"), F.col("permid")).alias("permid"),
            F.when(F.col("_known"), F.col("iau_name")).alias("iau_name"), (F.col("_prim") != F.col("_key")).alias("is_secondary"),
            F.col("_known").alias("is_numbered"), "orbit_class").alias("_r"))
    d = df.select(F.col(col).alias("mpec_desig"))
    is_number = F.col("mpec_desig").rlike("^[0-9]+$")
    d = d.withColumns({"_kind": F.when(is_number, F.lit("number")).otherwise(F.lit("packed")),
                       "_key": F.when(is_number, F.col("mpec_desig")).otherwise(D.pack_designation("mpec_desig"))})
    found = d.where(F.col("_key").isNotNull()).join(by_number.unionByName(by_alias), ["_kind", "_key"], "left")
    none = F.lit(None).cast(by_number.schema["_r"].dataType).alias("_r")
    both = found.select("mpec_desig", "_r").unionByName(d.where(F.col("_key").isNull()).select("mpec_desig", none))
    flags = {c: F.coalesce(f"_r.{c}", F.lit(False)) for c in ("is_secondary", "is_numbered")}
    return both.select("mpec_desig", *[flags.get(c, F.col(f"_r.{c}")).alias(c) for c in (
        "primary_desig", "permid", "iau_name", "is_secondary", "is_numbered", "orbit_class")])


def canonicalize(df: DataFrame, ni: DataFrame, orbits: DataFrame, *, raw: str) -> DataFrame:
    """Raw source designations to canonical identity.

    Unparseable strings, and numbers unknown to the numbered list, are dropped: a
    primary designation is never invented.
    """
    s = F.trim(F.col(raw))
    kind = D.designation_kind(s)
    packed_form = ~s.contains(" ") & ~s.contains("/")
    d = df.withColumn("raw_string", F.col(raw)).withColumn("_kind", kind) \
        .where(F.col("_kind").isNotNull())
    number = F.when(F.col("_kind") == "numbered",
                    F.when(s.rlike("^[1-9][0-9]*$"), s).otherwise(D.unpack_designation(s)))
    d = d.withColumn("_number", number)
    d = d.withColumn("_packed", F.when(F.col("_number").isNull(),
                                       F.when(packed_form, s).otherwise(D.pack_designation(s))))
    d = d.withColumn("_name", F.when(F.col("_number").isNull(),
                                     F.when(packed_form, D.unpack_designation(s)).otherwise(s)))
    # One lookup for numbers and packed names, in a table made of the catalogues alone.
    held = orbits.where(F.col(PACKED).isNotNull()).select(F.col(PACKED).alias("packed_desig"), F.lit(True).alias("_held")).distinct()
    numbers = ni.where(F.col("permid").isNotNull()).select(
        F.lit("number").alias("_by"), F.col("permid").alias("_key"), F.col(PACKED).alias("packed_desig"), F.col(UNPACKED).alias("_ni_name"))
    numbers = numbers.where(F.col("packed_desig").isNotNull()).join(held, "packed_desig", "left")
    names = held.select(F.lit("packed").alias("_by"), F.col("packed_desig").alias("_key"), "packed_desig",
                        F.lit(None).cast("string").alias("_ni_name"), "_held")
    d = d.withColumns({"_by": F.when(F.col("_number").isNull(), F.lit("packed")).otherwise(F.lit("number")),
                       "_key": F.coalesce("_number", "_packed")})
    d = d.join(numbers.unionByName(names), ["_by", "_key"], "left").where(
        F.col("_number").isNull() | F.col("packed_desig").isNotNull())
    return d.select(
        *[c for c in df.columns if c != raw],
        F.coalesce("_ni_name", "_name").alias("primary_desig"), F.coalesce("packed_desig", "_packed").alias("packed_desig"),
        F.col("_number").alias("permid"), "raw_string", F.lit(True).alias("desig_parsed"),
        F.coalesce("_held", F.lit(False)).alias("orbit_in_mpc"),
        D.is_comet("raw_string").alias("is_comet"))


def resolve_numbered_values(values: DataFrame, ni: DataFrame, *, key: str = "desig",
                            value: str = "value") -> DataFrame:
    """Re-key values given per number to designations, next to those already so keyed."""
    numbered = F.col(key).rlike("^[0-9]+$")
    names = ni.select(F.col("permid").alias(key), F.col(UNPACKED).alias("designation"))
    return (values.where(~numbered).select(F.col(key).alias("designation"), value)
            .unionByName(values.where(numbered).join(names, key)
                         .where(F.col("designation").isNotNull())
                         .select("designation", value)))


def member_designations(members: DataFrame, ci: DataFrame, ni: DataFrame) -> DataFrame:
    """(primary_desig, designation, kind) for every known form of a member's name."""
    m = members.select("primary_desig", "packed_desig").distinct()
    own = m.select("primary_desig", F.col("primary_desig").alias("designation"),
                   F.lit("primary").alias("kind"))
    alias = m.join(ci.select(F.col(PACKED).alias("packed_desig"),
                             F.col("unpacked_secondary_provisional_designation").alias("designation")),
                   "packed_desig").select("primary_desig", "designation", F.lit("secondary").alias("kind"))
    number = m.join(ni.select(F.col(PACKED).alias("packed_desig"),
                              F.col("permid").alias("designation")),
                    "packed_desig").select("primary_desig", "designation", F.lit("permid").alias("kind"))
    return own.unionByName(alias).unionByName(number).where(
        F.col("designation").isNotNull()).distinct()


def alias_lists(ci: DataFrame, ni: DataFrame) -> DataFrame:
    """(kind, primary_key, secondaries): all packed aliases of each primary.

    Numbered objects appear under their packed number with every alias, others
    under their packed designation without the alias that is the primary itself.
    """
    sec = "packed_secondary_provisional_designation"
    numbered = ci.join(ni.where(F.col("permid").rlike("^[0-9]+$")).select(PACKED, "permid"), PACKED) \
        .select(F.lit("numbered").alias("kind"), D.pack_number("permid").alias("primary_key"),
                F.col(sec).alias("secondary"))
    rest = ci.where((F.col(sec) != F.col(PACKED)) & ~F.col("numbered")).select(
        F.lit("unnumbered").alias("kind"), F.col(PACKED).alias("primary_key"),
        F.col(sec).alias("secondary"))
    return numbered.unionByName(rest).where(F.col("secondary").isNotNull()).groupBy(
        "kind", "primary_key").agg(F.array_sort(F.collect_set("secondary")).alias("secondaries"))


def alias_link_lines(lists: DataFrame) -> DataFrame:
    """One line per primary: its key, then the quoted aliases."""
    quoted = F.concat_ws(",", F.transform(
        "secondaries", lambda x: F.concat(F.lit('"'), x, F.lit('"'))))
    return lists.select("kind", "primary_key", F.concat(
        F.lit('"'), "primary_key", F.lit('": ['), quoted, F.lit("],")).alias("links"))


def ades_rows(obs: DataFrame, ci: DataFrame, *, permids: list[str] = (),
              packed: list[str] = ()) -> DataFrame:
    """Published observations of objects under their numbers, plus those without a
    number under any alias of the packed designations."""
    from .filters import published_active
    alias = ci.where(F.col(PACKED).isin(*packed)).select(
        F.col("unpacked_secondary_provisional_designation").alias("provid"),
        F.lit(True).alias("_alias")).distinct()
    d = published_active(obs).join(alias, "provid", "left")
    return d.where(F.col("permid").isin(*permids) | (F.col("permid").isNull() & F.col("_alias"))) \
        .select(*obs.columns)


def apply_alterations(obs: DataFrame, deletions: DataFrame, redesignations: DataFrame,
                      corrections: DataFrame) -> DataFrame:
    """Observations after the change log: deleted ones out, renamed and corrected
    ones under their new designation and id."""
    moved = redesignations.select("obsid", F.col("unpacked_provisional_designation_to").alias("_to"))
    fixed = corrections.select(F.col("obsid_old").alias("obsid"), F.col("obsid_new").alias("_new"))
    return (obs.join(deletions.select("obsid"), "obsid", "left_anti")
            .join(moved, "obsid", "left").join(fixed, "obsid", "left")
            .withColumns({"provid": F.coalesce("_to", "provid"), "obsid": F.coalesce("_new", "obsid")})
            .select(*obs.columns))


def identification_activity(redesignations: DataFrame, obs: DataFrame) -> DataFrame:
    """Per month and station: redesignated observations and the mean days from
    observation to redesignation."""
    from asterion.functions.timeconv import days_between, month_of
    d = redesignations.select("obsid", F.col("created_at").alias("_at")).join(
        obs.select("obsid", "stn", "obstime"), "obsid")
    return d.groupBy(month_of("_at").alias("month"), "stn").agg(
        F.count("*").alias("n"), F.round(F.avg(days_between("obstime", "_at")), 4).alias("mean_days"))


def distinct_packed_neos(orbits: DataFrame, *, rule: str = "iau") -> DataFrame:
    return select_neos(orbits, rule=rule).select(PACKED).distinct()
