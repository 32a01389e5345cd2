"""Which institutions list an object, where they disagree, and why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from asterion.functions import designation as D
from asterion.functions.common import count_if

from .identity import PACKED, UNPACKED, or_key_join
from .quantiles import with_percentiles


def membership_wide(members: DataFrame, *, sources: list[str],
                    details: tuple[str, ...] = ("nf_q", "nf_neo_prob", "nf_u")) -> DataFrame:
    """One row per listed asteroid with a flag and a refresh time per source."""
    aggs = [F.max("packed_desig").alias("packed_desig"), F.max("permid").alias("permid")]
    aggs += [F.bool_or(F.col("source") == s).alias(f"in_{s}") for s in sources]
    aggs += [F.max(F.when(F.col("source") == s, F.col("last_refreshed"))).alias(f"{s}_refreshed_at")
             for s in sources]
    aggs += [F.max(c).alias(c) for c in details if c in members.columns]
    return members.where(~F.col("is_comet")).groupBy("primary_desig").agg(*aggs)


def _total(sources: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(f"in_{s}").cast("int") for s in sources])


def source_health(runs: DataFrame, *, now) -> DataFrame:
    """Last run and last good run of each source, and the time since the good one."""
    last = F.max_by(F.struct("started_at", "status"), "started_at")
    ok = F.col("status") == "ok"
    good = F.max_by(F.when(ok, F.struct("started_at", "finished_at", "n_rows", "n_unresolved")),
                    F.when(ok, F.col("started_at")))
    d = runs.groupBy("source").agg(last.alias("l"), good.alias("g"))
    return d.select(
        "source", F.col("l.started_at").alias("last_run_started"),
        F.col("g.started_at").alias("last_ok_started"), F.col("l.status").alias("last_status"),
        F.col("g.finished_at").alias("last_ok_finished"), F.col("g.n_rows").alias("last_ok_n_rows"),
        F.col("g.n_unresolved").alias("last_ok_n_unresolved"),
        (F.lit(now).cast("timestamp_ntz") - F.col("g.finished_at")).alias("time_since_last_ok"))


def disagreement_patterns(wide: DataFrame, *, sources: list[str], n: int = 20) -> DataFrame:
    """Most frequent patterns of presence among objects not in every source."""
    flags = [f"in_{s}" for s in sources]
    return wide.where(_total(sources) < len(sources)).groupBy(
        *[F.col(f).cast("int").alias(f) for f in flags]).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), *flags).limit(n)


def disagreement_matrix(wide: DataFrame, *, sources: list[str]) -> DataFrame:
    """How many objects each source has that each other lacks, from one pass."""
    has = {s: F.col(f"in_{s}") for s in sources}
    cells = wide.agg(
        *[count_if(has[a] & ~has[b]).alias(f"{a}~{b}") for a in sources for b in sources if a != b],
        *[count_if(has[a]).alias(f"{a}~") for a in sources])
    rows = [F.struct(F.lit(a).alias("source_a"),
                     *[(F.lit(0).cast("bigint") if a == b else F.col(f"{a}~{b}")).alias(f"vs_{b}")
                       for b in sources], F.col(f"{a}~").alias("total")) for a in sources]
    return cells.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def pair_divergence(wide: DataFrame, *, a: str, b: str) -> DataFrame:
    x, y = F.col(f"in_{a}"), F.col(f"in_{b}")
    return wide.agg(count_if(x & ~y).alias("only_a"), count_if(y & ~x).alias("only_b"),
                    count_if(x & y).alias("both"))


def missing_from(wide: DataFrame, *, sources: list[str], source: str) -> DataFrame:
    """Objects every source but one has."""
    return wide.where(reduce(lambda p, s: p & (~F.col(f"in_{s}") if s == source else F.col(f"in_{s}")),
                             sources, F.lit(True)))


def only_in(wide: DataFrame, *, sources: list[str], source: str) -> DataFrame:
    return wide.where(reduce(lambda p, s: p & (F.col(f"in_{s}") if s == source else ~F.col(f"in_{s}")),
                             sources, F.lit(True)))


def missing_profile(wide: DataFrame, orbits: DataFrame, *, sources: list[str], source: str) -> DataFrame:
    """Elements of the objects only one source lacks: extremes, medians, tails."""
    d = missing_from(wide, sources=sources, source=source).select("primary_desig").join(
        orbits.select(F.col(UNPACKED).alias("primary_desig"), "q", "h"), "primary_desig")
    main = d.agg(F.count("*").alias("n"), F.round(F.min("q"), 3).alias("q_min"),
                 F.round(F.max("q"), 3).alias("q_max"), count_if(F.col("q") > 1.29).alias("n_q_gt_129"),
                 count_if(F.col("h") >= 27).alias("n_h_ge_27"))
    return with_percentiles(main, d, wanted={"q_median": ("q", 0.5), "h_median": ("h", 0.5)}).select(
        "n", "q_min", "q_max", F.round("q_median", 3).alias("q_median"), "n_q_gt_129",
        F.round("h_median", 1).alias("h_median"), "n_h_ge_27")


def only_profile(wide: DataFrame, orbits: DataFrame, *, sources: list[str], source: str,
                 detail_q: str = "nf_q") -> DataFrame:
    """Objects only one source has: its own mean q, and how many lie beyond 1.30."""
    d = only_in(wide, sources=sources, source=source).select("primary_desig", detail_q).join(
        orbits.select(F.col(UNPACKED).alias("primary_desig"), "q"), "primary_desig", "left")
    return d.agg(F.count("*").alias("n"), F.round(F.avg(detail_q), 3).alias("q_avg"),
                 count_if(F.col(detail_q) > 1.30).alias("listed_q_gt_130"),
                 count_if(F.col("q") > 1.30).alias("catalog_q_gt_130"))


def collapse_simulation(members: DataFrame, ci: DataFrame, *, n_sources: int) -> DataFrame:
    """Agreement before and after re-keying aliases to their primaries."""
    base = members.where(~F.col("is_comet")).select("source", "primary_desig", "packed_desig")
    alias = ci.select(F.col("packed_secondary_provisional_designation").alias("packed_desig"),
                      F.col(UNPACKED).alias("_true"))
    after = base.join(alias, "packed_desig", "left").select(
        "source", F.coalesce("_true", "primary_desig").alias("primary_desig"))

    def tally(d, label, order):
        per = d.groupBy("primary_desig").agg(F.countDistinct("source").alias("_k"))
        return per.agg(F.count("*").alias("n_primaries"),
                       count_if(F.col("_k") == n_sources).alias("all_agree"),
                       count_if(F.col("_k") < n_sources).alias("disagreements")).select(
            F.lit(label).alias("view"), "n_primaries", "all_agree", "disagreements")

    return tally(base, "before", 0).unionByName(tally(after, "after collapse", 1))


def disagreement_categories(wide: DataFrame, *, sources: list[str], together: list[tuple[str, ...]] = (),
                            apart: list[tuple[str, ...]] = ()) -> DataFrame:
    """(primary_desig, cat): objects only one source lacks, or only one has.

    ``together`` names groups of sources that share a category of what just they lack
    (``missing a+b``), ``apart`` groups of what just they have (``only a+b``). A category fixes the
    membership in every source, so an object has one at most.
    """
    def exactly(holders):
        return reduce(lambda p, x: p & (F.col(f"in_{x}") if x in holders else ~F.col(f"in_{x}")), sources, F.lit(True))

    named = {f"missing only {s}": [x for x in sources if x != s] for s in sources}
    named |= {f"only {s}": [s] for s in sources}
    named |= {f"missing {'+'.join(g)}": [x for x in sources if x not in g] for g in together}
    named |= {f"only {'+'.join(g)}": list(g) for g in apart}
    unknown = {x for g in [*together, *apart] for x in g} - set(sources)
    if unknown:
        raise ValueError(f"not a source: {sorted(unknown)}")
    cat = reduce(lambda c, kv: c.when(exactly(kv[1]), F.lit(kv[0])), named.items(), F.when(F.lit(False), F.lit("")))
    return wide.select("primary_desig", cat.alias("cat")).where(F.col("cat").isNotNull())


def category_characteristics(cats: DataFrame, summary: DataFrame) -> DataFrame:
    """Per category: counts, means and medians of observations and arc, short arcs."""
    d = cats.join(summary.select("primary_desig", "nobs", "arc_days", "first_obs", "last_obs"), "primary_desig")
    main = d.groupBy("cat").agg(
        F.count("*").alias("n"), F.round(F.avg("nobs"), 0).alias("nobs_avg"),
        F.round(F.avg("arc_days"), 0).alias("arc_avg"),
        count_if(F.col("arc_days") < 1).alias("one_night"), count_if(F.col("arc_days") < 30).alias("arc_lt_30d"),
        F.min("first_obs").alias("earliest_disc"), F.max("last_obs").alias("most_recent_obs"))
    out = with_percentiles(main, d, keys=["cat"], wanted={"nobs_p50": ("nobs", 0.5), "arc_p50": ("arc_days", 0.5)})
    return out.withColumns({c: F.round(c, 0).cast("int") for c in ("nobs_p50", "arc_p50")})


def top_category_stations(cats: DataFrame, summary: DataFrame, obscodes: DataFrame, *,
                          n: int = 6) -> DataFrame:
    """Most frequent discovery stations of each category."""
    from .ranking import top_n_per_group
    d = cats.join(summary.select("primary_desig", "disc_by"), "primary_desig").where(
        F.col("disc_by").isNotNull()).groupBy("cat", "disc_by").agg(F.count("*").alias("n_in_cat"))
    d = top_n_per_group(d, group=["cat"], order=[F.desc("n_in_cat"), F.col("disc_by")], n=n)
    name = obscodes.select(F.col("obscode").alias("disc_by"), F.col("name").alias("station_name"))
    return d.join(name, "disc_by", "left").select("cat", "disc_by", "station_name", "n_in_cat")


def single_site_counts(cats: DataFrame, obs: DataFrame) -> DataFrame:
    """Per category: objects seen from one station, from at most two, mean number."""
    per = cats.join(obs.select(F.col("provid").alias("primary_desig"), "stn"),
                    "primary_desig", "left").groupBy("cat", "primary_desig").agg(
        F.countDistinct("stn").alias("n_stns"))
    return per.groupBy("cat").agg(
        F.count("*").alias("n"), count_if(F.col("n_stns") == 1).alias("single_site"),
        count_if(F.col("n_stns") <= 2).alias("stns_le_2"),
        F.round(F.avg("n_stns"), 1).alias("n_stns_avg"))


def resolution_map(members: DataFrame, ci: DataFrame) -> DataFrame:
    """Every listed row with the primary designation its alias leads to."""
    alias = ci.select(F.col("packed_secondary_provisional_designation").alias("reported_packed"),
                      F.col(UNPACKED).alias("true_primary"),
                      F.col(PACKED).alias("true_primary_packed"), "object_type", "numbered")
    return members.select(
        "source", F.col("primary_desig").alias("reported_primary"),
        F.col("packed_desig").alias("reported_packed"), "is_comet", "permid").join(
        alias, "reported_packed", "left")


def resolution_counts(resolved: DataFrame) -> DataFrame:
    t, r = F.col("true_primary"), F.col("reported_primary")
    return resolved.agg(F.count("*").alias("rows_total"), count_if(t.isNull()).alias("no_ci_match"),
                        count_if(t == r).alias("self_match"), count_if(t != r).alias("aliased"))


def unresolved_by_source(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("true_primary").isNull()).groupBy("source").agg(
        F.count("*").alias("n_unresolved"))


def alias_report(resolved: DataFrame, members: DataFrame) -> DataFrame:
    """Every row listed under an alias, its case, and who holds which name.

    Source lists per name are built once per name (a handful of sources each) and
    joined twice, in place of a subquery per row.
    """
    holders = members.groupBy("primary_desig").agg(
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("_h"))
    true_h = holders.select(F.col("primary_desig").alias("true_primary"),
                            F.col("_h").alias("sources_holding_primary"))
    alias_h = holders.select(F.col("primary_desig").alias("reported_primary"),
                             F.col("_h").alias("sources_holding_alias"))
    d = resolved.where(F.col("true_primary") != F.col("reported_primary"))
    d = d.join(true_h, "true_primary", "left").join(alias_h, "reported_primary", "left")
    case = (F.when(F.col("true_primary").rlike("^[PCDXAI]/"), F.lit("D_comet"))
            .when(F.col("sources_holding_primary").isNotNull(), F.lit("B_primary_in_consensus"))
            .otherwise(F.lit("AC_primary_absent")))
    return d.select("source", "reported_primary", "reported_packed", "true_primary",
                    "true_primary_packed", "object_type", case.alias("case_class"),
                    "sources_holding_primary", "sources_holding_alias")


def common_to_all(wide: DataFrame, designations: DataFrame, *, sources: list[str]) -> DataFrame:
    """Every known designation of the objects all sources agree on."""
    agreed = wide.where(_total(sources) == len(sources)).select("primary_desig")
    return designations.join(agreed, "primary_desig", "left_semi")


def difference_of(a: DataFrame, b: DataFrame, *, key: str) -> DataFrame:
    return a.join(b.select(key), key, "left_anti")


def membership_upsert(snapshot: DataFrame, batch: DataFrame, *, source: str, now) -> DataFrame:
    """The member table after one source's refresh.

    New rows enter with all three times set to now; rows listed again keep
    first_seen and take everything else from the batch; rows no longer listed stay.
    A batch naming an object twice keeps its highest row.
    """
    t = F.lit(now).cast("timestamp_ntz")
    fields = [c for c in snapshot.columns if c not in (
        "source", "primary_desig", "first_seen", "last_seen", "last_refreshed")]
    new = batch.groupBy("primary_desig").agg(F.max(F.struct(*[
        (F.col(c) if c in batch.columns else F.lit(None).cast(snapshot.schema[c].dataType)).alias(c)
        for c in fields])).alias("_n")).withColumn("source", F.lit(source))
    d = snapshot.withColumn("_old", F.lit(True)).join(new, ["source", "primary_desig"], "full")
    hit = F.col("_n").isNotNull()
    keep = {c: F.when(hit, F.col(f"_n.{c}")).otherwise(F.col(c)) for c in fields}
    keep.update({"first_seen": F.coalesce("first_seen", t),
                 "last_seen": F.when(hit, t).otherwise(F.col("last_seen")),
                 "last_refreshed": F.when(hit, t).otherwise(F.col("last_refreshed"))})
    return d.select(*[keep.get(c, F.col(c)).alias(c) for c in snapshot.columns])


def consensus_obs(wide: DataFrame, obs: DataFrame) -> DataFrame:
    return or_key_join(wide.select("primary_desig", "permid"), obs)


def kinds_of_members(members: DataFrame) -> DataFrame:
    """How each source writes its designations."""
    return members.groupBy("source", D.designation_kind("raw_string").alias("kind")).agg(
        F.count("*").alias("n"))
