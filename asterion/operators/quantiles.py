"""Exact percentiles of groups of any size, by radix cells.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here a double
becomes a 64-bit integer of the same order, whose leading 22 bits name a cell. Counts per
(group, column, cell) say which cell holds a wanted rank; the next round looks at the rows of
those cells only, 22 bits deeper, and the third one at single values. All columns
and fractions of a request share the rounds, so the source is read three times whatever is
asked, one window never orders more than the 2^22 cells below one prefix, and every join is
one of equality. Nothing is rounded, sampled or approximated.

Where a group cannot be large, counting each (group, value) first is enough:
``value_counts``.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window, functions as F

from asterion.functions.common import with_isolated

BITS = 22
ROUNDS = 3
MAX = sys.float_info.max


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n) for non-NULL values; a large group spreads over its values."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count("*").alias("_n"))


def with_order_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the 64-bit integer whose order is that of the double; both zeros give 0, a negative gives minus its opposite.

    It is the double's own bit pattern, put together from exponent and mantissa:
    dividing by a power of two is exact, and the exponent's logarithm, which may be one off, is
    corrected by comparison.
    """
    a = F.least(F.abs(value), F.lit(MAX))  # infinity has a place of its own
    two = lambda e: F.pow(F.lit(2.0), e)
    df = df.withColumn("_e", F.floor(F.log2(F.greatest(a, F.lit(2.0 ** -1022)))))
    df = df.withColumn("_e", F.col("_e") + F.when(a >= two(F.col("_e") + 1), 1).when(a < two(F.col("_e")), -1).otherwise(0))
    normal = (F.col("_e") + 1023) * F.lit(1 << 52) + ((a / two(F.col("_e")) - 1) * F.lit(2.0 ** 52)).cast("bigint")
    bits = (F.when(F.abs(value) > MAX, F.lit(2047 << 52))
            .when(a < 2.0 ** -1022, (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("bigint")).otherwise(normal))
    return with_isolated(df, {name: F.when(F.col(value) < 0, -bits).otherwise(bits)}, keep=[c for c in df.columns if c != "_e"])


def cell(key: str, round: int) -> Column:
    """The prefix of the order key after so many rounds."""
    return F.shiftright(key, max(0, 64 - BITS * round))


def percentiles(df: DataFrame, *, keys: list[str], wanted: dict[str, tuple[str, float]],
                discrete: bool = False) -> DataFrame:
    """One row per group, a column per wanted (value column, fraction); NULL and NaN values ignored.

    Interpolated between neighbouring ranks, or for ``discrete`` the first value
    whose rank reaches the fraction. A NULL key is a group of its own; a group without any value has no row.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    own = [f"_key{i}" for i in range(len(keys))]
    long = df.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], F.explode(F.array(*[
        F.struct(F.lit(i).alias("_c"), (F.col(c).cast("double") + F.lit(0.0)).alias("_v")) for i, c in enumerate(columns)])).alias("_p")
    ).select(*own, "_p._c", "_p._v").where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    base = with_order_key(long, "_v", "_key")
    group = [*own, "_c"]

    # A rank is (number of the fraction, 0 for the lower and 1 for the upper neighbour, rows below it in its cell).
    def ranks(n: Column) -> Column:
        def rank(k, p, side):
            if discrete:
                r = F.greatest(F.ceil(F.lit(p) * n) - 1, F.lit(0))
            else:
                r = (F.ceil if side else F.floor)(F.lit(p) * (n - 1))
            return F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), r.cast("bigint").alias("r"))
        per = [F.when(F.col("_c") == columns.index(c), F.array(*[rank(k, p, side) for side in ((0,) if discrete else (0, 1))]))
               for k, (c, p) in enumerate(wanted.values())]
        none = F.array().cast("array<struct<k:int,side:int,r:bigint>>")
        return F.flatten(F.array(*[F.coalesce(x, none) for x in per]))

    found = None
    for round in range(1, ROUNDS + 1):
        here, within = cell("_key", round).alias("_cell"), [*group] if found is None else [*group, "_from"]
        count = [F.count("*").alias("_m"), F.min("_v").alias("_lo")]
        if found is None:
            hist = base.groupBy(*group, here).agg(*count)
        else:
            left, right = base.withColumn("_from", cell("_key", round - 1)), found.select(
                *[F.col(c).alias("_f" + c) for c in [*group, "_cell"]], "_n", "_ranks")
            on = (F.col("_c") == F.col("_f_c")) & (F.col("_from") == F.col("_f_cell"))
            for o in own:
                on = on & F.col(o).eqNullSafe(F.col("_f" + o))
            # Without keys the wanted cells are at most two per fraction; else their number is for Spark to judge.
            # Ranks depend on the cell; as grouping columns they keep the aggregation hashed.
            hist = left.join(right if keys else F.broadcast(right), on).groupBy(*within, "_n", "_ranks", here).agg(*count)
        w = Window.partitionBy(*within)
        hist = hist.withColumn("_upto", F.sum("_m").over(w.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)))
        if found is None:
            hist = hist.withColumn("_n", F.sum("_m").over(w)).withColumn("_ranks", ranks(F.col("_n")))
        below = F.col("_upto") - F.col("_m")
        inside = F.filter("_ranks", lambda x: (x["r"] >= below) & (x["r"] < F.col("_upto")))
        found = hist.withColumn("_ranks", F.transform(inside, lambda x: F.struct(
            x["k"].alias("k"), x["side"].alias("side"), (x["r"] - below).alias("r")))).where(F.size("_ranks") > 0).select(
            *group, "_cell", "_n", "_lo", "_ranks")
    picked = found.select(*own, "_n", "_lo", F.explode("_ranks").alias("_r"))
    out = []
    for k, (name, (_, p)) in enumerate(wanted.items()):
        def at(side):
            return F.max(F.when((F.col("_r.k") == k) & (F.col("_r.side") == side), F.col("_lo")))
        position = F.lit(p) * (F.max(F.when(F.col("_r.k") == k, F.col("_n"))) - 1)
        part = position - F.floor(position)
        out.append((at(0) if discrete else F.when(part == 0, at(0)).otherwise(at(0) * (1 - part) + at(1) * part)).alias(name))
    if not keys:  # a constant key: no values, no row
        return picked.groupBy(F.lit(0).alias("_all")).agg(*out).drop("_all")
    return picked.groupBy(*own).agg(*out).withColumnsRenamed(dict(zip(own, keys)))


def with_percentiles(main: DataFrame, rows: DataFrame, *, wanted: dict[str, tuple[str, float]],
                     keys: list[str] | None = None) -> DataFrame:
    """Aggregates of ``rows`` with their percentiles beside them; groups match by key, NULL with NULL."""
    if not keys:
        q = percentiles(rows, keys=[], wanted=wanted).select(F.struct(*wanted)).scalar()
        return main.withColumn("_q", q).select(*main.columns, "_q.*")
    q = percentiles(rows, keys=keys, wanted=wanted)
    q = q.withColumnsRenamed({k: "_q_" + k for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col("_q_" + k))
    return main.join(q, on, "left").drop(*["_q_" + k for k in keys])
