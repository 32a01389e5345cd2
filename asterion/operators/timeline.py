"""One object's observations along time, for all objects at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from asterion.functions import photometry, sky
from asterion.functions.timeconv import days_between, epoch_micros, from_epoch_micros

from .ordered import month_bucket, with_carried, with_previous, with_running_sum

DAY_US = 86_400_000_000


def segment_arcs(obs: DataFrame, *, key: str, time: str = "obstime", id: str = "obsid",
                 gap_days: float = 60.0, ra: str | None = None, center: float = 180.0) -> DataFrame:
    """Arcs of each object: a new one after a gap, and with ``ra`` also where the
    centred longitude jumps across the map's edge.

    One pass: inside a month the rows of an object become arcs with their first and last row, and
    of those few the neighbours across a border are joined where nothing breaks between them.
    """
    row = [time, id] + ([ra] if ra else [])
    d = obs.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        key, month_bucket(time).alias("_month"), F.struct(*row).alias("_r"))

    def breaks(before: Column, after: Column) -> Column:
        new = days_between(before[time], after[time]) > gap_days
        if ra:
            def centred(c):
                return F.pmod(c - F.lit(center) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
            new = new | (F.abs(centred(after[ra]) - centred(before[ra])) > 180)
        return F.coalesce(new, F.lit(False)).cast("int")

    inside = Window.partitionBy(key, "_month").orderBy(F.col(f"_r.{time}"), F.col(f"_r.{id}"))
    d = d.withColumn("_new", breaks(F.lag("_r").over(inside), F.col("_r")))
    d = d.withColumn("_part", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct(f"_r.{time}", f"_r.{id}")
    parts = d.groupBy(key, "_month", "_part").agg(
        F.min_by("_r", at).alias("_first"), F.max_by("_r", at).alias("_last"), F.count("*").alias("n"))
    along = Window.partitionBy(key).orderBy("_month", "_part")
    border = F.when(F.col("_part") > 0, 1).otherwise(breaks(F.lag("_last").over(along), F.col("_first")))
    parts = parts.withColumn("_new", border)
    parts = parts.withColumn("arc_id", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy(key, "arc_id").agg(
        F.min(f"_first.{time}").alias("start"), F.max(f"_last.{time}").alias("end"), F.sum("n").alias("n"))


def nearest_in_time(grid: DataFrame, obs: DataFrame, *, key: str, time: str,
                    columns: list[str], id: str = "obsid", cell_days: float = 1.0) -> DataFrame:
    """For each grid instant the nearest observation of its key; a tie takes the later.

    The instants of a calendar cell cut it into slots, and of each slot only the first and the last
    observation can be anyone's nearest. Observations are reduced to these two where they
    lie; what is ordered along a key are its slots and instants, whose number the calendar and
    the grid bound, not its observations. A key or cell that holds most of all rows is
    split like any other before it is added up.
    """
    def cell(c: str) -> Column:
        return F.floor(epoch_micros(c) / F.lit(float(round(cell_days * DAY_US))))

    g = grid.withColumn("_cell", cell(time))
    cuts = g.where(F.col(time).isNotNull()).groupBy(key, "_cell").agg(F.array_sort(F.collect_set(time)).alias("_at"))
    ident = F.col(id).cast("string").alias("_id")
    o = obs.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        key, cell(time).alias("_cell"), F.struct(F.col(time), ident, *columns).alias("_o")).join(cuts, [key, "_cell"], "left")
    slot = F.coalesce(F.size(F.filter("_at", lambda x: x <= F.col(f"_o.{time}"))), F.lit(0))
    rank = F.struct(f"_o.{time}", "_o._id")
    ends = o.groupBy(key, "_cell", slot.alias("_slot")).agg(F.min_by("_o", rank).alias("_first"), F.max_by("_o", rank).alias("_last"))
    none = F.lit(None).cast(ends.schema["_first"].dataType)
    whole = F.struct(*[F.col(c) for c in grid.columns])
    asked = g.join(cuts, [key, "_cell"], "left").select(
        key, "_cell", (F.array_position("_at", F.col(time)) - 1).cast("int").alias("_slot"), none.alias("_first"), none.alias("_last"),
        whole.alias("_g"))
    both = ends.withColumn("_g", F.lit(None).cast(asked.schema["_g"].dataType)).unionByName(asked)
    side = F.col("_g").isNotNull()  # an instant comes after its slot and before the next
    up = Window.partitionBy(key).orderBy("_cell", "_slot", side).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(key).orderBy(F.desc("_cell"), F.desc("_slot"), side.desc()).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumns({"_before": F.last("_last", ignorenulls=True).over(up),
                             "_after": F.last("_first", ignorenulls=True).over(down)})
    left = F.abs(days_between(F.col(f"_before.{time}"), F.col(f"_g.{time}")))
    right = F.abs(days_between(F.col(f"_g.{time}"), F.col(f"_after.{time}")))
    pick = F.when(F.col(f"_g.{time}").isNull(), None).when(F.col("_before").isNull(), F.col("_after")).when(
        F.col("_after").isNull(), F.col("_before")).when(left < right, F.col("_before")).otherwise(
        F.col("_after"))
    return both.where(side).select("_g", pick.alias("_p")).select(
        *[F.col(f"_g.{c}").alias(c) for c in grid.columns], F.col(f"_p.{time}").alias(f"nearest_{time}"),
        *[F.col(f"_p.{c}").alias(c) for c in columns])


def observability_segments(obs: DataFrame, *, key: str, step_days: int = 3, limit_deg: float = 90.0,
                           start: str | None = None, end: str | None = None) -> DataFrame:
    """Intervals in which each object, at its nearest observed place, is far from the Sun.

    Works on a grid of fixed steps (each object's own span unless given). Only the
    first and last observation inside each step can be the nearest to a grid
    instant, so an object shrinks to two rows per step before anything is ordered.
    """
    step = step_days * DAY_US
    d = obs.where(F.col(key).isNotNull() & F.col("obstime").isNotNull() & F.col("ra").isNotNull()
                  & F.col("dec").isNotNull()).select(
        key, "obsid", epoch_micros("obstime").alias("_us"), "ra", "dec")
    day0 = F.floor(F.col("_us") / F.lit(DAY_US)) * DAY_US
    span = d.groupBy(key).agg(
        (epoch_micros(F.lit(start).cast("timestamp_ntz")) if start else F.min(day0)).alias("_a"),
        (epoch_micros(F.lit(end).cast("timestamp_ntz")) if end
         else F.max(F.floor(F.col("_us") / F.lit(DAY_US)) * DAY_US + DAY_US)).alias("_z"))
    # Slot k holds the observations in (instant k-1, instant k].
    slotted = d.join(span, key).withColumn("_slot", F.least(F.greatest(
        F.ceil((F.col("_us") - F.col("_a")) / F.lit(step)), F.lit(0)),
        F.floor((F.col("_z") - F.col("_a")) / F.lit(step)) + 1))
    at, row = F.struct("_us", "obsid"), F.struct("_us", "ra", "dec")
    ends = slotted.groupBy(key, "_slot").agg(F.min_by(row, at).alias("_first"),
                                             F.max_by(row, at).alias("_last"))
    grid = span.withColumn("_slot", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("_z") - F.col("_a")) / F.lit(step)) + 1)))
    d = grid.join(ends, [key, "_slot"], "left").withColumn(
        "_g", F.col("_a") + F.col("_slot") * F.lit(step))
    # At most one row per step of the calendar from here on.
    w = Window.partitionBy(key).orderBy("_slot")
    # An observation exactly on the instant is the last of its slot and wins as 'next'.
    exact = F.col("_last._us") == F.col("_g")
    before = F.last(F.col("_last"), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    back = Window.partitionBy(key).orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    after = F.last(F.col("_first"), ignorenulls=True).over(back)
    d = d.withColumns({"_b": before, "_n": F.when(exact, F.col("_last")).otherwise(after)})
    d = d.where(F.col("_g") <= F.col("_z"))
    pick = F.when(F.col("_b").isNull(), F.col("_n")).when(F.col("_n").isNull(), F.col("_b")).when(
        (F.col("_g") - F.col("_b._us")) < (F.col("_n._us") - F.col("_g")), F.col("_b")).otherwise(F.col("_n"))
    d = d.select(key, "_slot", from_epoch_micros("_g").alias("_t"), pick.alias("_p"))
    d = sky.with_sun(d, "_t", "meeus")
    elong = sky.angular_separation(F.col("_p.ra"), F.col("_p.dec"), "sun_ra", "sun_dec")
    d = d.select(key, "_slot", "_t", (elong > limit_deg).alias("is_above"))
    change = (F.col("is_above") != F.lag("is_above").over(w)).cast("int")
    run = F.sum(F.coalesce(change, F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("_run", run).groupBy(key, "_run", "is_above").agg(
        F.min("_t").alias("x0"), F.max("_t").alias("_end"))
    following = F.lead("x0").over(Window.partitionBy(key).orderBy("x0"))
    return d.select(key, "x0", F.coalesce(following, F.col("_end")).alias("x1"), "is_above")


def site_groups(obs: DataFrame, *, top_n: int = 6, others: str = "Others",
                station: str = "stn") -> DataFrame:
    """Add ``site_group``: one of the busiest stations, or the rest together."""
    top = obs.groupBy(station).agg(F.count("*").alias("_n")).orderBy(
        F.desc("_n"), station).limit(top_n).select(station, F.col(station).alias("_g"))
    return obs.join(F.broadcast(top), station, "left").select(  # at most top_n rows
        *obs.columns, F.coalesce("_g", F.lit(others)).alias("site_group"))


def observation_history(obs: DataFrame, *, permid: str | None = None, provid: str | None = None) -> DataFrame:
    """Observations of one object with elongation and V magnitude."""
    if (permid is None) == (provid is None):
        raise ValueError("give exactly one of permid and provid")
    d = obs.where(F.col("permid") == permid if permid is not None else F.col("provid") == provid)
    return history_columns(d)


def history_columns(obs: DataFrame) -> DataFrame:
    """The same columns for every object in the input."""
    d = obs.where(F.col("obstime").isNotNull() & F.col("ra").isNotNull() & F.col("dec").isNotNull())
    d = sky.with_sun(d, "obstime", "meeus")
    return d.select("obstime", "ra", "dec", "mag", "band", "stn",
                    sky.angular_separation("ra", "dec", "sun_ra", "sun_dec").alias("elong"),
                    photometry.to_v("mag", "band", "as_blank").alias("v_mag"),
                    photometry.normal_band("band").alias("band_norm"))


def carry_forward(df: DataFrame, *, keys: list[str], position: str, value: str) -> DataFrame:
    """Fill a value down to the following rows of its key."""
    from .ordered import position_bucket
    return with_carried(df, keys=keys, order=[position], bucket=position_bucket(position),
                        value=value, name=f"{value}_filled")
