"""Cross tabulations by class, station, project and size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from asterion.functions import orbit, tables as T
from asterion.functions.common import count_if
from asterion.functions.timeconv import day_of, lunation, month_of

from .quantiles import with_percentiles
from .ranking import year_label_key
from .stations import project_of

COUNTS = ["pha", "nea_all", "nea_1km", "nea_h22", "aten", "aten_1km", "aten_h22", "apollo",
          "apollo_1km", "apollo_h22", "amor", "amor_1km", "amor_h22"]


def time_bin(time: str, unit: str) -> Column:
    """Label of a time bin: year, month, date or lunation."""
    if unit == "year":
        return F.year(time).cast("string")
    if unit == "month":
        return F.substring(month_of(time).cast("string"), 1, 7)
    if unit == "date":
        return day_of(time).cast("string")
    if unit == "lunation":
        return lunation(time).cast("string")
    raise ValueError(unit)


def class_label(grouping: str) -> Column:
    if grouping == "standard":
        return orbit.orbit_long_name("orbit_class_int")
    if grouping == "fine":
        return F.col("ext_name")
    if grouping == "coarse":
        return F.col("coarse_class")
    raise ValueError(grouping)


def class_names(grouping: str) -> list[str]:
    if grouping == "coarse":
        return list(T.COARSE_ORDER)
    table = T.ORBIT_CLASSES if grouping == "standard" else T.EXTENDED_CLASSES
    return [v[1] for v in table.values()] + [T.UNCLASSIFIED[1]]


def boxscore_cells(fact: DataFrame, catalog: DataFrame, *, metric: str | list[str] = "objects",
                   time: str = "year", grouping: str = "coarse", site: str | None = None) -> DataFrame:
    """(time_bin, class, value) with totals; of several metrics a column each, under its name.

    ``fact`` is per (provid, stn, obs_date) as :func:`summary.detection_daily` gives;
    a total of distinct objects counts an object once, not once per bin.
    """
    d = fact if site is None else fact.where(F.col("stn") == site)
    # One exchange by object, which calls on the same fact share; bins and totals are made of it in place.
    d = d.select("provid", "obs_date", "n_obs", "n_tracklets", "disc_flag").repartition("provid")
    label = F.coalesce(class_label(grouping), F.lit(T.UNCLASSIFIED[1]))
    # An object's classes with their numbers of catalogue rows, and without a class all of these.
    n = F.count("*").alias("n")
    classes = catalog.where(F.col("provid").isNotNull()).groupBy("provid", label.alias("class")).agg(n).groupBy("provid").agg(
        F.concat(F.collect_list(F.struct("class", "n")), F.array(F.struct(F.lit(None).cast("string").alias("class"), F.sum("n").alias("n")))).alias("classes"))
    alone = F.array(*[F.struct(F.lit(c).cast("string").alias("class"), F.lit(1).cast("bigint").alias("n")) for c in (T.UNCLASSIFIED[1], None)])
    value = {
        "observations": F.sum(F.col("n_obs") * F.col("c.n")), "tracklets": F.sum(F.col("n_tracklets") * F.col("c.n")),
        "objects": F.count("provid"), "discoveries": F.count(F.when(F.col("disc_flag"), F.col("provid"))),
    }
    wanted = [value[metric].alias("value")] if isinstance(metric, str) else [value[m].alias(m) for m in metric]

    def cells(bin: Column):
        # One row per object and bin, so that its objects are counted and not gathered.
        per = d.groupBy("provid", bin.alias("time_bin")).agg(
            F.sum("n_obs").alias("n_obs"), F.sum("n_tracklets").alias("n_tracklets"), F.bool_or("disc_flag").alias("disc_flag"))
        per = per.join(classes, "provid", "left").withColumn("c", F.explode(F.coalesce("classes", alone)))
        return per.groupBy("time_bin", F.col("c.class").alias("class")).agg(*wanted)

    both = cells(time_bin("obs_date", time)).unionByName(cells(F.lit("Total")))
    return both.withColumn("class", F.coalesce("class", F.lit("total")))


def boxscore(fact: DataFrame, catalog: DataFrame, *, metric: str = "objects", time: str = "year",
             grouping: str = "coarse", site: str | None = None) -> DataFrame:
    """The cells as a table: a row per time bin, a column per class, and totals."""
    cells = boxscore_cells(fact, catalog, metric=metric, time=time, grouping=grouping, site=site)
    names = [*class_names(grouping), "total"]
    return cells.groupBy("time_bin").pivot("class", names).agg(F.max("value")).select(
        "time_bin", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in names])


def boxscore_advanced(fact: DataFrame, catalog: DataFrame, *, time: str = "year",
                      grouping: str = "coarse") -> DataFrame:
    """Per bin and class: median H, H < 22, H < 17.75, and the share of detected
    objects that others discovered."""
    per = fact.groupBy(time_bin("obs_date", time).alias("time_bin"), "provid").agg(
        F.bool_or("disc_flag").alias("_disc"), F.sum("n_obs").alias("_nobs"))
    d = per.join(catalog.select("provid", "h", class_label(grouping).alias("class")), "provid", "left")
    d = d.withColumn("class", F.coalesce("class", F.lit(T.UNCLASSIFIED[1])))
    n = F.count("*")
    main = d.groupBy("time_bin", "class").agg(
        n.alias("n_objects"), count_if(F.col("h") < 22).alias("n_h22"), count_if(F.col("h") < 17.75).alias("n_1km"),
        F.round(F.sum("_nobs") / n, 4).alias("obs_per_object"),
        F.round(F.lit(1.0) - count_if("_disc") / n, 4).alias("others_share"))
    out = with_percentiles(main, d, keys=["time_bin", "class"], wanted={"median_h": ("h", 0.5)})
    return out.withColumn("median_h", F.round("median_h", 4))


def discovery_stats_by_site(discoveries: DataFrame) -> DataFrame:
    """Class by station with near-Earth and other subtotals and a grand total.

    Input: provid, station_code, class, neo. Each object counts once.
    """
    kind = F.when(F.col("neo"), F.lit("NEO")).otherwise(F.lit("Non-NEO"))
    d = discoveries.select(kind.alias("kind"), "class", "station_code")
    return d.cube("kind", "class", "station_code").agg(
        F.count("*").alias("n"), F.grouping_id("kind", "class", "station_code").alias("_g")).where(
        F.col("_g").isin(0, 1, 2, 3, 6, 7)).select(
        F.when(F.col("_g") >= 6, F.lit("TOTAL")).otherwise(F.col("kind")).alias("kind"),
        F.when(F.col("_g").isin(2, 3, 6, 7), F.lit("subtotal")).otherwise(F.col("class")).alias("class"),
        F.when(F.col("_g").isin(1, 3, 7), F.lit("ALL")).otherwise(F.col("station_code"))
        .alias("station_code"), "n")


def discovery_subsets_by_site(discoveries: DataFrame) -> DataFrame:
    """Overlapping near-Earth subsets per station: hazardous, 1 km, 140 m."""
    d = discoveries.where("neo")
    return d.rollup("station_code").agg(
        F.grouping("station_code").alias("_g"), count_if("pha").alias("phas"),
        count_if(F.col("h") < 17.75).alias("km1"), count_if(F.col("h") <= 22).alias("m140")).select(
        F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col("station_code")).alias("station_code"),
        "phas", "km1", "m140")


def station_totals(yearly: DataFrame, *, counts: list[str] = COUNTS) -> DataFrame:
    """Totals per station of year-block rows, with its first and last active year."""
    active = F.when(F.col("nea_all") > 0, F.col("year_label"))
    key = F.when(F.col("nea_all") > 0, year_label_key("year_label"))
    return yearly.groupBy("code").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.min_by(active, key).alias("first_year"), F.max_by(active, key).alias("last_year"))


def project_rollup(yearly: DataFrame, *, counts: list[str] = COUNTS, window: int = 3,
                   floor: int = 10, project=project_of) -> DataFrame:
    """Stations rolled up to projects.

    Unmapped stations are Independent Surveys with more than ``floor`` discoveries
    in one of the last ``window`` years, Historical when last active in 1999 or
    before, and Others otherwise.
    """
    totals = station_totals(yearly, counts=counts)
    numbered = yearly.where(F.col("nea_all") > 0).withColumn("_y", F.col("year_label").try_cast("int"))
    latest = numbered.agg(F.max("_y")).scalar()
    recent = numbered.where((F.col("_y") > latest - window) & (F.col("nea_all") > floor)).select(
        "code").distinct().withColumn("_indep", F.lit(True))
    d = totals.join(recent, "code", "left")
    old = F.col("last_year").startswith("<") | (F.col("last_year").try_cast("int") <= 1999)
    mapped = project("code")
    label = (F.when(mapped != "Others", mapped)
             .when(F.col("_indep"), F.lit("Independent Surveys"))
             .when(old, F.lit("Historical")).otherwise(F.lit("Others")))
    return d.groupBy(label.alias("project")).agg(
        *[F.sum(c).alias(c) for c in counts],
        F.min_by("first_year", year_label_key("first_year")).alias("first_year"),
        F.max_by("last_year", year_label_key("last_year")).alias("last_year"),
        F.array_join(F.array_sort(F.collect_set("code")), ",").alias("stations"))


# Sort keys of the project table: column and direction, ties by total.
SORTS = {"total": ("nea_all", False), "pha": ("pha", False), "1km": ("nea_1km", False),
         "140m": ("nea_h22", False), "first": ("first_year", True), "last": ("last_year", True)}


def project_order(by: str) -> list[Column]:
    column, is_year = SORTS[by]
    if is_year:
        missing = F.lit("9999" if by == "first" else "0000")
        key = F.coalesce(year_label_key(column), missing)
    else:
        key = F.desc(column)
    return [key, F.desc("nea_all"), F.col("project")]


def sort_projects(df: DataFrame, by: str = "total") -> DataFrame:
    """Projects by one of the keys of ``SORTS``, ties by total and then by name."""
    return df.orderBy(*project_order(by))


def with_project_position(df: DataFrame, by: str = "total") -> DataFrame:
    """The place of each project, of which there are a few dozens."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*project_order(by))))


def year_change(yearly: DataFrame, *, label: str, year: int, day_of_year: int) -> DataFrame:
    """This year's count against last year's, projected to the whole year."""
    y = F.col("year_label").try_cast("int")
    d = yearly.groupBy(label).agg(
        F.coalesce(F.sum(F.when(y == year, F.col("nea_all"))), F.lit(0)).alias("n_cur"),
        F.coalesce(F.sum(F.when(y == year - 1, F.col("nea_all"))), F.lit(0)).alias("n_prev"))
    cur, prev = F.col("n_cur"), F.col("n_prev")
    ratio = (cur / F.lit(day_of_year / 365.0)) / F.nullif(prev, F.lit(0))
    return d.withColumn("change", F.when(cur + prev < 5, F.lit(""))
                        .when(prev == 0, F.when(cur > 0, F.lit("+")).otherwise(F.lit("")))
                        .when(ratio > 1.15, F.lit("+")).when(ratio < 0.85, F.lit("-"))
                        .otherwise(F.lit("")))


def count_indicator(listed, counted) -> Column:
    """How a count compares with a published one: '', '0', or up to three arrows."""
    y, d = F.col(listed), F.col(counted)
    diff, gap = d - y, F.abs(d - y)
    pct, ratio = gap / F.nullif(y, F.lit(0)), d / F.nullif(y, F.lit(0))
    return (F.when(d.isNull() | ((d == 0) & (y > 0)), F.lit("0"))
            .when(y == d, F.lit(""))
            .when(y == 0, F.when(diff >= 5, F.lit(">>>")).when(diff >= 3, F.lit(">>")).otherwise(F.lit(">")))
            .when(pct < 0.01, F.lit(""))
            .when(diff > 0, F.when((ratio > 1.25) & (gap >= 5), F.lit(">>>"))
                  .when((ratio > 1.05) & (gap >= 3), F.lit(">>")).otherwise(F.lit(">")))
            .otherwise(F.when((ratio < 0.75) & (gap >= 5), F.lit("<<<"))
                       .when((ratio < 0.95) & (gap >= 3), F.lit("<<")).otherwise(F.lit("<"))))


def count_comparison(listed: DataFrame, counted: DataFrame, *, key: str = "code") -> DataFrame:
    """Published against counted numbers per key; keys missing on one side stay."""
    d = listed.select(key, F.col("n").alias("n_listed")).join(
        counted.select(key, F.col("n").alias("n_counted")), key, "full")
    return d.withColumn("indicator", F.when(
        F.col("n_listed").isNotNull(), count_indicator("n_listed", "n_counted"))
        .otherwise(F.lit("missing")))


def population_model(spark: SparkSession) -> DataFrame:
    """(h2, n_cum): the fixed cumulative population model."""
    return spark.createDataFrame([(float(h), float(n)) for h, n in T.POPULATION_MODEL.items()],
                                 "h2 double, n_cum double")


def model_bins(model: DataFrame) -> DataFrame:
    """Bins between the model's steps: their number, h1, h2, cumulative and differential counts."""
    w = Window.partitionBy(F.lit(0)).orderBy("h2")  # a few dozen rows
    return model.select((F.row_number().over(w) - 1).alias("_i"), F.lag("h2").over(w).alias("h1"), "h2", "n_cum",
                        F.lag("n_cum").over(w).alias("n_before"))


def with_step(df: DataFrame, h: str, model: DataFrame) -> DataFrame:
    """Add ``_i``, how many steps of the model lie at or below H: the number of its bin. The steps are one short array."""
    d = df.withColumn("_steps", model.agg(F.array_sort(F.collect_list("h2"))).scalar())
    below = F.size(F.filter("_steps", lambda x: x <= F.col(h)))
    return d.withColumn("_i", F.when(F.col(h).isNotNull(), below)).drop("_steps")


def size_completeness(discovered: DataFrame, model: DataFrame, *, mode: str = "cumulative") -> DataFrame:
    """Discovered objects against the model, per bin.

    Cumulative completeness belongs to a bin's right edge, differential to its
    centre. Discovered H are counted per bin before anything is compared.
    """
    bins = model_bins(model).where(F.col("h1").isNotNull())
    h = discovered.select("h").where(F.col("h").isNotNull())
    below = h.where(F.col("h") < model.agg(F.min("h2")).scalar()).agg(F.count("*")).scalar()
    counts = with_step(h, "h", model).groupBy("_i").agg(F.count("*").alias("_n"))
    t = bins.join(counts, "_i", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    if mode == "cumulative":
        w = Window.partitionBy(F.lit(0)).orderBy("h1").rowsBetween(Window.unboundedPreceding, 0)
        found, expected, at = F.sum("_n").over(w) + below, F.col("n_cum"), F.col("h2")
    elif mode == "differential":
        found, expected = F.col("_n"), F.col("n_cum") - F.col("n_before")
        at = (F.col("h1") + F.col("h2")) / 2
    else:
        raise ValueError(mode)
    return t.select("h1", "h2", at.alias("h_plot"), found.cast("bigint").alias("discovered"),
                    expected.alias("model"),
                    F.round(F.lit(100.0) * found / expected, 4).alias("completeness"))


def model_at(points: DataFrame, model: DataFrame, *, h: str = "h") -> DataFrame:
    """The model's cumulative count at any H, linear between its steps."""
    b = model_bins(model).where(F.col("h1").isNotNull())
    x = F.col(h)
    return with_step(points, h, model).join(b, "_i", "left").select(
        *points.columns, F.round(F.col("n_before") + (x - F.col("h1")) / (F.col("h2") - F.col("h1"))
                                 * (F.col("n_cum") - F.col("n_before")), 4).alias("model_n"))
