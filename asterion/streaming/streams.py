"""Streams of observations, catalogues kept current, and what one batch does to them.

Stream checkpoints and maintained tables live in the shared folder
(``spark.checkpoint.dir``). A maintained table is a series of versions numbered by
batch id: a batch that is retried after a failure reads the version before it and
replaces its own, so nothing is applied twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter

from asterion import storage
from asterion.bucketed import BucketTable, Combine, replace_by_key
from asterion.functions import orbit
from asterion.functions.common import blank_to_null
from asterion.functions.timeconv import day_of
from asterion.operators.consensus import membership_upsert
from asterion.operators.discovery import discovery_tracklets, product_columns, stats_of, tracklet_name
from asterion.operators.filters import clean_site_name, select_neos
from asterion.operators.identity import PACKED, UNPACKED, earliest_discovery, neo_keys, observation_keys, with_numbering


def read_stream(spark: SparkSession, path: str, schema, *, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp; zone-free instants are UTC."""
    if dict(df.dtypes)[column] == "timestamp":
        return df
    return df.withColumn(column, F.to_timestamp(F.concat(F.col(column).cast("string"), F.lit("Z"))))


# -- discoveries -----------------------------------------------------------------------

def new_discoveries(stream: DataFrame, *, late: str = "2 days", since=None) -> DataFrame:
    """Discovery observations, each id once within the lateness allowed."""
    d = event_time(stream.where(F.col("disc") == "*"), "created_at")
    if since is not None:
        d = d.where(F.col("created_at") > F.lit(since).cast("timestamp"))
    return d.withWatermark("created_at", late).dropDuplicatesWithinWatermark(["obsid"])


def enrich(stream: DataFrame, orbits: DataFrame, ni: DataFrame, obscodes: DataFrame) -> DataFrame:
    """Add class, size, hazard, MOID and site to each event from static tables.

    An event is found by its number, else by its designation; one that is found by neither
    stays, without values. Events that lack an identifier get a key of their own
    for that lookup, one that nothing matches, so they do not pile up in one task.
    """
    facts = F.struct(
        orbit.orbit_long_name(F.coalesce("orbit_type_int", orbit.classify_orbit("q", "e", "i"))).alias("orbit_class"),
        "h", "earth_moid", orbit.is_pha_by_moid("earth_moid", "h").alias("pha"))
    named = orbits.select(PACKED, F.col(UNPACKED).alias("_name"), facts.alias("_by_name"))
    numbered = named.join(ni.select(PACKED, F.col("permid").alias("_number")), PACKED).select(
        "_number", F.col("_by_name").alias("_by_number"))

    def keyed(c):
        return F.coalesce(blank_to_null(c), F.concat(F.lit("no identifier "), F.coalesce("obsid", F.lit(""))))

    d = stream.withColumns({"_number": keyed("permid"), "_name": keyed("provid")})
    d = d.join(numbered, "_number", "left").join(named.drop(PACKED), "_name", "left")
    d = d.withColumn("_facts", F.coalesce("_by_number", "_by_name"))
    site = obscodes.select(F.col("obscode").alias("stn"), clean_site_name("name").alias("site_name"),
                           "longitude", "observations_type")
    return d.select(*stream.columns, "_facts.*").join(site, "stn", "left")


def touched_objects(batch: DataFrame, orbits: DataFrame, ni: DataFrame) -> DataFrame:
    """Orbit rows of the objects a batch of observations mentions.

    An observation may complete the tracklet of an object that was known before,
    so every touched object is recomputed, not only new ones.
    """
    return objects_with(observation_keys(batch).distinct(), orbits, ni)


def objects_with(keys: DataFrame, orbits: DataFrame, ni: DataFrame) -> DataFrame:
    """Orbit rows of the objects named by distinct (kind, key) rows."""
    number = ni.select(PACKED, F.col("permid").alias("key"), F.lit("permid").alias("kind"))
    name = orbits.select(PACKED, F.col(UNPACKED).alias("key"), F.lit("provid").alias("kind"))
    hit = number.unionByName(name).join(keys, ["kind", "key"], "left_semi").select(PACKED).distinct()
    return orbits.join(hit, PACKED, "left_semi")


class KnownSet:
    """The discovery product kept up to date batch by batch, without a look at the whole archive.

    Three bucketed tables: discovery observations by identifier, observations by tracklet, and the
    product by object. A batch appends to the first two, finds the objects it can
    change, and recomputes those from the buckets of their identifiers and of their
    discovery tracklets. An object changes when a row of the batch carries one of its
    identifiers, or belongs to the tracklet of one of its discovery observations.
    """

    COLUMNS = ["obsid", "permid", "provid", "trkid", "stn", "obstime", "ra", "dec", "mag", "band", "disc"]

    def __init__(self, spark: SparkSession, path: str, orbits: DataFrame, ni: DataFrame, obscodes: DataFrame,
                 *, rule: str = "wide", hours: float = 12.0, buckets: int = 64, newest: int = 2):
        self.catalog, self.obscodes, self.rule, self.hours, self.newest = (orbits, ni), obscodes, rule, hours, newest
        self.path = path
        self.by_name = BucketTable(spark, f"{path}/by_name", ["kind", "key"], buckets=buckets)
        self.by_track = BucketTable(spark, f"{path}/by_track", ["_trk"], buckets=buckets)
        self.product = BucketTable(spark, f"{path}/product", [PACKED], buckets=buckets)

    def apply(self, batch: DataFrame, version: int) -> None:
        orbits, ni = self.catalog
        rows = self._settled(batch.select(*self.COLUMNS).withColumn("_trk", tracklet_name()), "batch")
        discovered = rows.where(F.col("disc") == "*")
        self.by_name.append(observation_keys(discovered, "obstime", "obsid", "stn", "trkid"), version)
        self.by_track.append(rows, version)
        keys, mates = observation_keys(rows), self.by_track.lookup(rows, before=version + 1)
        if mates is not None:
            keys = keys.union(observation_keys(mates.where(F.col("disc") == "*")))
        touched = objects_with(keys.distinct(), orbits, ni)
        neos = self._settled(with_numbering(select_neos(touched, rule=self.rule), ni), "neos")
        mine = self.by_name.lookup(neo_keys(neos), before=version + 1)
        if mine is None:
            fresh = None
        else:
            named = lambda kind: F.when(F.col("kind") == kind, F.col("key")).alias(kind)
            seen = mine.select(named("permid"), named("provid"), "obstime", "obsid", "stn", "trkid", F.lit("*").alias("disc"))
            disc = self._settled(earliest_discovery(neos, seen, carry=["permid"]), "disc")
            members = self.by_track.lookup(disc.select(tracklet_name().alias("_trk")), before=version + 1)
            fresh = None if members is None else product_columns(
                stats_of(disc, members, hours=self.hours, carry=["permid"]), self.obscodes)
        if fresh is not None:
            self.product.merge(fresh, replace_by_key([PACKED]), version)
        for table in (self.by_name, self.by_track, self.product):
            table.retain(self.newest)

    def _settled(self, df: DataFrame, name: str) -> DataFrame:
        """Written once for the several steps of a batch; the next batch writes over it."""
        path = f"{self.path}/now/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)

    def start(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)


def known_set_increment(known: DataFrame | None, batch: DataFrame, orbits: DataFrame, ni: DataFrame,
                        obs: DataFrame, obscodes: DataFrame) -> DataFrame:
    """The discovery product after a batch: touched objects recomputed, others kept."""
    fresh = discovery_tracklets(touched_objects(batch, orbits, ni), ni, obs, obscodes)
    if known is None:
        return fresh
    kept = known.join(fresh.select(PACKED), PACKED, "left_anti")
    return kept.unionByName(fresh).select(*known.columns)


def new_only(known: DataFrame, fresh: DataFrame, *, key: str = PACKED) -> DataFrame:
    """Rows announced for the first time: the append-only notices."""
    return fresh.join(known.select(key), key, "left_anti")


# -- maintained tables ---------------------------------------------------------------------

def maintain_buckets(stream: DataFrame, table: BucketTable, combine: Combine, *, checkpoint: str,
                     updates: Callable[[DataFrame], DataFrame] = lambda batch: batch, newest: int = 2) -> DataStreamWriter:
    """Fold every batch into a bucketed table: ``combine(rows of the touched buckets, updates(batch))``.

    A batch reads and writes the buckets that its updates touch and no others.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        table.merge(updates(batch), combine, batch_id)
        table.retain(newest)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def maintain(stream: DataFrame, path: str, step: Callable[[DataFrame | None, DataFrame], DataFrame],
             *, checkpoint: str) -> DataStreamWriter:
    """Fold every batch into a versioned table: ``step(previous, batch) -> next``.

    The whole table is written for every batch; for tables that are small or have no key.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [p for v, p in storage.versions(spark, path) if v < batch_id]
        previous = spark.read.parquet(earlier[-1]) if earlier else None
        storage.write_version(step(previous, batch), path, version=batch_id)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def latest_by_key(previous: DataFrame | None, batch: DataFrame, *, key: list[str], order: list[str]) -> DataFrame:
    """Compacted topic: one row per key, the newest by ``order``, whichever batch brought it.

    The last column of ``order`` should tell any two rows of a key apart.
    """
    both = batch if previous is None else previous.unionByName(batch)
    rest = [c for c in both.columns if c not in key]
    return both.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(
        *key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def members_step(source: str, now) -> Callable:
    """Maintain the member table: upsert each batch of one source's canonical rows.

    As a combination over buckets of ``primary_desig`` it touches the objects of the batch only.
    """
    def step(previous: DataFrame | None, batch: DataFrame) -> DataFrame:
        if previous is None:
            t = F.lit(now).cast("timestamp_ntz")
            previous = batch.limit(0).select(
                F.lit(source).alias("source"), *batch.columns,
                t.alias("first_seen"), t.alias("last_seen"), t.alias("last_refreshed"))
        return membership_upsert(previous, batch, source=source, now=now)
    return step


# -- windows ----------------------------------------------------------------------------------

def detection_daily(stream: DataFrame, *, late: str = "2 days") -> DataFrame:
    """Per (designation, station, UT day): observations, tracklets, any discovery.

    Distinct tracklets are counted by sketch, the form a stream can keep up to date.
    """
    d = event_time(stream.where(F.col("provid").isNotNull()), "obstime").withWatermark("obstime", late)
    return d.groupBy(F.window("obstime", "1 day"), "provid", "stn").agg(
        F.count("*").alias("n_obs"), F.approx_count_distinct("trkid").alias("n_tracklets"),
        F.bool_or(F.coalesce(F.col("disc") == "*", F.lit(False))).alias("disc_flag")).select(
        "provid", "stn", F.col("window.start").cast("date").alias("obs_date"), "n_obs",
        "n_tracklets", "disc_flag")


def daily_tracklets(batch: DataFrame) -> DataFrame:
    """Per (designation, station, day, tracklet): observations, any discovery."""
    return batch.where(F.col("provid").isNotNull()).groupBy(
        "provid", "stn", day_of("obstime").alias("obs_date"), "trkid").agg(
        F.count("*").alias("n_obs"), F.bool_or(F.coalesce(F.col("disc") == "*", F.lit(False))).alias("disc_flag"))


def add_daily_tracklets(previous: DataFrame | None, day: DataFrame) -> DataFrame:
    both = day if previous is None else previous.unionByName(day)
    return both.groupBy("provid", "stn", "obs_date", "trkid").agg(
        F.sum("n_obs").alias("n_obs"), F.bool_or("disc_flag").alias("disc_flag"))


def detection_daily_step(previous: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The same kept exactly as a maintained table, one row per tracklet underneath."""
    return add_daily_tracklets(previous, daily_tracklets(batch))


def arc_pieces(batch: DataFrame, *, key: str = "provid", days: float = 60.0) -> DataFrame:
    """(key, start, end, n) per object and stretch of ``days``.

    Two observations of one stretch are less than the gap apart, so a piece lies inside one arc,
    and an object has as many pieces as the calendar has stretches, not as
    many as it has observations.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("obstime"))
    stretch = F.floor(micros / F.lit(float(gap_micros(days))))
    return batch.where(F.col(key).isNotNull() & F.col("obstime").isNotNull()).groupBy(F.col(key).alias("key"), stretch.alias("_s")).agg(
        F.min("obstime").alias("start"), F.max("obstime").alias("end"), F.count("*").alias("n")).drop("_s")


def gap_micros(days: float) -> int:
    return round(days * 86_400_000_000)


def join_arcs(*, days: float = 60.0) -> Combine:
    """Arcs from earlier arcs and new pieces: those at most ``days`` apart become one.

    Rows may come late and in any order: a piece can lengthen an arc, or close the gap between two.
    """
    def combine(previous: DataFrame | None, pieces: DataFrame) -> DataFrame:
        both = pieces if previous is None else previous.unionByName(pieces)
        w = Window.partitionBy("key").orderBy("start", "end")
        so_far = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
        apart = F.timestamp_diff("MICROSECOND", so_far, F.col("start")) > gap_micros(days)
        d = both.withColumn("_new", F.when(so_far.isNull() | apart, 1).otherwise(0))
        d = d.withColumn("_arc", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return d.groupBy("key", "_arc").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("_arc")
    return combine


def with_open_flag(arcs: DataFrame, *, days: float = 60.0, now=None) -> DataFrame:
    """Add ``is_open``: an observation at ``now`` (by default the last one of any arc) would still lengthen the arc."""
    t = arcs.agg(F.max("end")).scalar() if now is None else F.lit(now).cast("timestamp_ntz")
    return arcs.withColumn("is_open", F.timestamp_diff("MICROSECOND", F.col("end"), t) <= gap_micros(days))


def arc_sessions(stream: DataFrame, *, key: Column | str = "provid", gap: str = "60 days",
                 late: str = "2 days") -> DataFrame:
    """Arcs of each object as session windows, given out once the watermark has closed them.

    For arcs that are complete at any time, open ones included, keep a table with :func:`join_arcs`.
    """
    d = event_time(stream, "obstime").withWatermark("obstime", late)
    k = F.col(key) if isinstance(key, str) else key
    return d.where(k.isNotNull()).groupBy(F.session_window("obstime", gap), k.alias("key")).agg(
        F.count("*").alias("n"), F.max("obstime").alias("end")).select(
        "key", F.col("session_window.start").alias("start"), "end", "n")


# -- ledger and list ----------------------------------------------------------------------------

def run_row(spark: SparkSession, *, source: str, started_at, status: str, finished_at=None,
            n_rows: int | None = None, n_unresolved: int | None = None, error: str | None = None) -> DataFrame:
    """One row of the refresh ledger; start and finish are appended as two rows."""
    from asterion.sources.schemas import SCHEMAS
    raw = spark.createDataFrame(
        [(source, str(started_at), None if finished_at is None else str(finished_at), status, n_rows,
          n_unresolved, error)],
        "source string, started_at string, finished_at string, status string, n_rows int, n_unresolved int, error_text string")
    return raw.select(*[F.col(p.split()[0]).cast(p.split()[1]) for p in SCHEMAS["source_runs"].split(", ")])


def append_run(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def ledger(runs: DataFrame) -> DataFrame:
    """The current state of every run: its terminal row if there is one, the last by time and then by content."""
    cols = [c for c in runs.columns if c not in ("source", "started_at")]
    done = F.struct(F.col("finished_at").isNotNull(), F.coalesce("finished_at", "started_at"), *sorted(cols))
    return runs.groupBy("source", "started_at").agg(F.max_by(F.struct(*cols), done).alias("_r")).select(
        "source", "started_at", *[F.col(f"_r.{c}").alias(c) for c in cols])


def list_augment(current: DataFrame, announced: DataFrame, *, key: str = "designation") -> DataFrame:
    """The object list with announced objects it lacks, marked until confirmed."""
    extra = announced.select(key).distinct().join(current.select(key), key, "left_anti")
    return current.unionByName(extra.withColumn("source", F.lit("circular")), allowMissingColumns=True)
