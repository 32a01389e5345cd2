"""Discovery tracklets and the products built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from asterion.functions import orbit, photometry
from asterion.functions.common import blank_to_null, count_if
from asterion.functions.sky import great_circle_deg, position_angle_deg
from asterion.functions.timeconv import epoch_seconds, mjd, seconds_between

from .filters import clean_site_name, select_neos
from .identity import PACKED, earliest_discovery, with_numbering

SITE_COLUMNS = ["name", "longitude", "rhocosphi", "rhosinphi", "observations_type"]


def earliest_per_key(df: DataFrame, *, key: str, order: str, tie: str) -> DataFrame:
    """One row per key: the earliest, ties to the lower ``tie``.

    A minimum over structs, so each map task already reduces a key to one row.
    """
    rest = [c for c in df.columns if c not in (key, order, tie)]
    row = F.struct(order, tie, *rest)
    return df.groupBy(key).agg(F.min_by(row, F.struct(order, tie)).alias("_r")).select(
        key, *[F.col(f"_r.{c}").alias(c) for c in df.columns if c != key])


PAYLOAD = ["ra", "dec", "mag", "band"]
HEAD = ["unpacked_desig", "packed_desig"]


def tracklet_name() -> Column:
    """The tracklet's label; an observation without one is a tracklet of its own."""
    return F.coalesce(blank_to_null("trkid"), F.concat(F.lit("obsid:"), F.col("obsid")))


def tracklet_members(disc: DataFrame, obs: DataFrame, *, hours: float = 12.0,
                     carry: list[str] = ()) -> DataFrame:
    """Observations of each discovery's tracklet: the same trkid within +-hours.

    An observation without a trkid is a tracklet of its own, keyed by its obsid, so
    a discovery without one stands alone and no second branch is needed. The join
    key is (trkid, time slot of that width) with the discovery offered to three
    slots: a trkid reused over years neither meets itself nor piles up in one
    partition.
    """
    width = int(hours * 3600)

    def slot(t):
        return F.floor(epoch_seconds(t) / F.lit(width)).cast("bigint")

    own = tracklet_name()
    d = disc.select(*HEAD, *carry, own.alias("_trk"), F.col("obstime").alias("_t0"),
                    F.explode(F.sequence(slot("obstime") - 1, slot("obstime") + 1)).alias("_slot"))
    o = obs.select("obsid", "obstime", *PAYLOAD, own.alias("_trk"), slot("obstime").alias("_slot"))
    return d.join(o, ["_trk", "_slot"]).where(
        F.abs(seconds_between("_t0", "obstime")) <= F.lit(width)).select(
        *HEAD, *carry, "obsid", "obstime", *PAYLOAD)


def discovery_tracklet_stats(members: DataFrame, *, carry: list[str] = ()) -> DataFrame:
    """Mean time and place, median V, count, span and end points of each tracklet.

    Two aggregation steps: first per (object, V magnitude), then per object. The
    median only ever sees distinct magnitudes with their counts, so an object with
    very many rows does not gather in one task. ``carry`` columns depend on the
    object and pass through.
    """
    keys = [*HEAD, *carry]
    at = F.struct("obstime", "obsid")
    spot = F.struct("obstime", "obsid", "ra", "dec")
    v = F.when(F.col("mag").isNotNull(), photometry.to_v("mag", "band"))
    part = members.withColumn("_v", v).groupBy(*keys, "_v").agg(
        F.count("*").alias("_n"), F.sum(mjd("obstime")).alias("_mjd"),
        F.sum("ra").alias("_ra"), F.count("ra").alias("_nra"),
        F.sum("dec").alias("_dec"), F.count("dec").alias("_ndec"),
        F.min_by(spot, at).alias("_first"), F.max_by(spot, at).alias("_last"))
    n = F.sum("_n")
    d = part.groupBy(*keys).agg(
        (F.sum("_mjd") / n).alias("avg_mjd"),
        (F.sum("_ra") / F.sum("_nra")).alias("avg_ra_deg"),
        (F.sum("_dec") / F.sum("_ndec")).alias("avg_dec_deg"),
        F.percentile("_v", F.lit(0.5), F.col("_n")).alias("median_v_mag"),
        n.alias("nobs"), F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    span = seconds_between("_first.obstime", "_last.obstime").cast("double")
    return d.select(
        *keys, "avg_mjd", "avg_ra_deg", "avg_dec_deg", "median_v_mag", "nobs",
        (span / 3600.0).alias("span_hours"), (span / 86400.0).alias("span_days"),
        F.col("_first.ra").alias("first_ra"), F.col("_first.dec").alias("first_dec"),
        F.col("_last.ra").alias("last_ra"), F.col("_last.dec").alias("last_dec"))


def motion_columns() -> dict[str, Column]:
    """Rate and direction of motion; NULL for a tracklet without duration."""
    ends = ("first_ra", "first_dec", "last_ra", "last_dec")
    moving = F.col("span_days") > 0
    return {
        "rate_deg_per_day": F.when(moving, great_circle_deg(*ends) / F.col("span_days")),
        "position_angle_deg": F.when(moving, position_angle_deg(*ends)),
    }


def with_site(df: DataFrame, obscodes: DataFrame, *, station: str = "stn") -> DataFrame:
    """Add site name, coordinates, latitude and type of a station code."""
    from asterion.functions.sky import site_latitude
    site = obscodes.select(
        F.col("obscode").alias("_code"), clean_site_name("name").alias("site_name"),
        "longitude", "rhocosphi", "rhosinphi", "observations_type")
    return df.join(site, F.col(station) == F.col("_code"), "left").drop("_code").withColumn(
        "latitude", site_latitude("rhosinphi", "rhocosphi"))


def discoveries_with_stats(orbits: DataFrame, ni: DataFrame, obs: DataFrame, *, rule: str,
                           hours: float, carry: list[str]) -> DataFrame:
    """One row per discovered object: stn, disc_obstime, carried columns of the
    object, tracklet numbers. One straight line of steps: nothing is joined back."""
    neos = with_numbering(select_neos(orbits, rule=rule), ni)
    return stats_of(earliest_discovery(neos, obs, carry=carry), obs, hours=hours, carry=carry)


def stats_of(disc: DataFrame, obs: DataFrame, *, hours: float, carry: list[str]) -> DataFrame:
    """Tracklet numbers of given discoveries, with their station and instant."""
    keep = ["stn", "disc_obstime", *carry]
    disc = disc.withColumn("disc_obstime", F.col("obstime"))
    return discovery_tracklet_stats(
        tracklet_members(disc, obs, hours=hours, carry=keep), carry=keep)


def discovery_tracklets(orbits: DataFrame, ni: DataFrame, obs: DataFrame, obscodes: DataFrame, *,
                        rule: str = "wide", hours: float = 12.0, with_time: bool = False) -> DataFrame:
    """The 12-column discovery product, one row per near-Earth object; ``with_time``
    adds the instant of discovery."""
    d = discoveries_with_stats(orbits, ni, obs, rule=rule, hours=hours, carry=["permid"])
    return product_columns(d, obscodes, with_time=with_time)


def product_columns(d: DataFrame, obscodes: DataFrame, *, with_time: bool = False) -> DataFrame:
    """The product's columns from discoveries with their tracklet numbers."""
    name = obscodes.select(F.col("obscode").alias("stn"),
                           clean_site_name("name").alias("discovery_site_name"))
    motion = motion_columns()
    return d.join(name, "stn", "left").select(
        F.coalesce("permid", "unpacked_desig").alias("primary_designation"),
        F.col("packed_desig").alias(PACKED),
        F.round("avg_mjd", 6).alias("avg_mjd_discovery_tracklet"),
        F.round("avg_ra_deg", 5).alias("avg_ra_deg"),
        F.round("avg_dec_deg", 5).alias("avg_dec_deg"),
        F.round("median_v_mag", 2).alias("median_v_magnitude"),
        "nobs", F.round("span_hours", 4).alias("span_hours"),
        F.round(motion["rate_deg_per_day"], 4).alias("rate_deg_per_day"),
        F.round(motion["position_angle_deg"], 2).alias("position_angle_deg"),
        F.col("stn").alias("discovery_site_code"), "discovery_site_name",
        *(["disc_obstime"] if with_time else []))


def load_discoveries(orbits: DataFrame, ni: DataFrame, obs: DataFrame, obscodes: DataFrame | None = None,
                     *, rule: str = "iau", hours: float = 12.0) -> DataFrame:
    """Discovery circumstances with elements and tracklet statistics; with
    ``obscodes`` also the coordinates of the site."""
    elements = ["h", "orbit_type_int", "q", "e", "i"]
    d = discoveries_with_stats(orbits, ni, obs, rule=rule, hours=hours, carry=elements)
    site = []
    if obscodes is not None:
        d = with_site(d, obscodes)
        site = [F.col("longitude").alias("stn_longitude"), F.col("rhocosphi").alias("stn_rhocosphi"),
                F.col("rhosinphi").alias("stn_rhosinphi"), F.col("observations_type").alias("stn_type")]
    t = F.col("disc_obstime")
    return d.select(
        F.col("unpacked_desig").alias("designation"),
        F.year(t).alias("disc_year"), F.month(t).alias("disc_month"),
        t.cast("date").alias("disc_date"), t, F.col("stn").alias("station_code"), *elements,
        "avg_ra_deg", "avg_dec_deg", "median_v_mag", F.col("nobs").alias("tracklet_nobs"), *site)


def designation_order(df: DataFrame, *, key: str = "primary_designation") -> DataFrame:
    """Numbered objects by number, then the others by name."""
    numbered = F.col(key).rlike("^[0-9]+$")
    return df.orderBy(numbered.desc(), F.when(numbered, F.lpad(key, 10, F.lit("0")))
                      .otherwise(F.col(key)))


def yearly_breakdown(orbits: DataFrame, ni: DataFrame, obs: DataFrame) -> DataFrame:
    """Near-Earth discoveries per station and year, by size and class."""
    neos = with_numbering(select_neos(orbits, rule="iau"), ni)
    d = earliest_discovery(neos, obs, carry=["h", "q", "e"])
    a, big_q = orbit.semi_major_axis("q", "e"), orbit.aphelion("q", "e")
    d = d.withColumns({"_a": a, "_bq": big_q})
    a, big_q, q, h = F.col("_a"), F.col("_bq"), F.col("q"), F.col("h")
    return d.groupBy("stn", F.year("obstime").alias("disc_year")).agg(
        F.count("*").alias("neos"),
        count_if(h < 17.75).alias("neos_1km"), count_if(h <= 22).alias("neos_h22"),
        count_if((a < 1) & (big_q < 0.983)).alias("n_atira"),
        count_if((a < 1) & (big_q >= 0.983)).alias("n_aten"),
        count_if((a >= 1) & (q < 1.017)).alias("n_apollo"),
        count_if((a >= 1) & (q >= 1.017)).alias("n_amor"),
        count_if(a.isNull() | (F.col("e") >= 1)).alias("n_unclass"))


def discovery_circumstances(tracklets: DataFrame, times: DataFrame | None, obscodes: DataFrame,
                            eclipses: DataFrame) -> DataFrame:
    """Add the Sun, Moon and eclipse situation at discovery to the product.

    ``times`` holds (primary_designation, disc_obstime); it may be None when the
    product carries disc_obstime itself.
    """
    from asterion.functions import sky
    from .skytime import eclipse_overlap
    d = tracklets if times is None else tracklets.join(
        times.select("primary_designation", "disc_obstime"), "primary_designation", "left")
    d = with_site(d, obscodes, station="discovery_site_code")
    d = sky.with_moon(sky.with_sun(d, "disc_obstime"), "disc_obstime")
    site = ("disc_obstime", "longitude", "latitude")
    d = d.withColumns({
        "_sat": F.coalesce(F.col("observations_type") == "satellite", F.lit(False)),
        "_alt": sky.altitude(*site, "sun_ra", "sun_dec"),
        "_moon": sky.altitude(*site, "moon_ra", "moon_dec"),
        "lunar_elong_deg": F.round(sky.angular_separation(
            "avg_ra_deg", "avg_dec_deg", "moon_ra", "moon_dec"), 1)})
    timed = F.col("disc_obstime").isNotNull()
    d = d.withColumns({
        "sun_alt_deg": F.round("_alt", 2),
        "twilight_class": F.when(timed, sky.twilight_class("_alt", F.col("_sat"))).otherwise(F.lit(""))})
    d = eclipse_overlap(d, eclipses, time="disc_obstime", moon_alt="_moon", satellite="_sat",
                        key="primary_designation")
    return d.select(*tracklets.columns, "sun_alt_deg", "twilight_class", "lunar_elong_deg",
                    "eclipse_class", "eclipse_date")


def expanded_discoveries(orbits: DataFrame, ni: DataFrame, obs: DataFrame, obscodes: DataFrame,
                         pha_set: DataFrame | None = None) -> DataFrame:
    """The discovery product with the fields a notice needs without another join."""
    base = discovery_tracklets(orbits, ni, obs, obscodes)
    extra = with_numbering(orbits, ni).withColumn("iau_name", F.lit(None).cast("string")) \
        if "iau_name" not in ni.columns else orbits.join(
            ni.select(PACKED, F.col("permid"), "iau_name"), PACKED, "left")
    extra = extra.select(
        PACKED, F.col("permid").try_cast("int").alias("permanent_number"),
        F.col("iau_name").alias("name"), F.col("h"),
        orbit.orbit_long_name(F.coalesce("orbit_type_int", orbit.classify_orbit("q", "e", "i")))
        .alias("orbit_class"), "earth_moid", orbit.is_pha_by_moid("earth_moid", "h").alias("pha"))
    site = obscodes.select(F.col("obscode").alias("discovery_site_code"),
                           F.col("longitude").alias("stn_longitude"),
                           F.col("rhocosphi").alias("stn_rhocosphi"),
                           F.col("rhosinphi").alias("stn_rhosinphi"),
                           F.col("observations_type").alias("stn_type"))
    return base.join(extra, PACKED, "left").join(site, "discovery_site_code", "left")


def sky_distribution(tracklets: DataFrame, *, mag_bin: float = 0.5, pa_bin: float = 15.0,
                     cell: float = 10.0) -> DataFrame:
    """Discovery counts by V bin, motion sector and sky cell, as (axis, bin_lo, n).

    Sky cells are numbered by declination band, then right ascension.
    """
    def floor_bin(c, width):
        return F.floor(F.col(c) / F.lit(width)) * F.lit(width)

    d = tracklets.select(F.explode(F.array(
        F.struct(F.lit("v_mag").alias("axis"),
                 floor_bin("median_v_magnitude", mag_bin).cast("double").alias("bin_lo"),
                 F.lit(None).cast("double").alias("bin_lo_dec")),
        F.struct(F.lit("position_angle").alias("axis"),
                 floor_bin("position_angle_deg", pa_bin).cast("double").alias("bin_lo"),
                 F.lit(None).cast("double").alias("bin_lo_dec")),
        F.struct(F.lit("sky").alias("axis"),
                 floor_bin("avg_ra_deg", cell).cast("double").alias("bin_lo"),
                 floor_bin("avg_dec_deg", cell).cast("double").alias("bin_lo_dec")))).alias("_b"))
    return d.select("_b.*").where(F.col("bin_lo").isNotNull()).groupBy(
        "axis", "bin_lo", "bin_lo_dec").agg(F.count("*").alias("n"))
