"""Spherical geometry, Sun and Moon. Angles in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import tables as T
from .common import col, with_isolated
from .timeconv import days_since_j2000, julian_day


def mod360(x) -> Column:
    return F.pmod(x, F.lit(360.0))


def angular_separation(ra1, dec1, ra2, dec2) -> Column:
    """Arc between two directions, from the clipped cosine."""
    d1, d2 = F.radians(col(dec1)), F.radians(col(dec2))
    c = F.sin(d1) * F.sin(d2) + F.cos(d1) * F.cos(d2) * F.cos(F.radians(col(ra1) - col(ra2)))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))))


def great_circle_deg(ra1, dec1, ra2, dec2) -> Column:
    """Arc by the haversine, accurate for small arcs and across 0/360."""
    ra1, dec1, ra2, dec2 = col(ra1), col(dec1), col(ra2), col(dec2)
    half_dec = F.sin(F.radians(dec2 - dec1) / 2.0)
    half_ra = F.sin(F.radians(ra2 - ra1) / 2.0)
    hav = half_dec * half_dec + \
        F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * half_ra * half_ra
    return F.lit(2.0) * F.degrees(F.asin(F.sqrt(hav)))


def position_angle_deg(ra1, dec1, ra2, dec2) -> Column:
    """Bearing from the first to the second direction, 0 = N, 90 = E, in [0, 360)."""
    d1, d2 = F.radians(col(dec1)), F.radians(col(dec2))
    dra = F.radians(col(ra2) - col(ra1))
    east = F.sin(dra) * F.cos(d2)
    north = F.cos(d1) * F.sin(d2) - F.sin(d1) * F.cos(d2) * F.cos(dra)
    return mod360(F.degrees(F.atan2(east, north)))


def _sun_from_longitude(lon_deg, obliquity_deg):
    lon, eps = F.radians(lon_deg), F.radians(obliquity_deg)
    ra = mod360(F.degrees(F.atan2(F.cos(eps) * F.sin(lon), F.cos(lon))))
    dec = F.degrees(F.asin(F.sin(eps) * F.sin(lon)))
    return ra, dec


def sun_longitude(t, model: str = "low"):
    """(ecliptic longitude, obliquity) of the Sun in degrees.

    ``low``: two-term series on J2000 days, about 1 degree or better, used for
    twilight and elongation. ``meeus``: three-term series on the Julian day of the
    whole second, about 0.01 degree, used for observability.
    """
    if model == "low":
        c = days_since_j2000(t) / F.lit(36525.0)
        l0 = mod360(F.lit(280.466) + F.lit(36000.77) * c)
        m = F.radians(mod360(F.lit(357.529) + F.lit(35999.05) * c))
        lon = l0 + F.lit(1.915) * F.sin(m) + F.lit(0.020) * F.sin(m * 2.0)
        return lon, F.lit(23.439) - F.lit(0.013) * c
    if model == "meeus":
        c = (julian_day(t) - F.lit(2451545.0)) / F.lit(36525.0)
        l0 = mod360(F.lit(280.46646) + F.lit(36000.76983) * c + F.lit(0.0003032) * c * c)
        m = F.radians(mod360(F.lit(357.52911) + F.lit(35999.05029) * c - F.lit(0.0001537) * c * c))
        centre = ((F.lit(1.914602) - F.lit(0.004817) * c - F.lit(0.000014) * c * c) * F.sin(m)
                  + (F.lit(0.019993) - F.lit(0.000101) * c) * F.sin(m * 2.0)
                  + F.lit(0.000289) * F.sin(m * 3.0))
        return l0 + centre, F.lit(23.43929111) - F.lit(0.0130041667) * c
    raise ValueError(model)


def sun_ra_dec(t, model: str = "low"):
    """(RA, Dec) of the Sun; see :func:`sun_longitude` for the models."""
    return _sun_from_longitude(*sun_longitude(t, model))


def sun_ra_dec_daily(day, model: str = "histogram"):
    """(RA, Dec) of the Sun for a calendar day, in the two daily forms published.

    Both count centuries from 2000-01-01 without the half day.
    """
    c = F.datediff(col(day), F.lit("2000-01-01").cast("date")).cast("double") / F.lit(36525.0)
    if model == "histogram":
        m = F.radians(F.lit(357.529) + F.lit(35999.05) * c)
        lon = F.lit(280.466) + F.lit(36000.77) * c + F.lit(1.915) * F.sin(m)
        return _sun_from_longitude(lon, F.lit(23.439) - F.lit(0.013) * c)
    if model == "stats":
        m = F.radians(F.lit(357.52911) + F.lit(35999.05029) * c)
        lon = (F.lit(280.46646) + F.lit(36000.76983) * c
               + (F.lit(1.914602) - F.lit(0.004817) * c) * F.sin(m)
               + F.lit(0.019993) * F.sin(m * 2.0))
        return _sun_from_longitude(lon, F.lit(23.439291) - F.lit(0.0130042) * c)
    raise ValueError(model)


def solar_elongation(t, ra, dec, model: str = "low") -> Column:
    sra, sdec = sun_ra_dec(t, model)
    return angular_separation(ra, dec, sra, sdec)


def signed_elongation(ra, dec, sun_ra, sun_dec) -> Column:
    """Elongation with a sign: positive east of the Sun, negative west."""
    east = mod360(col(ra) - col(sun_ra)) <= 180
    return F.when(east, F.lit(1.0)).otherwise(F.lit(-1.0)) * \
        angular_separation(ra, dec, sun_ra, sun_dec)


def moon_arguments(c) -> dict[str, Column]:
    """Fundamental arguments at c Julian centuries: mean longitude in degrees, the
    four angles D, M, M', F in radians, and the obliquity in radians."""
    c = col(c)
    c2 = c * c

    def angle(a0, a1, a2):
        return mod360(F.lit(a0) + F.lit(a1) * c + F.lit(a2) * c2)

    return {
        "lp": angle(218.3164477, 481267.88123421, -0.0015786),
        "d": F.radians(angle(297.8501921, 445267.1114034, -0.0018819)),
        "m": F.radians(angle(357.5291092, 35999.0502909, -0.0001536)),
        "mp": F.radians(angle(134.9633964, 477198.8675055, 0.0087414)),
        "f": F.radians(angle(93.2720950, 483202.0175233, -0.0036539)),
        "eps": F.radians(F.lit(23.439291) - F.lit(0.0130042) * c),
    }


def moon_ecliptic(a: dict[str, Column]):
    """(longitude, latitude) in radians from the fundamental arguments."""
    def series(terms):
        total = F.lit(0.0)
        for kd, km, kmp, kf, amp in terms:
            angle = F.lit(0.0)
            for k, x in ((kd, a["d"]), (km, a["m"]), (kmp, a["mp"]), (kf, a["f"])):
                if k:
                    angle = angle + x * float(k)
            total = total + F.lit(amp) * F.sin(angle)
        return total

    return F.radians(a["lp"] + series(T.MOON_LONGITUDE_TERMS)), F.radians(series(T.MOON_LATITUDE_TERMS))


def ecliptic_to_equatorial(lon, lat, eps):
    """(RA, Dec) in degrees from ecliptic radians."""
    ra = mod360(F.degrees(F.atan2(F.sin(lon) * F.cos(eps) - F.tan(lat) * F.sin(eps), F.cos(lon))))
    dec = F.degrees(F.asin(F.sin(lat) * F.cos(eps) + F.cos(lat) * F.sin(eps) * F.sin(lon)))
    return ra, dec


def moon_ra_dec(t):
    """(RA, Dec) of the Moon from the truncated lunar series, about 1 degree.

    Many rows are better served by ``with_moon``, which computes each step once.
    """
    a = moon_arguments(days_since_j2000(t) / F.lit(36525.0))
    lon, lat = moon_ecliptic(a)
    return ecliptic_to_equatorial(lon, lat, a["eps"])


def with_moon(df: DataFrame, time: str) -> DataFrame:
    """Add moon_ra and moon_dec, each intermediate step as a column of its own so
    that no step is evaluated more than once per row."""
    d = df.withColumn("_c", days_since_j2000(time) / F.lit(36525.0))
    d = d.withColumns({f"_m_{k}": v for k, v in moon_arguments("_c").items()})
    names = [n for n in d.columns if n.startswith("_m_")]
    lon, lat = moon_ecliptic({n[3:]: F.col(n) for n in names})
    d = d.withColumns({"_lon": lon, "_lat": lat})
    ra, dec = ecliptic_to_equatorial(F.col("_lon"), F.col("_lat"), F.col("_m_eps"))
    return with_isolated(d, {"moon_ra": ra, "moon_dec": dec}, df.columns)


def with_sun(df: DataFrame, time: str, model: str = "low") -> DataFrame:
    """Add sun_ra and sun_dec step by step."""
    lon, eps = sun_longitude(time, model)
    d = df.withColumns({"_sl": F.radians(lon), "_se": F.radians(eps)})
    lon, eps = F.col("_sl"), F.col("_se")
    ra = mod360(F.degrees(F.atan2(F.cos(eps) * F.sin(lon), F.cos(lon))))
    dec = F.degrees(F.asin(F.sin(eps) * F.sin(lon)))
    return with_isolated(d, {"sun_ra": ra, "sun_dec": dec}, df.columns)


def lunar_elongation(t, ra, dec) -> Column:
    mra, mdec = moon_ra_dec(t)
    return angular_separation(ra, dec, mra, mdec)


def sidereal_time(t) -> Column:
    """Greenwich mean sidereal time."""
    d = days_since_j2000(t)
    c = d / F.lit(36525.0)
    return mod360(F.lit(280.46061837) + F.lit(360.98564736629) * d + F.lit(0.000387933) * c * c)


def altitude(t, longitude, latitude, ra, dec) -> Column:
    """Altitude above the horizon; NULL when the site is unknown."""
    ha = F.radians(sidereal_time(t) + col(longitude) - col(ra))
    lat, d = F.radians(col(latitude)), F.radians(col(dec))
    s = F.sin(lat) * F.sin(d) + F.cos(lat) * F.cos(d) * F.cos(ha)
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s))))


def sun_altitude(t, longitude, latitude) -> Column:
    ra, dec = sun_ra_dec(t, "low")
    return altitude(t, longitude, latitude, ra, dec)


def moon_altitude(t, longitude, latitude) -> Column:
    ra, dec = moon_ra_dec(t)
    return altitude(t, longitude, latitude, ra, dec)


def site_latitude(rhosinphi, rhocosphi) -> Column:
    return F.degrees(F.atan2(col(rhosinphi), col(rhocosphi)))


def twilight_class(sun_alt, is_satellite) -> Column:
    alt = col(sun_alt)
    return (F.when(F.coalesce(col(is_satellite), F.lit(False)), F.lit("Space-based"))
            .when(alt < -18, F.lit("Nighttime"))
            .when(alt < -12, F.lit("Astronomical twilight"))
            .when(alt < -6, F.lit("Nautical twilight"))
            .when(alt < 0, F.lit("Civil twilight"))
            .when(alt >= 0, F.lit("Daytime"))
            .otherwise(F.lit("Unknown site")))


def days_from_full_moon(t) -> Column:
    """Days from the nearest mean full moon, in [-half, +half) of a synodic month."""
    from .timeconv import seconds_between
    d = seconds_between(F.expr(f"TIMESTAMP_NTZ'{T.REFERENCE_FULL_MOON}'"), t).cast("double") \
        / F.lit(86400.0)
    half = T.SYNODIC_MONTH_DAYS / 2
    return F.pmod(d + F.lit(half), F.lit(T.SYNODIC_MONTH_DAYS)) - F.lit(half)


def galactic_latitude(ra, dec) -> Column:
    """Angle from the galactic plane: arcsine of the component along its pole."""
    x, y, z = T.GALACTIC_POLE
    r, d = F.radians(col(ra)), F.radians(col(dec))
    s = F.cos(d) * F.cos(r) * x + F.cos(d) * F.sin(r) * y + F.sin(d) * z
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s))))


def ecliptic_latitude(ra, dec) -> Column:
    eps = F.radians(F.lit(T.OBLIQUITY_J2000))
    r, d = F.radians(col(ra)), F.radians(col(dec))
    return F.degrees(F.asin(F.sin(d) * F.cos(eps) - F.cos(d) * F.sin(eps) * F.sin(r)))


def sexagesimal_parts(text) -> Column:
    """The three numbers of a sexagesimal angle without its sign; NULLs if malformed."""
    p = F.split(F.trim(F.regexp_replace(F.trim(col(text)), "^[+-]", "")), " +")
    return F.when(F.size(p) == 3, F.transform(p, lambda x: x.try_cast("double")))


def hours_from_parts(parts) -> Column:
    p = col(parts)
    return (p[0] + p[1] / 60.0 + p[2] / 3600.0) * 15.0


def degrees_from_parts(parts, text) -> Column:
    """Degrees with the sign of the text, which also holds for -00."""
    p = col(parts)
    sign = F.when(F.ltrim(col(text)).startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return sign * (p[0] + p[1] / 60.0 + p[2] / 3600.0)


def ra_hms_to_deg(text) -> Column:
    """``HH MM SS.sss`` to degrees; NULL if malformed."""
    return hours_from_parts(sexagesimal_parts(text))


def dec_dms_to_deg(text) -> Column:
    """``sDD MM SS.ss`` to degrees, keeping the sign of -00; NULL if malformed."""
    return degrees_from_parts(sexagesimal_parts(text), text)


def round_to_input(value, text) -> Column:
    """Round an angle to two decimals more than the seconds of its sexagesimal text
    (four when the seconds carry none), as the exchange export does."""
    sec = F.element_at(F.split(F.trim(col(text)), " +"), -1)
    n = F.when(F.instr(sec, ".") > 0, F.length(sec) - F.instr(sec, ".") + 2).otherwise(F.lit(4))
    unit = F.pow(F.lit(10.0), n)
    return F.round(col(value) * unit) / unit
