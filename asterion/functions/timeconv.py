"""Instants, Julian days and the observation format's dates.

Instants are TIMESTAMP_NTZ in UTC, so nothing here depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import col

UNIX_EPOCH_MJD = 40587.0
UNIX_EPOCH_JD = 2440587.5
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def seconds_between(start, end) -> Column:
    """Exact seconds from start to end as DECIMAL(20,6)."""
    span = col(end).cast("timestamp_ntz") - col(start).cast("timestamp_ntz")
    return span.cast("interval second").cast("decimal(20,6)")


def epoch_seconds(t) -> Column:
    return seconds_between(F.expr(_EPOCH), t).cast("double")


def epoch_micros(t) -> Column:
    return (seconds_between(F.expr(_EPOCH), t) * F.lit(1000000)).cast("bigint")


def from_epoch_micros(us) -> Column:
    us = col(us)
    return F.expr(_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (us / F.lit(1000000)).cast("decimal(18,6)"))


def days_between(start, end) -> Column:
    return seconds_between(start, end).cast("double") / F.lit(86400.0)


def mjd(t) -> Column:
    return epoch_seconds(t) / F.lit(86400.0) + F.lit(UNIX_EPOCH_MJD)


def julian_day(t) -> Column:
    """Julian day of the whole second."""
    return F.floor(epoch_seconds(t)) / F.lit(86400.0) + F.lit(UNIX_EPOCH_JD)


def days_since_j2000(t) -> Column:
    """Days since 2000-01-01 12:00."""
    return seconds_between(F.expr("TIMESTAMP_NTZ'2000-01-01 12:00:00'"), t).cast("double") \
        / F.lit(86400.0)


def mjd_to_date(m) -> Column:
    return F.date_add(F.lit("1858-11-17").cast("date"), F.floor(col(m)).cast("int"))


def day_of(t) -> Column:
    return col(t).cast("date")


def month_of(t) -> Column:
    """First day of the month."""
    return F.trunc(col(t).cast("date"), "month")


def year_of(t) -> Column:
    return F.year(col(t))


def lunation(t, synodic: float = 29.5306) -> Column:
    """Number of the synodic month counted from the full moon of 2000-01-21 04:40."""
    d = seconds_between(F.expr("TIMESTAMP_NTZ'2000-01-21 04:40:00'"), t).cast("double")
    return F.floor(d / F.lit(86400.0) / F.lit(synodic)).cast("int")


def date_parts(text) -> Column:
    """Blank-separated fields of an observation date."""
    return F.split(F.trim(col(text)), " +")


def _day_and_fraction(parts):
    """(calendar day or NULL, fraction of the day as text, its number of decimals)."""
    parts = col(parts)
    day_text = F.get(parts, F.lit(2))
    whole = F.substring_index(day_text, ".", 1)
    base = F.when(F.size(parts) == 3, F.concat_ws(
        "-", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), whole)).try_cast("date")
    frac = F.substring(day_text, F.length(whole) + 1, 20)
    return base, F.concat(F.lit("0"), frac), F.greatest(F.length(frac) - 1, F.lit(0))


def timestamp_from_parts(parts) -> Column:
    base, frac, _ = _day_and_fraction(parts)
    seconds = F.round(frac.try_cast("decimal(28,18)") * F.lit(86400), 6).cast("decimal(18,6)")
    return base.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def iso8601_from_parts(parts) -> Column:
    base, frac, decimals = _day_and_fraction(parts)
    decimals = F.greatest(decimals - 5, F.lit(0))
    unit = F.pow(F.lit(10.0), decimals)
    ticks = F.round(frac.try_cast("double") * F.lit(86400.0) * unit)
    whole = F.floor(ticks / unit)
    instant = base.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), whole.cast("decimal(18,6)"))
    rest = (ticks - whole * unit).cast("bigint").cast("string")
    tail = F.when(decimals > 0, F.concat(F.lit("."), F.lpad(rest, decimals, F.lit("0")))) \
        .otherwise(F.lit(""))
    return F.concat(F.replace(instant.cast("string"), F.lit(" "), F.lit("T")), tail, F.lit("Z"))


def mpc_date_to_timestamp(text) -> Column:
    """``YYYY MM DD.dddddd`` to an instant rounded to microseconds; NULL if malformed."""
    return timestamp_from_parts(date_parts(text))


def mpc_date_to_iso8601(text) -> Column:
    """ISO 8601 UTC with as many second decimals as the input's precision carries.

    A date of d decimals gives max(0, d - 5) decimals of a second. Rounding up to
    a full minute carries through minutes, hours and days. Without a fraction it
    is midnight.
    """
    return iso8601_from_parts(date_parts(text))
