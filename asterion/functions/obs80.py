"""The 80-column observation line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import tables as T
from .common import blank_to_null, col, lookup
from .designation import unpack_designation
from .sky import degrees_from_parts, hours_from_parts, sexagesimal_parts
from .timeconv import date_parts, iso8601_from_parts, mpc_date_to_timestamp


def cat_to_ades(code) -> Column:
    return lookup(code, T.CATALOGS)


def mode_to_ades(code) -> Column:
    return F.when(col(code).isNotNull(), lookup(code, T.MODES, "UNK"))


def band_to_ades(code, passthrough: bool = False) -> Column:
    """ADES band; an unknown code is NULL, or itself when passing through."""
    code = col(code)
    known = lookup(code, T.BANDS)
    return F.coalesce(known, blank_to_null(F.trim(code))) if passthrough else known


def note_or_program(code):
    """(note, program): a letter is a note, any other mark a program code."""
    code = col(code)
    is_note = code.rlike("^[A-Za-z]$")
    return (F.when(is_note, code),
            F.when(~is_note, F.nullif(code, F.lit(" "))))


def _cut(line) -> dict[str, Column]:
    """The line's raw fields by their columns."""
    s = F.rpad(col(line), 80, " ")
    at = {"disc": (13, 1), "col14": (14, 1), "col15": (15, 1), "dec": (45, 12), "mag": (66, 5),
          "col71": (71, 1), "col72": (72, 1)}
    raw = {k: F.substring(s, start, n) for k, (start, n) in at.items()}
    raw["packed"] = F.trim(F.substring(s, 1, 12))
    raw["date_parts"] = date_parts(F.substring(s, 16, 17))
    raw["ra_parts"] = sexagesimal_parts(F.substring(s, 33, 12))
    raw["dec_parts"] = sexagesimal_parts(F.substring(s, 45, 12))
    raw["stn"] = F.trim(F.substring(s, 78, 3))
    return raw


def _fields(raw: dict[str, Column]) -> dict[str, Column]:
    notes, prog = note_or_program(raw["col14"])
    return {
        "packed_desig": raw["packed"],
        "unpacked_desig": unpack_designation(raw["packed"], tilde=False),
        "disc": F.nullif(raw["disc"], F.lit(" ")),
        "prog": prog,
        "notes": notes,
        "mode": mode_to_ades(raw["col15"]),
        "obs_time": iso8601_from_parts(raw["date_parts"]),
        "ra_deg": hours_from_parts(raw["ra_parts"]),
        "dec_deg": degrees_from_parts(raw["dec_parts"], raw["dec"]),
        "mag": F.trim(raw["mag"]).try_cast("double"),
        "band": band_to_ades(raw["col71"]),
        "ast_cat": cat_to_ades(raw["col72"]),
        "stn": raw["stn"],
    }


def decode_obs80(line) -> Column:
    """All fields of a line as one struct."""
    return F.struct(*[v.alias(k) for k, v in _fields(_cut(line)).items()])


def with_obs80(df: DataFrame, line: str) -> DataFrame:
    """Add all fields of a line as columns, cutting and splitting it only once."""
    raw = {f"_raw_{k}": v for k, v in _cut(line).items()}
    fields = _fields({k[5:]: F.col(k) for k in raw})
    return df.withColumns(raw).select(*df.columns, *[v.alias(k) for k, v in fields.items()])


def observed_at(line) -> Column:
    return mpc_date_to_timestamp(F.substring(col(line), 16, 17))


def tracklet_key(line) -> Column:
    """(station, UT date) of a valid observation line, else NULL."""
    s = col(line)
    valid = ((F.length(s) >= 80)
             & F.substring(s, 15, 1).rlike("[CcSsXxAaEeHhPpRrTtVvWw]")
             & F.substring(s, 16, 4).rlike("^ *[0-9]+ *$"))
    return F.when(valid, F.struct(
        F.trim(F.substring(s, 78, 3)).alias("stn"),
        F.trim(F.substring_index(F.substring(s, 16, 10), ".", 1)).alias("date")))


def splice_uncertainty(line, rms_ra, rms_dec) -> Column:
    """Write the two uncertainties into columns 57-65 of a line.

    Ten arcseconds and more print as integers, both below one as milliarcseconds
    with an ``m``, anything else with two decimals. Without both values the line
    stays as it is. A 160-column pair becomes two lines; every line ends in a
    newline.
    """
    s, ra, dec = col(line), col(rms_ra), col(rms_dec)
    two_line = F.length(s) == 160
    tail = F.when(two_line, F.concat(F.lit("\n"), F.substring(s, 81, 80), F.lit("\n"))) \
        .otherwise(F.lit("\n"))

    def whole(x):
        return F.lpad(F.round(x).cast("int").cast("string"), 4, F.lit(" "))

    def milli(x):
        return F.lpad(F.round(x * 1000).cast("int").cast("string"), 3, F.lit("0"))

    def plain(x):
        return F.format_string("%.2f", x.cast("decimal(20,6)").cast("double"))

    field = (F.when((ra >= 10) | (dec >= 10), F.concat(whole(ra), whole(dec), F.lit(" ")))
             .when((ra < 1) & (dec < 1),
                   F.concat(F.lit(" "), milli(ra), F.lit(" "), milli(dec), F.lit("m")))
             .otherwise(F.concat(plain(ra), F.lit(" "), plain(dec))))
    kept = F.when(two_line, F.substring(s, 1, 80)).otherwise(s)
    return F.when(ra.isNull() | dec.isNull(), F.concat(kept, tail)).otherwise(
        F.concat(F.substring(s, 1, 56), field, F.substring(s, 66, 15), tail))


def line_order(line):
    """Sort columns of exported lines: time, mode, station."""
    s = col(line)
    return [F.substring(s, 16, 17), F.substring(s, 15, 1), F.substring(s, 78, 3)]
