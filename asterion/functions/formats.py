"""Text formats of the exchange files."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import tables as T
from .common import blank_to_null, col


def number_text(c, name: str) -> Column:
    """A value as exchange text, with the field's fixed number of decimals."""
    c = col(c)
    if name in T.ADES_DECIMALS:
        return F.format_string(f"%.{T.ADES_DECIMALS[name]}f", c.cast("double"))
    return c.cast("string")


def optical_struct(fields: dict, order=None) -> Column:
    """Ordered struct of text children; blanks become NULL so no element is written."""
    order = order or T.ADES_OPTICAL_EXPORT
    return F.struct(*[
        F.when(col(fields[f]).isNotNull(), blank_to_null(number_text(fields[f], f))).alias(f)
        for f in order if f in fields])


def optical_xml(fields: dict, order=None) -> Column:
    """One escaped ``<optical>`` element on a line of its own."""
    xml = F.to_xml(optical_struct(fields, order), {"rowTag": "optical"})
    return F.regexp_replace(xml, r"\n\s*", "")


def psv_line(fields: dict) -> Column:
    """Right-aligned, pipe-separated record; longer values are never cut."""
    cells = []
    for name, width in T.PSV_COLUMNS:
        if name not in fields:
            cells.append(F.lit(" " * width))
            continue
        c = col(fields[name])
        text = F.when(c.isNotNull(), number_text(c, name)).otherwise(F.lit(""))
        cells.append(F.when(F.length(text) >= width, text)
                     .otherwise(F.lpad(text, width, F.lit(" "))))
    return F.concat_ws("|", *cells)


def psv_header() -> str:
    return "|".join(name.rjust(width) for name, width in T.PSV_COLUMNS)


def iso_micros(t) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.ffffffZ``."""
    return F.concat(F.date_format(col(t).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                    F.lit("Z"))


def elongation_bin_label(bin_number, width) -> Column:
    """``   5° to   10° E``: bounds padded to four, west bins counted outwards."""
    b = col(bin_number)
    lo = F.when(b >= 0, b * width).otherwise((b + 1) * -width)
    hi = F.when(b >= 0, (b + 1) * width).otherwise(b * -width)
    side = F.when(b >= 0, F.lit("E")).otherwise(F.lit("W"))

    def pad(x):
        return F.lpad(F.round(x).cast("int").cast("string"), 4, F.lit(" "))

    return F.concat(pad(lo), F.lit("° to "), pad(hi), F.lit("° "), side)
