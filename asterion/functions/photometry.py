"""Magnitudes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import tables as T
from .common import col, lookup


def band_offset(band, null_band: str = "as_v") -> Column:
    """Offset from a band to V; unknown bands count as V.

    A blank band is the old photographic default. Whether a NULL band counts as
    V (``as_v``) or as blank (``as_blank``, which also trims and accepts ADES
    two-character codes) differs between the two published uses.
    """
    band = col(band)
    if null_band == "as_v":
        return lookup(band, T.BAND_TO_V, 0.0)
    if null_band == "as_blank":
        return lookup(normal_band(band), {**T.BAND_TO_V, **T.BAND_TO_V_ADES}, 0.0)
    raise ValueError(null_band)


def normal_band(band) -> Column:
    return F.trim(F.coalesce(col(band), F.lit("")))


def to_v(mag, band, null_band: str = "as_v") -> Column:
    return col(mag) + band_offset(band, null_band)
