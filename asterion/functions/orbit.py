"""Orbit elements, dynamical classes and size scales."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from . import tables as T
from .common import col, lookup


def semi_major_axis(q, e) -> Column:
    """a = q/(1-e), NULL unless the orbit is an ellipse."""
    q, e = col(q), col(e)
    return F.when(e < 1, q / (F.lit(1.0) - e))


def aphelion(q, e) -> Column:
    q, e = col(q), col(e)
    return F.when(e < 1, q * (F.lit(1.0) + e) / (F.lit(1.0) - e))


def orbital_period(a) -> Column:
    """Years, by Kepler's third law; NULL unless a > 0."""
    a = col(a)
    return F.when(a > 0, F.pow(a, F.lit(1.5)))


def tisserand(a, e, i, jupiter: float = T.JUPITER_A) -> Column:
    """Tisserand parameter with respect to Jupiter; NULL for a <= 0."""
    a, e, i = col(a), col(e), col(i)
    root = F.sqrt(a / F.lit(jupiter) * (F.lit(1.0) - e * e))
    return F.when(a > 0, F.lit(jupiter) / a + F.lit(2.0) * F.cos(F.radians(i)) * root)


def tisserand_guarded(a, e, i, jupiter: float = T.JUPITER_A) -> Column:
    """The catalogue query's form: the root's argument never falls below zero."""
    a, e, i = col(a), col(e), col(i)
    arg = F.greatest(a / F.lit(jupiter) * (F.lit(1.0) - e * e), F.lit(0.0))
    return F.lit(jupiter) / F.nullif(a, F.lit(0.0)) + \
        F.lit(2.0) * F.cos(F.radians(i)) * F.sqrt(arg)


def classify_orbit(q, e, i=None, a=None) -> Column:
    """Class code from elements; NULL when q or e is missing.

    The order of the tests is part of the definition: geometry before the
    Tisserand test, and q of exactly 1.3 belongs to neither Amor nor Mars Crosser.
    """
    q, e = col(q), col(e)
    i = F.lit(None).cast("double") if i is None else col(i)
    derived = q / (F.lit(1.0) - e)
    a = derived if a is None else F.coalesce(col(a), derived)
    big_q = a * (F.lit(1.0) + e)
    tj = tisserand(a, e, i)
    rules = [
        (q.isNull() | e.isNull(), None),
        (e > 1, 30),
        (e == 1, 31),
        ((a < 1) & (big_q < 0.983), 0),
        (a < 1, 1),
        (q < 1.017, 2),
        (q < 1.3, 3),
        ((a < 3.2) & (q > 1.3) & (q < 1.666), 10),
        ((a < T.MAIN_BELT_OUTER) & (i < 75), 11),
        ((a > 4.8) & (a < 5.4) & (e < 0.3), 12),
        ((a > 29.8) & (a < 30.4), 21),
        ((tj > 2) & (tj < 3), 20),
        ((a >= T.JUPITER_A) & (a < T.NEPTUNE_A), 22),
        (a >= T.NEPTUNE_A, 23),
        (a < T.JUPITER_A, 19),
    ]
    expr = F.when(rules[0][0], F.lit(None).cast("int"))
    for test, code in rules[1:]:
        expr = expr.when(test, F.lit(code))
    return expr.otherwise(F.lit(9))


def orbit_label(code) -> Column:
    """Long name of a class code; NULL for an unknown or missing code."""
    names = {c: n[1] for c, n in T.ORBIT_CLASSES.items()}
    names[99] = "Other"
    return lookup(code, names)


def orbit_long_name(code) -> Column:
    return lookup(code, {c: n[1] for c, n in T.ORBIT_CLASSES.items()}, T.UNCLASSIFIED[1])


def orbit_short_name(code) -> Column:
    return lookup(code, {c: n[0] for c, n in T.ORBIT_CLASSES.items()}, T.UNCLASSIFIED[0])


def orbit_rank(code) -> Column:
    """Position in the display order; missing codes come last."""
    return lookup(code, {c: k for k, c in enumerate(T.ORBIT_CLASSES)}, len(T.ORBIT_CLASSES))


def classify_extended(code, q, e, a=None) -> Column:
    """Finer classes: two kinds of Amor, four main-belt zones, shifted 30 and 31."""
    code, q, e = col(code), col(q), col(e)
    derived = semi_major_axis(q, e)
    a = derived if a is None else F.coalesce(col(a), derived)
    return (
        F.when((code == 3) & (q <= T.AMOR_SPLIT_Q), F.lit(30))
        .when(code == 3, F.lit(31))
        .when((code == 11) & (a < T.HUNGARIA_OUTER), F.lit(110))
        .when((code == 11) & (a < T.INNER_BELT_OUTER), F.lit(111))
        .when((code == 11) & (a < T.MIDDLE_BELT_OUTER), F.lit(112))
        .when((code == 11) & a.isNotNull(), F.lit(113))
        .when(code == 11, F.lit(111))
        .when(code == 30, F.lit(300))
        .when(code == 31, F.lit(310))
        .otherwise(code)
    )


def extended_name(ext) -> Column:
    return lookup(ext, {c: n[1] for c, n in T.EXTENDED_CLASSES.items()}, "Unclassified")


def coarse_group(ext) -> Column:
    return lookup(ext, {c: n[2] for c, n in T.EXTENDED_CLASSES.items()}, "Unclassified")


def neo_class(a, e, q=None, big_q=None) -> Column:
    """Four-way near-Earth class from the best elements at hand."""
    a, e = col(a), col(e)
    q_own = a * (F.lit(1.0) - e)
    big_own = a * (F.lit(1.0) + e)
    q = q_own if q is None else F.coalesce(col(q), q_own)
    big_q = big_own if big_q is None else F.coalesce(col(big_q), big_own)
    return (
        F.when(a.isNull() | e.isNull() | (e >= 1), F.lit("Unclassified"))
        .when((a < 1) & (big_q < 0.983), F.lit("Atira"))
        .when(a < 1, F.lit("Aten"))
        .when(q < 1.017, F.lit("Apollo"))
        .when(q < 1.3, F.lit("Amor"))
        .otherwise(F.lit("Other"))
    )


def is_neo(q) -> Column:
    q = col(q)
    return q.isNotNull() & (q <= 1.3)


def is_pha(q, e, h) -> Column:
    """Hazard flag from elements; false, never NULL, when an input is missing."""
    q, e, h = col(q), col(e), col(h)
    return (q.isNotNull() & e.isNotNull() & h.isNotNull()
            & (q <= 1.3) & (e < 1) & (h <= 22))


def is_pha_by_moid(moid, h) -> Column:
    return (F.coalesce(col(moid), F.lit(999.0)) <= 0.05) & (F.coalesce(col(h), F.lit(99.0)) <= 22)


def size_class(h) -> Column:
    """'1km' (H < 17.75), '140m' (H <= 22), 'small', or NULL without H."""
    h = col(h)
    return (F.when(h < 17.75, F.lit("1km")).when(h <= 22, F.lit("140m"))
            .when(h.isNotNull(), F.lit("small")))


def h_to_diameter_km(h, albedo: float = 0.14) -> Column:
    return F.lit(1329.0 / math.sqrt(albedo)) * F.pow(F.lit(10.0), -col(h) / F.lit(5.0))


def diameter_km_to_h(d, albedo: float = 0.14) -> Column:
    return F.lit(5.0) * F.log10(F.lit(1329.0 / math.sqrt(albedo)) / col(d))


def reference_albedo(h) -> Column:
    """Size-dependent reference albedo: 0.15, 0.16 from H 18, 0.18 beyond H 22."""
    h = col(h)
    return F.when(h < 18, F.lit(0.15)).when(h <= 22, F.lit(0.16)).when(h.isNotNull(), F.lit(0.18))


def perihelion_disruption_distance(h) -> Column:
    return F.lit(0.135) + F.lit(0.032) * (col(h) - F.lit(20.0))
