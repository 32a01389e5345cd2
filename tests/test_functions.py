"""Column functions against published vectors."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from asterion.functions import (circular, designation as D, formats, obs80, orbit, photometry, sky,
                                timeconv)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def value(spark, column):
    return one(spark, column)[0]


def test_orbit_labels(spark):
    rows = [
        (0.502, 0.322, 25.0, "Atira"), (0.464, 0.450, 10.0, "Aten"), (0.800, 0.651, 5.0, "Apollo"),
        (1.200, 0.100, 10.0, "Amor"), (1.500, 0.300, 20.0, "Mars Crosser"), (2.430, 0.100, 10.0, "Main Belt"),
        (4.789, 0.080, 12.0, "Jupiter Trojan"), (2.534, 0.300, 10.0, "Middle Other"),
        (2.400, 0.600, 12.0, "Jupiter Coupled"), (28.669, 0.050, 5.0, "Neptune Trojan"),
        (8.068, 0.500, 20.0, "Centaur"), (40.500, 0.100, 5.0, "TNO"), (1.000, 1.500, 80.0, "Hyperbolic"),
        (1.0, 1.0, 10.0, "Parabolic"), (1.3, 0.4, 5.0, "Main Belt"), (None, 0.1, 1.0, None), (1.0, None, 1.0, None)]
    df = spark.createDataFrame(rows, "q double, e double, i double, want string")
    got = df.select("want", orbit.orbit_label(orbit.classify_orbit("q", "e", "i")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


@pytest.mark.parametrize("a,e,i,q,code", [
    (0.99, 0.0, 5.0, 0.99, 1), (1.0, 0.0, 5.0, 1.0, 2), (1.5, 0.322, 5.0, 1.017, 3), (2.0, 0.5, None, 1.0, 2),
    (3.2, 0.5, 10.0, 1.6, 11), (3.0, 0.1, 80.0, 2.7, 19), (5.2, 0.05, 10.0, 4.94, 12), (5.2, 0.29, 80.0, 3.692, 12),
    (30.0, 0.0, 5.0, 30.0, 21), (30.4, 0.0, 5.0, 30.4, 23), (5.2026, 0.4, 0.0, 3.12156, 20), (20.0, 0.01, 5.0, 19.8, 22)])
def test_orbit_boundaries(spark, a, e, i, q, code):
    lit = [F.lit(x).cast("double") for x in (q, e, i, a)]
    assert value(spark, orbit.classify_orbit(*lit)) == code


def test_extended_classes(spark):
    df = spark.createDataFrame([(3, 1.15, .3, None, 30), (3, 1.16, .3, None, 31), (11, 1.9, .05, 2.0, 110), (11, 2.0, .1, 2.3, 111),
                                (11, 2.4, .1, 2.7, 112), (11, 2.7, .1, 3.0, 113), (11, None, None, None, 111), (30, 1., 2., None, 300),
                                (31, 1., 1., None, 310), (2, 1., .5, None, 2), (None, 1., .5, None, None)],
                               "c int, q double, e double, a double, want int")
    rows = df.select("want", orbit.classify_extended("c", "q", "e", F.col("a")).alias("got")).collect()
    assert all(r.got == r.want for r in rows)
    assert one(spark, orbit.coarse_group(F.lit(112)), orbit.extended_name(F.lit(30)), orbit.coarse_group(F.lit(None).cast("int"))) == \
        ("Main Belt", "Near Amor", "Unclassified")


def test_dates(spark):
    iso = timeconv.mpc_date_to_iso8601
    assert one(spark, iso(F.lit("2024 12 27.238073")), iso(F.lit("2026 02 08.76638905")), iso(F.lit("2024 12 31.9999999")),
               iso(F.lit("2024 12 31")), iso(F.lit("2024 12")), iso(F.lit("2024 2 3.5")), iso(F.lit("2023 12 31.999999"))) == \
        ("2024-12-27T05:42:49.5Z", "2026-02-08T18:23:36.014Z", "2024-12-31T23:59:59.99Z", "2024-12-31T00:00:00Z", None,
         "2024-02-03T12:00:00Z", "2023-12-31T23:59:59.9Z")
    assert value(spark, timeconv.mpc_date_to_timestamp(F.lit("2024 12 27.238073"))) == dt.datetime(2024, 12, 27, 5, 42, 49, 507200)
    assert value(spark, iso(F.lit("2024 12 31.99999"))) == "2024-12-31T23:59:59Z"
    assert value(spark, iso(F.lit("2024 12 31.999999999"))) == "2024-12-31T23:59:59.9999Z"


def test_dates_do_not_depend_on_the_session_zone(spark):
    t = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
    want = one(spark, timeconv.mjd(t), timeconv.days_since_j2000(t))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, timeconv.mjd(t), timeconv.days_since_j2000(t)) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_angles(spark):
    ra, dec = one(spark, sky.ra_hms_to_deg(F.lit("08 56 40.968")), sky.dec_dms_to_deg(F.lit("-00 16 11.93")))
    assert (round(ra, 5), round(dec, 5)) == (134.17070, -0.26998)
    assert one(spark, sky.ra_hms_to_deg(F.lit("08 56")), sky.dec_dms_to_deg(F.lit("x y z"))) == (None, None)
    arc, pa = one(spark, sky.great_circle_deg(F.lit(359.9), F.lit(0.0), F.lit(0.1), F.lit(0.0)),
                  sky.position_angle_deg(F.lit(359.9), F.lit(0.0), F.lit(0.1), F.lit(0.0)))
    assert (round(arc, 6), round(pa, 6)) == (0.2, 90.0)


def test_moon_is_full_and_the_sun_opposite_at_a_total_eclipse(spark):
    t = F.lit("2004-10-28 03:04:00").cast("timestamp_ntz")
    sra, sdec = sky.sun_ra_dec(t)
    mra, mdec = sky.moon_ra_dec(t)
    sep, phase = one(spark, sky.angular_separation(sra, sdec, mra, mdec), sky.days_from_full_moon(t))
    assert sep > 179 and abs(phase) < 0.6
    d = sky.with_moon(spark.range(1).select(t.alias("t")), "t").first()
    assert (round(d.moon_ra, 9), round(d.moon_dec, 9)) == tuple(round(x, 9) for x in one(spark, mra, mdec))


def test_galactic_pole(spark):
    assert value(spark, sky.galactic_latitude(F.lit(192.85948), F.lit(27.12825))) > 89.9


@pytest.mark.parametrize("packed,unpacked", [("K24Y04R", "2024 YR4"), ("00433", "433"), ("J95X00A", "1995 XA"),
                                             ("K20C03D", "2020 CD3"), ("~0fr6", "780896"), ("A0001", "100001"), ("z9999", "619999"),
                                             ("~0000", "620000"), ("K07Tf8A", "2007 TA418")])
def test_designations(spark, packed, unpacked):
    assert one(spark, D.unpack_designation(F.lit(packed)), D.pack_designation(F.lit(unpacked))) == (unpacked, packed)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(numbers=st.lists(st.integers(1, 15_000_000), min_size=50, max_size=50))
def test_numbers_survive_packing(spark, numbers):
    df = spark.createDataFrame([(str(n),) for n in numbers], "n string")
    assert df.where(D.unpack_designation(D.pack_number("n")) != F.col("n")).count() == 0


def test_kinds(spark):
    names = {"433": "numbered", "K24Y04R": "provisional", "2024 YR4": "provisional", "2040 P-L": "survey", "C/2024 G3": "comet",
             "141P": "comet", "A/2019 Q2": "asteroid_cometary", "3I/ATLAS": "interstellar", "S/2021 J 1": "satellite", "nonsense": None}
    df = spark.createDataFrame(list(names.items()), "n string, want string")
    assert [(r.n, r.got) for r in df.select("n", D.designation_kind("n").alias("got")).collect()] == list(names.items())


def test_line(spark):
    line = "     K24Y04R* C2024 12 27.23807308 56 40.968-00 16 11.93         17.3 oV     W68"
    want = {"packed_desig": "K24Y04R", "unpacked_desig": "2024 YR4", "disc": "*", "prog": None, "notes": None, "mode": "CCD",
            "obs_time": "2024-12-27T05:42:49.5Z", "mag": 17.3, "band": "Ao", "ast_cat": "Gaia2", "stn": "W68"}
    row = value(spark, obs80.decode_obs80(F.lit(line))).asDict()
    assert {k: row[k] for k in want} == want
    staged = obs80.with_obs80(spark.createDataFrame([(line,)], "l string"), "l").drop("l").first().asDict()
    assert staged == row
    short = value(spark, obs80.decode_obs80(F.lit("     K24Y04R"))).asDict()
    assert short["ra_deg"] is None and short["mag"] is None and short["mode"] == "PHO"
    assert value(spark, obs80.tracklet_key(F.lit("too short"))) is None


def test_uncertainty_forms(spark):
    line = "a" * 56 + "b" * 9 + "c" * 15
    def put(ra, dec, text=line):
        return value(spark, obs80.splice_uncertainty(F.lit(text), F.lit(ra).cast("double"), F.lit(dec).cast("double")))
    a, c = "a" * 56, "c" * 15
    assert put(None, 1.0) == line + "\n"
    assert put(12.0, 0.25) == a + "  12   0 " + c + "\n"
    assert put(0.12, 0.5) == a + " 120 500m" + c + "\n"
    assert put(1.5, 0.25) == a + "1.50 0.25" + c + "\n"
    assert put(1.5, 0.25, line + "d" * 80) == a + "1.50 0.25" + c + "\n" + "d" * 80 + "\n"
    assert put(None, None, line + "d" * 80) == line + "\n" + "d" * 80 + "\n"


def test_bands(spark):
    none = F.lit(None).cast("string")
    m = F.lit(20.0)
    got = one(spark, *[photometry.to_v(m, F.lit(b)) for b in ("V", "o", "", "?")], photometry.to_v(m, none),
              photometry.to_v(m, none, "as_blank"), photometry.to_v(m, F.lit("Ao"), "as_blank"))
    assert [round(x, 3) for x in got] == [20.0, 20.33, 19.2, 20.0, 20.0, 19.2, 20.33]


YEAR = 2026
CIRCULARS = [
    ("DAILY ORBIT UPDATE", "", "dou"), ("", "DAILY ORBIT UPDATE (2026 Feb 19)", "dou"), ("RETRACTION OF 2026 AB", "", "retraction"),
    ("EDITORIAL NOTICE", "", "editorial"), ("Notice", "\n  EDITORIAL\n\nSome text", "editorial"),
    ("2026 CE3", "Additional Observations\n", "recovery"), ("2026 CE3", "Revision to MPEC 2026-C01\n", "recovery"),
    ("2026 CE3", "**2026 CE3**\nObservations:\n", "discovery"), ("2025 XY", "**2025 XY**\nObservations:\n", "recovery"),
    ("COMET C/2025 A1", "COMET  C/2025 A1 (MAPS)\nObservations:\n", "recovery"), ("2024 AB", "", "recovery"), ("2026 ZZ", "", "discovery"),
    ("", "", "editorial"), ("COMET 3I/ATLAS", "COMET  3I/ATLAS\n\nObservations:\n0003I        eC2025 11 29.21566012 08 01.050", "recovery"),
    ("COMET 4I/Foo", "COMET  4I/Foo\n\nObservations:\n0004I        eC2026 01 15.12345612 08 01.050", "discovery"),
    ("S/2021 J 1", "", "satellite"), ("x", "Satellite of Jupiter", "satellite")]


def test_circular_types(spark):
    df = spark.createDataFrame(CIRCULARS, "title string, body string, want string")
    rows = df.select("want", circular.circular_type("title", "body", YEAR).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]


@pytest.mark.parametrize("text,want", [
    ("  **2026 CE3**\n", "2026 CE3"), ("          2026 CT4\n", "2026 CT4"), ("     COMET  C/2026 A1 (MAPS)\n", "C/2026 A1 (MAPS)"),
    ("   C/2024 G3 (ATLAS)\n", "C/2024 G3 (ATLAS)"), ("   COMET  3I/ATLAS\n", "3I/ATLAS"), ("   COMET  1I/ʻOumuamua\n", "1I/ʻOumuamua"),
    ("   2I/Borisov\n", "2I/Borisov"), ("\n   M.P.E.C. 2026-D56\n\n   COMET  3I/ATLAS\n\n  text\n", "3I/ATLAS"), ("nothing here\n", None)])
def test_circular_designations(spark, text, want):
    assert value(spark, circular.circular_designation(F.lit(text))) == want


def test_circular_paths(spark):
    paths = [circular.circular_path(F.lit(x)) for x in ("2026-C105", "2026-C05", "1999-A359", "bad")]
    assert one(spark, *paths) == ("K26/K26CA5", "K26/K26C05", "J99/J99AZ9", None)


def test_elements(spark):
    text = "Epoch 2026 Jan. 1.0 TT\nM 12.5\na 2.0\ne 0.5   H 20.1   G 0.15  U 5\nEarth MOID = 0.0123 AU\nPeri. 10.5\nNode 20.5\nIncl. 3.25"
    e = value(spark, circular.parse_elements(F.lit(text)))
    assert (e.epoch, e.M, e.a, e.e, e.q, e.H, e.G, e.U, e.earth_moid, e.peri, e.node, e.incl) == \
        ("2026 Jan. 1.0", 12.5, 2.0, 0.5, 1.0, 20.1, 0.15, 5.0, 0.0123, 10.5, 20.5, 3.25)


def test_labels_and_formats(spark):
    assert one(spark, formats.elongation_bin_label(F.lit(1), 5), formats.elongation_bin_label(F.lit(-1), 5)) == \
        ("   5° to   10° E", "   0° to    5° W")
    xml = value(spark, formats.optical_xml({"trkSub": F.lit("a<b&c"), "ra": F.lit(1.5), "mag": F.lit(None).cast("double")}))
    assert xml == "<optical><trkSub>a&lt;b&amp;c</trkSub><ra>1.500000</ra></optical>"


def test_size_scales(spark):
    got = one(spark, orbit.h_to_diameter_km(F.lit(17.75)), orbit.diameter_km_to_h(F.lit(1.0)), orbit.diameter_km_to_h(F.lit(0.14)))
    assert [round(x, 2) for x in got] == [1.0, 17.75, 22.02]
