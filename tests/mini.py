"""Hand-built mini catalogue with the awkward rows in it."""

from datetime import datetime, timedelta

T0 = datetime(2024, 1, 10, 6, 0, 0)
H = timedelta(hours=1)
PACKED = "packed_primary_provisional_designation"
UNPACKED = "unpacked_primary_provisional_designation"

ORBITS = (f"{PACKED} string, {UNPACKED} string, q double, e double, i double, a double, h double, earth_moid double, "
          "orbit_type_int int")
NI = f"{PACKED} string, {UNPACKED} string, permid string, iau_name string"
CI = (f"{PACKED} string, {UNPACKED} string, packed_secondary_provisional_designation string, "
      "unpacked_secondary_provisional_designation string, numbered boolean, object_type int")
OBS = ("id int, obsid string, permid string, provid string, trkid string, trksub string, stn string, obstime timestamp_ntz, "
       "ra double, dec double, mag double, band string, disc string, status string, deprecated string, ref string, prev_ref string")
CODES = "obscode string, name string, longitude double, rhocosphi double, rhosinphi double, observations_type string"


def orbits(spark):
    return spark.createDataFrame([
        ("K24A00A", "2024 AA", 0.8, 0.5, 5.0, 1.6, 20.0, 0.01, 2),      # numbered 1001
        ("K24A00B", "2024 AB", 1.1, 0.3, 5.0, None, 17.0, None, None),  # plain
        ("K24A00C", "2024 AC", 1.31, 0.3, 5.0, None, 25.0, 0.2, None),  # only by the wide rule
        ("K24A00D", "2024 AD", 2.4, 0.1, 5.0, None, 15.0, None, 11),    # main belt
        ("K24A00E", "2024 AE", None, None, None, None, None, None, 20),  # only by type
        ("K24A00F", "2024 AF", 0.9, 1.2, 5.0, None, None, None, None),  # hyperbolic
    ], ORBITS)


def ni(spark):
    return spark.createDataFrame([("K24A00A", "2024 AA", "1001", "Mini")], NI)


def ci(spark):
    return spark.createDataFrame([
        ("K24A00A", "2024 AA", "K24A00A", "2024 AA", True, 0), ("K24A00A", "2024 AA", "K20X00X", "2020 XX", True, 0),
        ("K24A00B", "2024 AB", "K21Y00Y", "2021 YY", False, 0), ("K24A00B", "2024 AB", "K24A00B", "2024 AB", False, 0)], CI)


def obscodes(spark):
    return spark.createDataFrame([
        ("G96", "Mt. Lemmon Survey   ", 249.2, 0.845, 0.533, "optical"), ("C51", "WISE", None, None, None, "satellite"),
        ("Q01", "Obs\\'s place ", 10.0, 0.7, 0.7, "optical")], CODES)


def obs(spark):
    rows = []

    def add(permid=None, provid=None, trk=None, stn="G96", t=T0, ra=10.0, dec=5.0, mag=20.0, band="V", disc=None, status="P", deprecated=None, ref=None):
        k = len(rows) + 1
        rows.append((k, f"L{k:03d}", permid, provid, trk, None, stn, t, ra, dec, mag, band, disc, status, deprecated, ref, None))

    # 2024 AA: numbered, also under its designation; a row with both; two discovery rows at one time.
    add("1001", None, "t1", t=T0, ra=359.95, disc="*")                       # L001
    add("1001", "2024 AA", "t1", stn="Q01", t=T0, ra=0.05, disc="*")         # L002, loses the tie
    add(None, "2024 AA", "t1", t=T0 + 12 * H, ra=0.15, mag=None)             # L003, exactly 12 h: in
    add(None, "2024 AA", "t1", t=T0 + 12 * H + timedelta(seconds=1))         # L004, just beyond
    add(None, "2020 XX", "t9", t=T0 - timedelta(days=400))                   # L005, under an alias
    # 2024 AB: blank tracklet, single row.
    add(None, "2024 AB", "", t=T0 + H, band=None, mag=19.0, disc="*")        # L006
    add(None, "2024 AB", "t2", stn="C51", t=T0 + timedelta(days=200) + H)    # L007, exactly 200 d
    add(None, "2024 AB", "t2", stn="C51", t=T0 + timedelta(days=200, seconds=1) + H)  # L008, beyond
    add(None, "2024 AB", None, stn="Q01", t=T0 - timedelta(days=3), status="X")       # L009, before
    # 2024 AC, 2024 AE: only the wide rule; NULL tracklet.
    add(None, "2024 AC", None, t=T0, disc="*", band="")                      # L010
    add(None, "2024 AE", "t3", stn="C51", t=T0, disc="*")                    # L011
    add(None, "2024 AE", "t3", stn="C51", t=T0 + H, ra=11.0, dec=5.0, mag=21.0)        # L012
    # Main belt and unknown.
    add(None, "2024 AD", "t4", t=T0, disc="*")                               # L013
    add(None, "2030 ZZ", "t5", t=T0, deprecated="X")                         # L014
    add("", "2024 AB", "t6", t=T0 + 2 * H)                                   # L015, empty number
    return spark.createDataFrame(rows, OBS)
