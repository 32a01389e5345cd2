"""Operators on the mini catalogue and on generated data, against known or brute-force answers."""

from datetime import datetime, timedelta

import mini
import pytest
from pyspark.sql import functions as F

from asterion.operators import (apparition, boxscore, compare, consensus, discovery, filters, identity,
                                ordered, quality, quantiles, replicas, skytime, stations, summary, timeline)


def keyed(df, key, *cols):
    return {r[key]: (r[cols[0]] if len(cols) == 1 else tuple(r[c] for c in cols)) for r in df.collect()}


@pytest.fixture(scope="module")
def cat(spark):
    return {n: getattr(mini, n)(spark) for n in ("orbits", "ni", "ci", "obs", "obscodes")}


def product(cat, **kw):
    return discovery.discovery_tracklets(cat["orbits"], cat["ni"], cat["obs"], cat["obscodes"], **kw)


def test_product_rows_and_tracklets(cat):
    rows = {r.primary_designation: r for r in product(cat).collect()}
    assert set(rows) == {"1001", "2024 AB", "2024 AC", "2024 AE"}
    a = rows["1001"]
    assert a.discovery_site_code == "G96" and a.discovery_site_name == "Mt. Lemmon Survey"
    assert a.nobs == 3 and a.span_hours == 12.0          # the 12 h row is in, one second later is out
    assert a.median_v_magnitude == 20.0                  # the row without magnitude does not count
    assert a.rate_deg_per_day == pytest.approx(0.3985, abs=2e-4) and a.position_angle_deg == pytest.approx(90, abs=0.1)
    assert a.avg_ra_deg == pytest.approx((359.95 + 0.05 + 0.15) / 3, abs=1e-5)  # no wrap handling, by definition
    b = rows["2024 AB"]
    assert b.nobs == 1 and b.rate_deg_per_day is None and b.position_angle_deg is None and b.median_v_magnitude == 19.0
    assert rows["2024 AC"].median_v_magnitude == 19.2    # blank band
    assert rows["2024 AE"].discovery_site_name == "WISE"
    assert [r.primary_designation for r in discovery.designation_order(product(cat)).collect()] == \
        ["1001", "2024 AB", "2024 AC", "2024 AE"]


def test_rules(cat):
    assert set(keyed(product(cat, rule="iau"), "primary_designation", "nobs")) == {"1001", "2024 AB"}
    assert set(keyed(product(cat, rule="class"), "primary_designation", "nobs")) == {"1001"}


def test_discovery_tie_and_station(cat):
    neos = identity.with_numbering(filters.select_neos(cat["orbits"]), cat["ni"])
    assert keyed(identity.earliest_discovery(neos, cat["obs"]), "unpacked_desig", "obsid") == {"2024 AA": "L001", "2024 AB": "L006"}
    assert identity.match_by_designation(neos, cat["obs"]).where("unpacked_desig = '2024 AA'").count() == 3  # both ids of L002


def test_yearly_breakdown(cat):
    row = {r.stn: r for r in discovery.yearly_breakdown(cat["orbits"], cat["ni"], cat["obs"]).collect()}["G96"]
    assert (row.disc_year, row.neos, row.neos_1km, row.neos_h22, row.n_apollo, row.n_amor, row.n_unclass) == (2024, 2, 1, 2, 1, 1, 0)


def test_or_key_join_counts_each_observation_once(spark, cat):
    t = spark.createDataFrame([("2024 AA", "1001"), ("2024 AB", None)], "primary_desig string, permid string")
    rows = identity.or_key_join(t, cat["obs"], columns=["obsid"])
    assert rows.count() == rows.distinct().count()
    got = keyed(rows.groupBy("primary_desig").count(), "primary_desig", "count")
    assert got == {"2024 AA": 4, "2024 AB": 5}


def test_alias_semi_join(cat):
    got = {r.obsid for r in identity.alias_semi_join(cat["obs"], cat["orbits"], cat["ci"], cat["ni"]).collect()}
    assert got == {f"L{k:03d}" for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 15)}


def test_apparition_edges(cat):
    disc = apparition.discoveries(cat["orbits"], cat["ni"], cat["obs"])
    reach = {(r.designation, r.station_code): r for r in apparition.apparition_reach(disc, cat["obs"]).collect()}
    assert set(reach) == {("2024 AA", "G96"), ("2024 AA", "Q01"), ("2024 AB", "G96"), ("2024 AB", "C51"), ("2024 AB", "Q01")}
    assert reach["2024 AB", "Q01"].first_post_disc is None
    assert reach["2024 AB", "C51"].first_post_disc - reach["2024 AB", "C51"].disc_obstime == timedelta(days=200)
    trk = apparition.apparition_tracklets(disc, cat["obs"])
    assert trk.agg(F.sum("nobs")).first()[0] == 8
    sets = apparition.survey_sets(trk, survey="station_code", post_discovery_only=False)
    pairs = {(r.survey_i, r.survey_j): r.pct for r in apparition.pairwise_codetection(sets).collect()}
    assert pairs["G96", "C51"] == 50.0 and pairs["C51", "G96"] == 100.0
    regions = apparition.venn_regions(sets, surveys=["G96", "C51"])
    assert regions.agg(F.sum("n")).first()[0] == 2


def test_summaries(cat):
    s = keyed(summary.obs_summary_all(cat["obs"]), "primary_desig", "nobs", "disc_by")
    assert s["1001"] == (2, "G96") and s["2024 AA"] == (2, None) and s["2024 AB"] == (5, "G96")  # '' is no number


def test_resolution(spark, cat):
    d = spark.createDataFrame([("1001",), ("2020 XX",), ("2021 YY",), ("2099 ZZ",)], "n string")
    got = {r.mpec_desig: r for r in identity.resolve_alias(d, cat["ci"], cat["ni"], cat["orbits"], col="n").collect()}
    assert (got["1001"].primary_desig, got["1001"].iau_name, got["1001"].orbit_class) == ("2024 AA", "Mini", "Apollo")
    assert (got["2020 XX"].primary_desig, got["2020 XX"].permid, got["2020 XX"].is_secondary) == ("2024 AA", "1001", True)
    assert (got["2021 YY"].permid, got["2021 YY"].orbit_class) == (None, "Amor")
    assert got["2099 ZZ"].primary_desig is None and not got["2099 ZZ"].is_numbered
    raw = spark.createDataFrame([("1001",), ("K24A00B",), ("2024 AB",), ("C/2024 G3",), ("A/2019 Q2",), ("77777",), ("junk!",)], "raw string")
    c = {r.raw_string: r for r in identity.canonicalize(raw, cat["ni"], cat["orbits"], raw="raw").collect()}
    assert set(c) == {"1001", "K24A00B", "2024 AB", "C/2024 G3", "A/2019 Q2"}  # unknown number and junk are dropped
    assert c["1001"].primary_desig == "2024 AA" and c["1001"].orbit_in_mpc and c["K24A00B"].primary_desig == "2024 AB"
    assert c["C/2024 G3"].is_comet and not c["A/2019 Q2"].is_comet


def test_upsert_keeps_first_seen(spark):
    old = spark.createDataFrame([("s", "A", "p", "1", datetime(2020, 1, 1), datetime(2020, 1, 1), datetime(2020, 1, 1)),
                                 ("s", "B", "p", None, datetime(2020, 1, 1), datetime(2020, 1, 1), datetime(2020, 1, 1)),
                                 ("z", "A", "p", None, datetime(2020, 1, 1), datetime(2020, 1, 1), datetime(2020, 1, 1))],
                                "source string, primary_desig string, packed_desig string, permid string, first_seen timestamp_ntz, last_seen timestamp_ntz, last_refreshed timestamp_ntz")
    batch = spark.createDataFrame([("A", "q", None), ("C", "q", "3"), ("C", "q", "3")], "primary_desig string, packed_desig string, permid string")
    got = {(r.source, r.primary_desig): r for r in consensus.membership_upsert(old, batch, source="s", now="2021-01-01").collect()}
    assert len(got) == 4
    assert got["s", "A"].first_seen.year == 2020 and got["s", "A"].last_seen.year == 2021 and got["s", "A"].permid is None
    assert got["s", "B"].last_seen.year == 2020 and got["s", "C"].first_seen.year == 2021 and got["z", "A"].last_seen.year == 2020


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of all rows."""
    n = F.col("id")
    return spark.range(6000).select(
        n.alias("obsid"), F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (n % 40).cast("string"))).alias("k"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (n * 7919 % 30000).cast("int"))).alias("obstime"),
        ((n * 104729) % 36000 / 100.0).alias("ra"), F.when(n % 11 != 0, (n * 31 % 997) / 7.0).alias("v"))


def test_bucketed_windows_equal_plain_windows(skewed):
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy("obstime", "obsid")
    args = {"keys": ["k"], "order": ["obstime", "obsid"], "bucket": ordered.month_bucket("obstime")}
    d = ordered.with_previous(skewed, columns=["ra"], **args)
    d = ordered.with_running_sum(d, value=F.col("obsid") % 5, name="total", **args)
    d = ordered.with_carried(d, value="v", name="fwd", **args)
    d = ordered.with_carried(d, value="v", name="back", forward=False, **args)
    got = keyed(d, "obsid", "prev_ra", "total", "fwd", "back")
    full = w.rowsBetween(Window.unboundedPreceding, 0)
    want = keyed(skewed.select("obsid", F.lag("ra").over(w).alias("p"), F.sum(F.col("obsid") % 5).over(full).alias("t"),
                               F.last("v", True).over(full).alias("f"),
                               F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("b")), "obsid", "p", "t", "f", "b")
    assert got == want


@pytest.mark.parametrize("discrete", [False, True])
def test_exact_percentiles_equal_sorted_values(skewed, discrete):
    import math
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.percentiles(skewed, keys=["k"], wanted={f"p{i}": ("v", p) for i, p in enumerate(ps)}, discrete=discrete).collect()
    rows = {}
    for r in skewed.where("v IS NOT NULL").select("k", "v").collect():
        rows.setdefault(r.k, []).append(r.v)
    assert len(got) == len(rows)
    for r in got:
        vals = sorted(rows[r.k])
        for i, p in enumerate(ps):
            if discrete:
                want = vals[max(math.ceil(p * len(vals)) - 1, 0)]
            else:
                pos = p * (len(vals) - 1)
                lo = math.floor(pos)
                want = vals[lo] + (pos - lo) * (vals[math.ceil(pos)] - vals[lo])
            assert r[f"p{i}"] == pytest.approx(want, abs=1e-9)


def test_exact_percentiles_of_odd_groups(spark):
    d = spark.createDataFrame([(None, 1.0), (None, 3.0), ("one", 5.0), ("same", 2.0), ("same", 2.0), ("none", None), ("wild", -1e300), ("wild", 1.0), ("wild", 1e300)],
                              "k string, v double")
    got = keyed(quantiles.percentiles(d, keys=["k"], wanted={"m": ("v", 0.5)}), "k", "m")
    assert got == {None: 2.0, "one": 5.0, "same": 2.0, "wild": 1.0}
    assert quantiles.percentiles(d.where("k = 'none'"), keys=[], wanted={"m": ("v", 0.5)}).count() == 0


def test_order_keys_are_the_bits_of_the_doubles(spark):
    import math
    import random
    import struct
    r = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, float("inf"), -float("inf"), 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 1 / 3]
    values += [f(2.0 ** k) for k in range(-1022, 1024, 9) for f in (lambda x: x, lambda x: math.nextafter(x, 0), lambda x: -math.nextafter(x, math.inf))]
    values += [v for v in (struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0] for _ in range(3000)) if v == v]
    bits = lambda x: struct.unpack("q", struct.pack("d", abs(x)))[0]
    got = quantiles.with_order_key(spark.createDataFrame([(v,) for v in values], "v double"), "v", "k").collect()
    assert all(r.k == (-bits(r.v) if r.v < 0 else bits(r.v)) for r in got)


def test_percentiles_read_the_source_three_times_without_nested_loops(spark, tmp_path):
    """Many columns and fractions share the rounds; two keys, NULL among them; values that differ in the last bit."""
    import math
    base = [(k % 3 if k % 7 else None, "x", 1.0 + k * 2.0 ** -52, -float(k) if k % 5 else None) for k in range(500)]
    spark.createDataFrame(base, "k long, s string, a double, b double").write.parquet(str(tmp_path / "t"))
    d = spark.read.parquet(str(tmp_path / "t"))
    wanted = {f"{c}{p}": (c, p) for c in ("a", "b") for p in (0.0, 0.3, 0.5, 0.99)}
    for keys in ([], ["k", "s"]):
        got = quantiles.percentiles(d, keys=keys, wanted=wanted, discrete=True)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("FileScan") == 3 and "NestedLoop" not in plan and "Cartesian" not in plan
        rows = {}
        for k, s, a, b in base:
            rows.setdefault((k, s) if keys else (), []).append((a, b))
        have = {tuple(r[:len(keys)]): r for r in got.collect()}
        assert set(have) == set(rows)
        for key, values in rows.items():
            for name, (c, p) in wanted.items():
                v = sorted(x["ab".index(c)] for x in values if x["ab".index(c)] is not None)
                assert have[key][name] == v[max(math.ceil(p * len(v)) - 1, 0)]


def brute_segments(rows, step, limit, sun):
    """Grid walk for one object: rows of (time, ra, dec) in time order."""
    day0 = rows[0][0].replace(hour=0, minute=0, second=0, microsecond=0)
    end = rows[-1][0].replace(hour=0, minute=0, second=0, microsecond=0) + timedelta(days=1)
    grid, flags = [], []
    t = day0
    while t <= end:
        before = [r for r in rows if r[0] <= t]
        after = [r for r in rows if r[0] >= t]
        pick = before[-1] if before and (not after or t - before[-1][0] < after[0][0] - t) else after[0]
        grid.append(t)
        flags.append(sun(t, pick[1], pick[2]) > limit)
        t += timedelta(days=step)
    out, s = [], 0
    for k in range(1, len(grid) + 1):
        if k == len(grid) or flags[k] != flags[s]:
            out.append((grid[s], grid[k] if k < len(grid) else grid[-1], flags[s]))
            s = k
    return out


def test_observability_segments_equal_a_walk_over_the_grid(spark, skewed):
    from math import acos, asin, atan2, cos, degrees, floor, radians, sin

    def sun(t, ra, dec):
        jd = floor((t - datetime(1970, 1, 1)).total_seconds()) / 86400 + 2440587.5
        c = (jd - 2451545.0) / 36525
        l0 = 280.46646 + 36000.76983 * c + 0.0003032 * c * c
        m = radians(357.52911 + 35999.05029 * c - 0.0001537 * c * c)
        eq = (1.914602 - 0.004817 * c - 0.000014 * c * c) * sin(m) + (0.019993 - 0.000101 * c) * sin(2 * m) + 0.000289 * sin(3 * m)
        lon, eps = radians(l0 + eq), radians(23.43929111 - 0.0130041667 * c)
        sr, sd = atan2(cos(eps) * sin(lon), cos(lon)), asin(sin(eps) * sin(lon))
        r, d = radians(ra), radians(dec)
        return degrees(acos(max(-1, min(1, sin(d) * sin(sd) + cos(d) * cos(sd) * cos(r - sr)))))

    d = skewed.where("obsid % 13 = 0").withColumn("dec", F.col("obsid") % 60 - F.lit(30.0))
    got = {}
    for r in timeline.observability_segments(d, key="k", step_days=3).collect():
        got.setdefault(r.k, []).append((r.x0, r.x1, r.is_above))
    rows = {}
    for r in d.orderBy("obstime", "obsid").collect():
        rows.setdefault(r.k, []).append((r.obstime, r.ra, r.dec))
    assert set(got) == set(rows)
    for k in rows:
        assert sorted(got[k]) == brute_segments(rows[k], 3, 90.0, sun), k


def test_arcs(spark):
    t = datetime(2020, 1, 1)
    d = spark.createDataFrame([(1, "x", t, 10.0), (2, "x", t + timedelta(days=60), 20.0), (3, "x", t + timedelta(days=121), 350.0),
                               (4, "x", t + timedelta(days=122), 10.0)], "obsid int, k string, obstime timestamp_ntz, ra double")
    assert [(r.arc_id, r.n) for r in timeline.segment_arcs(d, key="k").orderBy("arc_id").collect()] == [(0, 2), (1, 2)]
    # Seen from longitude 0 the jump from 350 to 10 degrees crosses no edge, from 180 it does.
    assert timeline.segment_arcs(d, key="k", ra="ra", center=0.0).count() == 2
    assert timeline.segment_arcs(d, key="k", ra="ra", center=180.0).count() == 3


def test_arcs_in_one_pass_equal_a_walk(spark, skewed, tmp_path):
    skewed.select("k", "obsid", "obstime", (F.col("obsid") * 37 % 360).cast("double").alias("ra")).write.parquet(str(tmp_path / "t"))
    d = spark.read.parquet(str(tmp_path / "t"))
    for ra in (None, "ra"):
        got = timeline.segment_arcs(d, key="k", gap_days=2.0, ra=ra)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2
        want, rows = {}, {}
        for r in d.orderBy("obstime", "obsid").collect():
            rows.setdefault(r.k, []).append(r)
        centred = lambda x: (x - 180 + 180) % 360 - 180
        for k, v in rows.items():
            arc, before = 0, None
            for r in v:
                if before is not None and (r.obstime - before.obstime > timedelta(days=2) or ra and abs(centred(r.ra) - centred(before.ra)) > 180):
                    arc += 1
                first, _, n = want.get((k, arc), (r.obstime, None, 0))
                want[k, arc], before = (first, r.obstime, n + 1), r
        assert {(r.k, r.arc_id): (r.start, r.end, r.n) for r in got.collect()} == want and len(want) > len(rows)


def test_nearest_in_time_with_a_hot_station(spark):
    """Nine tenths of the rows on one station and month; repeated, missing and far instants."""
    import random
    r = random.Random(6)
    base = datetime(2024, 1, 1)
    rows = [(k, "hot" if k % 10 else f"s{k % 30}", base + timedelta(seconds=r.randint(0, 28 * 86400) if k % 10 else r.randint(0, 400 * 86400)), float(k)) for k in range(4000)]
    rows += [(4000, None, base, 0.0), (4001, "hot", None, 0.0), (4002, "tie", base, 1.0), (4003, "tie", base + timedelta(hours=2), 2.0), (4004, "tie", base + timedelta(hours=2), 3.0)]
    obs = spark.createDataFrame(rows, "obsid int, stn string, obstime timestamp_ntz, v double")
    asked = [(s, base + timedelta(seconds=r.randint(-10 * 86400, 420 * 86400))) for s in ("hot", "s0", "s10", "nobody") for _ in range(60)]
    asked += [("hot", t) for _, s, t, _ in rows[1:40] if s == "hot"] + [("tie", base + timedelta(hours=1)), ("tie", base + timedelta(hours=2)), ("hot", None), (None, base), ("hot", asked[0][1])]
    grid = spark.createDataFrame(asked, "stn string, obstime timestamp_ntz")
    got = sorted(map(str, timeline.nearest_in_time(grid, obs, key="stn", time="obstime", columns=["v"]).collect()))
    want = []
    for s, t in asked:
        mine = [(x[2], str(x[0]), x[3]) for x in rows if s is not None and t is not None and x[1] == s and x[2] is not None]
        before, after = max([x for x in mine if x[0] < t], default=None), min([x for x in mine if x[0] >= t], default=None)
        pick = after if before is None else before if after is None or t - before[0] < after[0] - t else after
        want.append((s, t, pick and pick[0], pick and pick[2]))
    names = ["stn", "obstime", "nearest_obstime", "v"]
    assert got == sorted(map(str, spark.createDataFrame(want, "stn string, obstime timestamp_ntz, nearest_obstime timestamp_ntz, v double").toDF(*names).collect()))


def test_eclipse_phases(spark):
    ecl = skytime.lunar_eclipses(spark)
    assert ecl.count() == 87
    times = ["2000-01-21 02:04:00", "2000-01-21 03:30:00", "2000-01-21 04:44:00", "2000-01-21 07:23:00", "2000-01-21 07:23:01", "2003-11-10 00:30:00"]
    rows = [(k, datetime.fromisoformat(t), alt, sat) for k, t in enumerate(times) for alt, sat in ((10.0, False), (-1.0, False), (None, True))]
    d = spark.createDataFrame([(f"{k}{a}{s}", t, a, s) for k, t, a, s in rows], "obsid string, obstime timestamp_ntz, moon_alt double, is_satellite boolean")
    got = keyed(skytime.eclipse_overlap(d, ecl), "obsid", "eclipse_class", "eclipse_date")
    names = ["Penumbral eclipse", "Partial eclipse", "Total eclipse", "Penumbral eclipse", "", "Partial eclipse"]
    for k, want in enumerate(names):
        assert got[f"{k}10.0False"][0] == want == got[f"{k}NoneTrue"][0] and got[f"{k}-1.0False"] == ("", "")
    assert got["510.0False"][1] == "2003-11-10"


def test_model_interpolation(spark):
    model = spark.createDataFrame([(21.75, 18100.0), (22.25, 24900.0)], "h2 double, n_cum double")
    pts = spark.createDataFrame([(22.0,), (21.9,), (30.0,)], "h double")
    assert keyed(boxscore.model_at(pts, model), "h", "model_n") == {22.0: 21500.0, 21.9: 20140.0, 30.0: None}


def test_indicators(spark):
    d = spark.createDataFrame([(10, None, "0"), (10, 0, "0"), (10, 10, ""), (0, 5, ">>>"), (0, 3, ">>"), (0, 1, ">"), (1000, 1005, ""), (100, 130, ">>>"),
                               (100, 106, ">>"), (100, 102, ">"), (100, 70, "<<<"), (100, 94, "<<"), (100, 98, "<")], "l int, c int, want string")
    assert all(r.got == r.want for r in d.select("want", boxscore.count_indicator("l", "c").alias("got")).collect())


def test_fingerprint_is_free_of_order_and_partitioning(skewed):
    a = replicas.snapshot_fingerprint(skewed, key="obsid", time="obstime").first()
    b = replicas.snapshot_fingerprint(skewed.repartition(17).orderBy(F.desc("ra")), key="obsid", time="obstime").first()
    c = replicas.snapshot_fingerprint(skewed.where("obsid <> 5"), key="obsid", time="obstime").first()
    assert a == b and a.content_hash != c.content_hash


def test_histogram_totals(skewed):
    h = quality.histogram(skewed, col="ra", n=10)
    assert h.agg(F.sum("count")).first()[0] == 6000


def test_station_report_and_site(cat):
    near = cat["obs"].where("provid = '2024 AB'")
    rep = stations.station_report(cat["obs"], near, cat["orbits"], site="G96")
    assert {(r.obs_year, r.is_neo, r.orbit_class): r.obs_count for r in rep.collect()} == {
        (2024, True, "Amor"): 2, (2024, False, "Apollo"): 2, (2024, False, "Unclassified"): 2, (2022, False, "Unclassified"): 1,
        (2024, False, "Main Belt"): 1, (2024, False, "Mars Crosser"): 1}
    d = discovery.with_site(cat["obs"], cat["obscodes"]).where("stn = 'Q01'").first()
    assert d.site_name == "Obs's place" and d.latitude == pytest.approx(45.0)


def test_discovery_scan_is_pushed_down(spark, cat, tmp_path):
    path = str(tmp_path / "obs")
    cat["obs"].write.parquet(path)
    d = product({**cat, "obs": spark.read.parquet(path)})
    plan = d._jdf.queryExecution().toString()
    assert "EqualTo(disc,*)" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_discovery_survives_a_hot_key(spark, cat):
    """A third of the catalogue's observations, and a reused tracklet id, on one object."""
    many = spark.range(3000).select(
        (F.col("id") + 1000).cast("int").alias("id"), F.concat(F.lit("Z"), F.col("id").cast("string")).alias("obsid"), F.lit("1001").alias("permid"),
        F.lit("2024 AA").alias("provid"), F.lit("t1").alias("trkid"), F.lit(None).cast("string").alias("trksub"), F.lit("G96").alias("stn"),
        (F.lit(mini.T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int") + 13)).alias("obstime"), F.lit(1.0).alias("ra"), F.lit(1.0).alias("dec"),
        F.lit(20.0).alias("mag"), F.lit("V").alias("band"), F.lit("*").alias("disc"), F.lit("P").alias("status"), F.lit(None).cast("string").alias("deprecated"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("string").alias("prev_ref"))
    got = product({**cat, "obs": cat["obs"].unionByName(many)}).where("primary_designation = '1001'").first()
    assert got == product(cat).where("primary_designation = '1001'").first()


@pytest.mark.parametrize("key", ["obsid", "obstime", "k"])
def test_replica_diff_equals_except_all(spark, skewed, tmp_path, key):
    """Inserts, deletes, twins, changed values, NULL keys; by number, by time and by hash."""
    a = skewed.select("obsid", "obstime", "k", "ra").withColumn("ra", F.when(F.col("obsid") % 50 != 0, F.col("ra")))
    b = a.where("obsid <> 17").unionAll(a.where("obsid IN (30, 31)")).withColumn("ra", F.when(F.col("obsid") == 40, -1.0).otherwise(F.col("ra")))
    b = b.unionAll(a.where("obsid = 3").withColumn(key, F.lit(None).cast(a.schema[key].dataType)))
    for d, name in ((a, "a"), (b, "b")):
        d.repartitionByRange(16, "obsid").sortWithinPartitions("obsid").write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / x)) for x in "ab")
    want = a.exceptAll(b).withColumn("side", F.lit("a")).unionAll(b.exceptAll(a).withColumn("side", F.lit("b")))
    got = replicas.replica_diff(a, b, key=key)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count() == 6
    cut = replicas.Ranges(a, b, key)
    differing = replicas.differing_ranges(cut.tree(a), cut.tree(b), cut.fine)
    assert len(differing) <= 5
    if key != "k":
        assert 0 < cut.rows(a, differing).count() < a.count() / 100
    everywhere = replicas.replica_diff(a, b.where("obsid % 3 <> 1"), key=key)
    assert everywhere.where("side = 'a'").count() == a.exceptAll(b.where("obsid % 3 <> 1")).count() and everywhere.count() > 100
    assert replicas.replica_diff(a, a, key=key).count() == 0 and replicas.replica_diff(a.limit(0), a.limit(0), key=key).count() == 0


def test_ranges_that_differ_are_filtered_in_the_scan(spark, tmp_path):
    spark.range(100_000).withColumn("v", F.col("id") * 2).repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    b = a.withColumn("v", F.when(F.col("id") == 777, -1).otherwise(F.col("v")))
    cut = replicas.Ranges(a, b, "id")
    rows = cut.rows(a, replicas.differing_ranges(cut.tree(a), cut.tree(b), cut.fine))
    assert rows.count() <= 25 and "PushedFilters: [GreaterThanOrEqual(id," in rows._jdf.queryExecution().executedPlan().toString().replace("IsNotNull(id), ", "")


def test_rows_without_a_key_are_not_shuffled(spark):
    """Nine rows in ten lack a key; each is given once, and the lookups see none of them."""
    rows = [(k, str(k) if k % 10 == 0 else None, f"D{k}" if k % 10 == 5 or k % 20 == 0 else None) for k in range(400)]
    obs = spark.createDataFrame(rows, "obsid int, permid string, provid string")
    keys = spark.createDataFrame([("permid", str(k)) for k in range(0, 200, 10)] + [("provid", f"D{k}") for k in range(100, 300)] + [("permid", None), ("permid", "0")], "kind string, key string")
    got = identity.semi_join_keys(obs, keys)
    want = {k for k, perm, prov in rows if perm is not None and k < 200 or prov is not None and 100 <= k < 300}
    assert sorted(r.obsid for r in got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and plan.count("isnotnull(permid") >= 1 and plan.count("isnotnull(provid") >= 1
    cat = {n: getattr(mini, n)(spark) for n in ("ci", "ni", "orbits")}
    named = spark.createDataFrame([(x,) for x in ["1001", "2020 XX", "2024 AB", "2099 ZZ", None, None]], "d string")
    out = identity.resolve_alias(named, **cat, col="d")
    assert sorted(map(tuple, out.select("mpec_desig", "primary_desig", "permid", "is_secondary", "is_numbered").collect()), key=str) == sorted([
        ("1001", "2024 AA", "1001", False, True), ("2020 XX", "2024 AA", "1001", True, True), ("2024 AB", "2024 AB", None, False, False),
        ("2099 ZZ", None, None, False, False), (None, None, None, False, False), (None, None, None, False, False)], key=str)
    entries = spark.createDataFrame([("K24A00A", True, "1001", 1.0), ("K24A00B", False, None, 2.0), ("x", True, None, 3.0), (None, False, None, 4.0), ("y", True, "77", 5.0)],
                                    "packed_desig string, is_numbered boolean, number string, h_list double")
    matched, only_list, only_catalog = compare.match_catalog(entries, cat["orbits"], cat["ni"])
    assert {r.h_list for r in matched.collect()} == {1.0, 2.0} and {r.h_list for r in only_list.collect()} == {3.0, 4.0, 5.0} and only_catalog.count() == 4


def test_factorised_sides_are_linear_and_expand_to_the_pairs(spark):
    """One candidate holds most rows of both tables."""
    from asterion.operators import factorised, neocp
    t = datetime(2024, 1, 1)
    prev = spark.createDataFrame([("hot", None, "lost"), ("b", "x", None), ("quiet", None, None)], "desig string, iau_desig string, status string")
    archive = spark.createDataFrame([("hot" if k % 10 else "b", f"line {k % 50}", None if k % 3 else 0.5, 1.0, t + timedelta(days=k)) for k in range(300)] + [("quiet", "l", 0.1, 0.1, t)],
                                    "desig string, obs80 string, rmsra double, rmsdec double, created_at timestamp_ntz")
    events = spark.createDataFrame([("hot" if k % 7 else "b", f"E{k % 4}", "text", None, t + timedelta(hours=5 * k)) for k in range(200)] + [("other", "E", "t", "u", t)],
                                   "desig string, event_type string, event_text string, event_user string, created_at timestamp_ntz")
    a, e = neocp.lifecycle_sides(prev, archive, events, size=16)
    assert (a.agg(F.sum("n"), F.max("n")).first(), e.agg(F.sum("n"), F.max("n")).first()) == ((300, 16), (200, 16))
    both = factorised.linear(a, e, key="desig")
    assert both.count() == a.count() + e.count() <= 500 / 16 + 4
    got = factorised.expand(a, e, key="desig")
    want = neocp.lifecycle(prev, archive, events).select(got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
