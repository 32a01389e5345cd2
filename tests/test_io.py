"""Readers, writers, streams, jobs and SQL functions."""

from datetime import datetime, timedelta
from pathlib import Path

import mini
import pytest
from pyspark.sql import Observation, functions as F

from asterion import sql, storage
from asterion.operators import identity
from asterion.plans import refresh
from asterion.sinks import writers
from asterion.sources import readers
from asterion.sources.schemas import SCHEMAS
from asterion.streaming import streams


def lines(path):
    return [x for f in sorted(path.glob("part-*")) for x in f.read_text().splitlines()]


def test_every_table_has_a_schema_that_reads_back(spark, tmp_path):
    assert len(SCHEMAS) == 20
    for name, ddl in SCHEMAS.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
        assert readers.read_table(spark, str(tmp_path), name).schema == spark.createDataFrame([], ddl).schema


def test_csv_table(spark, tmp_path):
    (tmp_path / "obs_alterations_deletions.csv").write_text(
        'id,obsid,publication_ref,status,created_at,updated_at\n1,L1,"{MPS 1,MPS 2}",0,2024-01-01 00:00:00,2024-01-01 00:00:00\n')
    assert readers.read_table(spark, str(tmp_path), "obs_alterations_deletions", format="csv").first().publication_ref == ["MPS 1", "MPS 2"]


def test_fixed_width_list(spark, tmp_path):
    def line(packed, h, e, a, name):
        s = f"{packed:<7} {h:>5} {'0.15':>5} K24AH {'10.5':>9}  {'20.5':>9}  {'30.5':>9}  {'5.25':>9}  {e:>9} {'0.5':>11} {a:>11}"
        return f"{s:<166}{name}"
    (tmp_path / "list.txt").write_text("\n".join([line("00433", "10.4", "0.2229", "1.4583", "(433) Eros"), line("K24Y04R", "99.9", "1.5000", "2.0000", "2024 YR4"),
                                                  "", "short line", line("~0fr6", "20.0", "x", "2.0", "(780896)")]) + "\n")
    got = {r.packed_desig: r for r in readers.read_mpcorb(spark, str(tmp_path / "list.txt")).collect()}
    assert got["00433"].number == "433" and got["00433"].q == pytest.approx(1.4583 * (1 - 0.2229)) and got["00433"].h == 10.4
    assert got["K24Y04R"].unpacked_desig == "2024 YR4" and got["K24Y04R"].h is None and got["K24Y04R"].q is None
    assert got["~0fr6"].number == "780896" and got["~0fr6"].e is None


def test_gz_catalogue_counts_what_it_skips(spark, tmp_path):
    import gzip
    row = lambda num, name, e, a: f"{num:>6} {name:<18}".ljust(158) + f"{e:>10} {a:>12}"
    with gzip.open(tmp_path / "orb.gz", "wt") as f:
        f.write("\n".join([row("433", "Eros", "0.22290000", "1.45830000"), row("", "2024 YR4", "0.66000000", "2.52000000"), row("5", "Astraea", "0.19000000", "2.57000000"),
                           row("6", "bad", "none", "2.5"), row("7", "hyper", "1.20000000", "0.50000000")]) + "\n")
    seen = Observation("scan")
    got = readers.read_astorb(spark, str(tmp_path / "orb.gz"), observation=seen)
    assert {r.raw for r in got.collect()} == {"433", "2024 YR4"}
    assert seen.get["n_lines"] == 5 and seen.get["n_skipped"] == 1


def test_ades_file_round_trip(spark, tmp_path):
    d = mini.obs(spark).withColumnsRenamed({"obsid": "obsID", "obstime": "obsTime"}).select("obsID", "stn", "obsTime", "ra", "mag", "band", "disc")
    writers.write_ades_xml(d.coalesce(1), str(tmp_path / "x"))
    text = "\n".join(lines(tmp_path / "x"))
    assert text.startswith("<?xml") and 'ades version="2022"' in text and "<mag></mag>" not in text
    back = {r.obsID: r for r in readers.read_ades_xml(spark, str(tmp_path / "x")).collect()}
    assert len(back) == 15 and back["L003"].mag is None and back["L001"].ra == 359.95


def test_psv_has_header_first_and_time_order(spark, tmp_path):
    d = mini.obs(spark)
    writers.write_psv(d, str(tmp_path / "p"), fields={"stn": "stn", "ra": "ra", "obsTime": F.col("obstime").cast("string")}, order="obstime")
    out = lines(tmp_path / "p")
    assert out[0] == "# version=2022" and out[1] == "" and out[2].startswith(" permID|") and len(out) == 18
    times = [x.split("|")[5].strip() for x in out[3:]]
    assert times == sorted(times) and len({len(x) for x in out[3:]}) == 1


def test_alias_file(spark, tmp_path):
    lists = identity.alias_lists(mini.ci(spark), mini.ni(spark))
    writers.write_alias_links(lists, str(tmp_path / "n"), kind="numbered")
    writers.write_alias_links(lists, str(tmp_path / "u"), kind="unnumbered")
    assert lines(tmp_path / "n") == ['"01001": ["K20X00X","K24A00A"],'] and lines(tmp_path / "u") == ['"K24A00B": ["K21Y00Y"],']


def test_obs80_file(spark, tmp_path):
    base = "     K24Y04R* C2024 12 {}.23807308 56 40.968-00 16 11.93         17.3 oV     W68"
    d = spark.createDataFrame([(base.format(28), 0.5, 0.5), (base.format(27), None, 1.0)], "obs80 string, rmsra double, rmsdec double")
    writers.write_obs80(d, str(tmp_path / "o"))
    out = lines(tmp_path / "o")
    assert out[0] == base.format(27) and out[1][56:65] == " 500 500m"


def test_snapshots_are_committed_reused_and_aged(spark, tmp_path):
    p = str(tmp_path / "snap")
    assert storage.latest(spark, p) is None
    storage.write_snapshot(spark.range(3), p)
    assert storage.write_snapshot(spark.range(9), p, max_age_seconds=3600).count() == 3
    assert storage.write_snapshot(spark.range(9), p, max_age_seconds=0).count() == 9
    half = tmp_path / "snap" / "v=99999999999999999999"
    half.mkdir()  # a version whose writer was lost has no marker and does not count
    assert storage.latest(spark, p).count() == 9


def feed(d, path, n):
    d.coalesce(1).write.mode("append").parquet(path)
    return n


def test_incremental_product_equals_full_rebuild(spark, tmp_path):
    cat = {n: getattr(mini, n)(spark) for n in ("orbits", "ni", "obs", "obscodes")}
    src, out = str(tmp_path / "in"), str(tmp_path / "table")
    parts = [cat["obs"].where("id % 3 = 0"), cat["obs"].where("id % 3 = 1"), cat["obs"].where("id % 3 = 2")]
    for k, part in enumerate(parts):
        feed(part, src, k)
        step = lambda known, batch: streams.known_set_increment(known, batch, cat["orbits"], cat["ni"], spark.read.parquet(src), cat["obscodes"])
        q = streams.maintain(streams.read_stream(spark, src, cat["obs"].schema), out, step, checkpoint=str(tmp_path / "cp"))
        q.trigger(availableNow=True).start().awaitTermination()
    from asterion.operators.discovery import discovery_tracklets
    want = discovery_tracklets(cat["orbits"], cat["ni"], cat["obs"], cat["obscodes"])
    got = storage.latest(spark, out)
    assert len(storage.versions(spark, out)) == 3 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_retried_batch_is_not_applied_twice(spark, tmp_path):
    p = str(tmp_path / "t")
    one = spark.createDataFrame([("U1", "G96", datetime(2024, 1, 1), "a", "*")], "provid string, stn string, obstime timestamp_ntz, trkid string, disc string")
    for batch_id in (0, 1, 1):
        earlier = [x for v, x in storage.versions(spark, p) if v < batch_id]
        previous = spark.read.parquet(earlier[-1]) if earlier else None
        storage.write_version(streams.detection_daily_step(previous, one), p, version=batch_id)
    assert storage.latest(spark, p).first().n_obs == 2


def test_stream_drops_repeats(spark, tmp_path):
    d = mini.obs(spark).withColumn("created_at", F.col("obstime"))
    src = str(tmp_path / "in")
    feed(d, src, 0), feed(d, src, 1)
    q = streams.new_discoveries(streams.read_stream(spark, src, d.schema, max_files=1), late="1000 days").writeStream.format("parquet") \
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.obsid for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["L001", "L002", "L006", "L010", "L011", "L013"]


def test_windowed_stream(spark, tmp_path):
    d = mini.obs(spark)
    src = str(tmp_path / "in")
    feed(d, src, 0)
    feed(d.limit(1).withColumn("obstime", F.lit("2030-01-01").cast("timestamp_ntz")), src, 1)
    q = streams.detection_daily(streams.read_stream(spark, src, d.schema, max_files=1)).writeStream.format("parquet").option(
        "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.provid, r.stn, str(r.obs_date)): r.n_obs for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["2024 AE", "C51", "2024-01-10"] == 2


def test_product_job(spark, tmp_path):
    from asterion.operators.discovery import discovery_tracklets
    from asterion.plans import discovery as job
    cat = [getattr(mini, n)(spark) for n in ("orbits", "ni", "obs", "obscodes")]
    got = job.run_discovery_product(*cat, str(tmp_path / "p"), min_rows=4)
    want = discovery_tracklets(*cat)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        job.run_discovery_product(*cat, str(tmp_path / "q"), min_rows=5)
    near = job.near_earth_subset(cat[2], cat[0], cat[1], mini.ci(spark), str(tmp_path / "n"))
    assert near.count() == 10 and set(near.columns) - set(cat[2].columns) == {"obs_year"}


def test_refresh_from_a_list(spark):
    members = spark.createDataFrame([], SCHEMAS["source_membership"])
    raw = spark.createDataFrame([("1001",), ("2024 AB",), ("nonsense",)], "raw string")
    got = refresh.refresh_source(members, raw, mini.ni(spark), mini.orbits(spark), source="x", now="2024-05-01")
    assert {(r.primary_desig, r.permid) for r in got.collect()} == {("2024 AA", "1001"), ("2024 AB", None)}
    assert [r.raw for r in refresh.unresolved(raw, mini.ni(spark), mini.orbits(spark)).collect()] == ["nonsense"]


def test_run_ledger(spark, tmp_path):
    p = str(tmp_path / "runs")
    streams.append_run(streams.run_row(spark, source="a", started_at="2024-01-01 00:00:00", status="running"), p)
    streams.append_run(streams.run_row(spark, source="a", started_at="2024-01-01 00:00:00", status="ok", finished_at="2024-01-01 00:05:00", n_rows=3), p)
    streams.append_run(streams.run_row(spark, source="a", started_at="2024-01-02 00:00:00", status="running"), p)
    assert {(str(r.started_at)[:10], r.status) for r in streams.ledger(spark.read.parquet(p)).collect()} == {("2024-01-01", "ok"), ("2024-01-02", "running")}


def test_sql_functions_equal_the_column_builders(spark):
    from asterion.functions import designation as D, obs80, orbit, photometry, sky, timeconv
    names = sql.register(spark)
    assert len(names) == len(sql.scalar_functions()) + 1
    d = spark.createDataFrame([("K24Y04R", "2024 12 27.238073", "08 56 40.968", "-00 16 11.93", "o", 0.8, 0.5, 5.0, "612345"),
                               ("~0fr6", "bad", "x", "+10 10 10.0", None, 1.5, 0.3, 20.0, "433"), ("00433", "2024 1 2.5", "1 2 3", "-89 59 59.9", "", None, 0.3, 20.0, "780896")],
                              "p string, t string, ra string, dec string, b string, q double, e double, i double, n string")
    d.createOrReplaceTempView("sql_probe")
    got = spark.sql("SELECT unpack_designation(p) u, mpc_date_to_timestamp(t) t, ra_hms_to_deg(ra) ra, dec_dms_to_deg(dec) dec, mpc_band_to_ades(b) b, to_v(20D, b) v, "
                    "classify_orbit(q, e, i) c, classify_orbit_label(q, e, i) l, packnum(n) n, is_pha(q, e, 20D) pha, mpc_date_to_iso8601(t) iso FROM sql_probe").collect()
    want = d.select(D.unpack_designation("p", tilde=False).alias("u"), timeconv.mpc_date_to_timestamp("t").alias("t"), sky.ra_hms_to_deg("ra").alias("ra"),
                    sky.dec_dms_to_deg("dec").alias("dec"), obs80.band_to_ades("b").alias("b"), photometry.to_v(F.lit(20.0), "b").alias("v"),
                    orbit.classify_orbit("q", "e", "i").alias("c"), orbit.orbit_label(orbit.classify_orbit("q", "e", "i")).alias("l"), D.pack_number("n").alias("n"),
                    orbit.is_pha("q", "e", F.lit(20.0)).alias("pha"), timeconv.mpc_date_to_iso8601("t").alias("iso")).collect()
    assert got == want
    line = "     K24Y04R* C2024 12 27.23807308 56 40.968-00 16 11.93         17.3 oV     W68"
    d = spark.createDataFrame([(line, 0.12, 0.5), (line, 12.0, 0.25), (line, 1.5, 0.25), (line, None, 1.0), ("short", None, None)], "s string, a double, b double")
    d.createOrReplaceTempView("line_probe")
    got = spark.sql("SELECT parse_obs80(s) p, format_obs80_with_uncertainty(s, a, b) f FROM line_probe").collect()
    assert got == d.select(obs80.decode_obs80("s").alias("p"), obs80.splice_uncertainty("s", "a", "b").alias("f")).collect()


def test_sql_table_function(spark):
    from asterion.operators import skytime
    mini.obs(spark).createOrReplaceTempView("obs_sbn")
    sql.register_table_functions(spark)
    got = spark.sql("SELECT count(*) n, min(signed_elongation) lo FROM solar_elongation('G96', DATE'2024-01-01', DATE'2024-01-31')").first()
    want = skytime.daily_sun_join(mini.obs(spark).where("stn = 'G96'"), start="2024-01-01", end="2024-01-31").count()
    assert got.n == want and -180 <= got.lo <= 180
    hist = spark.sql("SELECT * FROM solar_elongation_histogram('G96', DATE'2024-01-01', DATE'2024-01-31', 5) ORDER BY bin_num")
    frame = skytime.solar_elongation_histogram(mini.obs(spark), station="G96", start="2024-01-01", end="2024-01-31")
    assert {tuple(r) for r in hist.drop("bin_num").collect()} == {tuple(r) for r in frame.collect()}


def folders(table):
    return {b: tuple(d) for b, d in table.manifest().items()}


def test_bucket_table_writes_what_a_batch_touches(spark, tmp_path):
    from asterion.bucketed import BucketTable, replace_by_key
    t = BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    assert t.read() is None and t.lookup(spark.range(1).withColumnRenamed("id", "k")) is None
    d = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    t.merge(d(0, 200, "a"), replace_by_key(["k"]), 0)
    before = folders(t)
    t.merge(d(5, 6, "b"), replace_by_key(["k"]), 1)
    after = folders(t)
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1  # the others go on by reference
    size = lambda dirs: sum(f.stat().st_size for x in dirs for f in Path(x).glob("*.parquet"))
    changed = [b for b in before if before[b] != after[b]]
    assert size(after[changed[0]]) < sum(size(x) for x in after.values()) / 4
    for _ in range(2):  # a batch that is tried again replaces itself
        t.merge(d(7, 8, "c").union(d(300, 301, "new")), replace_by_key(["k"]), 2)
    want = {k: "a" for k in range(200)} | {5: "b", 7: "c", 300: "new"}
    assert {r.k: r.v for r in t.read().collect()} == want and t.read().count() == 201
    assert {r.k: r.v for r in t.lookup(spark.range(5, 8).withColumnRenamed("id", "k")).collect()} == {5: "b", 6: "a", 7: "c"}
    t.merge(d(0, 0, "x"), replace_by_key(["k"]), 3)  # an empty batch
    with pytest.raises(ValueError):
        t.merge(d(9, 10, "x"), lambda previous, rows: d(0, 200, "y"), 4)
    t.retain(1)
    assert len(storage.versions(spark, t.path)) == 1 and {r.k: r.v for r in t.read().collect()} == want
    left = {f"{p.parent}" for p in (tmp_path / "t" / "data").rglob("part-*.parquet")}
    assert left == {x for dirs in folders(t).values() for x in dirs}


def test_bucket_table_appends_and_compacts(spark, tmp_path, monkeypatch):
    from asterion import bucketed
    monkeypatch.setattr(bucketed, "COMPACT", 3)
    t = bucketed.BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    for v in range(5):
        t.append(spark.range(v * 10, v * 10 + 10).select((F.col("id") % 4).alias("k"), "id"), v)
        assert max(len(x) for x in t.manifest().values()) < 3
    assert sorted(r.id for r in t.read().collect()) == list(range(50))


def test_known_set_equals_full_rebuild(spark, tmp_path):
    """Observations in any order, a tracklet completed by a row of another batch and without the object's name."""
    from asterion.operators.discovery import discovery_tracklets
    cat = {n: getattr(mini, n)(spark) for n in ("orbits", "ni", "obs", "obscodes")}
    last = cat["obs"].where("id = 1").selectExpr("100 AS id", *[c if c not in ("obsid", "permid", "provid", "disc") else f"'L900' AS {c}" if c == "obsid" else f"cast(NULL AS string) AS {c}" for c in cat["obs"].columns if c != "id"])
    every = cat["obs"].unionByName(last.select(*cat["obs"].columns))
    known = streams.KnownSet(spark, str(tmp_path / "known"), cat["orbits"], cat["ni"], cat["obscodes"], buckets=4)
    for version, ids in enumerate(["id % 3 = 2", "id % 3 = 0", "id % 3 = 1 AND id < 100", "id = 100", "id = 100"]):
        known.apply(every.where(ids), min(version, 3))  # the last batch is tried again
        so_far = every.where(" OR ".join(f"({x})" for x in ["id % 3 = 2", "id % 3 = 0", "id % 3 = 1 AND id < 100", "id = 100"][:version + 1]))
        want = discovery_tracklets(cat["orbits"], cat["ni"], so_far, cat["obscodes"])
        got = known.product.read()
        assert (got.exceptAll(want).count(), want.exceptAll(got).count()) == (0, 0)


def test_sessions_are_whole_in_any_order(spark):
    import random
    r = random.Random(8)
    base = datetime(2024, 1, 1)
    rows = [(r.choice(["a", "b", "hot"]), base + timedelta(hours=r.choice([r.randint(0, 5000), r.randint(0, 300)]))) for _ in range(600)]
    rows += [("edge", base), ("edge", base + timedelta(days=2)), ("edge", base + timedelta(days=4, microseconds=1)), ("hot", None), (None, base)]
    r.shuffle(rows)
    arcs = None
    for k in range(0, len(rows), 150):
        batch = spark.createDataFrame(rows[k:k + 150], "provid string, obstime timestamp_ntz")
        arcs = spark.createDataFrame(
            streams.join_arcs(days=2)(arcs, streams.arc_pieces(batch, days=2)).collect(), "key string, start timestamp_ntz, end timestamp_ntz, n bigint")
    want = set()
    for key in ("a", "b", "hot", "edge"):
        times = sorted(t for k, t in rows if k == key and t is not None)
        arc = [times[0]]
        for t in [*times[1:], None]:
            if t is None or t - arc[-1] > timedelta(days=2):
                want.add((key, arc[0], arc[-1], len(arc)))
                arc = []
            arc.append(t)
    assert {tuple(x) for x in arcs.collect()} == want
    flags = {(x.key, x.end): x.is_open for x in streams.with_open_flag(arcs, days=2).collect()}
    newest = max(t for _, t in rows if t is not None)
    assert all(v == (newest - end <= timedelta(days=2)) for (_, end), v in flags.items())


def test_json_records_across_byte_ranges(spark, tmp_path):
    """Strings with commas, brackets, quotes and escapes; ranges that end anywhere, inside strings too."""
    import json
    import random
    from asterion.sources.json_records import json_records, pieces
    r = random.Random(3)
    text = lambda: "".join(r.choice(['a', ',', '[', ']', '{', '}', '"', chr(92), 'é', ' ', ':', '12']) for _ in range(r.randint(0, 12)))
    rows = [[text(), r.random(), None, r.choice([True, text()])] for _ in range(700)] + [[], ["only"]]
    targets = {f"{k}{text()}": {"q": r.random(), "u": None if k % 3 else 1.5, "neocp": k % 5 == 0, "more": text()} for k in range(500)}
    plain = json.dumps({"signature": {"a": "x, [y"}, "fields": ["pdes", "v", "n", "t"], "data": rows, "count": len(rows)})
    indented = json.dumps({"status": "}, {", "result": {"objects": targets, "n": 2}}, indent=1, ensure_ascii=False)
    (tmp_path / "a.json").write_text(plain), (tmp_path / "b.json").write_text(indented)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("97", "1000", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size), spark.conf.set("spark.sql.files.openCostInBytes", "0")
            records, head = json_records(spark, str(tmp_path / "a.json"), depth=2)
            got = [json.loads(x.text) for x in records.orderBy("record").collect()]
            assert got == rows
            assert '"fields": ["pdes", "v", "n", "t"]' in head.first().text and len(head.first().text) < 300
            got, _ = json_records(spark, str(tmp_path / "b.json"), depth=3)
            assert {k: v for x in got.collect() for k, v in json.loads("{" + x.text + "}").items()} == targets
            if size == "1000":
                assert pieces(spark, str(tmp_path / "a.json")).rdd.getNumPartitions() > 10
                want = {k: (v["q"], v["u"], v["neocp"]) for k, v in targets.items()}
                out = readers.read_target_map_json(spark, str(tmp_path / "b.json"))
                assert {x.packed_desig: (x.q, x.u, x.neocp) for x in out.collect()} == want
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
