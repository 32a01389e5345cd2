"""Findings of the third round: box score cells in one pass, headings in two passes, circular texts by many tasks."""

import re
from collections import defaultdict
from datetime import date

from asterion.functions import circular
from asterion.operators import boxscore
from asterion.queries.adapters import Inputs


def test_all_metrics_share_one_pass(spark):
    fact = [("a", "1", date(2020, 1, 1), 2, 1, True), ("a", "2", date(2021, 5, 1), 3, 2, None), ("a", "1", date(2020, 1, 9), 1, 1, False),
            ("b", "1", date(2020, 1, 1), 5, 1, True), ("c", "1", None, 7, 3, False), ("d", "2", date(2021, 1, 1), 1, 1, True)]
    catalog = [("a", "Amor"), ("a", "Amor"), ("a", "Aten"), ("b", None), ("d", "Amor"), (None, "Aten")]
    got = boxscore.boxscore_cells(
        spark.createDataFrame(fact, "provid string, stn string, obs_date date, n_obs long, n_tracklets long, disc_flag boolean"),
        spark.createDataFrame(catalog, "provid string, coarse_class string"), metric=["observations", "tracklets", "objects", "discoveries"])
    sums, seen, found = defaultdict(lambda: [0, 0]), defaultdict(set), defaultdict(set)
    for provid, _, day, n, m, disc in fact:
        for cls in [c or "Unclassified" for p, c in catalog if p == provid] or ["Unclassified"]:
            for cell in {(t, c) for t in (str(day.year) if day else None, "Total") for c in (cls, "total")}:
                sums[cell] = [sums[cell][0] + n, sums[cell][1] + m]
                seen[cell].add(provid)
                found[cell] |= {provid} if disc else set()
    want = {(*cell, *sums[cell], len(seen[cell]), len(found[cell])) for cell in sums}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_headings_are_found_in_two_passes(spark):
    texts = ["", None, "no heading\nat all", "Observations:Observations:\nObservations:\nx\nAvailable\n Observations:\ny\n\n",
             "head\nAdditional observation:\na\nOrbital elements of x: y: z\nq Residuals\nResiduals in s\nb\nEphemeris:  \nc\nResiduals\nd",
             "Observer detail:\nr\nEphemeris\nEphemeris: no\nresiduals\nOBSERVATIONS:\né\U0001f600\nObserver details:"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    d = circular.with_sections(df, "t", "s")
    for k, _, s in d.collect():
        t, heads = texts[k], {}
        for name, p in circular.SECTIONS.items():
            for m in re.finditer(p, t or ""):
                heads[name] = m.span()
        for name in circular.SECTIONS:
            if name not in heads:
                assert s[name] is None
                continue
            stop = min([a for a, _ in heads.values() if a > heads[name][0]], default=len(t))
            assert s[name] == t[heads[name][1]:stop].strip("\n\r")
        assert s["header"] == (None if t is None else t[:min([a for a, _ in heads.values()], default=len(t))].strip())
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2 and "split(" not in plan


def test_circular_texts_are_made_by_many_tasks(spark, tmp_path):
    spark.range(50).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    circulars = Inputs(spark, str(tmp_path)).circulars
    assert circulars.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert circulars.count() == 50
