"""Orderings return all rows, and long lines are read to their end."""

from asterion.queries import QUERIES
from asterion.sources.readers import parse_year_blocks

SF = "/root/testdata/sf0.01"


def test_orderings_return_every_row(spark):
    for name in ("designation_order", "station_profile_ordered", "year_label_order", "projects_by_first_year", "enum_order"):
        assert QUERIES[f"{name}_all"](spark, SF).count() > QUERIES[name](spark, SF).count(), name


def test_long_report_line(spark):
    line = "F51  7" + " " * 12_000 + "  ".join(f"{k}/ {k + 1}/ {k + 2}" for k in (1, 4, 7, 10))
    page = spark.createDataFrame([(f"<pre>x\n<b>2018</b>\n{line}\n</pre>",)], "html string")
    r = parse_year_blocks(page).first()
    assert list(r)[2:] == [7, *range(1, 13)]
