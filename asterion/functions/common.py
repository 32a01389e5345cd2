"""Small helpers shared by the column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ColumnOrName = "Column | str"


def col(c) -> Column:
    """A column from a name, or the column itself."""
    return F.col(c) if isinstance(c, str) else c


def lookup(key, mapping: dict, default=None) -> Column:
    """Value of a fixed, small mapping; unknown and NULL keys give ``default``."""
    key = col(key)
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def blank_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def share(part, whole, digits: int) -> Column:
    """Rounded percentage; NULL when the whole is empty."""
    return F.round(F.lit(100.0) * col(part) / F.nullif(col(whole), F.lit(0)), digits)


def count_if(condition) -> Column:
    """Rows for which the condition is true (NULL counts as not true)."""
    return F.count(F.when(col(condition), F.lit(1)))


def with_isolated(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Add columns through a one-element generator.

    A filter on a derived column is pushed down by writing the column's whole
    definition into the filter, and every later use may repeat it. For a long
    definition that multiplies into code too large to compile; a generator ends
    the push, and the value is computed once per row.
    """
    row = F.struct(*[v.alias(k) for k, v in columns.items()])
    return df.select(*(df.columns if keep is None else keep), F.inline(F.array(row)))
