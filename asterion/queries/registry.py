"""Registered queries and the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .adapters import VIEWS, Inputs, plain_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _with_views(sql: str) -> str:
    """Prefix the statement with the views it names."""
    used, todo = [], [sql]
    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in used and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text, re.I):
                used.append(name)
    if not used:
        return sql
    ctes = ",\n".join(f"{n} AS ({plain_sql(VIEWS[n])})" for n in used)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def query(name: str, oracle: str | None = None):
    """Register ``f(inputs) -> DataFrame`` under a name, with its checking SQL."""
    def add(f):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, dir: f(Inputs(spark, dir))
        if oracle is not None:
            ORACLES[name] = _with_views(oracle)
        return f
    return add
