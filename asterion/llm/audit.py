"""Filter interaction audit by count-weighted decision diagrams.

Every document fails some of five filters (A short, B repetitive, C shouting, D odd
signs, E copy of a smaller id); the set of them is its failure mask. Masks are counted
per part on the cluster, copies included: a text's first rows (those of its smallest
id) pass E and all its other rows fail it, so two counts per cell tell how many rows
fail, and no copies ever meet in one task. What reaches a group is at most 32
masks with their counts.

A part's diagram tests one filter per level, leads to a pass and a fail child and
ends in counts; a child with nothing below is left out, equal nodes are one.
Orders are visited so that each differs from the one before by one swap of
adjacent levels, which rewrites the nodes of these two levels only. The path on which
everything passes then gives the steps of an order: what stands below its fail
children is removed there.

Null texts count as empty, null parts as the empty string. A row without an id passes E
and is nobody's smaller id; rows that repeat an id and a text stand or fall together. A
document is good or toxic if any label row of its id says so; labels without a document
or without an id, and other columns, are ignored. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterion.storage import settle

FILTERS = "ABCDE"
SPACES = " \t\n\x0b\x0c\r"
SCHEMA = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
          "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def text_failures(text: Column) -> list[Column]:
    """Filters A to D of a text that is not null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    n = F.size(words)
    return [n < 200, F.size(F.array_distinct(words)) * 100 < n * 50,
            F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 3, text.rlike("[#$%&*|]")]


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per failure mask; bit k of the mask is filter k."""
    text = F.coalesce(docs["text"], F.lit(""))
    said = labels.groupBy(labels["doc_id"].cast("bigint").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")).where("good OR toxic")
    fails = sum(F.when(x, 1 << k).otherwise(0) for k, x in enumerate(text_failures(F.col("x"))))
    scanned = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.coalesce(docs["lang"], F.lit("")).alias("part"), text.alias("x")).select(
        "doc_id", "part", fails.alias("fails"), F.unhex(F.sha2("x", 256)).alias("digest"))
    rows = settle(scanned.join(said, "doc_id", "left").select(
        "doc_id", "part", "fails", "digest", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")), "audit_rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    cell = ["part", "fails", "good", "toxic"]
    every = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("ids"), F.lit(0).cast("bigint").alias("firsts"))
    firsts = rows.join(first, ["digest", "doc_id"], "left_semi").groupBy(*cell).agg(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("ids"), F.count(F.lit(1)).alias("firsts"))
    cells = every.union(firsts).groupBy(*cell).agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"), F.sum("firsts").alias("firsts"))
    copies = F.col("ids") - F.col("firsts")
    split = cells.select(*cell, F.explode(F.array(F.struct(F.col("fails").alias("mask"), (F.col("n") - copies).alias("m")),
                                                  F.struct((F.col("fails") + 16).alias("mask"), copies.alias("m")))).alias("s"))
    return split.groupBy("part", F.col("s.mask").alias("mask")).agg(
        F.sum("s.m").alias("n"), F.sum(F.when(F.col("good"), F.col("s.m")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("s.m")).otherwise(0)).alias("toxic")).where("n > 0")


def adjacent_swaps(n: int) -> Iterator[int]:
    """Positions k whose swaps of k and k + 1 visit every order of n things once."""
    if n < 2:
        return
    inner, down = list(adjacent_swaps(n - 1)), True
    for k in range(len(inner) + 1):  # the last thing walks through the others, which then make one swap of theirs
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if k < len(inner):
            yield inner[k] + (1 if down else 0)
        down = not down


class Diagram:
    """Nodes are (filter, pass child, fail child); ends are counts; nothing below is None."""

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: int):
        self.order = list(range(filters))
        self.width = len(next(iter(counts.values()))) if counts else 0
        self.nodes: list[tuple] = []
        self.weights: list[np.ndarray] = []
        self.known: dict[tuple, int] = {}
        self.root = self._build(counts, 0, 0)

    def _node(self, key: tuple, weight) -> int:
        if key not in self.known:
            self.known[key] = len(self.nodes)
            self.nodes.append(key)
            self.weights.append(weight)
        return self.known[key]

    def _test(self, filter: int, passed: int | None, failed: int | None) -> int | None:
        if passed is None and failed is None:
            return None
        return self._node((filter, passed, failed), self.weight(passed) + self.weight(failed))

    def _build(self, counts: dict[int, tuple[int, ...]], level: int, mask: int) -> int | None:
        if level == len(self.order):
            return self._node(("end", *counts[mask]), np.array(counts[mask], np.int64)) if mask in counts else None
        f = self.order[level]
        return self._test(f, self._build(counts, level + 1, mask), self._build(counts, level + 1, mask | 1 << f))

    def weight(self, node: int | None) -> np.ndarray:
        return np.zeros(self.width, np.int64) if node is None else self.weights[node]

    def _children(self, node: int | None) -> tuple:
        return (None, None) if node is None else self.nodes[node][1:]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one; all that lies above and below keeps its shape."""
        upper, lower = self.order[level], self.order[level + 1]
        done: dict[int, int | None] = {}

        def at(node: int | None, depth: int) -> int | None:
            if node is None:
                return None
            if node not in done:
                passed, failed = self._children(node)
                if depth < level:
                    done[node] = self._test(self.order[depth], at(passed, depth + 1), at(failed, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self._children(passed), self._children(failed)
                    done[node] = self._test(lower, self._test(upper, pp, fp), self._test(upper, pf, ff))
            return done[node]
        self.root = at(self.root, 0)
        self.order[level], self.order[level + 1] = lower, upper

    def steps(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(filter, weight kept, weight removed) along the path on which everything passes."""
        node = self.root
        for f in self.order:
            passed, failed = self._children(node)
            yield f, self.weight(passed), self.weight(failed)
            node = passed


def part_orders(rows: pd.DataFrame) -> pd.DataFrame:
    """All orders of one part from its mask counts."""
    counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(rows["mask"], rows["n"], rows["good"], rows["toxic"])}
    fails = [sum(c[0] for m, c in counts.items() if m >> k & 1) for k in range(len(FILTERS))]
    alone = [counts.get(1 << k, (0,))[0] for k in range(len(FILTERS))]
    d, out, total = Diagram(counts, len(FILTERS)), [], [0] * len(FILTERS)
    for level in [None, *adjacent_swaps(len(FILTERS))]:
        if level is not None:
            d.swap(level)
        name = "".join(FILTERS[f] for f in d.order)
        for k, (f, kept, gone) in enumerate(d.steps(), 1):
            total[f] += int(gone[0])
            out.append((rows["part"].iloc[0], name, k, kept[0], gone[0], fails[f] - gone[0], alone[f], gone[1], gone[2], f))
    table = pd.DataFrame(out, columns=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "f"])
    table["shapley"] = [total[f] for f in table.pop("f")]
    return table


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return mask_counts(docs, labels).groupBy("part").applyInPandas(part_orders, SCHEMA)


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, coalesce(lang, '') AS part FROM documents),
first AS (SELECT x, min(doc_id) AS m FROM t GROUP BY x),
said AS (SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT doc_id, part, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws FROM t),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(ws) < 200)::int + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::int
         + 4 * (100 * length(regexp_replace(w.x, '[^A-Z]', '', 'g')) > 3 * length(w.x))::int
         + 8 * regexp_matches(w.x, '[#$%&*|]')::int + 16 * coalesce(w.doc_id > m, false)::int AS mask
  FROM w JOIN first ON first.x = w.x LEFT JOIN said ON said.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
p AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM l a, l b, l c, l d, l e WHERE a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, k::int AS step, bits[k] AS bit, list_sum(bits[1:k - 1])::int AS earlier FROM p, range(1, 6) r(k)),
o AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (coalesce(earlier, 0) | bit) = 0), 0)::bigint AS kept,
         coalesce(sum(n) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit > 0), 0)::bigint AS removed,
         coalesce(sum(n) FILTER (mask & coalesce(earlier, 0) > 0 AND mask & bit > 0), 0)::bigint AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::bigint AS unique_fails,
         coalesce(sum(good) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit > 0), 0)::bigint AS good_lost,
         coalesce(sum(toxic) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit > 0), 0)::bigint AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::bigint AS shapley
FROM o
"""
