"""SimHash near duplicates by vantage-point trees.

A text's fingerprint has a bit for each bit that is set in over half of its 3-word
shingle hashes. Fingerprints that differ in at most 3 of 64 bits differ in at most 1 bit of
their low or of their high half, so each half has a vantage-point tree with radius 1, where
triangle bounds prune far better than with radius 3 over all bits: a node splits its
points at a Hamming distance ``mu`` from its vantage point, and of two points in reach of
each other that part there, the inner one is at ``mu`` and the outer at ``mu + 1``.
Every fingerprint lives in one leaf of each tree, the shard. One at the border of a
node also visits the other branch: a home on the inner border as a visitor of
the outer branch, a visitor on either border in both. So each pair in reach meets in a
shard, as two homes or as a home and a visitor, and is compared over all 64 bits.

Equal fingerprints are one from the start. The trees are fitted on a bounded sample of them
(``SAMPLE``) and broadcast; every fingerprint is indexed. In a shard, components grow one at
a time against what is not reached yet, so a dense ball shrinks as it is linked, and only
a star per component leaves the shard, not its pairs. A shard above ``SHARD_ROWS`` rows,
as a very large group of near copies makes, is cut into blocks, and each two blocks
meet in a task of their own. Components over shards spread as labels.

Null and empty texts, and those without words, have fingerprint zero and are linked like
any other. A row without an id has the component of its fingerprint, null if no linked row
has an id; repeated rows fall together; equal distances have no effect on results; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random
from itertools import accumulate, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterion.storage import settle

from .common import runs, space_words
from .jaccard import components

REACH = 3
SAMPLE = 1 << 16
LEAF = 1000
SHARD_ROWS = 200_000
CELLS = 1 << 21
FEWEST = 8  # sample points that a leaf stands on
HALF = np.uint64(0xFFFFFFFF)


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """SimHash of each text over 3-word shingles, repeats included."""
    import xxhash
    digest, hashes, sizes = xxhash.xxh64_intdigest, [], []
    for t in texts:
        words = space_words(t or "")
        joined, n = b" ".join(words), max(1, len(words) - 2) if words else 0
        ends = [a - 1 for a in accumulate(len(w) + 1 for w in words)]
        starts = [0, *[e + 1 for e in ends[:-1]]]
        last = ends[2:] if len(words) > 2 else ends[-1:]
        hashes.append(np.fromiter((digest(joined[a:b], 42) for a, b in zip(islice(starts, n), last)), np.uint64, n))
        sizes.append(n)
    out = np.zeros(len(texts), np.uint64)
    for i, h in enumerate(hashes):
        if sizes[i]:
            counts = np.zeros(64, np.int64)
            for k in range(0, sizes[i], 1 << 16):
                counts += np.unpackbits(h[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(counts * 2 > sizes[i], bitorder="little").view(np.uint64)[0]
    return out


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""
    def run(batches):
        for b in batches:
            t = b.column(1).to_pylist()
            for i, j in runs([len(x or "") for x in t], 2_000_000):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(fingerprints(t[i:j]).view(np.int64))], names=["doc_id", "fp"])
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]).mapInArrow(run, "doc_id bigint, fp bigint")


class Tree:
    """Nodes with vantage point, ``mu`` and two children; a child below zero is leaf ``-child - 1``."""

    def __init__(self, points: np.ndarray, weight: float, leaf: int = LEAF):
        self.vantage, self.mu, self.inner, self.outer, self.leaves = [], [], [], [], 0
        self.random = random.Random(len(points))
        self.root = self._grow(points, weight, leaf)
        self.vantage, self.mu = np.array(self.vantage, np.uint32), np.array(self.mu, np.int64)
        self.inner, self.outer = np.array(self.inner, np.int64), np.array(self.outer, np.int64)

    def _split(self, points: np.ndarray) -> tuple[float, int, int]:
        """(share of comparisons left, vantage point, mu) of the best of some vantage points."""
        best = (2.0, 0, 0)
        for v in self.random.sample(range(len(points)), min(8, len(points))):
            share = np.bincount(np.bitwise_count(points ^ points[v]), minlength=34) / len(points)
            upto = np.cumsum(share)
            work = upto[:33] * upto[1:] + (1 - upto[:33]) * (1 - upto[:33] + share[:33])
            mu = int(np.argmin(work))
            best = min(best, (float(work[mu]), int(points[v]), mu))
        return best

    def _grow(self, points: np.ndarray, weight: float, leaf: int) -> int:
        work, v, mu = self._split(points) if len(points) * weight > leaf and len(points) >= 2 * FEWEST else (1.0, 0, 0)
        if work > 0.9:
            self.leaves += 1
            return -self.leaves
        node = len(self.mu)
        for x, value in ((self.vantage, v), (self.mu, mu), (self.inner, 0), (self.outer, 0)):
            x.append(value)
        near = np.bitwise_count(points ^ np.uint32(v)) <= mu
        self.inner[node] = self._grow(points[near], weight, leaf)
        self.outer[node] = self._grow(points[~near], weight, leaf)
        return node

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leaf, index of the point, home) of every leaf that a point lives in or visits."""
        node, at, home = np.full(len(points), self.root), np.arange(len(points)), np.ones(len(points), bool)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
        while len(at):
            end = node < 0
            out.append((-node[end] - 1, at[end], home[end]))
            node, at, home = node[~end], at[~end], home[~end]
            d, mu = np.bitwise_count(self.vantage[node] ^ points[at]).astype(np.int64), self.mu[node]
            near = d <= mu
            also = np.where(home, d == mu, (d == mu) | (d == mu + 1))
            own, other = np.where(near, self.inner[node], self.outer[node]), np.where(near, self.outer[node], self.inner[node])
            node, at, home = np.concatenate([own, other[also]]), np.concatenate([at, at[also]]), np.concatenate([home, np.zeros(int(also.sum()), bool)])
        return tuple(np.concatenate(x) for x in zip(*out))


def halves(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (fps & HALF).astype(np.uint32), (fps >> np.uint64(32)).astype(np.uint32)


def stars(homes: np.ndarray, visitors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) of each fingerprint linked in a shard; pairs of two visitors meet elsewhere."""
    def hits(some: np.ndarray, rest: np.ndarray) -> np.ndarray:
        found = np.zeros(len(rest), bool)
        step = max(1, CELLS // max(1, len(rest)))
        for k in range(0, len(some) if len(rest) else 0, step):
            found |= (np.bitwise_count(some[k:k + step, None] ^ rest[None, :]) <= REACH).any(axis=0)
        return found
    members, roots = [], []
    while len(homes):
        root, homes = homes[:1], homes[1:]
        inside, passing = root, homes[:0]
        while len(inside) or len(passing):
            most = max(1, CELLS // max(1, len(homes) + len(visitors)))  # few at a time, so that the rest shrinks early
            some, inside = inside[:most], inside[most:]
            seen, passing = passing[:most], passing[most:]
            near, far = hits(some, homes) | hits(seen, homes), hits(some, visitors)
            if near.any() or far.any():
                reached = np.concatenate([homes[near], visitors[far]])
                members.append(reached)
                roots.append(np.repeat(root, len(reached)))
                inside, passing = np.concatenate([inside, homes[near]]), np.concatenate([passing, visitors[far]])
                homes, visitors = homes[~near], visitors[~far]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *members]), np.concatenate([none, *roots])


def grow_trees(distinct: DataFrame, sample: int, leaf: int) -> tuple[Tree, Tree]:
    """A tree per half, from a sample that is at most an eighth of the fingerprints and ``sample`` of them on average."""
    n = distinct.count()
    share = min(1 / 8, sample / max(1, n))
    picked = distinct.where(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1 << 32)) < int(share * (1 << 32))).limit(2 * sample).select("fp")
    points = np.array([r.fp for r in picked.toLocalIterator()], np.int64).view(np.uint64)
    return tuple(Tree(np.sort(x), 1 / share, leaf) for x in halves(points))


def shards(distinct: DataFrame, trees: tuple[Tree, Tree]) -> DataFrame:
    """(shard, fp, home): where each fingerprint lives and visits."""
    shared = distinct.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for b in batches:
            fps = b["fp"].to_numpy().view(np.uint64)
            for k, (tree, points) in enumerate(zip(shared.value, halves(fps))):
                leaf, at, home = tree.route(points)
                yield pd.DataFrame({"shard": leaf * 2 + k, "fp": fps[at].view(np.int64), "home": home})
    return distinct.select("fp").mapInPandas(run, "shard bigint, fp bigint, home boolean")


def in_blocks(rows: DataFrame, most: int) -> DataFrame:
    """Adds ``i`` and ``j``: shards above ``most`` rows are cut into blocks by hash, and each row goes to its block's meeting with every other."""
    large = rows.groupBy("shard").count().where(F.col("count") > most).select("shard", F.ceil(F.col("count") / most).cast("int").alias("blocks"))
    cut = rows.join(large, "shard", "left").withColumn("own", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), F.col("blocks"))).cast("int"))
    return cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).select(
        "shard", "fp", "home", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def links(distinct: DataFrame, *, sample: int = SAMPLE, leaf: int = LEAF, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pairs (a, b) of linked fingerprints that hold each shard's components together."""
    def match(rows: pd.DataFrame) -> pd.DataFrame:
        fps, home = rows["fp"].to_numpy().view(np.uint64), rows["home"].to_numpy(bool)
        a, b = stars(fps[home], fps[~home])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
    dealt = settle(shards(distinct, grow_trees(distinct, sample, leaf)), "simhash_shards")
    return in_blocks(dealt, shard_rows).groupBy("shard", "i", "j").applyInPandas(match, "a bigint, b bigint")


def near_classes(docs: DataFrame, **bounds: int) -> DataFrame:
    """Per row: doc_id, fp (signed 64 bits), component_id."""
    rows = settle(fingerprint_rows(docs), "simhash_rows")
    distinct = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash_distinct")
    comp = components(distinct.select(F.col("fp").alias("set")), settle(links(distinct, **bounds), "simhash_links"))
    named = distinct.join(comp.select(F.col("set").alias("fp"), "comp"), "fp")
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    return rows.join(settle(named.join(least, "comp").select("fp", "component_id"), "simhash_named"), "fp").select("doc_id", "fp", "component_id")


def report(classes: DataFrame) -> DataFrame:
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
