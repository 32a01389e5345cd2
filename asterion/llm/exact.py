"""Exact duplicates by minimal perfect hashing of the digests seen before.

The distinct digests of the history are dealt over buckets by their own bits. In
a bucket they get a minimal perfect hash (levels of single-hit bit arrays, ranked);
its slots hold the full digest and the locator of the row that stays. New digests
of the same bucket are looked up and compared byte for byte: members join the
history's group, the others form groups of their own.

Both sides are reduced to one row per digest before they meet, so a text that
makes up a third of all rows is one row here. Null text counts as empty; a null id
never wins over another one; repeated rows each count; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterion.storage import settle

from .common import fold_col, keyed, matched, mix, without

BUCKET_DIGESTS = 200_000


class PerfectHash:
    """Levels of bit arrays: a key lands on the first level where its slot is its alone."""

    def __init__(self, keys: np.ndarray, gamma: float = 1.5):
        self.levels: list[np.ndarray] = []
        left = keys
        while len(left):
            size = max(8, int(gamma * len(left)))
            slot = self._slot(left, len(self.levels), size)
            hits = np.bincount(slot, minlength=size)
            self.levels.append(hits == 1)
            left = left[hits[slot] != 1]
        ones = [0, *np.cumsum([int(x.sum()) for x in self.levels]).tolist()]
        self.ranks = [n + np.cumsum(x) - 1 for n, x in zip(ones, self.levels)]

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(mix(keys[:, 0] + np.uint64(level + 1)) ^ keys[:, 1]) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The key's own slot; some slot or -1 for a key that is not a member."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            slot = self._slot(keys[todo], level, len(bits))
            hit = bits[slot]
            out[todo[hit]] = rank[slot[hit]]
            todo = todo[~hit]
        return out


def _words(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, digests)), np.uint64).reshape(-1, 4)


def resolve(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    """One bucket: groups of the history with the new rows that belong to them, and the new groups."""
    keys, probe = _words(old["digest"]), _words(new["digest"])
    index = PerfectHash(keys[:, :2])
    slots = np.zeros((len(keys), 4), np.uint64)
    winner, size = np.full(len(keys), -2**63, np.int64), np.zeros(len(keys), np.int64)
    own = index.find(keys[:, :2])
    slots[own], winner[own], size[own] = keys, old["keep_id"], old["n"]
    at = index.find(probe[:, :2])
    member = at >= 0
    if len(keys):
        member &= (slots[np.maximum(at, 0)] == probe).all(axis=1)
    hit = at[member]  # new digests are distinct, so no slot is met twice
    winner[hit] = np.maximum(winner[hit], new["keep_id"].to_numpy()[member])
    size[hit] += new["n"].to_numpy()[member]
    seen = pd.DataFrame({"digest": [x.tobytes() for x in slots], "keep_id": winner, "group_size": size})
    rest = new[~member].rename(columns={"n": "group_size"})[["digest", "keep_id", "group_size"]]
    return pd.concat([seen, rest], ignore_index=True)


def exact_groups(docs: DataFrame, history_below: int | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept and the digest (binary).

    Rows with an id below ``history_below`` are the history (by default the lower
    half of the id range); the largest id of a group stays.
    """
    spark = docs.sparkSession
    none = F.lit(-2**63 + 1).cast("bigint")
    rows = settle(docs.select(docs[id_col].cast("bigint").alias("doc_id"),
                              F.unhex(F.sha2(fold_col(F.coalesce(docs[text_col], F.lit(""))), 256)).alias("digest")), "exact_digests")
    if history_below is None:
        r = rows.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
        history_below = 0 if r.a is None else (r.a + r.b + 1) // 2
    old = F.coalesce(F.col("doc_id") < history_below, F.lit(False))
    n = rows.count()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_DIGESTS))
    agg = (rows.groupBy("digest", old.alias("old"))
           .agg(F.max(F.coalesce("doc_id", none)).alias("keep_id"), F.count(F.lit(1)).alias("n"))
           .withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")))
    side = lambda flag: agg.where(F.col("old") == flag).select("bucket", "digest", "keep_id", "n").groupBy("bucket")
    groups = settle(side(True).cogroup(side(False)).applyInPandas(resolve, "digest binary, keep_id bigint, group_size bigint"), "exact_groups")
    keep = F.when(F.col("keep_id") != none, F.col("keep_id"))
    return rows.join(groups, "digest").select(
        "doc_id", keep.alias("keep_id"), "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "digest")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns, decided row by row: of each text the one with the largest id.

    Rows without an id go when a row with an id has their text; of rows alike in id
    and text, one stays.
    """
    digest = F.unhex(F.sha2(fold_col(F.coalesce(docs["text"], F.lit(""))), 256))
    groups = exact_groups(docs)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    out = without(docs, groups.where(~stays).select("doc_id", F.col("digest").alias("key")).distinct(), digest)
    twins = settle(groups.where(stays).groupBy("doc_id", "digest").count().where("count > 1").select("doc_id", F.col("digest").alias("key")), "exact_twins")
    if twins.isEmpty():
        return out
    rows, name = keyed(out, digest)
    alike = matched(rows, name, twins, "left_semi").dropDuplicates(["doc_id", name])
    return matched(rows, name, twins, "left_anti").unionByName(alike).drop(name)


ORACLE = """
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = max(doc_id) OVER w, false) AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""
