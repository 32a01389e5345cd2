"""Repeated 200-byte strings by bucket-pointer refinement.

Suffixes are put into buckets by their first q = 100 bytes, and the bucket's
identifier is a hash built recursively: the identifier of 2k bytes comes from the
identifiers of k bytes at two offsets, so identifiers agree on every machine
without ranking all suffixes in one place. Buckets are refined by the bucket
identifier of a later offset: the pair (bucket of p, bucket of p + 100) stands for
the 200 bytes from p.

Only buckets that can hold a repeat are refined. Of the 101 q-grams in a 200-byte
string the one with the least identifier is its anchor; equal strings have equal
anchors. All strings of one document that share an anchor form a stretch. A
stretch met again whole is a repeat whole; single strings are compared only for
stretches whose anchor bucket is shared but which are themselves unique or the
one representative of their copies. Counts are pre-aggregated, so copies that
make up a third of all rows are one row before they meet. Anchors and strings are
first counted alone; rows whose anchor or string stands nowhere else go by a bitmap
of fixed size before anything is joined (a full bitmap only lets more through), and
tables are deleted after their last reader.

Null and empty texts have no bytes; repeated rows are repeats of each other; ties
between equal identifiers go to the leftmost; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterion.storage import discard, settle

from .common import chain, possibly_in, runs, texts

LOW = np.uint64(0xFFFFFFFF)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def buckets(data: np.ndarray, q: int) -> np.ndarray:
    """Bucket identifier of the q bytes from each position on, by doubling."""
    h, size = data.astype(np.uint64) + np.uint64(1), 1
    while size < q:
        step = min(size, q - size)
        if len(h) <= step:
            return h[:0]
        h = _join(h[:-step], h[step:])
        size += step
    return h


def anchors(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least identifier among the ``width`` from each position on."""
    m, size = (h & ~LOW) | np.arange(len(h), dtype=np.uint64), 1
    while size < width:
        step = min(size, width - size)
        if len(m) <= step:
            return np.zeros(0, np.int64)
        m = np.minimum(m[:-step], m[step:])
        size += step
    return (m & LOW).astype(np.int64)


def stretches(data: np.ndarray, length: int):
    """(bucket, identity, first and last string start) of every stretch of a text."""
    q = length // 2
    if len(data) < length:
        return None
    h = buckets(data, q)
    at = anchors(h, length - q + 1)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    a = at[first]
    whole = chain([h[first], h[first + length - q], h[last], h[last + length - q], (a - first).astype(np.uint64), (last - first).astype(np.uint64)])
    return h[a], whole, first, last


def again(rows: DataFrame, name: str) -> DataFrame:
    """The values of a column that more than one row has."""
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name)


def repeated(docs: DataFrame, length: int = 200) -> DataFrame:
    """Per row: doc_id, n_bytes, ``spans`` (edges of the maximal repeated runs) and ``kept`` (the other bytes)."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    q = length // 2

    def find(batches):
        for b in batches:
            part, size = [], 0
            for uid, t in zip(b["uid"], b["text"]):
                s = stretches(np.frombuffer(t.encode("utf-8"), np.uint8), length)
                if s is not None:
                    part.append(pd.DataFrame({"uid": uid, "g": s[0].view(np.int64), "c": s[1].view(np.int64), "lo": s[2].astype(np.int32), "hi": s[3].astype(np.int32)}))
                    size += len(s[0])
                if size > 50_000:
                    yield pd.concat(part)
                    part, size = [], 0
            if part:
                yield pd.concat(part)
    all_found = settle(rows.select("uid", "text").mapInPandas(find, "uid bigint, g bigint, c bigint, lo int, hi int"), "repeat_stretches")
    shared = settle(again(all_found, "g"), "repeat_anchors")
    found = settle(possibly_in(all_found, "g", shared), "repeat_shared")
    discard(all_found)
    same = found.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "lo")).alias("rep"))
    shared = same.groupBy("g").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k")).where("total > 1")
    verdict = settle(same.join(shared, "g").select("g", "c", "n", "k", "rep"), "repeat_verdicts")
    mine = F.struct("uid", "lo") == F.col("rep")
    judged = settle(found.join(verdict, ["g", "c"]).select("uid", "lo", "hi", (F.col("n") > 1).alias("whole"), ((F.col("k") > 1) & mine).alias("open"))
                    .where("whole OR open"), "repeat_judged")
    discard(found)
    discard(verdict)
    opened = judged.where("open").groupBy("uid").agg(F.collect_list(F.struct("lo", "hi", F.col("whole").cast("int").alias("whole"))).alias("at"))

    def refine(batches):
        for b in batches:
            for uid, t, at in zip(b["uid"], b["text"], b["at"]):
                h = buckets(np.frombuffer(t.encode("utf-8"), np.uint8), q)
                for i in range(0, len(at), 2_000):
                    p = np.concatenate([np.arange(x["lo"], x["hi"] + 1) for x in at[i:i + 2_000]])
                    whole = np.concatenate([np.full(x["hi"] + 1 - x["lo"], x["whole"]) for x in at[i:i + 2_000]])
                    yield pd.DataFrame({"uid": uid, "s": chain([h[p], h[p + length - q]]).view(np.int64), "p": p.astype(np.int32), "whole": whole.astype(bool)})
    strings = settle(rows.join(opened, "uid").select("uid", "text", "at").mapInPandas(refine, "uid bigint, s bigint, p int, whole boolean"), "repeat_strings")
    twice = settle(again(strings, "s"), "repeat_twice")
    single = possibly_in(strings.where("NOT whole"), "s", twice).join(twice, "s").select("uid", F.col("p").alias("lo"), F.col("p").alias("hi"))
    spans = settle(judged.where("whole").select("uid", "lo", "hi").union(single).groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("at")), "repeat_spans")
    for done in (judged, strings, twice):
        discard(done)

    def cut(batches):
        for b in batches:
            t = texts(b["text"])
            for i, j in runs([len(x) for x in t], 8_000_000):
                out = []
                for doc, x, at in zip(b["doc_id"].iloc[i:j], t[i:j], b["at"].iloc[i:j]):
                    data = np.frombuffer(x.encode("utf-8"), np.uint8)
                    depth = np.zeros(len(data) + 1, np.int32)
                    if at is not None and len(at):
                        np.add.at(depth, [y["lo"] for y in at], 1)
                        np.add.at(depth, [y["hi"] + length for y in at], -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    out.append((doc, len(data), edge, data[~gone].tobytes()))
                yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])
    return rows.join(spans, "uid", "left").select("doc_id", "text", "at").mapInPandas(cut, "doc_id bigint, n_bytes bigint, spans array<bigint>, kept binary")


def report(found: DataFrame) -> DataFrame:
    kept = F.octet_length("kept")
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - kept).cast("bigint").alias("n_removed"), (F.size("spans") / 2).cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["repeated", "report"]
