"""Benchmark decontamination as a prefix-filtered containment join.

Every benchmark item is cut into windows of 13 words (a shorter item is one
window). A window is the set of its shingles, ordered by rarity in the benchmark.
A document holds a window only if it holds all of its shingles, so a prefix of one
shingle, the rarest, is enough to find every candidate. The position of that
shingle in the window fixes where the window must start in the document
(positional bound) and that it must end inside it (length bound); the words there
are then compared one by one.

The benchmark is taken in blocks of at most ``block_words`` words; each block is
broadcast, so what is broadcast is bounded, and every document meets every block.
Documents are never shuffled.

Null and empty texts have no words; items without words have no windows; items
that repeat an id count once for that id; items without an id hit words but are
not among the items found; repeated documents get a row each.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grams, runs, text_key, texts, tidy, without, word_hashes

#: Bytes of words stay, A-Z are lower-cased, every other byte separates.
WORD_BYTES = bytes(b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
SHINGLE = 5


def words_of(text: str) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the lower-cased text, in UTF-8."""
    return text.encode("utf-8").translate(WORD_BYTES).split()


class Windows:
    """Prefix index over the windows of some items, one table per shingle length."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], size: int = 13):
        self.size = size
        self.windows: list[tuple[tuple[bytes, ...], list[int]]] = []
        owners: dict[tuple[bytes, ...], list[int]] = {}
        for item, words in items:
            for p in range(max(1, len(words) - size + 1) if words else 0):
                known = owners.setdefault(tuple(words[p:p + size]), [])
                if item is not None and item not in known:
                    known.append(item)
        self.windows = list(owners.items())
        cut = []
        df: Counter[int] = Counter()
        for w, _ in self.windows:
            n = min(SHINGLE, len(w))
            g = grams(word_hashes(list(w)), n).tolist()
            cut.append((n, g))
            df.update(set(g))
        tables: dict[int, list[tuple[int, int, int]]] = {}
        for i, (n, g) in enumerate(cut):
            at = min(range(len(g)), key=lambda k: (df[g[k]], g[k], k))
            tables.setdefault(n, []).append((g[at], i, at))
        self.tables = {}
        for n, rows in tables.items():
            rows.sort()
            self.tables[n] = (np.array([r[0] for r in rows], np.uint64), [r[1:] for r in rows])

    def hits(self, words: list[list[bytes]]) -> list[tuple[np.ndarray, set[int]]]:
        """Per document: which words are hit, and the items found."""
        size = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(size)
        h = word_hashes([x for w in words for x in w])
        out: list[tuple[np.ndarray, set[int]]] = [(np.zeros(n, bool), set()) for n in size]
        for n, (keys, rows) in self.tables.items():
            g = grams(h, n)
            lo = np.searchsorted(keys, g)
            found = np.flatnonzero((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == g))
            for p in found.tolist():
                d = int(np.searchsorted(ends, p, side="right"))
                w, k = words[d], int(lo[p])
                here = p - int(ends[d] - size[d])
                while k < len(keys) and keys[k] == g[p]:
                    i, at = rows[k]
                    window, items = self.windows[i]
                    start = here - at
                    if start >= 0 and start + len(window) <= len(w) and tuple(w[start:start + len(window)]) == window:
                        out[d][0][start:start + len(window)] = True
                        out[d][1].update(items)
                    k += 1
        return out


def blocks(benchmark: DataFrame, most: int):
    """Items in blocks of at most ``most`` words (or one item), read row by row."""
    items: list[tuple[int | None, list[bytes]]] = []
    total = 0
    for row in benchmark.where("text IS NOT NULL").select("item_id", "text").toLocalIterator():
        w = words_of(row.text)
        if items and total + len(w) > most:
            yield items
            items, total = [], 0
        items.append((row.item_id, w))
        total += len(w)
    yield items


def judged(docs: DataFrame, benchmark: DataFrame, *, size: int = 13, percent: int = 5, block_words: int = 500_000) -> DataFrame:
    """Per row: doc_id, text, n_words, hit word ranges, item ids (sorted as strings) and ``contaminated``."""
    sc = docs.sparkSession.sparkContext
    schema = "doc_id bigint, text string, n_words bigint, spans array<bigint>, items array<bigint>"
    empty = F.array().cast("array<bigint>")
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.lit(0).cast("bigint").alias("n_words"), empty.alias("spans"), empty.alias("items"))
    for items in blocks(benchmark, block_words):
        shared = sc.broadcast(items)

        def scan(batches, shared=shared):
            index = Windows(shared.value, size)
            for b in batches:
                t = texts(b["text"])
                for i, j in runs([len(x) for x in t], 4_000_000):
                    part = b.iloc[i:j].copy()
                    words = [words_of(x) for x in t[i:j]]
                    spans, found = [], []
                    for (flags, items), s, f in zip(index.hits(words), part["spans"], part["items"]):
                        for k in range(0, len(s), 2):
                            flags[s[k]:s[k + 1]] = True
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
                        spans.append(edge)
                        found.append(sorted(items.union(int(x) for x in f), key=str))
                    part["n_words"], part["spans"], part["items"] = [len(w) for w in words], spans, found
                    yield part
        out = out.mapInPandas(tidy(scan), schema)
    n_hit = F.aggregate("spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("sign")),
                        lambda a, x: F.struct((a.n + a.sign * x).alias("n"), (-a.sign).alias("sign")), lambda a: a.n)
    return out.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent))


def contamination(docs: DataFrame, benchmark: DataFrame, *, size: int = 13, percent: int = 5, block_words: int = 500_000) -> DataFrame:
    """Per row: doc_id, n_words, hit word ranges, item ids (sorted as strings) and ``contaminated``."""
    return judged(docs, benchmark, size=size, percent=percent, block_words=block_words).drop("text")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with all their columns, decided row by row, with or without an id."""
    bad = judged(docs, benchmark).where("contaminated")
    return without(docs, bad.select("doc_id", text_key(bad).alias("key")).distinct(), text_key(docs))


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.transform("items", lambda x: x.cast("string")), ","), 256).alias("items_sha256"), "contaminated")


__all__ = ["contamination", "keep_clean", "report", "words_of"]
