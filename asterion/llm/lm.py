"""Language model scores from a log-frequency Bloom filter.

Counts of all words and all word pairs, also of those that occur once, come from
all training documents, in one shuffle by block of grams; the number of blocks
grows with the text, so a block does not. A count n is quantised to level
1 + floor(log2 n); the filter of a block holds one key per gram and level up to its
own, at ``BITS_PER_KEY`` bits a key, so a count is read back by probing level after
level until one is missing. P(w|v) = LAMBDA c(vw)/c(v) + (1 - LAMBDA) (c(w)+1)/(N+V+1).
The end token of a text also stands before its first word, so that pairs at the
start have the number of texts as their context's count.

Documents are read in runs of consecutive rows, twice. First each run sends its
distinct grams, with their training counts (0 for those of other rows only), to the
blocks. A task that fills blocks also reads its filters for every gram it was sent,
and answers each run with a level a gram and the exact count of each word, in the order
of the request. Then the rows of a run meet its answers, which the run's grams, made
again, put in place. So the filter is never gathered anywhere, no word or pair is joined,
and a gram that is frequent costs one entry a run. Consecutive blocks share a task and a
row of a run (a shard), since rows number runs times shards.

Null and empty texts are one end token. Repeated rows are scored one by one; with no
training row every count is 0; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterion.storage import discard, settle

from .common import chain, held_out, mix, runs, span_hashes, tidy, word_hashes

LAMBDA = 0.6
BITS_PER_KEY = 12
PROBES = 3
BLOCK_CHARS = 2_000_000
RUN_CHARS = 4_000_000
#: Grams that meet in one task: a character makes at most 8 bytes of them (a word and a pair for two characters).
SHARED_BYTES = 1 << 27


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of some texts, each text closed by an end token (an empty word), and their numbers.

    Words stand between white space (0x20, 0x09-0x0D), A-Z lower-cased.
    """
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    edge = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    text = bytes(memoryview(data)[edge[0]:edge[-1]]).lower() if data is not None else b""
    edge = edge - edge[0]
    at = np.frombuffer(text, np.uint8)
    inside = (at != 32) & ((at - np.uint8(9)) > 4)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = edge[:-1][edge[1:] > edge[:-1]]  # a word ends with its text
    first[full] = inside[full]
    full = edge[1:][edge[1:] > edge[:-1]] - 1
    last[full] = inside[full]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = np.diff(np.searchsorted(start, edge))
    h = np.full(len(start) + len(words), word_hashes([b""])[0], np.uint64)
    h[np.arange(len(start)) + np.repeat(np.arange(len(words)), words)] = span_hashes(text, start, end - start)
    return h, words + 1


def pair_hashes(h: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it in its text."""
    before = np.concatenate((h[-1:], h[:-1]))
    before[np.cumsum(size) - size] = word_hashes([b""])[0]
    return chain([before, h])


def block_of(gram: np.ndarray, blocks: int) -> np.ndarray:
    return ((gram >> np.uint64(17)) % np.uint64(blocks)).astype(np.int64)


def by_shard(gram: np.ndarray, blocks: int, per: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of grams in the order of their shards (``per`` blocks each), and where each shard's begin, with the end."""
    shards = -(-blocks // per)
    shard = block_of(gram, blocks) // per
    by = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    return by, np.concatenate(([0], np.cumsum(np.bincount(shard, minlength=shards))))


def packed(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """The bytes of consecutive stretches of ``values``, which begin at ``edge``."""
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer((edge * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of packed stretches, and where each stretch begins, with the end."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind), np.cumsum([0, *map(len, parts)]) // np.dtype(kind).itemsize


def in_runs(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Consecutive rows of at most ``chars`` (or one row), and the number of their run, which is the same each time that a part of the rows is read."""
    run = TaskContext.get().partitionId() << 40
    for b in batches:
        for i, j in runs(pc.fill_null(pc.utf8_length(b.column("text")), 0).to_pylist(), chars):
            yield run, b.slice(i, j - i)
            run += 1


class Filters:
    """Filters of the blocks of one shard. A block without grams is one empty word."""

    def __init__(self, gram: np.ndarray, level: np.ndarray, blocks: int, first: int, per: int, bits_per_key: int):
        self.blocks, self.first = blocks, first
        block = block_of(gram, blocks) - first
        keys = np.bincount(block, level, per).astype(np.int64)
        self.bits = np.maximum(64, (bits_per_key * keys + 63) // 64 * 64)
        self.start = np.cumsum(self.bits) - self.bits
        self.data = np.zeros(int(self.bits.sum()), bool)
        for k in range(1, int(level.max(initial=0)) + 1):
            for p in self.places(gram[level >= k], k):
                self.data[p] = True

    def places(self, gram: np.ndarray, level: int) -> Iterator[np.ndarray]:
        """Bit numbers of (gram, level)."""
        block = block_of(gram, self.blocks) - self.first
        bits, start = self.bits.astype(np.uint64)[block], self.start[block]
        x = mix(gram + np.uint64(0x9E3779B97F4A7C15 * level % 2 ** 64))
        step = mix(x) | np.uint64(1)
        return (((x + np.uint64(k) * step) % bits).astype(np.int64) + start for k in range(PROBES))

    def read(self, gram: np.ndarray) -> np.ndarray:
        """Level of each gram's count; 0 for a gram that is not there."""
        level = np.zeros(len(gram), np.uint8)
        todo = np.arange(len(gram))
        for k in range(1, 64):
            hit = np.ones(len(todo), bool)
            for p in self.places(gram[todo], k):
                hit &= self.data[p]
            todo = todo[hit]
            if not len(todo):
                break
            level[todo] = k
        return level


def added(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams in order, the sums of their counts, and the position of each given gram among them."""
    by = np.argsort(gram, kind="stable")
    new = np.ones(len(gram), bool)
    new[1:] = gram[by[1:]] != gram[by[:-1]]
    first = np.flatnonzero(new)
    at = np.empty(len(gram), np.int64)
    at[by] = np.cumsum(new) - 1
    return gram[by[first]], np.add.reduceat(n[by].astype(np.int64), first) if len(n) else np.zeros(0, np.int64), at


def per_shard() -> int:
    """Blocks of a shard."""
    return max(1, SHARED_BYTES // (8 * BLOCK_CHARS))


ASKED = "shard bigint, run bigint, word binary, word_n binary, pair binary, pair_n binary"
COUNTED = "shard bigint, data binary, tokens bigint, kinds bigint, answers array<struct<run bigint, word_n binary, word_level binary, pair_level binary>>"


def counts(docs: DataFrame, blocks: int, train: Column | None = None) -> DataFrame:
    """One row per shard of blocks: their filter, the sum of the counts of their words, the number of these, and the answers to all runs of docs.

    Rows where ``train`` is false (none, if it is not given) ask but are not counted.
    """
    per = per_shard()

    def ask(batches):
        for run, b in in_runs(batches, RUN_CHARS):
            counted = b.column("train")
            rest = token_hashes(b.filter(pc.invert(counted)).column("text"))
            seen = token_hashes(b.filter(counted).column("text"))
            cut, full = {}, 0
            for name, g, more in (("word", seen[0], rest[0]), ("pair", pair_hashes(*seen), pair_hashes(*rest))):
                key, n = np.unique(np.concatenate((g, more)), return_counts=True)
                key_more, n_more = np.unique(more, return_counts=True)
                n[np.searchsorted(key, key_more)] -= n_more
                by, edge = by_shard(key, blocks, per)
                cut[name], cut[f"{name}_n"] = packed(key[by], edge), packed(n[by].astype(np.uint32), edge)
                full = full + np.diff(edge)
            yield pa.RecordBatch.from_pydict({"shard": np.arange(len(full)), "run": np.full(len(full), run), **cut}).filter(pa.array(full > 0))

    def fill(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        (words, word_n, word_at, word_edge), (pairs, pair_n, pair_at, pair_edge) = (
            (*added(gram, unpacked(rows.column(f"{name}_n"), np.uint32)[0]), edge) for name in ("word", "pair") for gram, edge in [unpacked(rows.column(name), np.uint64)])
        gram, n = np.concatenate((words, pairs)), np.concatenate((word_n, pair_n))
        there = n > 0
        filters = Filters(gram[there], np.frexp(n[there])[1], blocks, shard * per, per, BITS_PER_KEY)
        level = filters.read(gram)
        answers = pa.StructArray.from_arrays([rows.column("run").combine_chunks(), packed(word_n[word_at], word_edge), packed(level[:len(words)][word_at], word_edge),
                                              packed(level[len(words):][pair_at], pair_edge)], ["run", "word_n", "word_level", "pair_level"])
        return pa.table({"shard": [shard], "data": [np.packbits(filters.data, bitorder="little").tobytes()], "tokens": [int(word_n.sum())], "kinds": [int((word_n > 0).sum())],
                         "answers": pa.ListArray.from_arrays(pa.array([0, len(answers)], pa.int32()), answers)})
    rows = docs.select("text", (F.lit(True) if train is None else train).alias("train"))
    return rows.mapInArrow(tidy(ask), ASKED).groupBy("shard").applyInArrow(fill, COUNTED)


def middle(level: np.ndarray) -> np.ndarray:
    """Middle of the range of counts of each level."""
    return np.where(level == 0, 0.0, np.where(level == 1, 1.0, 1.5 * 2.0 ** (level.astype(np.int64) - 1)))


def answered(gram: np.ndarray, blocks: int, per: int, column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The answers of all shards, in their order, as one for each of a run's distinct grams."""
    values = unpacked(column, kind)[0]
    if len(values) != len(gram):
        raise RuntimeError("a run of documents was read twice, with other rows the second time")
    out = np.empty(len(gram), kind)
    out[by_shard(gram, blocks, per)[0]] = values
    return out


SCORED = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def scored_runs(docs: DataFrame, answers: DataFrame, blocks: int, total: int, kinds: int) -> DataFrame:
    """Scored rows of docs (doc_id, text) by the answers to their runs."""
    per = per_shard()

    def dealt(batches):
        for run, b in in_runs(batches, RUN_CHARS):
            yield pa.RecordBatch.from_pydict({"run": np.full(len(b), run), "doc_id": b.column("doc_id"), "text": b.column("text")})

    def scored(rows: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("shard")
        h, size = token_hashes(rows.column("text").combine_chunks())
        edge = np.cumsum(size) - size
        word, at = np.unique(h, return_inverse=True)
        pair, pair_at = np.unique(pair_hashes(h, size), return_inverse=True)
        before = np.concatenate((at[-1:], at[:-1]))
        before[edge] = np.searchsorted(word, word_hashes([b""])[0])
        c = middle(answered(word, blocks, per, found.column("word_level"), np.uint8))
        n = answered(word, blocks, per, found.column("word_n"), np.int64)
        ratio = np.minimum(1.0, middle(answered(pair, blocks, per, found.column("pair_level"), np.uint8))[pair_at] / np.maximum(c[before], 1.0))
        p = LAMBDA * ratio + (1 - LAMBDA) * (c[at] + 1) / (total + kinds + 1)
        exact = np.log10(n + 1.0) - math.log10(total + kinds + 1)
        return pa.table({"doc_id": rows.column("doc_id"), "n_tokens": size, "n_known": np.add.reduceat((n > 0).astype(np.int64)[at], edge),
                         "base_score": np.add.reduceat(exact[at], edge), "score": np.minimum(np.add.reduceat(np.log10(np.minimum(p, 1.0)), edge), 0.0)})
    return docs.mapInArrow(tidy(dealt), "run bigint, doc_id bigint, text string").groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(scored, SCORED)


def steady(docs: DataFrame) -> DataFrame:
    """The rows, so that each plan reads them in the same order and parts: rows of files as they are, others are written first."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.children().head()
    return docs if plan.nodeName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation" else settle(docs, "lm_documents")


@contextmanager
def same_parts(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside cut files into the same parts, also while executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    unset = spark.conf.get(name, None) is None
    if unset:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(name)


def scores(docs: DataFrame, train: Column) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; the counts are those of the rows where ``train`` is true."""
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(train, F.lit(False)).alias("train"))
    docs = steady(given)
    chars = docs.agg(F.sum(F.length("text") * F.when(F.col("train"), 2).otherwise(1))).first()[0] or 0
    blocks = math.ceil((chars + 1) / BLOCK_CHARS)
    with same_parts(docs.sparkSession):
        table = settle(counts(docs, blocks, F.col("train")).drop("data"), "lm_counts")
        total, kinds = (int(x or 0) for x in table.agg(F.sum("tokens"), F.sum("kinds")).first())
        rows = settle(scored_runs(docs.select("doc_id", "text"), table.select("shard", F.inline("answers")), blocks, total, kinds), "lm_rows")
    discard(table)
    if docs is not given:
        discard(docs)
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id"), 7, 2), F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                       F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")


def predictions(docs: DataFrame) -> DataFrame:
    return scores(docs, ~F.coalesce(held_out(F.col("doc_id"), 7, 2), F.lit(True)))
