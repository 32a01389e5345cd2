"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import hashlib
import string
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterion.storage import settle

MARKS = 1 << 27
ASCII_FOLD = {ord(a): a.lower() for a in string.ascii_uppercase}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table; Arrow batches are kept small since texts can be long."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows per Arrow batch for plans built from here on; a Python worker holds one batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold(text: str) -> str:
    """Lower-case A-Z only."""
    return text.translate(ASCII_FOLD)


def fold_col(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def texts(column: pd.Series) -> list[str]:
    """Null texts become empty ones."""
    return [t if isinstance(t, str) else "" for t in column]


def runs(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose lengths add up to at most ``most`` (or one item)."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def give_back() -> None:
    """Frees what a Python worker remembers and returns the free pages of its allocators to the system."""
    _known.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInPandas and mapInArrow, whose worker gives its memory back after each task.

    Workers serve the tasks of all later stages, so what one stage leaves behind would add to the next one's need.
    """
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


def text_key(docs: DataFrame) -> Column:
    """With the id, tells rows of one id apart; only rows with one id and one text share both."""
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def keyed(docs: DataFrame, key: Column) -> tuple[DataFrame, str]:
    """The rows with ``key`` as one more column, and its name, which no column of theirs has."""
    name = "key"
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    return docs.withColumn(name, key), name


def matched(rows: DataFrame, name: str, chosen: DataFrame, how: str) -> DataFrame:
    """Rows whose id and column ``name`` are (left_semi) or are not (left_anti) in ``chosen`` (doc_id, key), compared null-safe."""
    return rows.join(chosen, rows["doc_id"].cast("bigint").eqNullSafe(chosen["doc_id"]) & rows[name].eqNullSafe(chosen["key"]), how)


def without(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """The rows of docs whose id and ``key`` are not in ``gone`` (doc_id, key)."""
    rows, name = keyed(docs, key)
    return matched(rows, name, settle(gone, "rows_gone"), "left_anti").drop(name)


def marks(at: Column, rows: DataFrame) -> Broadcast:
    """The numbers ``at`` (0 to MARKS - 1) of the rows as pages of a bitmap, for ``marked``; at most MARKS bits at any number of rows."""
    maps = rows.groupBy(F.floor(at / 32768).alias("page")).agg(F.bitmap_construct_agg(at % 32768).alias("bits"))
    return rows.sparkSession.sparkContext.broadcast({r.page: bytes(r.bits) for r in maps.toLocalIterator()})


def bitmap(pages: dict[int, bytes]) -> np.ndarray:
    out = np.zeros((MARKS // 32768, 4096), np.uint8)
    for page, bits in pages.items():
        out[page] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def marked(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def possibly_in(rows: DataFrame, name: str, wanted: DataFrame) -> DataFrame:
    """The rows whose 64-bit hash ``name`` is in ``wanted`` (and a few more, by a bitmap of fixed size), without a shuffle of rows."""
    shared = marks(F.col(name).bitwiseAND(F.lit(MARKS - 1)), wanted.select(name))

    def run(batches):
        bits = bitmap(shared.value)
        for b in batches:
            yield b.filter(pa.array(marked(bits, b.column(name).to_numpy(zero_copy_only=False) & (MARKS - 1))))
    return rows.mapInArrow(tidy(run), rows.schema)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == part


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def space_words(text: str) -> list[bytes]:
    """Words between white space (0x20, 0x09-0x0D), A-Z lower-cased; byte methods touch ASCII only."""
    return text.encode("utf-8").lower().split()


class _Hashes(dict):
    """Hash of each word met; long words are not kept."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_known = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word, alike on every machine."""
    if len(_known) > 300_000:  # bounds the memory only
        _known.clear()
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


#: The part of XXH3's secret that hashes of 1 to 16 bytes use.
_SECRET = np.frombuffer(bytes.fromhex("b8fe6c3923a44bbe7c01812cf721ad1cded46de9839097db7240a4a4b7b3671fcb79e64eccc0e578825ad07dccff7221b8084674f743248e"), np.uint64)


def span_hashes(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``word_hashes`` of the stretches of ``data``, none of them empty; those of up to 16 bytes without a Python object each."""
    import xxhash
    u, low = np.uint64, np.uint64(0xFFFFFFFF)
    at = np.frombuffer(data + bytes(8), np.uint8)
    four, eight = (np.ndarray(len(at) - n + 1, f"<u{n}", at, strides=(1,)) for n in (4, 8))
    out = np.empty(len(start), u)
    k = np.flatnonzero(size < 4)
    s, n = start[k], size[k]
    h = (at[s].astype(u) << u(16)) | (at[s + (n >> 1)].astype(u) << u(24)) | at[s + n - 1].astype(u) | (n.astype(u) << u(8))
    h ^= (_SECRET[0] ^ (_SECRET[0] >> u(32))) & low
    h = (h ^ (h >> u(33))) * u(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> u(29))) * u(0x165667B19E3779F9)
    out[k] = h ^ (h >> u(32))
    k = np.flatnonzero((size >= 4) & (size <= 8))
    s, n = start[k], size[k]
    h = ((four[s].astype(u) << u(32)) + four[s + n - 4]) ^ _SECRET[1] ^ _SECRET[2]
    h ^= ((h << u(49)) | (h >> u(15))) ^ ((h << u(24)) | (h >> u(40)))
    h *= u(0x9FB21C651E98DF25)
    h = (h ^ ((h >> u(35)) + n.astype(u))) * u(0x9FB21C651E98DF25)
    out[k] = h ^ (h >> u(28))
    k = np.flatnonzero((size > 8) & (size <= 16))
    s, n = start[k], size[k]
    a, b = eight[s] ^ _SECRET[3] ^ _SECRET[4], eight[s + n - 8] ^ _SECRET[5] ^ _SECRET[6]
    cross = (((a & low) * (b & low)) >> u(32)) + (((a >> u(32)) * (b & low)) & low) + (a & low) * (b >> u(32))
    high = (((a >> u(32)) * (b & low)) >> u(32)) + (cross >> u(32)) + (a >> u(32)) * (b >> u(32))
    h = n.astype(u) + a.byteswap() + b + ((a * b) ^ high)
    h = (h ^ (h >> u(37))) * u(0x165667919E3779F9)
    out[k] = h ^ (h >> u(32))
    for k in np.flatnonzero(size > 16).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[start[k]:start[k] + size[k]])
    return out


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for the n hashes from each position on, order included."""
    m = max(0, len(h) - n + 1)
    out = np.full(m, n, np.uint64)
    for k in range(n if m else 0):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[k:k + m]
    return mix(out)


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for a sequence of hashes, order included."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + p + np.uint64(1))
    return out
