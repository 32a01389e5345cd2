"""Byte-level BPE on padded numpy matrices.

The pieces of a batch that are not remembered are sorted into buckets by byte length and every
bucket is one padded matrix of token ids. In each round every row merges its
leftmost pair of minimum rank; pairs are found in a hashed table, merged rows are
compacted, and finished rows leave. Pieces beyond ``MATRIX_BYTES`` would need as
many rounds as they have merges, so these follow the same rule with a heap.

Null and empty texts give no ids. Repeated rows and ids are encoded row by row,
further columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, texts, tidy

MATRIX_BYTES = 128
KNOWN_CHARS = 2_000_000
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Ranks of byte strings, with an open-addressing table of all mergeable pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.known_chars = 0
        left, right, out = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    out.append(rank)
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        self.pairs = dict(zip(keys.tolist(), out))
        self.bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_rank = np.full(1 << self.bits, NONE, np.int32)
        self.probes = 1
        todo, slot, step = np.arange(len(keys)), self._slot(keys), 0
        values = np.array(out, np.int32)
        while len(todo):
            at = (slot[todo] + step) & ((1 << self.bits) - 1)
            free = self.slot_key[at] == -1
            self.slot_key[at[free]] = keys[todo[free]]  # the last writer of a slot has it
            won = free & (self.slot_key[at] == keys[todo])
            self.slot_rank[at[won]] = values[todo[won]]
            todo, step = todo[~won], step + 1
            self.probes = step

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        out = np.full(keys.shape, NONE, np.int32)
        flat, res = keys.ravel(), out.ravel()
        todo = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        home = self._slot(flat[todo])
        for step in range(self.probes):
            at = (home + step) & ((1 << self.bits) - 1)
            found = self.slot_key[at]
            hit = found == flat[todo]
            res[todo[hit]] = self.slot_rank[at[hit]]
            more = ~hit & (found != -1)
            todo, home = todo[more], home[more]
            if not len(todo):
                break
        return res.reshape(keys.shape)

    def merge_matrix(self, rows: list[bytes]) -> list[np.ndarray]:
        """Ids of byte strings of similar length."""
        out: list[np.ndarray | None] = [None] * len(rows)
        width = max(map(len, rows))
        m = np.full((len(rows), width), -1, np.int32)
        for i, r in enumerate(rows):
            m[i, :len(r)] = self.bytes[np.frombuffer(r, np.uint8)]
        live = np.arange(len(rows))
        while len(live):
            if m.shape[1] > 1:
                rank = self.pair_ranks(m[:, :-1], m[:, 1:])
                at = rank.argmin(axis=1)  # the first of equals is the leftmost
                best = rank[np.arange(len(m)), at]
            else:
                at, best = np.zeros(len(m), np.int64), np.full(len(m), NONE)
            done = best == NONE
            for i in np.flatnonzero(done):
                out[live[i]] = m[i][m[i] >= 0]
            m, at, best, live = m[~done], at[~done], best[~done], live[~done]
            if not len(live):
                break
            m[np.arange(len(m)), at] = best
            column = np.arange(m.shape[1] - 1)
            m = np.where(column[None, :] <= at[:, None], m[:, :-1], m[:, 1:])
            m = m[:, :max(1, int((m >= 0).sum(axis=1).max()))]
        return out  # type: ignore[return-value]

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges, picked from a heap of (rank, position)."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pair = self.pairs.get
        heap = [(r, i) for i in range(len(ids) - 1) if (r := pair(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or pair(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(ids):
                    r = pair(ids[k] << 32 | ids[after[k]])
                    if r is not None:
                        heapq.heappush(heap, (r, k))
        return np.array([t for t in ids if t >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif len(p) > MATRIX_BYTES:
                out[i] = self.merge_long(p)
            elif p:
                buckets.setdefault((len(p) + 3) // 4, []).append(i)
        for members in buckets.values():
            for i, ids in zip(members, self.merge_matrix([pieces[i] for i in members])):
                out[i] = ids
        return out

    def learn(self, pieces: list[str]) -> None:
        for p, ids in zip(pieces, self.encode_pieces([p.encode("utf-8") for p in pieces])):
            self.known[p] = ids.astype("<i4").tobytes()
            self.known_chars += len(p)

    def forget(self, most: int = KNOWN_CHARS) -> None:
        """Keep what a worker remembers bounded; results do not depend on it."""
        if self.known_chars > most:
            self.known, self.known_chars = {}, 0


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def encode(texts_: list[str], vocab: Vocabulary, pattern) -> list[np.ndarray]:
    """Ids of every text; a piece is merged when it is first met, and its ids are remembered."""
    split = [pattern.findall(t) for t in texts_]
    vocab.learn(list(set().union(*split) - vocab.known.keys()))
    out = [np.frombuffer(b"".join(map(vocab.known.__getitem__, s)), "<i4") for s in split]
    vocab.forget()
    return out


def decode(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.tokens.__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                     batch_chars: int = 2_000_000, packed: bool = False) -> DataFrame:
    """Encode and decode every text: id, ``ids`` and ``decoded`` (binary) per row.

    ``ids`` is an array of int, or if ``packed`` a binary of little-endian unsigned 32-bit integers.
    """
    def run(batches):
        import regex
        vocab, split = vocabulary(ranks_path), regex.compile(pattern)
        for b in batches:
            t = texts(b["text"])
            for i, j in runs([len(x) for x in t], batch_chars):
                ids = encode(t[i:j], vocab, split)
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[i:j], "ids": [x.tobytes() for x in ids] if packed else ids,
                                    "decoded": [decode(x, vocab) for x in ids]})
        vocab.forget(0)
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInPandas(
        tidy(run), f"doc_id bigint, ids {'binary' if packed else 'array<int>'}, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """Digest columns of packed ``encode_documents``."""
    return encoded.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
