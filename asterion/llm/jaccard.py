"""N-gram Jaccard join with token-combination prefixes.

A document is its set of 4-word shingles (64-bit hashes, the tokens). Equal sets
are one set from the start, named by a 64-bit hash. Tokens are ordered by class, rare before
frequent, then by hash; classes come from a fixed-size count sketch over the
sets of all partitions (they shape the order only, so a coarse sketch costs time, not links).
Two sets that link share at least ``need = ceil(0.85 n)`` tokens, so their first
common token is among the first n-need+1 of each, their first k common tokens among
the first n-need+k.

Every set is indexed by the single tokens of its prefix. Sets per key are counted
exactly: rows of a key with one set go before any join, by a bitmap of the other keys, and where a frequent key has more pairs of sets than combinations with a further
prefix token, each of its sets is indexed anew by those combinations of k+1 tokens,
up to LONGEST tokens; a key with fewer pairs keeps them. A key carries its
position: sets that first meet there share at most what follows it, and rows
and pairs that cannot reach a link any more are left out inside the joins.

Keys are not expanded into pairs at once. Two rounds link each set with a hub of its
key (verified exactly), which joins groups of near copies: first with the set that can
share most from the key on, which is the one with the fewest tokens of its own, then
with any. Only sets of one key that still lie in different components meet. A candidate goes only by a bound
that no link can break: the lengths, the positions, or the difference of two parity bitmaps (a bit
per token, flipped by each token that falls on it), which is never larger than the
difference of the sets. A hot key is spread over tasks by the skew handling of the
join. Sets are not kept: those of the candidates are made again from their texts,
which a bitmap of fixed size picks out; a full bitmap would only let more through.

Null and empty texts have empty sets and are their own component; repeated rows
fall together; a null id keeps its row with a null component; extra columns are
ignored; ties in the order of tokens do not occur, as hashes in a set differ.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterion.storage import settle

from .common import MARKS, bitmap, grams, marked, marks, possibly_in, runs, space_words, text_key, texts, tidy, without, word_hashes

SKETCH = 1 << 20
CELLS = 1 << 14
ROUNDS = 2
LONGEST = 3
FEW = 64


def shingle_sets(texts_: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [space_words(t) for t in texts_]
    h = word_hashes([x for w in words for x in w])
    whole = grams(h, n)
    out, at = [], 0
    for w in words:
        if len(w) >= n:
            g = np.sort(whole[at:at + len(w) - n + 1])
            out.append(g[np.concatenate(([True], g[1:] != g[:-1]))])
        else:
            out.append(grams(h[at:at + len(w)], len(w)) if w else np.zeros(0, np.uint64))
        at += len(w)
    return out


def parity(tokens: np.ndarray) -> bytes:
    """Parity bitmap of a power of two bytes, about a bit per token."""
    size = max(8, 1 << (max(1, len(tokens)) // 8).bit_length())
    bits = np.bincount((tokens % np.uint64(8 * size)).astype(np.int64), minlength=8 * size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A number that the difference of two sets is never below."""
    while len(a) > len(b):
        a, b = b, a
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    size = len(b)
    while size > len(a):  # halves of the wider one laid on each other
        size //= 2
        y = (y >> (8 * size)) ^ (y & ((1 << (8 * size)) - 1))
    return (x ^ y).bit_count()


def named_sets(texts_: list[str], n: int) -> list[tuple[int, np.ndarray]]:
    import xxhash
    s = shingle_sets(texts_, n)
    return list(zip(np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in s], np.uint64).view(np.int64).tolist(), s))


def scan(docs: DataFrame, n: int) -> DataFrame:
    """A row per document (doc_id, key of its text, n, set, bits where the task meets the set first), and each task's part of the count sketch."""
    def run(batches):
        seen, counts = set(), np.zeros(SKETCH, np.int32)
        for b in batches:
            t = texts(b["text"])
            for i, j in runs([len(x) for x in t], 2_000_000):
                named, bits, fresh = named_sets(t[i:j], n), [], []
                for name, x in named:
                    first = len(x) > 0 and name not in seen
                    bits.append(parity(x) if first else None)
                    if first:
                        seen.add(name)
                        fresh.append(x)
                if fresh:
                    counts += np.bincount((np.concatenate(fresh) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH).astype(np.int32)
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[i:j].astype("Int64"), "key": b["key"].iloc[i:j].astype("Int64"), "n": [len(x) for _, x in named], "set": [k for k, _ in named],
                                    "bits": bits, "task": None, "part": None, "counts": None})
        if seen:
            task = TaskContext.get().partitionId()
            for k in range(0, SKETCH, CELLS):
                yield pd.DataFrame({"doc_id": [None], "key": [None], "n": [None], "set": [None], "bits": [None], "task": [task], "part": [k], "counts": [counts[k:k + CELLS].tobytes()]})
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_key(docs).alias("key")).mapInPandas(
        tidy(run), "doc_id bigint, key bigint, n bigint, set bigint, bits binary, task bigint, part bigint, counts binary")


def token_classes(parts: DataFrame) -> np.ndarray:
    """Class of each cell of the sketch, the binary logarithm of its count; tasks are added up in groups of 256, then the groups."""
    def add(rows):
        total = np.sum([np.frombuffer(x, np.int64) for x in rows["counts"]], axis=0)
        return pd.DataFrame({"task": rows["task"].iloc[:1].to_numpy() // 256, "part": rows["part"].iloc[:1].to_numpy(), "counts": [total.tobytes()]})

    def add_tasks(rows):
        return add(rows.assign(counts=[np.frombuffer(x, np.int32).astype(np.int64).tobytes() for x in rows["counts"]]))
    schema = "task bigint, part bigint, counts binary"
    some = parts.groupBy("part", F.floor(F.col("task") / 256)).applyInPandas(add_tasks, schema)
    total = np.zeros(SKETCH, np.int64)
    for r in some.groupBy("part").applyInPandas(add, schema).toLocalIterator():
        total[r.part:r.part + CELLS] = np.frombuffer(bytes(r.counts), np.int64)
    return np.ceil(np.log2(total + 1)).astype(np.uint8)


def prefix(tokens: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a set in the common order, as many as combinations of LONGEST tokens need."""
    n = len(tokens)
    order = np.argsort(classes[(tokens % np.uint64(SKETCH)).astype(np.int64)], kind="stable")
    return tokens[order[:n + percent * -n // 100 + LONGEST]]


def need(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def reach(n: Column, on: Column, most: Column, percent: int) -> Column:
    """Whether sets of these sizes can link when they share at most so many tokens."""
    return most * (100 + percent) >= percent * (n + on)


def near(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def plausible(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps leave room for a link: the difference of linked sets is at most (100 - percent) / (100 + percent) of both lengths."""
    def run(batches):
        for p in batches:
            room = (100 - percent) * (p["na"] + p["nb"])
            low = np.array([least_difference(bytes(x), bytes(y)) for x, y in zip(p["ba"], p["bb"])], np.int64)
            yield p.loc[low * (100 + percent) <= room.to_numpy(), ["a", "b"]]
    side = lambda x: table.select(F.col("set").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"b{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ba", "bb").mapInPandas(tidy(run), "a bigint, b bigint")


def mark(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(MARKS))


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """Sets (set, n, tokens) of the wanted (set, rep), made from the texts of the documents ``rep``."""
    shared = marks(mark(F.col("rep")), wanted)

    def run(batches):
        bits = bitmap(shared.value)
        for b in batches:
            b = b[marked(bits, b["mark"].to_numpy())]
            t = texts(b["text"])
            for i, j in runs([len(x) for x in t], 2_000_000):
                named = named_sets(t[i:j], n)
                yield pd.DataFrame({"rep": b["doc_id"].iloc[i:j], "set": [k for k, _ in named], "n": [len(x) for _, x in named], "tokens": [x.view(np.int64) for _, x in named]})
    made = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("mark", mark(F.col("doc_id"))).mapInPandas(
        tidy(run), "rep bigint, set bigint, n bigint, tokens array<bigint>")
    return made.join(wanted, ["set", "rep"]).select("set", "n", "tokens")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, by exact intersection."""
    side = lambda x: sets.select(F.col("set").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").where(both * 100 >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest set reachable (set, comp): labels spread over links, then jump along labels."""
    both = settle(edges.union(edges.select("b", "a")).distinct(), "jaccard_edges")
    label = settle(both.groupBy(F.col("a").alias("set")).agg(F.min(F.least("a", "b")).alias("comp")), "jaccard_labels")
    while True:
        best = (both.join(label.select(F.col("set").alias("b"), "comp"), "b").groupBy(F.col("a").alias("set")).agg(F.min("comp").alias("other")))
        step = label.join(best, "set").select("set", F.least("comp", "other").alias("next"), "comp")
        jump = label.select(F.col("set").alias("next"), F.col("comp").alias("far"))
        new = settle(step.join(jump, "next", "left").select("set", F.least("next", F.coalesce("far", "next")).alias("comp"), F.col("comp").alias("was")), "jaccard_labels")
        done = new.where("comp <> was").isEmpty()
        label = new.select("set", "comp")
        if done:
            return nodes.join(label, "set", "left").select("set", F.coalesce("comp", "set").alias("comp"))


def can_meet(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of keys with several components that could link with the shortest set of the key that their own length admits; ``sets`` and ``longer`` are the key's sets and their combinations with one more token."""
    stats = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("least")).where("lo < hi")
    rows = rows.join(stats.select("key", "least"), "key").where(reach(F.col("n"), F.greatest("least", need(F.col("n"), percent)), F.col("most"), percent)).drop("least")
    later = need(F.col("n"), percent) * -1 + F.col("n") + F.col("k") - F.col("pos")
    stats = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("sets"), F.sum(later).alias("longer")).where("lo < hi")
    return rows.join(stats.drop("lo", "hi"), "key")


def partners(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of one key (a, b) that lie in different components and could link."""
    other = rows.select("key", F.col("set").alias("o"), F.col("n").alias("on"), F.col("most").alias("omost"), F.col("comp").alias("oc"))
    return rows.join(other, "key").where((F.col("set") < F.col("o")) & (F.col("comp") != F.col("oc")) & near(F.col("n"), F.col("on"), percent)
                                         & reach(F.col("n"), F.col("on"), F.least("most", "omost"), percent)).select(F.col("set").alias("a"), F.col("o").alias("b"))


def open_pairs(rows: DataFrame, raw: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets that share a key: combinations grow by a token where they are fewer than the pairs of their key."""
    out, k = None, 1
    rows = rows.select("key", "set", "n", "pos", "most", "comp").distinct()
    while True:
        rows = settle(can_meet(rows.withColumn("k", F.lit(k)), percent), "jaccard_open")
        hot = (F.col("sets") > FEW) & (F.col("sets") * (F.col("sets") - 1) > 2 * F.col("longer")) if k < LONGEST else F.lit(False)
        met = partners(rows.where(~hot | (need(F.col("n"), percent) <= k)), percent)  # sets that may share no further token meet here in any case
        out = met if out is None else out.union(met)
        rows = rows.where(hot)
        if k == LONGEST or rows.isEmpty():
            return out.distinct()
        token = raw.select("set", F.col("key").alias("token"), F.col("pos").alias("at"))
        rows = rows.join(token, "set").where((F.col("at") > F.col("pos")) & (F.col("at") <= F.col("n") - need(F.col("n"), percent) + k)).select(
            F.xxhash64("key", "token").alias("key"), "set", "n", F.col("at").alias("pos"), (F.col("n") - F.col("at") + k).alias("most"), "comp").distinct()
        k += 1


def near_rows(docs: DataFrame, *, n: int = 4, percent: int = 85) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, key of the text, and the component itself (two can have one id, when an id has two texts)."""
    scanned = settle(scan(docs, n), "jaccard_scan")
    rows = scanned.where("part IS NULL").select("doc_id", "key", "n", "set")
    table = settle(scanned.where("part IS NULL AND n > 0 AND doc_id IS NOT NULL").groupBy("set").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")).join(
        scanned.where("bits IS NOT NULL").groupBy("set").agg(F.max("bits").alias("bits")), "set"), "jaccard_table")
    shared = docs.sparkSession.sparkContext.broadcast(token_classes(scanned.where("part IS NOT NULL").select("task", "part", "counts")))

    def emit(batches):
        seen = set()
        for b in batches:
            t = texts(b["text"])
            for i, j in runs([len(x) for x in t], 2_000_000):
                keys, names = [np.zeros(0, np.uint64)], []
                for name, x in named_sets(t[i:j], n):
                    if len(x) and name not in seen:
                        seen.add(name)
                        keys.append(prefix(x, shared.value, percent))
                        names.append((name, len(x)))
                size = [len(x) for x in keys[1:]]
                yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "set": np.repeat(np.array([k for k, _ in names], np.int64), size),
                                    "n": np.repeat(np.array([k for _, k in names], np.int32), size),
                                    "pos": np.concatenate([np.arange(x, dtype=np.int32) for x in size] or [np.zeros(0, np.int32)])})
    raw = settle(docs.where("doc_id IS NOT NULL").select("text").mapInPandas(tidy(emit), "key bigint, set bigint, n int, pos int"), "jaccard_prefixes")
    first = raw.where(F.col("pos") <= F.col("n") - need(F.col("n"), percent)).withColumn("most", F.col("n") - F.col("pos"))
    multi = first.groupBy("key").agg(F.min("set").alias("lo"), F.max("set").alias("hi"), F.min("n").alias("least")).where("lo < hi").select("key", "least")
    multi = settle(multi, "jaccard_multi")
    keys = settle(possibly_in(first, "key", multi).join(multi, "key").where(reach(F.col("n"), F.greatest("least", need(F.col("n"), percent)), F.col("most"), percent)).drop("least").distinct(), "jaccard_keys")
    nodes, comp, links, tried = table.select("set"), None, None, None
    for k in range(ROUNDS + 1):
        at = keys.withColumn("comp", F.col("set")) if comp is None else keys.join(comp, "set")
        if k < ROUNDS:
            best = F.col("most") / F.col("n") if k == 0 else F.lit(0.0)
            split = at.groupBy("key").agg(F.max(F.struct(best.alias("best"), F.xxhash64("set", F.lit(k)), "set", "n", "most", "comp")).alias("hub"),
                                          F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
            pairs = at.join(split, "key").select("set", "n", "most", "comp", *[F.col(f"hub.{x}").alias(y) for x, y in (("set", "o"), ("n", "on"), ("most", "omost"), ("comp", "oc"))])
            pairs = pairs.where((F.col("comp") != F.col("oc")) & near(F.col("n"), F.col("on"), percent) & reach(F.col("n"), F.col("on"), F.least("most", "omost"), percent)).select(
                F.least("set", "o").alias("a"), F.greatest("set", "o").alias("b")).distinct()
        else:
            pairs = open_pairs(at, raw, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = settle(plausible(pairs, table, percent), "jaccard_pairs")
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.union(pairs)
        wanted = settle(pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct().join(table.select("set", "rep"), "set"), "jaccard_wanted")
        good = settle(verified(pairs, settle(sets_of(docs, wanted, n), "jaccard_sets"), percent), "jaccard_links")
        links = good if links is None else links.union(good)
        comp = settle(components(nodes, links), "jaccard_comp")
    named = table.select("set", F.col("rep").alias("component"), F.col("set").alias("comp"))
    if comp is not None:
        named = table.join(comp, "set")
        named = named.join(named.groupBy("comp").agg(F.min("rep").alias("component")), "comp").select("set", "component", "comp")
    return rows.join(named, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), "key", "comp")


def near_classes(docs: DataFrame, *, n: int = 4, percent: int = 85) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    return near_rows(docs, n=n, percent=percent).drop("key", "comp")


def keep_one(docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """Documents of which one of each group stays, that with the smallest id, decided row by row.

    Of different texts with that id in one group, one stays; texts without words and rows without an id stay.
    """
    rows = settle(near_rows(docs, n=n, percent=percent).where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "component_id", "key", "comp"), "jaccard_rows")
    heads = rows.where("doc_id = component_id").groupBy("comp").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most")
    twins = rows.where("doc_id = component_id").join(heads, "comp").where("key > least")
    gone = rows.where("doc_id <> component_id").select("doc_id", "key").union(twins.select("doc_id", "key")).distinct()
    return without(docs, gone, text_key(docs))
