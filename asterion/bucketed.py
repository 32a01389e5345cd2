"""Tables that are kept up to date by rewriting only what a batch touches.

A table's rows are dealt over a fixed number of buckets by a hash of their key. A version is a
manifest: for each bucket the folders that hold its rows. A batch writes the buckets it
touches to new folders and carries all others by reference, so what is read
and written follows the batch, not the table. Manifests are committed by Spark's own marker
(:mod:`asterion.storage`), numbered by batch id, and a retried batch starts from
the version before it, so nothing is applied twice. Only bucket numbers and folder names,
at most a few per bucket, pass through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import storage

Combine = Callable[["DataFrame | None", DataFrame], DataFrame]


class BucketTable:
    """A table of ``buckets`` parts by the hash of ``key`` under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], *, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def manifest(self, *, before: int | None = None) -> dict[int, list[str]]:
        """Folders of each bucket in the newest version, or the newest one before a version number."""
        v = [p for n, p in storage.versions(self.spark, self.path) if before is None or n < before]
        out: dict[int, list[str]] = {}
        for r in self.spark.read.parquet(v[-1]).collect() if v else []:
            if r.bucket >= 0:
                out.setdefault(r.bucket, []).append(f"{self.path}/{r.folder}")
        return out

    def read(self, touched: Iterable[int] | None = None, *, before: int | None = None) -> DataFrame | None:
        """Rows of the given buckets, or of all; None where there are none."""
        m = self.manifest(before=before)
        dirs = [d for b in (m if touched is None else touched) for d in m.get(b, [])]
        return self.spark.read.parquet(*dirs) if dirs else None

    def touched(self, keys: DataFrame) -> list[int]:
        """Numbers of the buckets that the keys fall into."""
        return [r._bucket for r in self._bucketed(keys.select(*self.key)).select("_bucket").distinct().collect()]

    def lookup(self, keys: DataFrame, *, before: int | None = None) -> DataFrame | None:
        """Rows with one of the keys (a table with the key columns); other buckets are not read."""
        rows = self.read(self.touched(keys), before=before)
        return None if rows is None else rows.join(keys.select(*self.key).distinct(), self.key, "left_semi")

    def _write(self, rows: DataFrame, kind: str, version: int) -> dict[int, str]:
        """Write rows by bucket into a new folder; the folders written, by bucket."""
        folder = f"{kind}/{version}-{uuid.uuid4().hex[:12]}"
        self._bucketed(rows).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        p, fs = storage._fs(self.spark, f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return {int(n.split("=")[1]): f"{folder}/{n}" for n in names if n.startswith("_bucket=")}

    def _commit(self, folders: dict[int, list[str]], version: int) -> None:
        rows = [(b, d.removeprefix(self.path + "/")) for b, dirs in folders.items() for d in dirs]
        m = self.spark.createDataFrame(rows or [(-1, "")], "bucket int, folder string").coalesce(1)
        storage.write_version(m, self.path, version=version)

    def append(self, rows: DataFrame, version: int) -> None:
        """Add rows; nothing that is there is read or written again.

        A bucket of many small folders is rewritten as one once it has ``COMPACT`` of them.
        """
        m = self.manifest(before=version)
        for b, d in self._write(rows, "data", version).items():
            m.setdefault(b, []).append(f"{self.path}/{d}")
        full = [b for b, dirs in m.items() if len(dirs) >= COMPACT]
        if full:
            merged = self._write(self.spark.read.parquet(*[d for b in full for d in m[b]]), "data", version)
            m.update({b: [f"{self.path}/{d}"] for b, d in merged.items()})
        self._commit(m, version)

    def merge(self, updates: DataFrame, combine: Combine, version: int) -> None:
        """Replace the buckets that ``updates`` touch by ``combine(their rows so far, updates)``."""
        m = self.manifest(before=version)
        new = self._write(updates, "batch", version)
        if new:
            updates = self.spark.read.parquet(*[f"{self.path}/{d}" for d in new.values()])
            dirs = [d for b in new for d in m.get(b, [])]
            result = combine(self.spark.read.parquet(*dirs) if dirs else None, updates)
            out = self._write(result, "data", version)
            if set(out) - set(new):
                raise ValueError("the result has keys in buckets that the updates do not touch")
            for b in new:
                m.pop(b, None)
                if b in out:
                    m[b] = [f"{self.path}/{out[b]}"]
        self._commit(m, version)

    def retain(self, newest: int) -> None:
        """Remove all but the newest versions and the folders that none of them refers to."""
        v = storage.versions(self.spark, self.path)
        keep = {"/".join(r.folder.split("/")[1:]) for _, p in v[-newest:] for r in self.spark.read.parquet(p).collect()}
        for _, p in v[:-newest]:
            storage.remove(self.spark, p)
        storage.remove(self.spark, f"{self.path}/batch")
        p, fs = storage._fs(self.spark, f"{self.path}/data")
        if not fs.exists(p):
            return
        for run in fs.listStatus(p):
            name = run.getPath().getName()
            if not any(k.startswith(f"{name}/") for k in keep):
                fs.delete(run.getPath(), True)
                continue
            for part in fs.listStatus(run.getPath()):
                part_name = part.getPath().getName()
                if part_name.startswith("_bucket=") and f"{name}/{part_name}" not in keep:
                    fs.delete(part.getPath(), True)


COMPACT = 16


def replace_by_key(key: list[str]) -> Combine:
    """New rows take the place of all old rows with their key."""
    def combine(previous: DataFrame | None, updates: DataFrame) -> DataFrame:
        if previous is None:
            return updates
        return previous.join(updates.select(*key).distinct(), key, "left_anti").unionByName(updates).select(*previous.columns)
    return combine
