"""Quality classifier: a byte CNN over overlapping chunks that cover the whole text.

It is fitted on the driver from at most ``most`` labelled rows (those with the
smallest hash of their id, no longer than ``train_bytes`` each; longer texts give
their first, middle and last thirds of that size to the fit only). Every text is
scored whole: filters are max-pooled in each chunk, the chunks' mean and maximum
are combined into one probability. A null or empty text is one padded chunk.
Repeated rows are scored alike; further columns never reach the model; without
labels of both kinds every score is the share of label 1 (1.0 without labels).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytecnn import Net, Shape
from .common import held_out, runs, texts, tidy

FIT_ROWS = 4_000
FIT_BYTES = 4_096
SHAPE = Shape(window=256, step=224, dim=8, widths=(4, 7), filters=16, classes=1, pools=2)


def piece(text: str, most: int) -> bytes:
    data = text.encode("utf-8")
    if len(data) <= most:
        return data
    third, mid = most // 3, len(data) // 2
    return data[:third] + data[mid:mid + third] + data[-third:]


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    lab = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("y"))
    lab = lab.where(~held_out(F.col("doc_id"), 3, 1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, *, most: int = FIT_ROWS, train_bytes: int = FIT_BYTES, epochs: int = 6) -> Net:
    rows: dict[int, tuple[bytes, int]] = {}
    for r in training_rows(docs, labels, most).toLocalIterator():
        rows.setdefault(r.doc_id, (piece(r.text or "", train_bytes), r.y))
    net = Net(SHAPE)
    data = [rows[k] for k in sorted(rows)]
    y = np.array([v for _, v in data], np.float32)
    if not len(y) or y.min() == y.max():
        net.p["out"][:] = 0
        net.p["ob"][:] = 20.0 if not len(y) or y[0] > 0 else -20.0
        return net
    # Rows of the rarer label weigh more, up to three times.
    weight = np.where(y > 0, 1.0, min(3.0, float(y.mean() / (1 - y.mean()))))
    net.fit([d for d, _ in data], y, epochs=epochs, weight=weight)
    return net


def scored(docs: DataFrame, net: Net) -> DataFrame:
    """Every row with a column ``score`` before its own columns."""
    shared = docs.sparkSession.sparkContext.broadcast((net.shape, net.p))

    def run(batches):
        model = Net(shared.value[0])
        model.p = shared.value[1]
        for b in batches:
            t = texts(b["text"])
            for i, j in runs([len(x) for x in t], 1_000_000):
                p = model.probabilities([model.cut(x.encode("utf-8")) for x in t[i:j]])[:, 0]
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[i:j], "score": p.astype(float)})
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(tidy(run), "doc_id bigint, score double")


def keep_good(docs: DataFrame, labels: DataFrame, *, least: float = 0.5) -> DataFrame:
    """The rows scored ``least`` or more, with all their columns."""
    net = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((net.shape, net.p))

    def run(batches):
        import pyarrow as pa
        model = Net(shared.value[0])
        model.p = shared.value[1]
        for b in batches:
            t = [x or "" for x in b.column("text").to_pylist()]
            p = [model.probabilities([model.cut(x.encode("utf-8")) for x in t[i:j]])[:, 0] for i, j in runs([len(x) for x in t], 1_000_000)]
            if p:
                yield b.filter(pa.array(np.concatenate(p) >= least))
    return docs.mapInArrow(tidy(run), docs.schema)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = scored(docs, fit(docs, labels))
    return s.select("doc_id", F.coalesce(held_out(F.col("doc_id"), 3, 1), F.lit(False)).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
