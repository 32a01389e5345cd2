"""Language by a byte CNN of several filter widths with a softmax over the languages.

It is fitted on the driver from at most ``most`` rows with a language (smallest
hash of the id first, ``train_bytes`` of each). A text is scored whole, in fixed
windows: responses are max-pooled per window and averaged over the windows.
Null texts and texts without a letter are ``und`` with score 0; without training
rows every text is. Repeated rows are scored alike, extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytecnn import Net, Shape
from .common import held_out, runs, texts
from .quality import piece

FIT_ROWS = 3_000
FIT_BYTES = 1_024
SHAPE = Shape(window=256, step=248, dim=8, widths=(2, 3, 5), filters=12)


def fit(docs: DataFrame, *, most: int = FIT_ROWS, train_bytes: int = FIT_BYTES, epochs: int = 5) -> tuple[Net, list[str]]:
    rows = (docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.coalesce(held_out(F.col("doc_id"), 3, 1), F.lit(True)))
            .select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    chosen = F.broadcast(rows.groupBy("doc_id").agg(F.min("lang").alias("y")))
    data: dict[int, tuple[bytes, str]] = {}
    for r in docs.select("doc_id", "text").join(chosen, "doc_id").toLocalIterator():
        data.setdefault(r.doc_id, (piece(r.text or "", train_bytes), r.y))
    names = sorted({y for _, y in data.values()})
    import dataclasses
    net = Net(dataclasses.replace(SHAPE, classes=max(1, len(names))))
    if len(names) > 1:
        keys = sorted(data)
        y = np.array([names.index(data[k][1]) for k in keys])
        share = np.bincount(y) / len(y)
        net.fit([data[k][0] for k in keys], y, epochs=epochs, weight=np.minimum(4.0, 1 / (len(names) * share))[y])
    return net, names


def predictions(docs: DataFrame) -> DataFrame:
    net, names = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast((net.shape, net.p, names))

    def run(batches):
        import regex
        letter = regex.compile(r"\p{L}")
        shape, params, names = shared.value
        model = Net(shape)
        model.p = params
        for b in batches:
            t = texts(b["text"])
            for i, j in runs([len(x) for x in t], 1_000_000):
                if len(names) > 1:
                    p = model.probabilities([model.cut(x.encode("utf-8")) for x in t[i:j]])
                else:
                    p = np.ones((j - i, 1))
                best = p.argmax(axis=1)
                known = [bool(names) and letter.search(x) is not None for x in t[i:j]]
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[i:j], "lang_pred": [names[k] if ok else "und" for k, ok in zip(best, known)],
                                    "score": np.where(known, p.max(axis=1), 0.0).astype(float)})
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(run, "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id"), 3, 1), F.lit(False)).alias("held_out"), "lang_pred", "score")
