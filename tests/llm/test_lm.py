"""Word and pair counts of the language model: runs, shards and answers."""

import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from asterion.llm import lm  # noqa: E402
from asterion.llm.common import small_batches, space_words, word_hashes  # noqa: E402
from asterion.storage import shared_dir  # noqa: E402


def rows(n=400):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.choice((1, 1, 2, 3, 5, 9, 17))))
    out = {k: " ".join(word() for _ in range(r.randint(0, 60))) for k in range(n)}
    return out | {n: None, n + 1: "", n + 2: "\t\n"}


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lm") / "documents.parquet")
    spark.createDataFrame(list(rows().items()), "doc_id bigint, text string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_token_hashes():
    r = random.Random(2)
    texts = ["".join(r.choice("aBÉß \t\n\x0b\x0c\rxyzQ \x1c\x85😀") if r.random() < .5 else r.choice("abcdefg") for _ in range(r.randint(0, 80))) for _ in range(800)]
    for column in (pa.array([*texts, None, "", " ", "a" * 30, "b"]), pa.array(texts)[5:400], pa.array([], pa.string()), pa.array([None], pa.string())):
        h, size = lm.token_hashes(column)
        words = [space_words(t or "") + [b""] for t in column.to_pylist()]
        assert h.tolist() == word_hashes([w for t in words for w in t]).tolist() and size.tolist() == [len(t) for t in words]


def test_a_run_asks_by_shard(spark, files):
    """Rows of a run number its shards: blocks grow with the text as runs do, so their product must not be dealt."""
    few, many = (lm.counts(files, n) for n in (1, 400))
    assert few.count() == 1 and many.count() == 400 // lm.per_shard()
    asked = many.select(F.size("answers").alias("n")).agg(F.sum("n")).first()[0]
    assert asked <= 3 * many.count()
    assert few.agg(F.sum("tokens"), F.sum("kinds")).first() == many.agg(F.sum("tokens"), F.sum("kinds")).first()


@pytest.mark.parametrize("shared, run", [(0, 300), (lm.SHARED_BYTES, 300), (0, lm.RUN_CHARS)])
def test_scores_do_not_depend_on_runs_and_shards(spark, files, monkeypatch, shared, run):
    monkeypatch.setattr(lm, "BITS_PER_KEY", 1200)  # no false hits
    monkeypatch.setattr(lm, "BLOCK_CHARS", 3000)
    monkeypatch.setattr(lm, "SHARED_BYTES", shared)
    monkeypatch.setattr(lm, "RUN_CHARS", run)
    small_batches(spark, 50)
    base, pairs = brute.base_scores(rows()), brute.scores(rows())
    got = lm.predictions(files).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows())
    for r in got:
        n, known, total, score = base[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.base_score == pytest.approx(score) and r.score == pytest.approx(pairs[r.doc_id]), r


def test_only_the_scores_stay(spark, files, monkeypatch):
    """A large filter is not kept, and neither are tokens, counts or rows that were written to be read twice."""
    monkeypatch.setattr(lm, "SHARED_BYTES", 0)
    folder = Path(shared_dir(spark).removeprefix("file://").removeprefix("file:"))
    before = set(folder.glob("lm_*/v=*"))
    assert lm.predictions(files).count() == lm.predictions(files.repartition(2)).count() == len(rows())
    assert {p.parent.name for p in set(folder.glob("lm_*/v=*")) - before} == {"lm_rows"}


def test_rows_are_read_in_the_same_order_twice(spark, files):
    narrow = files.where("doc_id > 3").select("doc_id", "text")
    assert lm.steady(narrow) is narrow
    for other in (files.repartition(2), files.limit(9), files.withColumn("x", F.rand()), spark.createDataFrame([(1, "a")], "doc_id bigint, text string")):
        assert lm.steady(other) is not other


def test_other_rows_the_second_time():
    with pytest.raises(RuntimeError):
        lm.answered(np.arange(3, dtype=np.uint64), 1, 1, pa.chunked_array([[b"\0\0"]]), np.uint8)
