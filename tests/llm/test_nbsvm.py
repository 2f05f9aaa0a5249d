import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import nbsvm


def test_held_out_accuracy(spark):
    """On rows that taught nothing."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = (nbsvm.score_quality(docs, nbsvm.train(docs, labels)).join(labels, "doc_id").where("held_out").collect())
    good, bad = [r.score for r in got if r.quality == 1], [r.score for r in got if r.quality == 0]
    assert len(good) > 30 and len(bad) > 5
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95


def test_indicators_are_distinct_and_by_row():
    row, bucket = nbsvm.indicators(pa.array(["a b a b", None, "", "x", "a b a b"]))
    cells = list(zip(row, bucket))
    assert len(set(cells)) == len(cells) and set(row) == {0, 3, 4}
    assert {b for r, b in cells if r == 0} == {b for r, b in cells if r == 4}


def test_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.array([i % 2, 2 + i % 5]) for i in range(60)]
    scale = rng.uniform(0.8, 1.2, 7)
    y = np.array([1.0 if i % 2 else -1.0 for i in range(60)])
    w, bias = nbsvm.descend(rows, scale, y, np.full(60, 10.0), 50, rng)
    assert all(s * (w[r].sum() / np.sqrt(scale[r].sum()) + bias) > 0.9 for r, s in zip(rows, y))


def test_odd_rows(spark, odd, odd_rows):
    labels = spark.createDataFrame([(1, 1), (7, 0), (None, 0), (99, 0), (8, None), (11, 1), (11, 1)],
                                   "doc_id long, quality int").withColumn("text", F.lit("!"))
    model = nbsvm.train(odd, labels)
    got = nbsvm.score_quality(odd, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in odd_rows)
    assert all(0 <= r.score <= 1 for r in got)
    kept = nbsvm.keep_good(odd, model)
    assert kept.schema == odd.schema and kept.count() <= len(odd_rows)


def test_no_labels_one_class_no_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in nbsvm.score_quality(odd, nbsvm.train(odd, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(1, 12)], "doc_id long, quality int")
    assert {r.predicted for r in nbsvm.score_quality(odd, nbsvm.train(odd, ones)).collect()} == {1}
    empty = odd.limit(0)
    assert nbsvm.score_quality(empty, nbsvm.train(empty, ones)).count() == 0


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat(concat('w', id % 2, ' x', id, ' '), 1 + id * 50) AS text")
    labels = spark.range(40).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")

    # In place of the model: the bytes that reach the fit.
    def counted(sample):
        total = sum(len(b.as_py()) for b in sample["buckets"])
        return pa.table({"model": pa.array([total.to_bytes(8, "little")], pa.binary())})

    monkeypatch.setattr(nbsvm, "_fit", counted)
    whole = int(nbsvm.train(docs, labels).view("int64")[0])
    part = int(nbsvm.train(docs, labels, fit_bytes=whole // 2).view("int64")[0])
    assert 0 < part <= whole // 2
    assert part == int(nbsvm.train(docs, labels, fit_bytes=whole // 2).view("int64")[0])


def test_a_batch_is_featured_within_bounded_memory():
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, 1 << 20, 3000))) for _ in range(400)]  # 8 MB
    flags = pa.array([True] * len(texts))
    batch = pa.RecordBatch.from_arrays([flags, flags, pa.array(texts), pa.array(range(len(texts)))], ["a", "b", "t", "i"])
    tracemalloc.start()
    try:
        assert sum(part.num_rows for part in nbsvm._featured(iter([batch]))) == len(texts)
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()
