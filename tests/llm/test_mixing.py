import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import mixing


def uniform(seed, ident, part):
    return int(hashlib.md5(f"{seed}|{ident}|{part}".encode()).hexdigest()[:13], 16) / 2**52


def inverse(mean, u):
    k, p = 0, math.exp(-mean)
    c = p
    while u >= c:
        k += 1
        p *= mean / k
        c += p
    return k


def test_counts_invert_the_distribution(spark, documents):
    rates = spark.createDataFrame([("src0", 2.5), ("src1", 0.3), ("src2", 150.0), ("src3", 0.0)], "grp string, mean double")
    got = mixing.poisson_mix(documents, rates, seed=3).select("doc.doc_id", "copy", "n_copies").collect()
    want = {}
    for d in documents.select("doc_id", "source").collect():
        mean = {"src0": 2.5, "src1": 0.3, "src2": 150.0}.get(d.source, 0.0)
        draws = max(1, math.ceil(mean / mixing.DRAW_MEAN))
        n = sum(inverse(mean / draws, uniform(3, d.doc_id, j)) for j in range(draws)) if mean else 0
        if n:
            want[d.doc_id] = n
    assert Counter(r.doc_id for r in got) == want
    assert {(r.doc_id, r.copy) for r in got} == {(i, c) for i, n in want.items() for c in range(1, n + 1)}
    assert all(r.n_copies == want[r.doc_id] for r in got)


def test_targets_are_met(spark, sf):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "a").otherwise("b")
                                      .alias("source"), F.lit("xxxx").alias("text"))
    targets = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("absent", 5.0)], "grp string, weight double")
    share = {r["source"]: r["count"] for r in mixing.mix_to_targets(docs, targets).groupBy("doc.source").count().collect()}
    # Weights of absent sources are ignored: a and b share the corpus 3 to 1.
    assert abs(share["a"] - 15_000) < 500 and abs(share["b"] - 5_000) < 300


def test_odd_rows(odd, odd_rows):
    mixed = mixing.mix_to_targets(odd)
    assert mixed.select("doc.*").columns == odd.columns
    rows = mixed.select("doc.doc_id", "doc.text", "n_copies").collect()
    assert {(r.doc_id, r.text) for r in rows} <= set(odd_rows)


def test_no_rows(odd):
    assert mixing.mix_to_targets(odd.limit(0)).count() == 0
