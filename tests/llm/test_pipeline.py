"""The pipeline against brute force, stage by stage on each stage's own input."""

import math
import re
import zlib
from collections import Counter

import corpus_pipeline as pipeline
import numpy as np
import public_tokenizers
import pytest
from test_mixing import inverse, uniform
from tokenizers import Tokenizer

from tidemark.llm import nbsvm
from tidemark.llm.common import written

WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


@pytest.fixture(scope="module")
def steps(spark, sf, documents):
    """The rows before and after each stage."""
    docs, found = documents, [documents.collect()]
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "test")
        found.append(docs.collect())
    return found


def shingles(text):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_columns_stay(steps, documents):
    for rows in steps[:-1]:
        assert list(rows[0].asDict()) == documents.columns


def test_quality(spark, sf, documents, steps):
    model = nbsvm.train(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    accepted = {r.doc_id for r in nbsvm.score_quality(documents, model).collect() if r.predicted}
    assert {r.doc_id for r in steps[1]} == accepted
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    right = [(r.doc_id in accepted) == quality[r.doc_id] for r in steps[0] if r.doc_id in quality]
    assert sum(right) > 0.95 * len(right)


def test_near_copies(steps):
    rows = sorted(steps[1], key=lambda r: r.doc_id)
    sets = [shingles(r.text) for r in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                a, b = sets[i], sets[j]
                if label[i] != label[j] and (rows[i].text == rows[j].text or (a and b and len(a & b) * 5 >= 4 * len(a | b))):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    assert sorted(r.doc_id for r in steps[2]) == sorted({rows[c].doc_id for c in label})


def test_decontamination(spark, sf, steps):
    items = [" ".join(WORD.findall(r.text.lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in steps[2]
             if not any(f" {x} " in f" {' '.join(WORD.findall((r.text or '').lower()))} " for x in items)]
    assert sorted(r.doc_id for r in steps[3]) == sorted(clean)


def test_mixture(steps):
    size = Counter()
    for r in steps[3]:
        size[r.source] += len(r.text or "")
    weight = {s: math.sqrt(n) for s, n in size.items()}
    mean = {s: round(weight[s] / sum(weight.values()) * sum(size.values()) / n, 9) for s, n in size.items() if n}
    want = Counter({r.doc_id: inverse(mean.get(r.source, 0.0), uniform(17, r.doc_id, 0)) for r in steps[3]})
    assert Counter(r.doc_id for r in steps[4]) == +want


def test_token_files(steps):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path(pipeline.TOKENIZER)))
    want, at = [], 0
    for r in sorted(steps[4], key=lambda r: r.doc_id):
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [pipeline.END_ID]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, steps[5])) == want


def test_run_gives_the_last_stage(spark, sf, steps):
    assert sorted(map(tuple, pipeline.run(spark, sf).collect())) == sorted(map(tuple, steps[5]))
