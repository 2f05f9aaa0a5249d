import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as dc

WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def best(words, item):
    """The longest stretch on any alignment, by trying all of them."""
    top = 0
    for shift in range(-len(item) + 1, len(words)):
        same = [words[shift + j] == w if 0 <= shift + j < len(words) else None for j, w in enumerate(item)]
        at = [j for j, s in enumerate(same) if s]
        for a in at:
            for b in at:
                n = b - a + 1
                if n >= dc.MIN_TOKENS and n > top and sum(map(bool, same[a:b + 1])) >= dc.MIN_SHARE * n - 1e-9:
                    top = n
    return top


def test_against_brute_force(spark, sf, documents):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").limit(12)
    rnd, rows = random.Random(5), []
    texts = {r.item_id: WORD.findall(r.text.lower()) for r in items.collect()}
    for n, (i, words) in enumerate(list(texts.items()) * 5):
        cut = words[: 10 + n % 12] if n % 2 else list(words)
        for j in rnd.sample(range(len(cut)), len(cut) * (n % 5) // 20):
            cut[j] = f"changed{j}"
        rows.append((n, " ".join(["before"] * (n % 7) + cut + ["after"] * (n % 3))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.doc_to - r.doc_from for r in dc.overlaps(docs, items).collect()}
    want = {(n, i): k for n, t in rows for i, w in texts.items() if (k := best(t.split(), w))}
    assert set(got) <= set(want)
    assert all(got[k] <= want[k] for k in got)
    # A seed needs a stretch that fits a mask; all but a few heavily changed short passages have one.
    assert len(got) >= 0.9 * len(want)
    changed_little = {(n, i) for n, i in want if n % 5 <= 2 and want[n, i] >= 15}
    assert changed_little <= set(got)


@pytest.mark.parametrize("length,changed", [(13, 2), (15, 3), (20, 4), (25, 5)])
def test_some_mask_fits_every_overlap(length, changed):
    """Shorter of equal changes; longer overlaps hold one of 13 to 25 tokens that is as much alike."""
    assert changed == int(length * (1 - dc.MIN_SHARE) + 1e-9)
    places = [sum(1 << (s + k) for k, bit in enumerate(m) if bit == "1")
              for m in dc.MASKS for s in range(length - len(m) + 1)]
    spoilt = (sum(1 << j for j in c) for c in itertools.combinations(range(length), changed))
    assert not [c for c in spoilt if all(p & c for p in places)]


def test_short_overlaps_equal_brute_force(spark):
    rnd, items, rows = random.Random(6), {}, []
    for i in range(12):
        items[i] = [f"w{i}x{j}" for j in range(13 + i % 9)]
        for _ in range(12):
            cut = list(items[i])
            for j in rnd.sample(range(1, len(cut) - 1), len(cut) // 5 + rnd.randrange(2)):
                cut[j] = f"changed{j}"
            rows.append((len(rows), " ".join(["before"] * rnd.randrange(3) + cut + ["after"] * rnd.randrange(3))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.doc_to - r.doc_from for r in dc.overlaps(docs, table).collect()}
    want = {(n, i): k for n, t in rows for i, w in items.items() if (k := best(t.split(), w))}
    assert len(want) > 50 and got == want


def test_planted_passages_and_clean_texts(spark, sf, documents):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    texts = {r.item_id: " ".join(WORD.findall(r.text.lower())) for r in items.collect()}
    docs = {r.doc_id: " ".join(WORD.findall((r.text or "").lower())) for r in documents.collect()}
    want = {(d, i) for d, t in docs.items() for i, x in texts.items() if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id) for r in dc.overlaps(documents, items).collect()}
    assert want and got == want
    left = {r.doc_id for r in dc.clean(documents, items).collect()}
    assert left == set(docs) - {d for d, _ in want}


def test_odd_rows(spark, odd, odd_rows):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while nine other animals look on"),
                                   (1, None), (2, ""), (None, "short"), (3, "one two three")], "item_id long, text string")
    items = items.withColumn("hash", F.lit("!")).withColumn("word", F.lit(1))
    got = dc.overlaps(odd, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 1), (3, 1), (None, 1)}
    kept = dc.clean(odd, items)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in odd_rows} - {1, 2, 3, None}
    assert dc.overlaps(odd, items.limit(0)).count() == 0
    assert dc.clean(odd.limit(0), items).count() == 0


def test_the_whole_extent_of_a_long_overlap(spark):
    """400 of 500 tokens agree; the seeds stand far apart, and those that differ lie close together."""
    item = [f"w{j}" for j in range(500)]
    text = list(item)
    for j in [*range(100, 160), *range(400, 440)]:
        text[j] = f"changed{j}"
    docs = spark.createDataFrame([(1, " ".join(["x"] * 50 + text + ["y"] * 50))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    row = dc.overlaps(docs, items).first()
    assert (row.doc_from, row.doc_to, row.item_from, row.n_same) == (50, 550, 0, 400)


def test_a_large_benchmark_is_read_in_parts(spark, sf, documents, monkeypatch):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = {tuple(r) for r in dc.overlaps(documents, items).collect()}
    monkeypatch.setattr(dc, "MOST_SEEDS", 1 << 13)
    assert whole and {tuple(r) for r in dc.overlaps(documents, items).collect()} == whole
