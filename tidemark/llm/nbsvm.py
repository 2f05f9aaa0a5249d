"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, written
from .text import LOWER, SPACE, mix64, slices, word_hashes

#: Buckets of hashed n-grams, and labelled rows at the most that the classifier is fitted on.
BUCKETS, FIT_ROWS = 1 << 18, 16_000
#: Bytes of the bucket numbers of those rows at most; a row has up to 4 * BUCKETS.
FIT_BYTES = 256 << 20
#: Smoothing of the counts, cost of a margin error (balanced over the classes), passes over the sample.
ALPHA, COST, PASSES = 1.0, 1.0, 12
#: Bytes of text whose n-grams are held at a time; these take about 60 times as much.
SLICE_BYTES = 1 << 20
#: Score from which a text is taken for good.
THRESHOLD = 0.3

_CLASSES = np.zeros(256, np.uint8)
for _c in range(33, 256):
    _s = chr(_c)
    _CLASSES[_c] = (8 if _c >= 128 else 1 if "a" <= _s <= "z" else 2 if "A" <= _s <= "Z" else 4 if _s.isdigit()
                    else 16 if _s in ".,;:'\"()-" else 64 if _s in "!?" else 32)
#: Set where a word repeats the one before.
_SAME = np.uint8(128)


def indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every distinct n-gram of each text, by row.

    N-grams are single words and pairs of words, lower-cased, and runs of one to four word classes: which kinds of
    characters a word has, and whether it repeats the word before it.
    """
    words, counts, kinds = word_hashes(texts, SPACE, LOWER, _CLASSES)
    n = len(words)
    row = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(n)
    first = left == counts[row] if n else np.empty(0, bool)
    same = np.zeros(n, bool)
    same[1:] = (words[1:] == words[:-1]) & ~first[1:]
    kinds = (kinds | np.where(same, _SAME, np.uint8(0))).astype(np.uint64)
    grams = [(words, slice(None)), (words[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + words[1:], left[:-1] > 1)]
    run = kinds
    for k in range(1, 5):
        if k > 1:
            run = (run[:-1] << np.uint64(8)) | kinds[k - 1:]
        size = max(0, n - k + 1)
        grams.append((run[:size] + (np.uint64(k) << np.uint64(40)), left[:size] >= k))
    found = []
    for kind, (g, ok) in enumerate(grams):
        bucket = (mix64(g + np.uint64(kind)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        found.append((row[:len(g)] * BUCKETS + bucket)[ok])
    cells = np.sort(np.concatenate(found))
    cells = cells[np.diff(cells, prepend=-1) > 0]
    return cells // BUCKETS, cells % BUCKETS


def _featured(batches):
    for batch in slices(batches, 2, SLICE_BYTES):
        row, bucket = indicators(batch.column(2))
        ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
        bucket = bucket.astype(np.uint32)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
            [bucket[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()), batch.column(3)],
            ["good", "aside", "buckets", "id"])


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = [np.full(BUCKETS, ALPHA), np.full(BUCKETS, ALPHA)]
    for b, y in zip(rows, good):
        counts[int(y)][b] += 1
    bad, fine = (c / c.sum() for c in counts)
    return np.log(fine / bad)


def descend(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, passes: int,
            rng) -> tuple[np.ndarray, float]:
    """The hinge-loss machine by dual coordinate descent, one row's multiplier at a time.

    A row's vector has the ratio r of each of its buckets, scaled to length 1; `scale` is r squared. What is kept and
    returned is weight times r for each bucket, and the bias: margins are sums of it over a row's buckets, divided by
    the length of its ratios, so no row's values need to be held.
    """
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    size = np.array([scale[b].sum() for b in rows])
    length = np.sqrt(np.maximum(size, 1e-18))
    square = size / length**2 + 1.0
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]].sum() / length[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if (step := (new - alpha[i]) * y[i]) != 0.0:
                w[rows[i]] += scale[rows[i]] * (step / length[i])
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def _squash(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from margins to probabilities, by Newton steps on smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target))
        theta -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def _fit(sample: pa.Table) -> pa.Table:
    """The model of one bounded sample: weight and squared scale of each bucket, then bias, slope and offset."""
    good = sample["good"].to_numpy().astype(bool)
    aside = sample["aside"].to_numpy().astype(bool)
    rows = [np.frombuffer(b.as_buffer(), np.uint32) for b in sample["buckets"]]
    n1, n = int(good.sum()), len(good)
    fit = np.flatnonzero(~aside)
    if len(set(good[fit])) < 2 or len(set(good[aside])) < 2:
        fit = np.arange(n)  # too few to set some aside
    weights, scale, bias, slope = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0
    offset = float(np.log((n1 + 1) / (n - n1 + 1)))  # the labels' rate where there is one class at the most
    if 0 < n1 < n:
        scale = log_count_ratios([rows[i] for i in fit], good[fit]) ** 2
        y = np.where(good, 1.0, -1.0)
        share = good[fit].mean()
        cost = np.where(good, COST / (2 * share), COST / (2 * (1 - share)))
        weights, bias = descend([rows[i] for i in fit], scale, y[fit], cost[fit], PASSES, np.random.default_rng(5))
        hold = np.flatnonzero(aside) if len(fit) < n else np.arange(n)
        margin = np.array([weights[rows[i]].sum() / np.sqrt(max(scale[rows[i]].sum(), 1e-18)) + bias for i in hold])
        slope, offset = _squash(margin, good[hold])
    model = np.concatenate([weights, scale, [bias, slope, offset]])
    return pa.table({"model": pa.array([model.tobytes()], pa.binary())})


def crc_fold(ident: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")), F.lit(0)) % folds


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", fit_rows: int = FIT_ROWS, folds: int = 5,
          fit_bytes: int = FIT_BYTES) -> np.ndarray:
    """Fits on at most `fit_rows` labelled rows, drawn by hash, of those whose fold is not 0.

    Of these, in the same order, only as many as have `fit_bytes` of bucket numbers together: one task fits the model,
    and this bounds its memory however long the texts are. Texts are read whole.
    Rows of fold 1 are set aside for the curve from margins to scores. Null identifiers, null labels and labels of
    absent documents teach nothing; of documents with the same identifier one is used. Without rows, or with labels of
    one kind, every score is the smoothed rate of the labels.
    """
    ident = F.col(id_col).cast("long")
    chosen = (labels.select(ident.alias("id"), (F.col(label_col) == 1).alias("good")).dropna()
              .where(crc_fold(F.col("id"), folds) != 0).orderBy(F.xxhash64("id"), "id", "good").limit(fit_rows))
    sample = (docs.select(ident.alias("id"), text_of(text_col).alias("text"))
              .join(F.broadcast(chosen), "id")  # fit_rows rows
              .dropDuplicates(["id"]).select("good", (crc_fold(F.col("id"), folds) == 1).alias("aside"), "text", "id"))
    featured = written(sample.mapInArrow(_featured, "good boolean, aside boolean, buckets binary, id long"), "fit-rows")
    # An identifier and a size for each of at most fit_rows rows.
    so_far = Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    fitting = (featured.select("id", F.sum(F.octet_length("buckets")).over(so_far).alias("bytes"))
               .where(F.col("bytes") <= fit_bytes).select("id"))
    model = (featured.join(F.broadcast(fitting), "id", "left_semi").drop("id")
             .withColumn("all", F.lit(1)).groupBy("all").applyInArrow(_fit, "model binary").collect())
    if not model:
        return np.zeros(2 * BUCKETS + 3)
    return np.frombuffer(model[0]["model"])


def scores(model: np.ndarray, texts: pa.Array) -> np.ndarray:
    weights, scale = model[:BUCKETS], model[BUCKETS:2 * BUCKETS]
    bias, slope, offset = model[2 * BUCKETS:]
    row, bucket = indicators(texts)
    size = np.bincount(row, weights=scale[bucket], minlength=len(texts))
    margin = np.bincount(row, weights=weights[bucket], minlength=len(texts)) / np.sqrt(np.maximum(size, 1e-18)) + bias
    return 1 / (1 + np.exp(-np.clip(slope * margin + offset, -40, 40)))


def score_quality(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                  folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out (fold 0), score from 0 to 1, predicted.

    Whole texts are read and nothing else; a null text counts as empty and is scored by the bias alone. Null
    identifiers are in fold 0. Equal texts have equal scores. No rows give no rows.
    """
    def run(batches):
        for batch in slices(batches, 1, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(model, batch.column(1)))],
                                             ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (crc_fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: np.ndarray, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that are scored THRESHOLD or more."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in slices(batches, at, SLICE_BYTES):
            yield batch.filter(pa.array(scores(model, batch.column(at)) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
