"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, written
from .text import LOWER, PUNCT, mix64, slices, word_hashes

#: Fixed masks; a 0 is a position that may differ. Each looks at 7 tokens. One of them fits every stretch of 13 tokens
#: with 2 differences, 15 with 3, 20 with 4 and 25 with 5 (tested by enumeration), and so every overlap of at least
#: MIN_TOKENS and MIN_SHARE: a longer one can be halved until a part as alike has 13 to 25 tokens.
MASKS = ("1101000101101", "110111011", "110100001111", "11101111",
         "1110100010101", "1110000110011")
SPAN = max(map(len, MASKS))
#: An overlap counts from this many aligned tokens on, of which this share must agree.
MIN_TOKENS, MIN_SHARE = 13, 0.8
#: Seeds of the benchmark that travel to every task, 16 MB; with more, the documents are read once for each part of the
#: range of hashes.
MOST_SEEDS = 1 << 21

_WEIGHTS = np.array([pow(0xA0761D6478BD642F | 1, k + 1, 2**64) for k in range(SPAN)], np.uint64)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(pc.utf8_lower(pc.fill_null(texts, "")), PUNCT, LOWER)


def seed_hashes(words: np.ndarray, mask: int) -> np.ndarray:
    """The hash of the looked-at tokens of every window as long as the mask."""
    n = max(0, len(words) - len(MASKS[mask]) + 1)
    acc = np.full(n, mask + 1, np.uint64)
    for k, bit in enumerate(MASKS[mask]):
        if bit == "1":
            acc += words[k:k + n] * _WEIGHTS[k]
    return mix64(acc)


def _inside(counts: np.ndarray, total: int, mask: int) -> np.ndarray:
    """The starts of windows that lie in one text."""
    ends = np.repeat(np.cumsum(counts), counts)
    return np.flatnonzero(np.arange(total) + len(MASKS[mask]) <= ends)


def _item_seeds(batches):
    for batch in slices(batches, 1):
        words, counts = tokens(batch.column(1))
        begin = np.cumsum(counts) - counts
        row = np.repeat(np.arange(batch.num_rows), counts)
        for m in range(len(MASKS)):
            ok = _inside(counts, len(words), m)
            h = seed_hashes(words, m)[ok]
            own = row[ok]
            yield pa.RecordBatch.from_arrays([
                pa.array(h.view(np.int64)), batch.column(0).take(pa.array(own)), pa.array((ok - begin[own]).astype(np.int32))],
                ["hash", "item", "item_pos"])


def _item_tokens(batches):
    for batch in slices(batches, 1):
        words, counts = tokens(batch.column(1))
        ends = np.cumsum(counts)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
            [words[e - c:e].tobytes() for e, c in zip(ends, counts)], pa.binary())], ["item", "item_words"])


def _regions(seeds: np.ndarray, reach: int):
    """Stretches of a text within `reach` tokens of the sorted seeds, with those seeds."""
    shift = np.uint64(64 - max(10, min(26, 6 + int(len(seeds)).bit_length())))
    heads = np.zeros(1 << int(64 - shift), bool)  # sorts out most windows at once
    heads[seeds >> shift] = True

    def run(batches):
        region = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 1):
            words, counts = tokens(batch.column(1))
            at, hashes = [], []
            for m in range(len(MASKS)):
                h = seed_hashes(words, m)
                found = _inside(counts, len(words), m)
                found = found[heads[h[found] >> shift]]
                found = found[np.isin(h[found], seeds)]
                at.append(found)
                hashes.append(h[found])
            at, hashes = np.concatenate(at), np.concatenate(hashes)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, hashes = at[order], hashes[order]
            ends = np.cumsum(counts)
            doc = np.searchsorted(ends, at, "right")
            new = np.ones(len(at), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > reach)
            starts = np.flatnonzero(new)
            stops = np.append(starts[1:], len(at))
            rows = []
            for s, e in zip(starts, stops):
                lo = max(int(ends[doc[s]] - counts[doc[s]]), int(at[s]) - reach)
                hi = min(int(ends[doc[s]]), int(at[e - 1]) + SPAN + reach)
                rows.append((region, words[lo:hi].tobytes(), lo - int(ends[doc[s]] - counts[doc[s]]),
                             hashes[s:e].view(np.int64), (at[s:e] - lo).astype(np.int32)))
                region += 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(doc[starts])), pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int32()),
                pa.array([r[3] for r in rows], pa.list_(pa.int64())), pa.array([r[4] for r in rows], pa.list_(pa.int32()))],
                ["doc", "region", "words", "from_word", "hashes", "places"])

    return run


def _best_overlap(equal: np.ndarray, least_tokens: int, share: float) -> tuple[int, int, int] | None:
    """The longest stretch with at least that share of equal tokens that begins and ends with one: start, end, equal."""
    at = np.flatnonzero(equal)
    if len(at) < share * least_tokens:
        return None
    # With s = equal - share a stretch qualifies when its sum is not negative; for each end the earliest start whose
    # prefix sum is at most the end's is the longest one.
    total = np.concatenate([[0], np.cumsum(equal - share)])
    low = np.minimum.accumulate(total[:-1])
    best = None
    for e in at:
        s = int(np.searchsorted(-low, -(total[e + 1] + 1e-9), "left"))
        s = int(at[np.searchsorted(at, s)])
        length = e + 1 - s
        if length >= least_tokens and (best is None or length > best[1] - best[0]):
            best = (s, int(e) + 1)
    return None if best is None else (*best, int(equal[best[0]:best[1]].sum()))


def _verify(least_tokens: int, share: float):
    def run(batches):
        for batch in batches:
            out = []
            for doc, raw, first, item, item_raw, shift in zip(*(batch.column(i) for i in range(6))):
                words, other = (np.frombuffer(x.as_buffer(), np.uint64) for x in (raw, item_raw))
                d = shift.as_py()  # place in the region less place in the item
                lo, hi = max(0, d), min(len(words), len(other) + d)
                equal = words[lo:hi] == other[lo - d:hi - d]
                if found := _best_overlap(equal, least_tokens, share):
                    s, e, same = found
                    at = first.as_py() + lo
                    out.append((doc.as_py(), item.as_py(), at + s, at + e, lo - d + s, same))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), *[pa.int32()] * 4))],
                    ["doc", "item", "doc_from", "doc_to", "item_from", "same"])

    return run


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", min_tokens: int = MIN_TOKENS,
             min_share: float = MIN_SHARE) -> DataFrame:
    """Passages of the documents that agree with a benchmark item, up to replaced tokens.

    Returns one row for each document and item with an overlap, the longest: doc_id, item_id, doc_from, doc_to,
    item_from (in tokens) and n_same, the tokens that agree. An overlap is a stretch of at least `min_tokens` aligned
    tokens of which at least `min_share` agree. Tokens are lower-cased runs of letters, digits and characters beyond
    ASCII.

    Seeds of all windows of both sides are joined by hash; tasks know the benchmark's seeds, or a part of them that is
    bounded, and pass on only windows that are among them, with the tokens around that any item can span. Each joined
    diagonal is then compared token by token over the whole item. Texts may be of any length.

    An overlap is found when one of the masks fits it anywhere, as one does for every overlap under the given settings
    or stricter ones. Texts and items of fewer than `min_tokens` tokens, null or empty ones included, give none. Null identifiers are kept as null, rows with equal identifiers give one row.
    Repeated items are found under each identifier. An empty table on either side gives no rows.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc"), text_of(text_col).alias("text"))
    i = items.select(F.col(item_col).cast("long").alias("item"), text_of(item_text_col).alias("text"))
    seeds = written(i.mapInArrow(_item_seeds, "hash long, item long, item_pos int"), "seeds")
    items_tokens = written(i.mapInArrow(_item_tokens, "item long, item_words binary").distinct(), "items")
    longest_item = items_tokens.agg(F.max(F.octet_length("item_words"))).first()[0] or 0
    known = written(seeds.select("hash").distinct(), "hashes")
    parts = max(1, -(-known.count() // MOST_SEEDS))
    regions, numbered = None, known.withColumn("part", F.pmod("hash", F.lit(parts)))
    for part in range(parts):
        own = np.array([r.hash for r in numbered.where(F.col("part") == part).select("hash").collect()], np.int64)
        if not len(own):
            continue
        found = written(d.mapInArrow(_regions(np.sort(own.view(np.uint64)), longest_item // 8),
                                     "doc long, region long, words binary, from_word int, hashes array<long>, "
                                     "places array<int>").withColumn("part", F.lit(part)), "regions")
        regions = found if regions is None else regions.unionByName(found)
    if regions is None:  # no item is long enough for a seed
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, doc_from int, doc_to int, item_from int, n_same int")
    hits = (regions.select("part", "region", F.explode(F.arrays_zip("hashes", "places")).alias("h"))
            .select("part", "region", F.col("h.hashes").alias("hash"), F.col("h.places").alias("place")).join(seeds, "hash")
            .select("part", "region", "item", (F.col("place") - F.col("item_pos")).alias("shift")).distinct())
    words = items_tokens.withColumnRenamed("item", "own")
    found = (hits.join(regions.select("part", "region", "doc", "words", "from_word"), ["part", "region"])
             .join(words, F.col("item").eqNullSafe(F.col("own")))
             .select("doc", "words", "from_word", "item", "item_words", "shift")
             .mapInArrow(_verify(min_tokens, min_share),
                         "doc long, item long, doc_from int, doc_to int, item_from int, same int"))
    longest = F.max(F.struct((F.col("doc_to") - F.col("doc_from")).alias("n"), (-F.col("doc_from")).alias("minus_from"),
                             "doc_from", "doc_to", "item_from", "same")).alias("b")
    return found.groupBy("doc", "item").agg(longest).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "b.doc_from", "b.doc_to", "b.item_from",
        F.col("b.same").alias("n_same"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents, all columns, without those that overlap with an item; null identifiers are matched as null."""
    hit = overlaps(docs, items, id_col, **options).select(F.col("doc_id").alias("hit_id")).distinct()
    return (docs.select(F.struct("*").alias("doc"))
            .join(hit, F.col(f"doc.{id_col}").cast("long").eqNullSafe(F.col("hit_id")), "left_anti").select("doc.*"))
