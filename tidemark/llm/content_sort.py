"""Exact deduplication by a range-partitioned external sort of the content."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of

#: Characters of a text that the sampled splitters hold.
SPLIT_CHARS = 64

_ROWS = "doc_id long, text_sha256 string, part int, run long, first boolean, keep_id long, n long, edge string"


def _runs(batches):
    """Slim rows with their run of equal texts; `edge` holds the text of a run that touches the partition's border."""
    part = TaskContext.get().partitionId()
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("part", pa.int32()), ("run", pa.int64()),
                        ("first", pa.bool_()), ("keep_id", pa.int64()), ("n", pa.int64()), ("edge", pa.string())])
    run, text, sha, ids = 0, None, None, []

    def closed(edge):
        all_ids = pa.concat_arrays(ids)
        n = len(all_ids)
        first = np.zeros(n, bool)
        first[0] = True
        return pa.RecordBatch.from_arrays([
            all_ids, pa.array([sha] * n, pa.string()), pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, run)),
            pa.array(first), pa.array([all_ids[0].as_py()] * n, pa.int64()), pa.array(np.full(n, n)),
            pa.array([text if edge else None] + [None] * (n - 1), pa.string())], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        doc, texts, shas = batch.column(0), batch.column(1), batch.column(2)
        same = pc.equal(texts.slice(1), texts.slice(0, len(texts) - 1)).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(texts)]])
        if text is not None and texts[0].as_py() != text:
            yield closed(run == 0)
            run, ids = run + 1, []
        ids.append(doc.slice(0, starts[1]))
        text, sha = texts[0].as_py(), shas[0].as_py()
        if len(starts) == 2:
            continue
        yield closed(run == 0)  # the run that reached into this batch
        run += 1
        lo, hi = starts[1], starts[-2]  # runs that begin and end here
        if hi > lo:
            sizes = np.diff(starts[1:-1])
            own = np.repeat(np.arange(len(sizes)), sizes)
            heads = starts[1:-2]
            first = np.zeros(hi - lo, bool)
            first[heads - lo] = True
            yield pa.RecordBatch.from_arrays([
                doc.slice(lo, hi - lo), shas.slice(lo, hi - lo), pa.array(np.full(hi - lo, part, np.int32)),
                pa.array(run + own), pa.array(first), doc.take(pa.array(heads[own])), pa.array(sizes[own]),
                pa.nulls(hi - lo, pa.string())], schema=schema)
            run += len(sizes)
        text, sha, ids = texts[int(hi)].as_py(), shas[int(hi)].as_py(), [doc.slice(hi)]
    if text is not None:
        yield closed(True)


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the group of rows that have the same text; the row with the largest identifier stays.

    Sampled splitters deal the rows out by (beginning of the text, hash of the whole text, identifier), an external sort
    by these and the text itself puts equal texts side by side, and neighbours are compared in full. The splitters so
    stay small whatever the texts' length. A group may cross partitions: only the runs at partition borders, at most two of
    each partition, are brought together afterwards, again by their full texts.

    A null text counts as empty. A null identifier comes after all others; where all are null, so is `keep_id`.
    Of rows that agree in text and largest identifier exactly one is kept. No rows give no rows; other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    split = [F.substring("text", 1, SPLIT_CHARS), F.xxhash64("text")]
    last = F.col("doc_id").desc_nulls_last()
    ordered = rows.repartitionByRange(*split, last).sortWithinPartitions(*split, "text", last)
    slim = cut(ordered.select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
               .mapInArrow(_runs, _ROWS))
    seams = (slim.where(F.col("edge").isNotNull()).groupBy("edge")
             .agg(F.max("keep_id").alias("all_keep"), F.sum("n").alias("all_n"), F.min("part").alias("from_part"),
                  F.collect_list(F.struct("part", "run")).alias("runs"))
             .select("all_keep", "all_n", "from_part", F.explode("runs").alias("r"))
             .select(F.col("r.part").alias("part"), F.col("r.run").alias("run"), "all_keep", "all_n", "from_part"))
    # At most two rows for each partition of the sort.
    return (slim.join(F.broadcast(seams), ["part", "run"], "left")
            .select("doc_id", F.coalesce("all_keep", "keep_id").alias("keep_id"),
                    F.coalesce("all_n", "n").alias("group_size"),
                    (F.col("first") & (F.coalesce("from_part", "part") == F.col("part"))).alias("kept"), "text_sha256"))
