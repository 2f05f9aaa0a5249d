"""Codes of vectors by product quantisation, whose codebooks come from ball k-means in whole numbers."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written

#: Vectors are cut into PARTS, each with a codebook of ENTRIES; components become floor(SCALE * x).
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Bytes of components that are worked on at a time.
SLICE = 8 << 20

_FAR = np.iinfo(np.int64).max


@dataclass
class Balls:
    """A codebook and, for each entry of each part, its ball's neighbours by distance.

    book: (parts, entries, width). order: neighbours of an entry, nearest first. ring: for each of them the squared
    distance that a vector needs from its own entry before the neighbour can be as near; _FAR beyond the ball's reach.
    """

    book: np.ndarray
    order: np.ndarray
    ring: np.ndarray


def _root_up(x: int) -> int:
    return math.isqrt(x - 1) + 1 if x > 0 else 0


def balls(book: np.ndarray, radii: np.ndarray | None) -> Balls:
    """radii: upper bounds of the distance between an entry and its members, -1 where it has none; None: not known.

    Entry j can be as near to a vector x as x's own entry i only if |ij| <= 2 |xi|, so only if |ij| <= 2 radius(i).
    """
    gap = ((book[:, :, None] - book[:, None]) ** 2).sum(-1)
    ring = (gap >> 2) + (gap & 3 > 0)  # a quarter, upwards
    if radii is not None:
        reach = np.array([[r * r if r >= 0 else -1 for r in map(int, part)] for part in radii], object)
        ring = np.where(ring.astype(object) <= reach[:, :, None], ring, _FAR).astype(np.int64)
    own = np.arange(book.shape[1])
    ring[:, own, own] = _FAR
    order = np.argsort(ring, axis=2, kind="stable")
    return Balls(book, order, np.take_along_axis(ring, order, 2))


def assign(x: np.ndarray, part: int, own: np.ndarray, b: Balls) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row of x and its squared distance, ties to the lower index.

    own: the rows' entries so far. Rows of an entry's stable core (no ring reaches them) keep it without another
    comparison; a row in the m-th ring is compared with its entry's m nearest neighbours.
    """
    book = b.book[part]
    best = ((x - book[own]) ** 2).sum(1)
    entry = own.astype(np.int64)
    rings = (b.ring[part][own] <= best[:, None]).sum(1)
    for m in range(int(rings.max(initial=0))):
        at = np.flatnonzero(rings > m)
        other = b.order[part][own[at], m]
        d = ((x[at] - book[other]) ** 2).sum(1)
        nearer = (d < best[at]) | ((d == best[at]) & (other < entry[at]))
        best[at[nearer]], entry[at[nearer]] = d[nearer], other[nearer]
    return entry, best


def _parts_of(column: pa.Array, parts: int) -> np.ndarray:
    """(rows, parts, width), a copy of the column's components."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1) if len(column) else np.empty((0, parts, 1), np.int64)


def _assigning(b: Balls, parts: int, fields: list[str]):
    """Rows with new codes and errors, and at the end the task's sums for each entry as a row of their own."""
    width, entries = b.book.shape[2], b.book.shape[1]

    def run(batches):
        sums = np.zeros((parts, entries, width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        far = np.full((parts, entries), -1, np.int64)
        empty = pa.nulls(1, pa.list_(pa.int64()))
        for batch in batches:
            step = max(1, SLICE // (8 * parts * width))
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                x = _parts_of(rows.column("v"), parts)
                codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(-1, parts).copy()
                error = np.zeros(len(x), np.int64)
                for p in range(parts):
                    entry, d = assign(x[:, p], p, codes[:, p], b)
                    np.add.at(sums[p], entry, x[:, p])
                    counts[p] += np.bincount(entry, minlength=entries)
                    np.maximum.at(far[p], entry, d)
                    codes[:, p] = entry
                    error += d
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"), rows.column("v"),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array(np.zeros(len(x), bool)), *[pa.nulls(len(x), pa.list_(pa.int64()))] * 3], fields)
        lists = [pa.array([a.ravel().tolist()], pa.list_(pa.int64())) for a in (sums, counts, far)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), empty, pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
             pa.array([True]), *lists], fields)

    return run


_FIELDS = "vec_id long, label string, v array<long>, codes binary, error long, is_sum boolean, " \
          "sums array<long>, counts array<long>, far array<long>"


def _round(rows: DataFrame, b: Balls, parts: int, name: str) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """All rows assigned and written in one pass, with sums, counts and squared radii of all entries."""
    names = [f.split()[0] for f in _FIELDS.split(", ")]
    done = written(rows.mapInArrow(_assigning(b, parts, names), _FIELDS), name, "is_sum")
    of_tasks = done.where("is_sum")
    exact = "decimal(38,0)"  # sums over all rows may be wider than their terms

    # A row for each task; the places are as many as the codebook has numbers.
    rows = (of_tasks.select(F.posexplode(F.concat("sums", "counts", "far")).alias("place", "x")).groupBy("place")
            .agg(F.sum(F.col("x").cast(exact)).alias("total"), F.max("x").alias("top")).orderBy("place").collect())
    numbers, entries = b.book.size, b.book[:, :, 0].size
    totals = [int(r.total) for r in rows]
    sums = np.array(totals[:numbers], object).reshape(b.book.shape)
    counts = np.array(totals[numbers:numbers + entries], object).reshape(b.book.shape[:2])
    far = np.array([r.top for r in rows[numbers + entries:]], object).reshape(b.book.shape[:2])
    return done.where("not is_sum").drop("is_sum", "sums", "counts", "far", "error"), sums, counts, far


def _moved(b: Balls, sums: np.ndarray, counts: np.ndarray, far: np.ndarray) -> Balls:
    """Entries moved to the floor of their members' means; a ball's radius grows by its entry's way."""
    book = b.book.copy()
    radii = np.full(counts.shape, -1, object)
    for p, e in np.argwhere(counts > 0):
        book[p, e] = [s // counts[p, e] for s in sums[p, e]]
        way = sum((int(x) - int(y)) ** 2 for x, y in zip(book[p, e], b.book[p, e]))
        radii[p, e] = _root_up(far[p, e]) + _root_up(way)
    return balls(book, radii)


def whole_components(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x), kept within the limit."""
    high = F.lit(float(limit))
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, high), -high)).cast("long"))


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row for each vector kept: vec_id, code, error, label_error, codebooks_sha256 (see the module's settings).

    Vectors are cut into `parts` equal consecutive parts. A part's codebook starts as that part of the vectors with the
    smallest identifiers. Each round assigns every part to its nearest entry (squared Euclidean distance, ties to the
    lower index) and moves each entry to the floor of its members' mean; unused entries stay. At the end parts are
    assigned once more. `code` has two hexadecimal digits for each part, `error` the squared distances, `label_error`
    their sum over equal labels.

    Method (ball k-means): an entry's radius, kept up from round to round, leaves it the neighbours that its members can
    reach; a vector in the stable core is not compared again, others with as many neighbours as their ring says. This
    is exact, since all is done in whole numbers. A round reads and writes the vectors once; tasks return sums for
    each entry. On the driver: the codebooks and sums (parts x entries x width numbers), whatever the number of rows.

    Null vectors and vectors with null or non-finite components are left out, as are those of another length than the
    vector kept with the smallest identifier; nothing remains of no rows. A length that the parts do not divide is
    filled up with zeros. Ties among identifiers go by components; null identifiers come last. With fewer vectors than
    entries the codebooks are smaller. Null labels count as one. Components are cut to what whole numbers of 64 bits
    can hold squared and summed (beyond 46,000 for 64 components). Sums of errors beyond 64 bits stay at the largest
    number. Equal rows each get a row; other columns are not read.
    """
    spark = vectors.sparkSession
    vector = F.col("v").cast("array<double>")
    fine = F.col("v").isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).alias("v")).where(F.coalesce(fine, F.lit(False)))
    first = [F.col("vec_id").asc_nulls_last(), vector]
    lead = rows.orderBy(*first).select(F.size("v").alias("n")).first()
    if lead is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    dims = parts * max(-(-lead.n // parts), 1)
    limit = math.isqrt(2**63 // dims) // 2 - 1
    filled = F.concat(whole_components(F.col("v"), scale, limit), F.array_repeat(F.lit(0).cast("long"), dims - lead.n))
    whole = rows.where(F.size("v") == lead.n).select("vec_id", "label", filled.alias("v"))
    start = whole.orderBy(*first[:1], "v").limit(entries).select("v").collect()
    book = np.array([r.v for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2)
    now = whole.withColumn("codes", F.unhex(F.lit("00" * parts)))
    b, before = balls(book, None), None
    for r in range(rounds):
        now, sums, counts, far = _round(now, b, parts, f"vectors-{r}")
        drop_written(before)
        b, before = _moved(b, sums, counts, far), now
    names = [f.split()[0] for f in _FIELDS.split(", ")]
    last = written(now.mapInArrow(_assigning(b, parts, names), _FIELDS).where("not is_sum")
                   .select("vec_id", "label", "codes", "error"), "codes")
    drop_written(before)
    digest = hashlib.sha256(",".join(str(x) for x in b.book.ravel()).encode()).hexdigest()
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    # The sums lie in a file, so their size is known: few labels are broadcast, many are joined by shuffle.
    labels = written(last.groupBy(F.col("label").alias("l")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error")), "labels")
    return last.join(labels, F.col("label").eqNullSafe(F.col("l"))).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
