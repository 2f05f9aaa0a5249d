"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_bits, written

#: Means above this are dealt out over several independent draws, so that exp(-mean) stays far from underflow.
DRAW_MEAN = 64.0


def temperature_targets(docs: DataFrame, group_col: str, size: Column) -> DataFrame:
    """Weights in proportion to the square root of a source's size (temperature 2)."""
    return docs.groupBy(F.col(group_col).alias("grp")).agg(F.sqrt(F.sum(size)).alias("weight"))


def replication_rates(docs: DataFrame, group_col: str, size: Column, targets: DataFrame) -> DataFrame:
    """For each source the mean number of copies of a document that brings the source to its weight.

    targets: (grp, weight). The expected size of the mixture is that of the input. A source without a target or with a
    weight of zero or less gets 0; sources of size 0 get 0. Weights of absent sources are ignored.
    """
    sizes = docs.groupBy(F.col(group_col).alias("grp")).agg(F.sum(size).alias("size"))
    t = targets.select(F.col("grp").alias("t"), F.greatest(F.col("weight"), F.lit(0.0)).alias("weight"))
    both = written(sizes.join(t, F.col("grp").eqNullSafe(F.col("t")), "left")
                   .select("grp", "size", F.when(F.col("size") > 0, F.coalesce("weight", F.lit(0.0)))
                           .otherwise(F.lit(0.0)).alias("weight")), "sources")
    total = both.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    mean = F.col("weight") / total.select("all_weight").scalar() * total.select("all_size").scalar() / F.col("size")
    return both.select("grp", F.when(F.col("weight") > 0, F.round(mean, 9)).otherwise(F.lit(0.0)).alias("mean"))


def _poisson_table(mean: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... far beyond the largest uniform of 52 bits."""
    steps = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def more(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(steps, start, more, lambda acc: acc["c"])


def poisson_mix(docs: DataFrame, rates: DataFrame, seed: int = 17, id_col: str = "doc_id",
                group_col: str = "source") -> DataFrame:
    """Each document as often as the inverse Poisson distribution says at the hash of (seed, identifier).

    Returns the documents' columns as struct `doc`, `copy` (from 1), `n_copies` and `shuffle_key`; rows lie in the
    order of the key inside each partition, partitions are dealt by the key, so the whole is in random order.

    rates: (grp, mean). Null sources match null; a source without a rate gets no copies. Rows with equal identifiers
    (nulls too) get equal counts. Texts are carried whole and never looked at. No rows give no rows.
    """
    draws = F.greatest(F.ceil(F.col("mean") / DRAW_MEAN), F.lit(1)).cast("int")
    r = written(rates.where("mean > 0").select(F.col("grp").alias("g"), draws.alias("draws"),
                                               _poisson_table(F.col("mean") / draws).alias("cdf")), "rates")
    ident = F.coalesce(F.col("doc")[id_col].cast("string"), F.lit("null"))

    def drawn(part):
        u = hash_bits(F.lit(str(seed)), ident, part.cast("string")) / F.lit(float(2**52))
        return F.size(F.filter(F.col("cdf"), lambda c: c <= u))

    count = F.aggregate(F.transform(F.sequence(F.lit(0), F.col("draws") - 1), drawn), F.lit(0), lambda a, x: a + x)
    # The table of rates lies in a file, so its size is known: small ones are broadcast, larger ones joined by shuffle.
    counted = (docs.select(F.struct("*").alias("doc"))
               .join(r, F.col(f"doc.{group_col}").eqNullSafe(F.col("g")))
               .select("doc", count.alias("n_copies")).where("n_copies > 0"))
    copies = counted.select("doc", "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    key = hash_bits(F.lit(f"{seed} order"), ident, F.col("copy").cast("string"))
    return (copies.withColumn("shuffle_key", key).repartition("shuffle_key")
            .sortWithinPartitions("shuffle_key", F.col("doc")[id_col]))


def mix_to_targets(docs: DataFrame, targets: DataFrame | None = None, seed: int = 17, id_col: str = "doc_id",
                   group_col: str = "source", text_col: str = "text") -> DataFrame:
    """The corpus mixed to the targets, by default to temperature 2; sizes are counted in code points of all texts."""
    size = F.length(F.coalesce(F.col(text_col), F.lit("")))
    if targets is None:
        targets = temperature_targets(docs, group_col, size)
    return poisson_mix(docs, replication_rates(docs, group_col, size, targets), seed, id_col, group_col)
