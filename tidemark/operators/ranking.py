"""`ntile` over a whole table without sorting it in one task.

Slim rows (sort key, id) are range-partitioned and sorted; their place in the partition
is written with them, so it stays the same whatever task is repeated afterwards. Per-partition
counts turn places into ranks, and only the few rows that open a tile are kept, as one array: every
row's tile is the number of those it has reached, without a join. For more than `MOST_CUTS` tiles the
ranks give the tiles, which are joined back by identifier.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

PLACE_BITS = 33
#: Tiles up to which every row is compared with the rows that open them; beyond, tiles are joined back by identifier.
MOST_CUTS = 1000


def _sort_key(measure: Column, descending: bool) -> tuple[Column, Column]:
    """NULL sorts first ascending and last descending, as ORDER BY does by default."""
    return (measure.isNull() if descending else measure.isNotNull()).cast("int"), measure


def _ranked(df: DataFrame, id_col: str, measure: Column, descending: bool) -> DataFrame:
    """(grp, key, id) of every row with its `_rank` in the whole table and the table's `_total`."""
    group, key = _sort_key(measure, descending)
    slim = df.select(group.alias("grp"), key.alias("key"), F.col(id_col).alias("id"))
    order = [F.col("grp"), F.col("key").desc() if descending else F.col("key"), F.col("id")]
    placed = materialise(
        slim.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranking",
    ).withColumn("_block", F.shiftright("_place", PLACE_BITS))
    blocks = placed.groupBy("_block").agg(F.count("*").alias("_n"), F.min("_place").alias("_start"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per written partition: a few thousand at most, whatever the table size.
    offsets = blocks.select(
        "_block", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    return placed.join(offsets, "_block").withColumn(
        "_rank", F.col("_before") + F.col("_place") - F.col("_start") + 1
    )


def _tiles(df: DataFrame, id_col: str, measure: Column, descending: bool, n: int) -> DataFrame:
    """(id, tile) of every row."""
    base, extra, place = F.expr(f"_total div {n}"), F.col("_total") % n, F.col("_rank") - 1
    wide = extra * (base + 1)
    # Without a full tile (base 0) every row lies in the wide part.
    tile = F.when(place < wide, F.floor(F.try_divide(place, base + 1))).otherwise(
        extra + F.floor(F.try_divide(place - wide, base)))
    return _ranked(df, id_col, measure, descending).select("id", (tile + 1).cast("int").alias("tile"))


def _cuts(df: DataFrame, id_col: str, measure: Column, descending: bool, n: int) -> Column:
    """The rows that open tiles 2..n, at most n - 1, as one array of (grp, key, id) in their own types."""
    ranked = _ranked(df, id_col, measure, descending)
    # Tiles 1..extra have one row more than the others; a row opens a tile when the row before it
    # lies in another one.
    base, extra = F.expr(f"_total div {n}"), F.col("_total") % n
    wide = extra * (base + 1)

    def opens(rank: Column) -> Column:
        in_wide = F.when(base + 1 > 0, (rank - 1) % (base + 1) == 0)
        in_rest = F.when(base > 0, F.try_mod(rank - 1 - wide, base) == 0).otherwise(F.lit(False))
        return F.when(rank <= wide, in_wide).otherwise(in_rest)

    cuts = ranked.where((F.col("_rank") > 1) & opens(F.col("_rank")))
    return cuts.agg(F.collect_list(F.struct("grp", "key", "id")).alias("cuts")).select("cuts").scalar()


def _reached(measure: Column, descending: bool, id_col: str):
    """Whether a row stands at or behind the row that opens a tile."""
    group, key = _sort_key(measure, descending)

    def at_or_behind(cut: Column) -> Column:
        beyond = key < cut["key"] if descending else key > cut["key"]
        tied = key.eqNullSafe(cut["key"]) & (F.col(id_col) >= cut["id"])
        same = (group == cut["grp"]) & (F.coalesce(beyond, F.lit(False)) | tied)
        return (group > cut["grp"]) | same

    return at_or_behind


def ntile_scores(
    df: DataFrame, id_col: str, rankings: Mapping[str, tuple[Column, bool]], n: int
) -> DataFrame:
    """Adds one `ntile(n)` column per entry of `rankings`: name -> (measure, descending).

    Measures are compared in their own type. Ties are broken by the unique `id_col`. `df` is read
    once per ranking and once more; pass a written table.
    """
    if n < 2:
        return df.withColumns({name: F.lit(1) for name in rankings})
    if n > MOST_CUTS:
        for name, (measure, descending) in rankings.items():
            tiles = _tiles(df, id_col, measure, descending, n).select(F.col("id").alias("_id"), F.col("tile").alias(name))
            df = df.join(tiles, F.col(id_col).eqNullSafe(F.col("_id"))).drop("_id")
        return df
    cuts = {f"_cuts_{name}": _cuts(df, id_col, measure, descending, n)
            for name, (measure, descending) in rankings.items()}
    scores = {
        name: F.size(F.filter(F.col(f"_cuts_{name}"), _reached(measure, descending, id_col))) + 1
        for name, (measure, descending) in rankings.items()
    }
    return df.withColumns(cuts).withColumns(scores).drop(*cuts)


def ntile_distributed(
    df: DataFrame, n: int, measure: Column, id_col: str, descending: bool = False,
    name: str = "tile",
) -> DataFrame:
    return ntile_scores(df, id_col, {name: (measure, descending)}, n)
