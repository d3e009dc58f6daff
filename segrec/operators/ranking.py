"""Ranking helpers.

``rank_within_groups`` numbers the rows of each group 1..n in a total order without putting
a group into one task: a range shuffle spreads every group (even a group holding most rows)
over contiguous slices, each row gets its slice id and its position inside (slice, group)
(a window whose groups hold at most one slice), and a small table of slice offsets (one row
per non-empty (slice, group) pair, at most slices + groups - 1 rows) turns that into the
group-wide position.

Slice ids are the partition ids of the range shuffle, so the sliced rows are materialised
once with a reliable checkpoint (shared ``spark.checkpoint.dir``) before positions and
offsets are derived from them: both then come from the same data, whatever AQE does to later
shuffle reads, and a lost executor re-reads the checkpoint instead of re-sampling ranges.

``top_n_per_group`` is ``row_number <= n``; Spark plans it with ``WindowGroupLimit`` which
keeps only ``n`` rows per group in every map task before the shuffle, so a hot group sends at
most ``n`` rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segrec.session import cut_lineage


def rank_within_groups(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                       rank_col: str = "rank", num_slices: int | None = None) -> DataFrame:
    """``row_number() over (partition by group_cols order by order)``, computed distributed.

    ``order`` must make the order total within a group (end it with a unique key), otherwise
    positions of tied rows are arbitrary, as with ``row_number``. Eager: runs the range
    shuffle and checkpoints the sliced rows (one pass over ``df``).
    """
    keys = [F.col(g).asc() for g in group_cols] + list(order)
    # Without num_slices the partition count is the session's, and AQE may coalesce small
    # range partitions (adjacent ranges, order kept); the checkpoint fixes the slice ids.
    ranged = df.repartitionByRange(num_slices, *keys) if num_slices else df.repartitionByRange(*keys)
    sliced = cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()))
    # position inside the slice: a (slice, group) holds at most one slice of rows
    in_slice = Window.partitionBy("_slice", *group_cols).orderBy(*order)
    local = sliced.withColumn("_pos", F.row_number().over(in_slice))
    segments = sliced.groupBy("_slice", *group_cols).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = segments.select("_slice", *group_cols,
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # offsets has at most (#slices + #groups - 1) rows, which can be many groups: its bytes decide
    # whether it is broadcast
    ranked = local.join(offsets, ["_slice", *group_cols])
    rank = (F.col("_offset") + F.col("_pos")).cast("bigint")
    return ranked.withColumn(rank_col, rank).drop("_slice", "_pos", "_offset")


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= F.lit(n))
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))
