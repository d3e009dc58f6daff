"""Comparison of runs over several K."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_metrics(metrics: Sequence[DataFrame]) -> DataFrame:
    """Union by name of the per-run metric rows; each gets its sweep ordinal."""
    out = None
    for ordinal, m in enumerate(metrics):
        m = m.withColumn("ordinal", F.lit(ordinal).cast("bigint"))
        out = m if out is None else out.unionByName(m)
    if out is None:
        raise ValueError("no metrics to combine")
    return out


def metrics_summary(all_metrics: DataFrame) -> DataFrame:
    """Runs ranked by precision desc, then recall desc (NULL metrics last), then sweep order."""
    return all_metrics.orderBy(F.col("precision_at_k").desc_nulls_last(),
                               F.col("recall_at_k").desc_nulls_last(),
                               F.col("ordinal").asc())


def best_k(all_metrics: DataFrame) -> DataFrame:
    """The run with the highest precision; the earliest in sweep order wins ties."""
    return all_metrics.orderBy(F.col("precision_at_k").desc_nulls_last(),
                               F.col("ordinal").asc()).limit(1)
