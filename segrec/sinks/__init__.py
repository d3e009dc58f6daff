"""Sinks: the per-run result tables and the served documents.

Each result table is written once for the whole sweep, partitioned by ``k``
(``<out>/<name>/k=<K>/part-*``), so a reader that filters on k prunes directories. Writes
overwrite only the partitions present (dynamic partition overwrite). Documents are sorted by
user, as JSON Lines (splittable, not one JSON array) or Parquet (point reads skip row groups).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

FORMATS = ("json", "parquet")


def write_table(df: DataFrame, path: str, fmt: str = "json", partition_by: str | None = None) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    getattr(writer, fmt)(path)


def write_outputs(tables: Mapping[str, DataFrame], out: str, fmt: str = "json") -> list[str]:
    """Write each named table below ``out``; tables with a ``k`` column are partitioned by it.
    An empty table is written as an empty dataset (readers pass a schema)."""
    written = []
    for name, df in tables.items():
        path = f"{out.rstrip('/')}/{name}"
        write_table(df, path, fmt, "k" if "k" in df.columns else None)
        written.append(path)
    return written


def write_documents(docs: DataFrame, out: str, fmt: str = "json") -> None:
    """Served documents, range-partitioned and sorted by user: a lookup of few users reads the
    files and row groups (Parquet) whose statistics hold them."""
    write_table(docs.repartitionByRange("user_id").sortWithinPartitions("user_id"), out, fmt)
