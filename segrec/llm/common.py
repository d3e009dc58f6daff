"""Small helpers shared by the operators: scratch tables, Arrow batches, words."""

from __future__ import annotations

import ctypes
import math
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from segrec.session import scratch_path

# Text bytes that one chunk of documents holds at least before the next one is begun. One task
# works on one chunk at a time, so this bounds its memory (besides a single longer text).
CHUNK_BYTES = 8 << 20


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough wherever that folder exists (local mode, a shared file system, images); elsewhere
    the package is sent with ``--py-files`` as usual."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    Cuts the lineage with files that every executor sees, so a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, doc_id="id")``: the named columns under fixed internal names and nothing else,
    so that extra columns of the input can never clash with an operator's own."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def give_back() -> None:
    """Return freed memory to the system. Spark keeps idle Python workers, and what their allocators
    hold for later is memory that the tasks of other workers lack."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc has it
        trim(0)


def partitions_for(total_bytes: float, per_partition: int = 16 << 20, least: int = 1) -> int:
    return max(least, math.ceil((total_bytes or 0) / per_partition))


def map_rows(df: DataFrame, schema: str, work: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` over plain column dictionaries (name -> list)."""
    def run(batches):
        for columns in work(b.to_pydict() for b in batches):
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    arrow = arrow_schema(df.sparkSession, schema)
    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def chunk_table(docs: DataFrame, text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """The documents as a written table bucketed by chunk, and the bytes of their texts.

    Columns: chunk, nth (place in the chunk), text (UTF-8, binary) and row (struct of all other
    columns). A chunk is what one task handles at a time; it ends at ``chunk_bytes``. The table
    is written without a shuffle and read by chunk without one, as often as an operator needs."""
    spark = docs.sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    carried = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col(f"`{text_col}`").cast("binary").alias("text"), carried.alias("row"))
    schema = StructType([StructField("chunk", LongType()), StructField("nth", LongType()), *rows.schema.fields])

    def run(batches):
        chunk, nth, held = 0, 0, 0
        for batch in batches:
            chunks, places = [], []
            for n in pc.binary_length(batch.column(0)).to_pylist():
                chunks.append(TaskContext.get().partitionId() << 32 | chunk)
                places.append(nth)
                nth, held = nth + 1, held + (n or 0) + 64
                if held >= chunk_bytes:
                    chunk, nth, held = chunk + 1, 0, 0
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(places, pa.int64()), *batch.columns],
                                             names=schema.names)

    source_bytes = int(docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0)
    return bucketed(rows.mapInArrow(run, schema), "chunks", "chunk", partitions_for(source_bytes, chunk_bytes, 4)), source_bytes


def row_number_in_chunks() -> Column:
    """A number of its own for every row of a ``chunk_table``, ascending with chunk and nth: 25 bits of
    the task, 20 of its chunks, 18 of a chunk's rows (a row counts 64 bytes at least of ``CHUNK_BYTES``)."""
    task, chunk = F.shiftright("chunk", 32), F.col("chunk").bitwiseAND((1 << 32) - 1)
    return F.shiftleft(task, 38).bitwiseOR(F.shiftleft(chunk, 18)).bitwiseOR(F.col("nth"))


def rows_of_chunks(chunks: DataFrame, wanted: DataFrame, columns: StructType) -> DataFrame:
    """The rows of a ``chunk_table`` that ``wanted`` (chunk, nth) names, as ``columns`` (text and fields of row).
    The chunks stay where they are."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.filter(pa.array(np.isin(left["nth"].to_numpy(), right["nth"].to_numpy())))
        row = rows["row"].combine_chunks()
        return pa.table([rows["text"].cast(pa.string()) if f.name == "text" else pc.struct_field(row, f.name) for f in columns], names=columns.names)

    return chunks.groupBy("chunk").cogroup(wanted.select("chunk", "nth").groupBy("chunk")).applyInArrow(run, columns)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a written table bucketed and sorted by ``key``: it is grouped, joined or
    cogrouped by that key without a shuffle, as often as needed.

    Spark has an upper bound of buckets; beyond it a bucket holds the rows of several keys, which are
    groups of their own all the same. Buckets are known through the catalog only; its entry goes as
    soon as the DataFrame, which keeps what it said, is made. The files stay, below the scratch folder."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    (df.write.option("path", scratch_path(spark, name)).option("compression", "zstd")
     .bucketBy(bucket_count(spark, buckets), key).sortBy(key).saveAsTable(name))
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def bucket_count(spark: SparkSession, wanted: int) -> int:
    return min(wanted, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


__all__ = ["CHUNK_BYTES", "arrow_schema", "bucket_count", "bucketed", "chunk_table", "ensure_importable", "give_back", "map_rows", "materialise", "partitions_for", "pick", "row_number_in_chunks", "rows_of_chunks"]
