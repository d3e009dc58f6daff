"""Files that hold one JSON array of objects, read by byte ranges.

Spark's ``multiLine`` reads such a file in one task. Here the text source deals out byte
ranges as it does for lines, with ``}`` as the end of a line, so a range begins behind one of
them; what it can't know is whether that place lies within a string and how deep. Two passes:

1. Each range counts its quotation marks and by how much it changes the depth, for a begin
   outside and one inside of a string. A running sum over the ranges of a file, one row each, gives
   the state at every range's begin.
2. With it each range finds where elements of the array begin and end. Whole objects are parsed
   where they are; only what an element leaves to the next range is put together, at most
   two pieces a range.

The state at a place does not depend on how the file was cut, so a range of any length is read
right if its begin is known; one that begins elsewhere (split sizes changed after the file was opened)
is an error, never a wrong row.

Small ranges share tasks, up to ``TASK_BYTES`` of them each once every core has its tasks, so neither tasks nor
the files that a result is written to grow with the number of ranges. A task takes its ranges one after
another, each from its own state.

Elements of the array that are no objects are passed over. A file that is no array, or ends within
one, is an error. Compressed files are one range each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of ranges that a task reads at most, if a range is smaller.
TASK_BYTES = 64 << 20

_QUOTE, _ESCAPE, _OPEN, _CLOSE = 34, 92, (123, 91), (125, 93)  # " \ { [ } ]


def _marks(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the brackets, how many quotation marks lie before each, and the places of those marks.

    ``data`` begins behind a bracket, so no escape reaches into it."""
    a = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(a == _QUOTE)
    if len(quotes) and _ESCAPE in data:
        # a mark behind an odd number of escapes is a letter of its string
        place = np.arange(len(a))
        last_other = np.maximum.accumulate(np.where(a != _ESCAPE, place, -1))
        before = np.maximum(quotes - 1, 0)
        escapes = np.where(quotes > 0, before - last_other[before], 0)
        quotes = quotes[escapes % 2 == 0]
    brackets = np.flatnonzero(np.isin(a, (*_OPEN, *_CLOSE)))
    return brackets, np.searchsorted(quotes, brackets), quotes


class _Range:
    """The state while one range is read: within a string or not, and the depth."""

    def __init__(self, inside: int, depth: int):
        self.inside, self.depth = inside, depth

    def elements(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where bracketed elements of the array begin, and behind which places they end."""
        brackets, before, quotes = _marks(data)
        brackets = brackets[(before + self.inside) % 2 == 0]
        kind = np.frombuffer(data, np.uint8)[brackets]
        depth = self.depth + np.cumsum(np.where(np.isin(kind, _OPEN), 1, -1))
        self.inside = (self.inside + len(quotes)) % 2
        self.depth = int(depth[-1]) if len(depth) else self.depth
        opening = np.isin(kind, _OPEN)
        return brackets[opening & (depth == 2)], brackets[~opening & (depth == 1)] + 1


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """((file, start, ...), text) in order: the pieces of each batch that belong to one range, with their
    ``}`` again. The columns behind the text tell the range."""
    for batch in batches:
        keys = list(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True))
        values = batch.column(0).to_pylist()
        at = 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[at]:
                yield keys[at], b"}".join(values[at:k]) + b"}"
                at = k


def _sums(batches):
    """Pass 1: per range, and batch of it, the marks and the depth changes."""
    for (file, start), data in _ranges(batches):
        brackets, before, quotes = _marks(data)
        change = np.where(np.isin(np.frombuffer(data, np.uint8)[brackets], _OPEN), 1, -1)
        head = data.lstrip(b"\xef\xbb\xbf \t\r\n")[:1]
        yield pa.RecordBatch.from_pydict({
            "file": [file], "start": [start], "quotes": [len(quotes)], "outside": [int(change[before % 2 == 0].sum())],
            "inside": [int(change[before % 2 == 1].sum())], "first": [head]}, schema=_SUMS)


_SUMS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("quotes", pa.int64()), ("outside", pa.int64()),
                   ("inside", pa.int64()), ("first", pa.binary())])
_SUMS_DDL = "file string, start bigint, quotes bigint, outside bigint, inside bigint, first binary"


def _states(rows: list) -> list[tuple[str, int, int, int]]:
    """(file, start, within a string, depth) at the begin of every range, from the sums in the order of
    their ranges; an error for files that are no arrays."""
    out, file = [], None

    def check(inside, depth):
        # the end of the file counts as a } more
        if file is not None and (inside, depth) != (0, -1):
            raise ValueError(f"{file}: the array does not end")

    inside = depth = 0
    for r in rows:
        if r["file"] != file:
            check(inside, depth)
            file, inside, depth = r["file"], 0, 0
            if r["first"] != b"[":
                raise ValueError(f"{file} holds no JSON array")
        if not out or out[-1][:2] != (file, r["start"]):
            out.append((file, r["start"], inside, depth))
        depth += r["inside" if inside else "outside"]
        inside = (inside + r["quotes"]) % 2
    check(inside, depth)
    return out


def _records(whole: bool):
    """Pass 2: the objects that lie in one range, or else the pieces of elements that ranges leave to each other."""
    def run(batches):
        key = state = None
        text, had_end = b"", False  # of the element that is open

        def ended():
            if not whole and key is not None and text:
                yield piece(not (key[3] >= 2 and not had_end), text)

        def piece(opens, data):
            return pa.RecordBatch.from_pydict({"file": [key[0]], "start": [key[1]], "opens": [opens], "value": [data]}, schema=_PIECES)

        for found, data in _ranges(batches):
            if found != key:
                yield from ended()
                key = found
                if key[2] is None:
                    raise ValueError(f"{key[0]} is read from byte {key[1]}, which is no begin of a range that was known when it was opened")
                state, text, had_end = _Range(key[2], key[3]), b"", False
            opened = state.depth >= 2
            begins, ends = state.elements(data)
            values, at = [], 0 if opened else None
            marks = sorted([(int(b), 0) for b in begins] + [(int(e), 1) for e in ends])
            for place, closing in marks:
                if not closing:
                    at = place
                    continue
                text += data[at:place]
                if key[3] >= 2 and not had_end:
                    if not whole:  # the end of an element that began in an earlier range
                        yield piece(False, text)
                elif text.startswith(b"{"):
                    values.append(text)
                had_end, text, at = True, b"", None
            if at is not None:
                text += data[at:]
            if whole and values:
                yield pa.RecordBatch.from_pydict({"value": values}, schema=pa.schema([("value", pa.binary())]))
        yield from ended()

    return run


_PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("opens", pa.bool_()), ("value", pa.binary())])


def _tasks(spark: SparkSession, ranges: int) -> int:
    """How many tasks read so many ranges."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return max(4 * spark.sparkContext.defaultParallelism, -(-ranges // max(1, TASK_BYTES // size)))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The objects of JSON array files as rows of ``schema``. Runs the first pass when called."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))
    pieces = pieces.coalesce(_tasks(spark, pieces.rdd.getNumPartitions()))  # a range stays whole and in order
    # one row per range (and batch of it): what Spark's driver keeps of a scan anyway
    sums = pieces.mapInArrow(_sums, _SUMS_DDL).withColumn("nth", F.monotonically_increasing_id())
    rows = sums.collect()
    states = spark.createDataFrame(_states(sorted(rows, key=lambda r: (r["file"], r["start"], r["nth"]))),
                                   "file string, start bigint, inside int, depth int")
    # broadcast: a row per range of the scan; the pieces must stay in their order, which no other join keeps
    known = pieces.join(F.broadcast(states), ["file", "start"], "left").select("value", "file", "start", "inside", "depth")
    whole = known.mapInArrow(_records(True), "value binary")
    parts = known.mapInArrow(_records(False), "file string, start bigint, opens boolean, value binary")
    # within a range the end of an earlier object comes before the begin of the next
    order = Window.partitionBy("file").orderBy("start", "opens").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("nth", F.sum(F.col("opens").cast("int")).over(order))
    joined = parts.groupBy("file", "nth").agg(F.sort_array(F.collect_list(F.struct("start", "opens", F.hex("value").alias("value")))).alias("p"))
    joined = joined.select(F.unhex(F.array_join(F.transform("p", lambda p: p["value"]), "")).alias("value"))
    joined = joined.filter(F.col("value").startswith(F.lit(b"{")))  # not the arrays within the array
    parsed = whole.unionByName(joined).select(F.from_json(F.col("value").cast("string"), schema).alias("r"))
    return parsed.select("r.*")


def write_json_array(df: DataFrame, path: str) -> None:
    """``df`` as JSON array files, one array per part file, an object a line."""
    def run(batches):
        first = True
        for batch in batches:
            lines = batch.column(0).to_pylist()
            if lines:
                yield pa.RecordBatch.from_pydict({"value": [("[" if first and not k else ",") + x for k, x in enumerate(lines)]})
                first = False
        yield pa.RecordBatch.from_pydict({"value": ["[]" if first else "]"]})

    df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(run, "value string").write.mode("overwrite").text(path)


__all__ = ["read_json_array", "write_json_array"]
