"""Sharding by a minimax contiguous partition (DataFrame functions only).

Groups of equal texts are atomic. They are put in one fixed order (by the SHA-256 of the text,
which is uniform, so no sampling and no locality skew), and the ordered list is cut into
``n_shards`` contiguous runs such that the largest run is as small as any contiguous cut
allows. The smallest feasible capacity is found by binary search; a capacity is checked
greedily over the running sizes.

The running sizes are a distributed table (one row per distinct text). The search needs only
a few of them, so the driver holds a *digest*: at most ``bins`` running sizes of each interval
in which a cut can still lie. A greedy walk over known running sizes that uses the largest
known one below a target is pessimistic, one that uses the target itself is optimistic; while
the two disagree the intervals between them are read again in finer bins. The capacity found
is the exact optimum, and what reaches the driver is bounded by ``bins * (n_shards - 1)``
rows per round, whatever the number of documents.

Defined results: null text has size 1, CRC 0 and forms a group of its own (apart from ''); a
null id sorts first within its group; repeated rows are separate rows that get a slot each
(equal rows are interchangeable); an empty table gives an empty result; extra columns are
ignored. Fewer groups than shards leave the last shards empty.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segrec.llm.common import materialise, pick

LAW = "bytes"


class SizeDigest:
    """Known running sizes of an ordered list of groups, and which gaps between them are empty."""

    def __init__(self, total: int):
        self.total = total
        self.known = [0, total] if total else [0]
        self.closed = set()  # running sizes with no unknown one between them and the known one before

    def add(self, bins: list[tuple[int, int, int]]) -> None:
        """``bins``: (smallest, largest, number) of the running sizes of each bin of a gap."""
        self.known = sorted({*self.known, *(x for low, high, _ in bins for x in (low, high))})
        self.closed |= {low for low, _, _ in bins} | {high for _, high, n in bins if n <= 2}

    def open_gaps(self, low: int, high: int) -> list[tuple[int, int]]:
        """Gaps between known running sizes that reach into (low, high) and may hold others."""
        i = max(0, bisect.bisect_right(self.known, low) - 1)
        out = []
        while i + 1 < len(self.known) and self.known[i] < high:
            if self.known[i + 1] not in self.closed:
                out.append((self.known[i], self.known[i + 1]))
            i += 1
        return out

    def below(self, target: int, optimistic: bool) -> int:
        i = bisect.bisect_right(self.known, target) - 1
        if not optimistic or i + 1 == len(self.known) or self.known[i + 1] in self.closed:
            return self.known[i]
        return target

    def cuts(self, capacity: int, shards: int, optimistic: bool) -> list[int]:
        """Greedy: every shard takes as many groups as fit; the ends of the shards."""
        out, at = [], 0
        for _ in range(shards):
            at = self.below(min(at + capacity, self.total), optimistic)
            out.append(at)
        return out

    def smallest(self, low: int, high: int, shards: int, optimistic: bool) -> int:
        """Binary search for the smallest capacity whose greedy walk reaches the end."""
        while low < high:
            mid = (low + high) // 2
            if self.cuts(mid, shards, optimistic)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low


def _running_ends(groups: DataFrame, spans: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """The smallest and largest running size, and how many there are, of each bin of each span (low, high]."""
    pieces = []
    for i, (low, high) in enumerate(spans):
        width = max(1, math.ceil((high - low) / bins))
        inside = (F.col("end") > low) & (F.col("end") <= high)
        pieces.append(F.when(inside, F.lit(i * (bins + 1)) + F.floor((F.col("end") - low - 1) / width)))
    rows = (groups.select("end", F.coalesce(*pieces).alias("bin")).where("bin is not null")
            .groupBy("bin").agg(F.min("end").alias("low"), F.max("end").alias("high"), F.count(F.lit(1)).alias("n")).collect())
    return [(int(r["low"]), int(r["high"]), int(r["n"])) for r in rows]


def minimax_cuts(groups: DataFrame, total: int, largest: int, n_shards: int, bins: int = 1024) -> tuple[int, list[int]]:
    """(smallest capacity, ends of the shards) for a table of running sizes ``end``."""
    digest = SizeDigest(total)
    if not total:
        return 0, [0] * n_shards
    floor = max(largest, -(-total // n_shards))
    gaps = [(0, total)]
    while True:
        # every open gap loses its first running size and is cut in two at least, so the search ends
        digest.add(_running_ends(groups, gaps, max(2, bins // len(gaps))))
        high = digest.smallest(floor, total, n_shards, optimistic=False)
        low = digest.smallest(floor, high, n_shards, optimistic=True)
        if low == high:
            return high, digest.cuts(high, n_shards, optimistic=False)
        cuts = zip(digest.cuts(low, n_shards, False)[:-1], digest.cuts(high, n_shards, True)[:-1], strict=True)
        gaps = sorted({gap for a, b in cuts for gap in digest.open_gaps(a, b)})


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col("text")
    base = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(text.isNull(), F.lit("").cast("binary")).otherwise(F.unhex(F.sha2(text, 256))).alias("key"))
    base = materialise(base, "shard-rows")
    rows = base.count()
    # A group of copies can hold a third of all rows: its rows are numbered in sqrt(rows) parts.
    root = max(1, math.isqrt(rows))
    base = base.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(root)))

    parts = base.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    parts = materialise(parts, "shard-parts")
    # Running sizes over all groups: within slices of the order, plus the offset of the slice.
    # The slice is the leading 32 bits of the key scaled down, so slices follow the key order.
    lead = F.coalesce(F.conv(F.substring(F.hex("key"), 1, 8), 16, 10).cast("long"), F.lit(0))
    groups = (parts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
              .withColumn("slice", F.floor(lead * root / F.lit(1 << 32))))
    per_slice = groups.groupBy("slice").agg(F.sum("n").alias("sn"), F.sum("bytes").alias("sb"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # sqrt(rows) rows
    per_slice = per_slice.select("slice", F.coalesce(F.sum("sn").over(before), F.lit(0)).alias("n0"),
                                 F.coalesce(F.sum("sb").over(before), F.lit(0)).alias("b0"))
    inside = Window.partitionBy("slice").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    groups = groups.join(per_slice, "slice").select(
        "key", "n", "bytes", (F.col("n0") + F.sum("n").over(inside) - F.col("n")).alias("first_slot"),
        (F.col("b0") + F.sum("bytes").over(inside)).alias("end"))
    groups = materialise(groups, "shard-groups")

    size = groups.agg(F.coalesce(F.max("end"), F.lit(0)).alias("total"),
                      F.coalesce(F.max("bytes"), F.lit(0)).alias("largest")).first()
    _, ends = minimax_cuts(groups, int(size["total"]), int(size["largest"]), n_shards)
    shard = sum(((F.col("end") > end).cast("int") for end in ends[:-1]), F.lit(0))
    groups = groups.withColumn("shard", shard)
    first = groups.groupBy("shard").agg(F.min("first_slot").alias("shard_slot"))  # n_shards rows
    placed = groups.join(F.broadcast(first), "shard").select(
        "key", "shard", (F.col("first_slot") - F.col("shard_slot")).alias("group_slot"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_slot", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    placed = parts.join(placed, "key").select(
        "key", "part", "shard", (F.col("group_slot") + F.col("part_slot")).alias("base_slot"))
    within = Window.partitionBy("key", "part").orderBy("doc_id")
    return base.withColumn("nth", F.row_number().over(within)).join(placed, ["key", "part"]).select(
        F.col("doc_id"), "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("base_slot") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


__all__ = ["LAW", "SizeDigest", "minimax_cuts", "shard_documents"]
