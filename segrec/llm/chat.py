"""Chat formatting into a prefix tree laid out depth-first.

A turn becomes ``[INST]role[/INST]text</s>`` with the control strings inside role and text
escaped reversibly. Conversations that share their initial turns share tree nodes: a node is a
turn together with all turns before it, named by a chained 128-bit hash. The conversation with
the smallest id through a node *owns* it; the nodes that a conversation owns are always the
rest of its path, its *run*. A depth-first walk that visits the owner's child first writes each
run in one piece, then the runs that branch off it, the deepest branch first. So the order of
runs is the order of short keys (branch depth and owner of each run passed on the way), which a
range sort and a distributed running sum turn into offsets. No step gathers a tree, and a
first turn shared by a third of all conversations is one aggregated row.

A token is a code point of the formatted text. Per node the output has its place in the packed
sequence of its tree (``start``, ``end``), the position id of its first token within the
conversation, the loss span, and the ancestor intervals that its tokens attend to besides the
earlier tokens of the node itself.

Defined results: null role or text is empty; turns are ordered by (turn, role, text), nulls
first, and equal rows are separate turns; null conv_ids form one conversation of their own
(internally the smallest long); an empty table gives empty tables; extra columns are ignored.
A conversation of any length is streamed in order by one task in constant memory.
"""

from __future__ import annotations

import hashlib
import re
import struct
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segrec.llm.common import map_rows, materialise, pick

OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
# The control strings of the template and of tokenizers around it.
CONTROL = (OPEN, MIDDLE, CLOSE, "<s>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_SEGMENT = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(MIDDLE) + "(.*)" + re.escape(CLOSE), re.DOTALL)
NO_ID = -(2**63)


def escape(text: str) -> str:
    """Double every backslash and break control strings with one; holds no control string."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and its loss span: the text of an assistant turn, else empty."""
    head, body = f"{OPEN}{escape(role)}{MIDDLE}", escape(text)
    end = len(head) + (len(body) if role == "assistant" else 0)
    return f"{head}{body}{CLOSE}", len(head), end


def parse_turn(segment: str) -> tuple[str, str]:
    m = _SEGMENT.fullmatch(segment)
    if m is None:
        raise ValueError(f"not a formatted turn: {segment[:40]!r}")
    return unescape(m[1]), unescape(m[2])


@dataclass
class ChatTree:
    """``nodes``: the packed trees. ``members``: conv_id, depth, node_id of every turn."""

    nodes: DataFrame
    members: DataFrame


def _chained(turns: DataFrame) -> DataFrame:
    """Turns in order with their node, the node before, depth, and place on the path."""
    def work(batches):
        conv, node, depth, at = None, b"", 0, 0
        for b in batches:
            out = {k: [] for k in ("conv", "depth", "node_id", "parent_id", "segment", "loss_start", "loss_end", "position")}
            for c, role, text in zip(b["conv"], b["role"], b["text"], strict=True):
                if c != conv:
                    conv, node, depth, at = c, b"", 0, 0
                segment, low, high = format_turn(role, text)
                parent, node = node, hashlib.blake2b(node + segment.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                for k, v in zip(out, (c, depth, node, parent, segment, low, high, at), strict=True):
                    out[k].append(v)
                depth, at = depth + 1, at + len(segment)
            yield out

    return map_rows(turns.select("conv", "role", "text"), "conv long, depth long, node_id binary, parent_id binary, "
                    "segment string, loss_start long, loss_end long, position long", work)


def _run_keys(steps: DataFrame) -> DataFrame:
    """Per run: owner conversation, first position, length, sort key and the runs passed.

    ``steps`` has conv, depth, owner, position, size, sorted by conv and depth."""
    def work(batches):
        state = {"conv": None, "passed": []}

        def finish():
            conv, passed = state["conv"], state["passed"]
            if conv is None or passed[-1][0] != conv:
                return []  # every node belongs to a smaller conversation
            # deeper branches come first, then smaller owners; big-endian, so bytes sort like numbers
            key = b"".join(struct.pack(">QQ", 2**64 - 1 - depth if k else 0, owner + 2**63)
                           for k, (owner, depth, _, _) in enumerate(passed))
            above = [{"owner": o, "position": p, "length": end - p} for o, _, p, end in passed[:-1]]
            return [(conv, passed[-1][2], passed[-1][3] - passed[-1][2], key, passed[0][0], above)]

        def table(rows):
            return dict(zip(("owner", "position", "length", "key", "tree", "above"), zip(*rows, strict=True), strict=True))

        for b in batches:
            rows = []
            for conv, depth, owner, position, size in zip(*(b[k] for k in ("conv", "depth", "owner", "position", "size")),
                                                          strict=True):
                if conv != state["conv"]:
                    rows += finish()
                    state = {"conv": conv, "passed": []}
                if not state["passed"] or state["passed"][-1][0] != owner:
                    state["passed"].append((owner, depth, position, position))
                o, d, p, _ = state["passed"][-1]
                state["passed"][-1] = (o, d, p, position + size)
            if rows:
                yield table(rows)
        if last := finish():
            yield table(last)

    return map_rows(steps, "owner long, position long, length long, key binary, tree long, "
                    "above array<struct<owner:long,position:long,length:long>>", work)


def _by_conversation(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", *order)


def format_tree(conversations: DataFrame) -> ChatTree:
    """Format all conversations into packed prefix trees."""
    turns = pick(conversations, conv="conv_id", turn="turn", role="role", text="text").select(
        F.coalesce("conv", F.lit(NO_ID)).cast("long").alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = materialise(_chained(_by_conversation(turns, "turn", "role", "text")), "chat-turns")

    owners = rows.groupBy("node_id").agg(F.min("conv").alias("owner"))
    rows = materialise(rows.join(owners, "node_id").withColumn("size", F.length("segment").cast("long")), "chat-owned")
    steps = _by_conversation(rows.select("conv", "depth", "owner", "position", "size"), "depth")
    runs = _run_keys(steps.select("conv", "depth", "owner", "position", "size"))

    # Offsets: running sums within key ranges, plus the sums of the ranges before. The ranges
    # are written, so their numbers cannot change when a task runs again.
    n = max(1, int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = materialise(runs.repartitionByRange(n, "key").sortWithinPartitions("key")
                       .withColumn("range", F.spark_partition_id()), "chat-runs")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = runs.groupBy("range").agg(F.sum("length").alias("total")).select(
        "range", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    placed = runs.join(F.broadcast(ranges), "range").withColumn(
        "at", F.col("base") + F.sum("length").over(inside) - F.col("length"))
    placed = materialise(placed.select("owner", "position", "length", "tree", "above", "at"), "chat-places")

    starts = placed.select("owner", "at")
    trees = starts.select(F.col("owner").alias("tree"), F.col("at").alias("tree_at"))
    here = placed.join(trees, "tree").select("owner", "tree", "above", F.col("position").alias("run_position"),
                                             (F.col("at") - F.col("tree_at")).alias("run_start"))
    run_starts = here.select(F.col("owner").alias("above_owner"), F.col("run_start").alias("above_start"))
    intervals = (here.select("owner", F.posexplode("above").alias("nth", "a"))
                 .select("owner", "nth", F.col("a.owner").alias("above_owner"), F.col("a.length").alias("length"))
                 .join(run_starts, "above_owner")
                 .groupBy("owner").agg(F.sort_array(F.collect_list(F.struct(
                     "nth", F.col("above_start").alias("start"),
                     (F.col("above_start") + F.col("length")).alias("end")))).alias("passed")))
    here = here.drop("above").join(intervals, "owner", "left")

    start = F.col("run_start") + F.col("position") - F.col("run_position")
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    passed = F.coalesce(F.transform("passed", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))), empty)
    own = F.when(start > F.col("run_start"), F.array(F.struct(F.col("run_start").alias("start"), start.alias("end")))
                 ).otherwise(empty)
    nodes = rows.where("conv = owner").join(here, "owner").select(
        "node_id", "parent_id", F.col("tree").alias("tree_id"), "depth", "segment", start.alias("start"),
        (start + F.col("size")).alias("end"), "position", "loss_start", "loss_end",
        F.concat(passed, own).alias("attends"))
    return ChatTree(materialise(nodes, "chat-nodes"), rows.select("conv", "depth", "node_id"))


def read_back(tree: ChatTree) -> DataFrame:
    """Conversations parsed from the packed trees: digests of turns and of the text under the loss mask."""
    joined = tree.members.join(tree.nodes.select("node_id", "segment", "loss_start", "loss_end"), "node_id")
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def work(batches):
        conv, state = None, None

        def finish():
            return (conv, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])

        for b in batches:
            rows = []
            for c, segment, low, high in zip(*(b[k] for k in ("conv", "segment", "loss_start", "loss_end")), strict=True):
                if c != conv:
                    if state:
                        rows.append(finish())
                    conv, state = c, {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                role, text = parse_turn(segment)
                learnt = unescape(segment[low:high])
                state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state["loss"].update(learnt.encode("utf-8", "surrogatepass"))
                state["n"] += 1
                state["loss_chars"] += len(learnt)
                state["chars"] += len(segment)
            if rows:
                yield dict(zip(names, zip(*rows, strict=True), strict=True))
        if state:
            yield dict(zip(names, ([x] for x in finish()), strict=True))

    ordered = _by_conversation(joined, "depth").select("conv", "segment", "loss_start", "loss_end")
    out = map_rows(ordered, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                   "formatted_chars long", work)
    return out.withColumn("conv_id", F.when(F.col("conv_id") != NO_ID, F.col("conv_id")))


__all__ = ["ChatTree", "escape", "format_tree", "format_turn", "parse_turn", "read_back", "unescape"]
