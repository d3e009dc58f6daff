"""Staged output of a run: nothing in the output folder changes before all of it is written.

Tables are written below ``<out>/_staging/<key>/tables`` first. ``publish`` then records every
move in a journal (``<out>/_publish.json``), puts each table in its place by a rename, writes
``<out>/_committed.json`` (what the output folder holds) and drops the journal. So

- a run that ends early leaves the last result as it was;
- one that ends within ``publish`` leaves the journal, and whoever comes next, a run or a reader
  (``recover``), finishes the moves: each is done once, whatever was done before;
- tables of other K's than the run's stay as they are.

The staging folder outlives a broken run. Its name is the key of input and configuration, so
the same run finds what it has already finished (``finish``, ``finished``) and goes on from there.

One run at a time may use an output folder. A rename is atomic on HDFS and local disks; on
object stores it copies, which the journal covers as well. Names that begin with ``_`` are not seen by
Spark's readers.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from segrec.files import Files
from segrec.session import scratch_path

STAGING, JOURNAL, COMMITTED = "_staging", "_publish.json", "_committed.json"


def input_key(*inputs: DataFrame) -> str:
    """A digest of what DataFrames read and do: their files (names, bytes, times of change) and
    their canonical plans. Another file, a rewritten one or another expression changes it.
    Rows that come from no file (of a list, an RDD, a cached table) can't be known again: then it is a
    random one."""
    parts = []
    for df in inputs:
        files = Files(df.sparkSession)
        plan = df._jdf.queryExecution().optimizedPlan().canonicalized()
        leaves = plan.collectLeaves()
        if any(leaves.apply(k).nodeName() not in ("LogicalRelation", "OneRowRelation", "Range") for k in range(leaves.size())):
            return uuid.uuid4().hex
        for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
            parts.append([folder, *files.stamps(folder)])
        parts.append(_whole_text(df.sparkSession, plan))
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def _whole_text(spark: SparkSession, plan) -> str:
    """A plan's text with every field of its rows (Spark leaves out the later ones by default)."""
    setting = "spark.sql.debug.maxToStringFields"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, 2**31 - 1)
    try:
        return plan.treeString()
    finally:
        spark.conf.set(setting, usual)


class StagedOutput:
    """The staging folder of one run below ``out``."""

    def __init__(self, spark: SparkSession, out: str, key: str):
        self.files, self.out, self.key = Files(spark), out.rstrip("/"), key
        self.folder = f"{self.out}/{STAGING}/{key}"

    def path(self, table: str) -> str:
        """Where to write a table, named by its path in the output folder (``metrics/k=3``)."""
        return f"{self.folder}/tables/{table}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table of the scratch folder, that of an earlier attempt if there is one.

        It is not part of the staging folder, so results may read it after the run was published."""
        spark, found = df.sparkSession, self.finished(name)
        if not found or not self.files.exists(f"{found['path']}/_SUCCESS"):
            found = {"path": scratch_path(spark, name)}
            df.write.parquet(found["path"])
            self.finish(name, found)
        return spark.read.schema(df.schema).parquet(found["path"])

    def finish(self, step: str, value) -> None:
        """Record that a step is done; ``value`` (JSON) is what ``finished`` returns from then on."""
        self.files.write_json(f"{self.folder}/done/{step}.json", value)

    def finished(self, step: str):
        path = f"{self.folder}/done/{step}.json"
        return self.files.read_json(path) if self.files.exists(path) else None

    def discard(self) -> None:
        self.files.delete(self.folder)

    def publish(self, tables: Iterable[str], about: dict | None = None) -> None:
        """Put the staged ``tables`` in their places and commit them."""
        journal = {"key": self.key, "tables": list(tables), "about": about or {}}
        self.files.write_json(f"{self.out}/{JOURNAL}", journal)
        _apply(self.files, self.out, journal)


def _apply(files: Files, out: str, journal: dict) -> None:
    folder = f"{out}/{STAGING}/{journal['key']}"
    for table in journal["tables"]:
        staged = f"{folder}/tables/{table}"
        if files.exists(staged):  # else it has been moved
            files.replace(staged, f"{out}/{table}")
    files.write_json(f"{out}/{COMMITTED}", journal)
    files.delete(f"{out}/{JOURNAL}")
    files.delete(folder)


def recover(spark: SparkSession, out: str) -> bool:
    """Finish a publication that was broken off; whether there was one."""
    files, out = Files(spark), out.rstrip("/")
    if not files.exists(f"{out}/{JOURNAL}"):
        return False
    _apply(files, out, files.read_json(f"{out}/{JOURNAL}"))
    return True


def committed(spark: SparkSession, out: str) -> dict | None:
    """The tables of the last published run and what it said about itself."""
    path = f"{out.rstrip('/')}/{COMMITTED}"
    files = Files(spark)
    return files.read_json(path) if files.exists(path) else None


__all__ = ["StagedOutput", "committed", "input_key", "recover"]
