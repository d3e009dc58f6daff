"""Session helpers: a tuned builder for local runs and the shared scratch folder.

Nothing here changes a session the caller already configured: the scratch folder is read
from ``spark.checkpoint.dir`` and a local one is only created when that setting is unset
(tests, laptops). On a cluster the setting must name a shared file system.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions (a hot user or item).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # let AQE coalesce the partitions of persisted plans too (the pair and cluster tables are
    # persisted and re-read many times; 200 near-empty partitions cost 200 tasks per read)
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # checkpoint files of garbage-collected DataFrames are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "segrec",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    The context's checkpoint folder if one is set, else ``spark.checkpoint.dir``. A local
    folder is made only when neither is set and the session is local (tests, laptops); on a
    cluster each machine would see its own, so that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="segrec-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the scratch folder and read back.

    Unlike a persisted or checkpointed DataFrame the table read back has no partitioning that
    a later join could reuse, so that join shuffles both sides itself and AQE may split a hot
    key; it also survives lost executors and is a plain, well-sized scan for every consumer."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _STORED.append(path)
    return out


_STORED: list[str] = []


def drop_stored(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables that ``stored`` wrote, but for the first ``keep`` of them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    while len(_STORED) > keep:
        path = hadoop(_STORED.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


__all__ = ["build_session", "checkpoint_root", "scratch_path", "cut_lineage", "stored", "drop_stored",
           "DEFAULT_CONF"]
