"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plans; sizes are left to the cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

_local_base: str | None = None


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword dots are written as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a fresh temporary folder, because
    there driver and executors are one process on one disk.
    """
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(_local_base)
    return _local_base


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, *, few_files: bool = False) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back.

    For a result that feeds several branches of a plan: it is computed once, a lost
    executor does not bring it back, and its file size tells the optimizer whether it
    may be broadcast. With ``few_files`` the narrow result of a wide scan is rebalanced into
    files of full size instead of a small one per task.
    """
    path = fresh_folder(df.sparkSession, label)
    (df.hint("rebalance") if few_files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(*jobs: Callable[[], Any]) -> list[Any]:
    """Start independent Spark jobs together, so that one fills the cores another leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
