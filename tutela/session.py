"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot student ids: let the runtime split the large side of a join even when
    # that costs one more exchange afterwards
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "tutela", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), f"tutela-{os.getpid()}")


_roots: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in a folder of this application that
    is dropped when its driver ends."""
    root = f"{shared_dir(spark)}/tutela/{spark.sparkContext.applicationId}"
    if root not in _roots:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _roots.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, written: list[str] | None = None) -> DataFrame:
    """Write an intermediate result with several readers once and read it back.

    The table lies in the shared folder, so a lost executor costs the tasks it
    was running and nothing upstream; readers prune its columns and the planner
    sees its true size. Its path is added to ``written``, for an owner that
    removes it before the application ends.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if written is not None:
        written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table that ``keep`` has written; nothing outside the scratch folder."""
    if not path.startswith(f"{shared_dir(spark)}/tutela/"):
        raise ValueError(f"{path} is no scratch table")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
