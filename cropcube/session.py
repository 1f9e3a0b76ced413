"""SparkSession helpers.

The library never creates a session behind a caller's back: functions take
DataFrames.  ``get_session`` is for scripts, tests and the bench only.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "cropcube") -> SparkSession:
    master = master or os.environ.get("CROPCUBE_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CROPCUBE_DRIVER_MEMORY", "6g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="cropcube-")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    The setting is read, never changed.  Only queries that write need it.  Where it is
    unset, a session in local mode (tests) writes to a folder of its own; on a cluster
    the query raises, as a folder of one machine would be lost to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.split("[")[0] == "local":
        named = _own_folder()
    if not named:
        raise RuntimeError("this query writes a table: start the session with spark.checkpoint.dir "
                           "set to a folder that the driver and all executors share")
    return named


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    _WRITTEN.append(f"{checkpoint_dir(spark).rstrip('/')}/cropcube/{name}-{uuid.uuid4().hex[:12]}")
    return _WRITTEN[-1]


#: Folders that :func:`shared_path` named, for :func:`clean`.
_WRITTEN: list[str] = []


#: Tables that :func:`shared_table` named, for :func:`clean`.
_TABLES: list[str] = []


def shared_table(name: str) -> str:
    """A fresh name for a bucketed table of this application; its files go to a :func:`shared_path`."""
    _TABLES.append(f"cropcube_{name}_{uuid.uuid4().hex}")
    return _TABLES[-1]


def clean(spark: SparkSession) -> None:
    """Delete the tables written under the shared folder so far; results that read them must be saved before."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    while _WRITTEN:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage before iterative work (model fits read their input many
    times): a lost executor then re-reads the written table instead of
    recomputing the whole upstream chain.  Uses the folder named by
    ``spark.checkpoint.dir`` (shared storage on a cluster), never a
    machine-local path, and never ``localCheckpoint``.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
