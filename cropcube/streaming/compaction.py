"""Compaction of landed observations behind a manifest.

Every epoch of the ingest adds folders ``bbox=/year=/epoch=`` to the sink.  Compaction folds
the epochs of a partition up to a given one into a new generation, and a manifest tells which
rows live:

* ``<sink>/_folded/generation=/bbox=/year=``: folded rows, the latest epoch of each key;
* ``<sink>/_manifest/version=``: a row for each folded partition: bbox, year, generation and
  ``through``, the last epoch folded.  The greatest version that its writer finished is in
  force.

A row lives if it is in the generation that the manifest names for its partition, or in an
epoch after ``through``.  Each step leaves the same live rows: a folded generation counts only
from the moment that the manifest naming it is complete, and the same moment ends the epochs
that it holds.  A crash before leaves an unnamed generation, a crash after leaves dead files;
:func:`vacuum` deletes both.  The latest epoch is never folded, since it may be replayed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cropcube.operators.observe import latest_per_key
from cropcube.sources import listing as LI
from cropcube.sources.tables import read_dataset

MANIFEST = "bbox string, year int, generation string, through long"
PARTITION = ["bbox", "year"]


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, sink_dir: str) -> list[int]:
    """Versions of the manifest that are complete."""
    fs, at = _files(spark, f"{sink_dir}/_manifest")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    done = [int(m[1]) for n in names if (m := re.fullmatch(r"version=(\d+)", n))
            and LI.exists(spark, f"{sink_dir}/_manifest/{n}/_SUCCESS")]
    return sorted(done)


def manifest(spark: SparkSession, sink_dir: str, version: int | None = None) -> DataFrame:
    """The manifest in force (or of a version): a row for each folded partition."""
    have = _versions(spark, sink_dir)
    if not have:
        return spark.createDataFrame([], MANIFEST).where(F.lit(False))  # known to be empty: joins with it move no row
    return spark.read.schema(MANIFEST).parquet(f"{sink_dir}/_manifest/version={have[-1] if version is None else version}")


def live_rows(spark: SparkSession, sink_dir: str, schema: StructType, named: DataFrame | None = None) -> DataFrame:
    """All live rows with their epoch: folded ones, and those of epochs after ``through``.

    ``schema`` is that of the observations.  The manifest has a row for each partition at most;
    the joins with it are on partition columns.
    """
    full = StructType([*schema.fields]).add("epoch", "long")
    named = manifest(spark, sink_dir) if named is None else named
    epochs = read_dataset(spark, sink_dir, schema=full, missing_ok=True)
    through = named.select(*PARTITION, "through")
    fresh = epochs.join(through, PARTITION, "left").where(F.col("through").isNull() | (F.col("epoch") > F.col("through")))
    folded = read_dataset(spark, f"{sink_dir}/_folded", schema=StructType([*full.fields]).add("generation", "string"), missing_ok=True)
    folded = folded.join(named.select(*PARTITION, "generation"), [*PARTITION, "generation"])
    columns = full.fieldNames()
    return fresh.select(*columns).unionByName(folded.select(*columns))


def fold(spark: SparkSession, sink_dir: str, schema: StructType, key, through: int,
         touched: DataFrame | None = None) -> DataFrame:
    """Write a new generation of the partitions that have live epochs up to ``through``; gives its manifest rows.

    ``touched`` (bbox, year) narrows the partitions.  Nothing lives in the new generation yet.
    """
    named = manifest(spark, sink_dir)
    rows = live_rows(spark, sink_dir, schema, named)
    files = LI.with_partitions(LI.list_files(spark, sink_dir), "bbox string, year int, epoch long")
    due = files.where(F.col("epoch") <= through).join(named.select(*PARTITION, F.col("through").alias("done")), PARTITION, "left") \
        .where(F.col("done").isNull() | (F.col("epoch") > F.col("done"))).select(*PARTITION).distinct()
    if touched is not None:
        due = due.join(touched, PARTITION, "left_semi")
    generation = uuid.uuid4().hex
    values = [c for c in schema.fieldNames() if c not in key]
    kept = latest_per_key(rows.where(F.col("epoch") <= through).join(due, PARTITION, "left_semi"), list(key), ["epoch"], values)
    kept.hint("rebalance", *PARTITION).withColumn("generation", F.lit(generation)) \
        .write.mode("append").partitionBy("generation", *PARTITION).parquet(f"{sink_dir}/_folded")
    return due.select(*PARTITION, F.lit(generation).alias("generation"), F.lit(int(through)).cast("long").alias("through"))


def publish(spark: SparkSession, sink_dir: str, entries: DataFrame) -> int:
    """Write the next version of the manifest, in which ``entries`` replace their partitions'.

    The version is in force once Spark has committed it (``_SUCCESS``).  Of two writers of one
    version the second fails, and its generation stays unnamed.
    """
    have = _versions(spark, sink_dir)
    version = (have[-1] if have else 0) + 1
    fs, at = _files(spark, f"{sink_dir}/_manifest/version={version}")
    if fs.exists(at) and not LI.exists(spark, f"{sink_dir}/_manifest/version={version}/_SUCCESS"):
        fs.delete(at, True)  # left by a writer that crashed
    old = manifest(spark, sink_dir).join(entries, PARTITION, "left_anti")
    old.unionByName(entries).coalesce(1).write.mode("error").parquet(f"{sink_dir}/_manifest/version={version}")
    return version


def compact(spark: SparkSession, sink_dir: str, schema: StructType, key, through: int | None = None,
            touched: DataFrame | None = None) -> int | None:
    """Fold epochs up to ``through`` (by default all but the latest) and put the new generation in force.

    Returns the manifest's version, None if there was nothing to fold.
    """
    files = LI.with_partitions(LI.list_files(spark, sink_dir), "epoch long")
    latest = files.agg(F.max("epoch").alias("e")).first().e
    if latest is None or latest < 1:
        return None
    through = latest - 1 if through is None else min(through, latest - 1)
    entries = fold(spark, sink_dir, schema, key, through, touched)
    if entries.isEmpty():
        return None
    return publish(spark, sink_dir, entries)


def dead_folders(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Folders that no live row lies in: epochs that are folded, and generations that the manifest does not name."""
    named = manifest(spark, sink_dir)
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")
    epochs = LI.with_partitions(LI.list_files(spark, sink_dir), "bbox string, year int, epoch long")
    dead = epochs.join(named, PARTITION).where(F.col("epoch") <= F.col("through")).select(folder)
    folded = LI.with_partitions(LI.list_files(spark, f"{sink_dir}/_folded"), "generation string, bbox string, year int")
    return dead.unionByName(folded.join(named, [*PARTITION, "generation"], "left_anti").select(folder)).distinct()


def vacuum(spark: SparkSession, sink_dir: str) -> int:
    """Delete dead folders and all versions of the manifest but the one in force; returns the number of folders.

    Run it when no reader is on an older manifest and no compaction is under way.
    """
    gone = 0
    for row in dead_folders(spark, sink_dir).toLocalIterator():  # folder names, one partition of them at a time
        fs, at = _files(spark, row.folder)
        gone += bool(fs.delete(at, True))
    for version in _versions(spark, sink_dir)[:-1]:
        fs, at = _files(spark, f"{sink_dir}/_manifest/version={version}")
        fs.delete(at, True)
    return gone
