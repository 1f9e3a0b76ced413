"""Incremental ingest with Structured Streaming.

The original re-runs whole scripts and skips what already exists by listing
folders.  Here new observation files are picked up by a file stream with a
checkpoint.  Deliveries may come in any order and late by any time: what is
already landed is found by an anti join against the partitions that a batch
touches, not by a watermark, so back-fill of old years is never dropped.
Series are refreshed only for the (bbox, year) partitions a batch touched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cropcube import constants as K
from cropcube.operators.loader import slots_long, training_examples
from cropcube.operators.moments import refresh_moments
from cropcube.operators.observe import latest_per_key, quality_filter
from cropcube.operators.series import build_series, encode_series
from cropcube.streaming.compaction import live_rows

#: What makes two rows deliveries of one observation.
OBSERVATION_KEY = ["bbox", "year", "pixel_id", "tile", "scene_date"]
#: Partitions a batch may touch for its reads to name them all in a filter.
NAMED_PARTITIONS = 1000


def observation_stream(spark: SparkSession, source_dir: str, schema: StructType,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """File source over landed observation files (explicit schema, no inference)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(source_dir)


class Touched:
    """The (bbox, year) partitions of a batch, and reads narrowed to them.

    Up to 1,000 partitions are named in a filter, which prunes directories.  Beyond that,
    rows are narrowed by a semi-join with the batch's partitions: only directories are no
    longer pruned, no other partition's row is kept or worked on.
    """

    def __init__(self, batch: DataFrame):
        self.keys = batch.select("bbox", "year").distinct()
        named = self.keys.limit(NAMED_PARTITIONS + 1).collect()
        self.none = not named
        self.where = reduce(lambda a, b: a | b, [self._is(r) for r in named]) if named and len(named) <= NAMED_PARTITIONS else None

    @staticmethod
    def _is(row) -> Column:
        return F.col("bbox").eqNullSafe(F.lit(row.bbox)) & F.col("year").eqNullSafe(F.lit(row.year))

    def of(self, rows: DataFrame) -> DataFrame:
        if self.where is not None:
            return rows.where(self.where)
        keys = self.keys.select(F.col("bbox").alias("_bbox"), F.col("year").alias("_year"))
        return rows.join(keys, rows["bbox"].eqNullSafe(keys["_bbox"]) & rows["year"].eqNullSafe(keys["_year"]), "left_semi")


def touched_partitions(batch: DataFrame) -> Touched:
    """The partitions that a batch touches."""
    return Touched(batch)


def land_batch(batch: DataFrame, epoch_id: int, sink_dir: str, touched: Touched | None = None,
               key=tuple(OBSERVATION_KEY)) -> None:
    """R01 + R02: append what a batch has that earlier epochs have not landed.

    Of rows that share the key within a batch one stays (``latest_per_key`` over all
    other columns).  A row that repeats a landed one in every column is dropped; one that
    corrects it lands too, and :func:`landed` prefers the later epoch.  Rows go to
    (bbox, year, epoch) with dynamic partition overwrite and the comparison leaves out
    the own epoch, so a replayed epoch rewrites exactly its own files.  What compaction has
    folded counts as landed.
    """
    touched = touched or touched_partitions(batch)
    if touched.none:
        return
    values = [c for c in batch.columns if c not in key]
    new = latest_per_key(batch, list(key), values[:1], values[1:])
    done = touched.of(live_rows(batch.sparkSession, sink_dir, batch.schema)).where(F.col("epoch") < epoch_id)
    done = latest_per_key(done, list(key), ["epoch"]).drop("epoch")
    # one landed row a key at most: joined on the key alone, both sides stay where they were grouped
    done = done.select(*key, F.struct(*values).alias("_done"))
    new.join(done, list(key), "left").where(~F.struct(*values).eqNullSafe(F.col("_done"))).select(*batch.columns) \
        .withColumn("epoch", F.lit(int(epoch_id)).cast("long")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("bbox", "year", "epoch").parquet(sink_dir)


def landed(spark: SparkSession, sink_dir: str, schema: StructType, touched: Touched | None = None,
           key=tuple(OBSERVATION_KEY)) -> DataFrame:
    """The observations landed so far, the latest epoch of each key, whether folded or not.

    An epoch holds a key once.  So partitions whose live rows are all of one epoch are taken as
    they are, without a shuffle; only the others are grouped by key.
    """
    rows = live_rows(spark, sink_dir, schema)
    rows = rows if touched is None else touched.of(rows)
    latest = lambda r: latest_per_key(r, list(key), ["epoch"]).select(*schema.fieldNames())
    if not {"bbox", "year"} <= set(key):
        return latest(rows)
    epochs = rows.select("bbox", "year", "epoch").distinct().groupBy("bbox", "year").count()
    mixed = Touched(epochs.where("count > 1"))
    if mixed.none:
        return rows.select(*schema.fieldNames())
    if mixed.where is None:
        return latest(rows)
    return rows.where(~mixed.where).select(*schema.fieldNames()).unionByName(latest(rows.where(mixed.where)))


def ingest_available(stream: DataFrame, sink_dir: str, checkpoint_dir: str) -> None:
    """Land every file available now, then stop."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        land_batch(batch, epoch_id, sink_dir)  # reads the batch's files twice, first two columns only
    _run(stream, run, checkpoint_dir)


def refresh_series_batch(obs_root: str, series_dir: str, moments_dir: str | None = None):
    """A ``foreachBatch`` function that lands a batch and refreshes its partitions.

    The series of every touched (bbox, year) are rebuilt from the landed observations as
    a batch job builds them: latest processing of each scene, quality filter, series.  Only
    touched partitions are read, worked on and replaced; an empty batch reads nothing.  With
    ``moments_dir`` the statistics of the touched partitions are refreshed as well (M06).
    The batch's files are read for its partitions (two columns) and again to land them.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        touched = touched_partitions(batch)
        if touched.none:
            return
        land_batch(batch, epoch_id, obs_root, touched)
        obs = landed(batch.sparkSession, obs_root, batch.schema, touched)
        obs = latest_per_key(obs, ["bbox", "year", "pixel_id", "CDL", "scene_date", "mgrs"],
                             ["seq", "scl", *K.BANDS])
        obs = quality_filter(obs.withColumn("tile", F.concat_ws("_", "mgrs", F.col("seq").cast("string"))))
        series = build_series(obs)
        encode_series(series).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("bbox", "year").parquet(series_dir)
        if moments_dir:
            refresh_moments(slots_long(training_examples(series)), moments_dir)
    return run


def refresh_series(stream: DataFrame, obs_root: str, series_dir: str, checkpoint_dir: str,
                   moments_dir: str | None = None) -> None:
    """R03 driver: run the stream to completion with the refresh function."""
    _run(stream, refresh_series_batch(obs_root, series_dir, moments_dir), checkpoint_dir)


def _run(stream: DataFrame, each_batch, checkpoint_dir: str) -> None:
    stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_dir) \
        .trigger(availableNow=True).start().awaitTermination()


def window_counts(events: DataFrame, ts_col: str = "ts", by=("event_type",), width: str = "5 days",
                  watermark: str | None = None) -> DataFrame:
    """Event-time counts per tumbling window (epoch-aligned).

    Works on a batch DataFrame or, with ``watermark``, on a stream in append
    mode (a window is emitted once the watermark passes its end).
    """
    ev = events.withColumn("_ts", F.col(ts_col).cast("timestamp"))
    if watermark:
        ev = ev.withWatermark("_ts", watermark)
    g = ev.groupBy(F.window("_ts", width).alias("w"), *by).agg(F.count("*").alias("n"))
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *by, "n")
