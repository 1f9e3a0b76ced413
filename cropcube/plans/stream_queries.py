"""Streaming queries.

Landing data is derived from the driver's tables and written to the shared
checkpoint folder (``spark.checkpoint.dir``) in two deliveries, the second
re-delivering a year of the first; the stream is run to completion twice
on the same checkpoint, as a restarted job would be.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.operators import moments as MO
from cropcube.plans import sql as Q
from cropcube.plans.catalog import ENCODED_SQL, encoded_text
from cropcube.plans.registry import query
from cropcube.session import shared_path
from cropcube.sources import fixtures as FX
from cropcube.sources.tables import read_table
from cropcube.streaming import compaction as CP
from cropcube.streaming import ingest as I

RESENT_YEAR = 1998


def landing_rows(spark, sf):
    raw = FX.with_pixel_attributes(FX.raw_observations(spark, sf))
    return raw.withColumn("tile", F.concat_ws("_", "mgrs", F.col("seq").cast("string"))).drop("cdl_code")


def _two_deliveries(spark, sf, base, run):
    """Write delivery 1 (years >= RESENT_YEAR), run; delivery 2, an older back-fill that
    re-sends RESENT_YEAR (years <= RESENT_YEAR), run again."""
    rows = landing_rows(spark, sf)
    schema = rows.schema
    rows.where(F.col("year") >= RESENT_YEAR).write.parquet(f"{base}/landing/d1")
    run(I.observation_stream(spark, f"{base}/landing/*/*.parquet", schema))
    rows.where(F.col("year") <= RESENT_YEAR).write.parquet(f"{base}/landing/d2")
    run(I.observation_stream(spark, f"{base}/landing/*/*.parquet", schema))
    return schema


_LANDED_SQL = Q.with_(Q.RAW_OBS) + f""",
landed AS (
  SELECT *, {Q.AOI_LIST}[CAST(pixel_id % 7 AS INTEGER) + 1] AS bbox, {Q.class_case('pixel_id % 12')} AS CDL,
         mgrs || '_' || CAST(seq AS VARCHAR) AS tile FROM raw_obs
  QUALIFY row_number() OVER (PARTITION BY year, pixel_id, mgrs, seq, scene_date
                             ORDER BY scl DESC, {', '.join(b + ' DESC' for b in K.BANDS)}) = 1)
"""


@query("r01_stream_ingest", "R01 R02 S03", sql=_LANDED_SQL + "SELECT * FROM landed")
def r01_stream_ingest(spark, sf):
    """Two deliveries, the older one later, one year sent twice: every observation lands once."""
    base = shared_path(spark, "r01")
    schema = _two_deliveries(spark, sf, base,
                             lambda stream: I.ingest_available(stream, f"{base}/sink", f"{base}/checkpoint"))
    return I.landed(spark, f"{base}/sink", schema)


@query("r03_stream_refresh_series", "R03 U01 S03", sql=ENCODED_SQL)
def r03_stream_refresh_series(spark, sf):
    """Stream with foreachBatch: the refreshed series equal those of a batch job over the table."""
    base = shared_path(spark, "r03")
    _two_deliveries(spark, sf, base, lambda stream: I.refresh_series(
        stream, f"{base}/obs", f"{base}/series", f"{base}/checkpoint"))
    return encoded_text(spark.read.parquet(f"{base}/series"))


@query("r01_compacted_ingest", "R01 R03 S03 U01", sql=_LANDED_SQL + "SELECT * FROM landed")
def r01_compacted_ingest(spark, sf):
    """Two deliveries, epochs folded behind the manifest, dead folders deleted, a third delivery that
    re-sends a year, folded again: every observation is there once."""
    base = shared_path(spark, "r01c")
    sink = f"{base}/sink"
    ingest = lambda stream: I.ingest_available(stream, sink, f"{base}/checkpoint")
    schema = _two_deliveries(spark, sf, base, ingest)
    CP.compact(spark, sink, schema, I.OBSERVATION_KEY)
    CP.vacuum(spark, sink)
    landing_rows(spark, sf).where(F.col("year") == RESENT_YEAR).write.parquet(f"{base}/landing/d3")
    ingest(I.observation_stream(spark, f"{base}/landing/*/*.parquet", schema))
    CP.compact(spark, sink, schema, I.OBSERVATION_KEY)
    return I.landed(spark, sink, schema)


@query("m06_merged_normaliser", "M06 A08 A09 R03", sql=Q.with_(Q.TRAIN) + ", stacked AS (" + " UNION ALL ".join(
    f"SELECT year, {i} AS band_index, '{b}' AS band, {b} AS v FROM train_long" for i, b in enumerate(K.BANDS)) + """)
SELECT year, CAST(band_index AS INTEGER) AS band_index, band, count(*) FILTER (WHERE v <> 0) AS n,
       round(avg(CAST(v AS DOUBLE)) FILTER (WHERE v <> 0), 4) AS mean, round(stddev_pop(CAST(v AS DOUBLE)) FILTER (WHERE v <> 0), 4) AS std
FROM stacked GROUP BY year, band_index, band""")
def m06_merged_normaliser(spark, sf):
    """Mean and deviation of each year's bands, merged over areas from statistics that each of two
    deliveries refreshed for the partitions it touched."""
    base = shared_path(spark, "m06")
    _two_deliveries(spark, sf, base, lambda stream: I.refresh_series(
        stream, f"{base}/obs", f"{base}/series", f"{base}/checkpoint", f"{base}/moments"))
    merged = MO.merge_moments(MO.read_moments(spark, f"{base}/moments"), by=("year",))
    std = F.sqrt(F.try_divide("squared", "n"))
    return merged.select("year", "band_index", "band", "n", F.round("mean", 4).alias("mean"), F.round(std, 4).alias("std"))


@query("r04_window_counts", "R04", sql="""
SELECT strftime(TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch(ts) / 432000) * 432000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS window_start,
       event_type, count(*) AS n
FROM events GROUP BY 1, 2""")
def r04_window_counts(spark, sf):
    ev = read_table(spark, sf, "events", ["ts", "event_type"])
    return I.window_counts(ev)


@query("r04_stream_window_counts", "R04", sql="""
WITH w AS (SELECT TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch(ts) / 432000) * 432000 AS BIGINT)) AS ws, event_type
           FROM events),
wm AS (SELECT max(ts) - INTERVAL 1 DAY AS watermark FROM events)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
FROM w JOIN wm ON ws + INTERVAL 5 DAY <= watermark GROUP BY 1, 2""")
def r04_stream_window_counts(spark, sf):
    """The same counts from a stream with a watermark (append mode).

    Append mode emits a window once the watermark (max event time - 1 day)
    passes its end, so the result is every window closed by the end of the
    available data.
    """
    base = shared_path(spark, "r04")
    ev = read_table(spark, sf, "events", ["ts", "event_type"])
    ev.write.parquet(f"{base}/landing/d1")
    stream = spark.readStream.schema(ev.schema).parquet(f"{base}/landing/*/*.parquet")
    counts = I.window_counts(stream, watermark="1 day")
    q = (counts.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
         .outputMode("append").trigger(availableNow=True).start(f"{base}/sink"))
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink")
