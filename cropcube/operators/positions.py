"""Global row positions without a global sort.

Positions come from sizes: rows fall into buckets whose order is known, the sizes of the
buckets are summed up front, and a row's position is what stands before its bucket plus its
rank inside.  Each bucket is ranked on its own, so no task sees more than one bucket.

* shuffle (L10): buckets of the rows' draws;
* interleaved files (S14): buckets of the rows' places in their files;
* batches (S15): the buckets are the files themselves, and a row's rank is its place there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.draws import draw

#: Rows of a bucket, about.
BUCKET_ROWS = 50_000


def _before(sizes: DataFrame, bucket: str) -> DataFrame:
    """``before``: rows of the buckets that come first; one row a bucket, so the window is small."""
    return sizes.withColumn("before", F.sum("n").over(Window.orderBy(bucket)) - F.col("n"))


def positions(df: DataFrame, bucket: Column, order: list) -> DataFrame:
    """Adds ``position`` (from 0): by bucket, then by ``order`` within it.

    ``bucket`` and ``order`` must follow from a row's own values, since buckets are counted
    first and ranked after.
    """
    placed = df.withColumn("_bucket", bucket)
    before = _before(placed.groupBy("_bucket").agg(F.count("*").alias("n")), "_bucket").select("_bucket", "before")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)) - 1
    return placed.withColumn("_rank", rank).join(before, "_bucket") \
        .withColumn("position", F.col("before") + F.col("_rank")).drop("_bucket", "_rank", "before")


def shuffled(df: DataFrame, key=("pixel_id", "year"), seed: int = 0, epoch: int = 0, rows: int | None = None) -> DataFrame:
    """A seeded permutation; ``position`` is a row's place in it.

    Rows go by the MD5 draw of seed, epoch and key, rows of equal draw by key.  Draws are
    uniform, so buckets of draws are even; ``rows`` saves the count of the rows where known.
    ``df`` is read for its count, its buckets and its rows: store it first if it is costly.
    """
    buckets = max(1, -(-(df.count() if rows is None else rows) // BUCKET_ROWS))
    d = draw("shuffle", *[F.col(k) for k in key], seed=seed, epoch=epoch)
    return positions(df.withColumn("_draw", d), F.shiftright(F.col("_draw") * buckets, 32), ["_draw", *key]).drop("_draw")


def file_rows(df: DataFrame) -> DataFrame:
    """Rows of each file of a table of Parquet files; only footers are read."""
    return df.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("n"))


def interleaved(df: DataFrame) -> DataFrame:
    """The rows of a table's files dealt in turn, the first row of every file, then the second, ...

    ``position`` orders by (place in the file, file).  Places fall into ranges that hold about
    BUCKET_ROWS rows of all files together, or one place of each file where there are more files.
    """
    files = file_rows(df).count()
    step = max(1, BUCKET_ROWS // max(files, 1))
    at = df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    return positions(at, F.floor(F.col("_row") / step), ["_row", "_file"]).drop("_file", "_row")


class Batches:
    """The rows of a table of Parquet files in batches of exactly ``size``, the last one excepted.

    Rows are numbered by file (in order of path), then by place in the file: file sizes are summed
    up, no row is moved or sorted.  The numbering is the files' own, so it is the same however
    the table is read.
    """

    def __init__(self, spark: SparkSession, path: str, size: int = K.BATCH_SIZE):
        self.spark, self.path, self.size = spark, path, size
        self.files = _before(file_rows(spark.read.parquet(path)), "file")

    def _numbered(self, df: DataFrame, files: DataFrame) -> DataFrame:
        at = df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
        n = F.col("before") + F.col("_row")
        return at.join(files.select(F.col("file").alias("_file"), "before"), "_file") \
            .withColumns({"batch": F.floor(n / self.size), "place": F.pmod(n, F.lit(self.size))}).drop("_file", "_row", "before")

    def rows(self) -> DataFrame:
        """All rows with ``batch`` and ``place`` (both from 0)."""
        return self._numbered(self.spark.read.parquet(self.path), self.files)

    def read(self, batch: int) -> DataFrame:
        """The rows of one batch, in order of place; only the files that it reaches into are read."""
        first, end = batch * self.size, (batch + 1) * self.size
        reached = self.files.where((F.col("before") < end) & (F.col("before") + F.col("n") > first)).collect()  # a row of the batch each, at least
        if not reached:
            return self.rows().limit(0)
        some = self._numbered(self.spark.read.parquet(*[r.file for r in reached]), self.spark.createDataFrame(reached, "file string, n long, before long"))
        return some.where(F.col("batch") == batch).orderBy("place")

    def stacked(self, *columns: str) -> DataFrame:
        """A row for each batch with the named columns as arrays in order of place, ready for a training step."""
        listed = self.rows().groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("place", *columns))).alias("_rows"))
        return listed.select("batch", *[F.col(f"_rows.{c}").alias(c) for c in columns])
