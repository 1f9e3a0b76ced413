"""Dataset listings as tables.

A listing has one row for each data file: path, length and time of change, as the file
system tells them.  It comes from the binary-file source without its contents column, so
no data file is opened, whatever it holds; partition values are read off the paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILES = "path string, length bigint, modified timestamp"
#: What Spark writes in place of a null or empty partition value.
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def list_files(spark: SparkSession, *roots: str, pattern: str = "*.parquet") -> DataFrame:
    """The data files below one or more roots; a root that does not exist has none.

    Names that begin with '_' or '.' (commit markers, manifests, unfinished writes) are not data,
    nor are files of no bytes, which no Parquet file is.
    """
    roots = tuple(r for r in roots if exists(spark, r))
    if not roots:
        return spark.createDataFrame([], FILES)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(list(roots))
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def with_partitions(files: DataFrame, schema: str | StructType) -> DataFrame:
    """The ``key=value`` folders of each path as columns of ``schema``, unescaped and typed.

    A folder that a path lacks, and the folder of a null value, give null.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return files.withColumns({f.name: _value(f.name).cast(f.dataType) for f in schema.fields})


def _value(key: str) -> Column:
    text = F.regexp_extract(F.col("path"), f"/{key}=([^/]*)/", 1)
    plain = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))  # only %xx is an escape in a folder's name
    return F.when((text != "") & (text != NULL_VALUE), F.coalesce(plain, text))


def partitions(files: DataFrame, schema: str | StructType) -> DataFrame:
    """The distinct partition values of a listing, with files and bytes of each."""
    listed = with_partitions(files, schema)
    keys = StructType.fromDDL(schema).fieldNames() if isinstance(schema, str) else schema.fieldNames()
    return listed.groupBy(*keys).agg(F.count("*").alias("num_files"), F.sum("length").alias("total_bytes"))


def size(files: DataFrame) -> DataFrame:
    """Number of files, bytes and gigabytes of a listing; no files give zeros."""
    total = F.coalesce(F.sum("length"), F.lit(0)).cast("bigint")
    return files.agg(F.count("*").alias("num_files"), total.alias("total_bytes"),
                     F.round(total / F.lit(1024 ** 3), 6).alias("total_gb"))


def pending(inputs: DataFrame, outputs: DataFrame, schema: str | StructType) -> DataFrame:
    """Partitions that one listing has and another lacks."""
    keys = StructType.fromDDL(schema).fieldNames() if isinstance(schema, str) else schema.fieldNames()
    return partitions(inputs, schema).select(*keys).subtract(partitions(outputs, schema).select(*keys))
