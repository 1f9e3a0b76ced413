"""Dataset scans and sinks (S01-S04, S12-S14, S16); listings are in ``listing``.

Reads always name their columns so the Parquet scan is pruned, and filters
on partition columns are left to Catalyst (PartitionFilters).  Writes are
partitioned by (bbox, year) and idempotent per partition through dynamic
partition overwrite, so a retried task or job never duplicates rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cropcube.sources.listing import exists

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


#: Session setting by which a caller deals what is read to so many partitions (unset: no exchange).
READ_PARTITIONS = "cropcube.read.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               deal_by: list[str] | None = None) -> DataFrame:
    """One table with named columns, and no exchange of its own unless the caller asks.

    A file of a single row group is read by one task.  A caller who has such files may set
    ``cropcube.read.partitions``: rows are then dealt to that many partitions, by ``deal_by``
    where given, whatever their number or size.  Nothing here looks at the input's size.
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*columns) if columns else df
    wanted = spark.conf.get(READ_PARTITIONS, None)
    return df.repartition(int(wanted), *(deal_by or [])) if wanted else df


def read_dataset(spark: SparkSession, *paths: str, schema: StructType | None = None,
                 where: Column | str | None = None, columns: list[str] | None = None,
                 missing_ok: bool = False) -> DataFrame:
    """Scan one or many Parquet roots as one dataset.

    ``where`` on partition columns prunes directories; ``columns`` prunes
    the read schema.  ``missing_ok`` (Q16): a root that does not exist yet
    reads as an empty dataset of ``schema``; any other error still raises.
    """
    if missing_ok:
        existing = [p for p in paths if exists(spark, p)]
        if not existing:
            if schema is None:
                raise ValueError("missing_ok needs a schema for an absent dataset")
            df = spark.createDataFrame([], schema).where(F.lit(False))  # schema may be DDL text or StructType; known to be empty
            return df.select(*columns) if columns else df
        paths = tuple(existing)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*paths)
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df


def write_dataset(df: DataFrame, path: str, partition_by=("bbox", "year"),
                  mode: str = "overwrite", sort_within=None) -> None:
    """Partitioned Parquet sink.

    ``mode="overwrite"`` uses dynamic partition overwrite: only partitions
    present in ``df`` are replaced, so re-running a partition is idempotent.
    Rows are clustered with the ``rebalance`` hint on the partition columns:
    AQE splits a large (bbox, year) into advisory-size tasks, so a handful of
    partition values never means a handful of writer tasks, and small ones
    are merged so each task writes few files.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
        order = list(partition_by) + list(sort_within or [])
        out = out.sortWithinPartitions(*order)
    w = out.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_and_verify(df: DataFrame, path: str, **kw) -> int:
    """Write, re-read, compare with what was sent and return the row count.

    The rows sent are counted by an observation of the write itself, so the input is
    not computed twice.  A retried task may be observed twice, so a difference is
    checked by an exact count before it raises.
    """
    sent = Observation()
    write_dataset(df.observe(sent, F.count(F.lit(1)).alias("rows")), path, **kw)
    landed = df.sparkSession.read.parquet(path).count()
    if landed != sent.get["rows"] and landed != (exact := df.count()):
        raise ValueError(f"{path}: {exact} rows written, {landed} read back")
    return landed


def check_schema(df: DataFrame, expected: StructType, exact: bool = False) -> DataFrame:
    """Fail early when columns are missing or typed differently."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"column {f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if exact:
        extra = set(have) - {f.name for f in expected.fields}
        problems += [f"unexpected column {c}" for c in sorted(extra)]
    if problems:
        raise ValueError("schema check failed: " + "; ".join(problems))
    return df
