"""Corpus pipeline over ``documents``: the stages in order, each on what its predecessor kept.

All stages but the last return the columns that ``documents`` came with, extra ones
included, whatever their names.  Empty tables, null texts and repeated rows pass
through as each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropcube.llm import anchors, packing, quality, simhash
from cropcube.llm.common import fresh, table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (4): documents that it rejects (score under 0.5) go.

    Null and empty texts are scored like others; null and repeated ids stay.
    """
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (3): one row of each group stays, that of the smallest doc_id.

    Three-word shingles, at most 2 differing bits.  Rows are told apart by a number of the
    stage's own: rows without a doc_id, and unrelated rows that share one, are documents
    like any other.  In a group, rows without a doc_id come last, and of rows that repeat the
    smallest doc_id one stays.
    """
    row = fresh(docs, "row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered", "zstd")
    found = simhash.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), words=3, radius=2)
    ids = numbered.select(F.col(row).alias("doc_id"), F.col("doc_id").alias("id"))
    place = F.struct(F.col("id").isNull().alias("none"), "id", F.col("doc_id").alias("row"))
    kept = found.select("doc_id", "component_id").join(ids, "doc_id").groupBy("component_id").agg(F.min(place).alias("first"))
    kept = kept.select(F.col("first.row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


#: Stands for a missing doc_id where documents are ordered: such rows come last.
LAST = (1 << 63) - 1


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup (9): words covered by a window of 20 words that also starts earlier go.

    A document that loses words keeps the others joined by one space, and its n_chars
    follows; one that loses none stays as it is.  No document goes: rows without a doc_id
    stand after all others.
    """
    own = fresh(docs, "own_id")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    placed = docs.withColumn(own, F.col("doc_id")).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    found = anchors.dedup(placed, window=20, carry=[own, *others])
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("text")).otherwise(F.col("original"))
    columns = {"doc_id": F.col("carry_0"), "text": text}
    for i, c in enumerate(others):
        columns[c] = F.col(f"carry_{i + 1}")
        if c == "n_chars":
            columns[c] = F.when(changed, F.length("text").cast(docs.schema[c].dataType)).otherwise(columns[c])
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing (8): the pieces of every document with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [("quality_classifier", classify), ("simhash_near_dedup", near_dedup), ("substring_dedup", cut_passages),
          ("best_fit_packing", pack)]

#: Boosted trees, linked components and packing are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
