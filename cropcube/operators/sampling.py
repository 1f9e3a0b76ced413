"""Row sampling and export batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.draws import draw


def hash_sample(df: DataFrame, key, fraction: float, seed: int = 0) -> DataFrame:
    """Keep about ``fraction`` of the rows, by the draw of their key columns.

    Each key is in or out whatever the engine, the partitions or the other rows; rows
    that share a key go together.
    """
    return df.where(draw("sample", *[F.col(k) for k in key], seed=seed) < F.lit(int(fraction * 2 ** 32)))


def batches(df: DataFrame, batch_size: int = K.BATCH_SIZE) -> DataFrame:
    """Number the batches of ``batch_size`` rows in which each partition hands its rows on.

    Adds ``partition`` and ``batch``.  A training loop reads the rows of one batch
    together; batches are formed per partition, in the JVM, without a shuffle.
    """
    at = F.monotonically_increasing_id()
    return df.withColumn("partition", F.shiftright(at, 33)) \
        .withColumn("batch", F.floor(at.bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(batch_size)))
