"""Batches of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.fixed_values import BATCH_SIZE
from annolink.operators.skew import with_position


def assign_batches(df: DataFrame, order_by: list[str], size: int = BATCH_SIZE) -> DataFrame:
    """Number of the batch of each row: ``size`` rows each, in the given total order.

    Pass the columns that the batching needs, not the texts: the rows are sorted.
    """
    numbered = with_position(df, *order_by)
    return numbered.withColumn("batch", F.expr(f"position div {int(size)}")).drop("position")
