"""Guards against hot keys and oversized broadcasts.

A *hot* key has more rows than one task should hold. Hot keys are counted exactly (with
map-side combine, so the count itself is not skewed) and take a path of their own that
spreads one key over many tasks; no row is dropped on either path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolink.staging import stage

# Rows of one key that may be gathered in one task.
HOT_ROWS = 100_000
# A side is broadcast only when it was measured to be below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows that one task should hold in memory, about.
TASK_ROWS = 250_000


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and their count, or None if there are none.

    The question is put to the data at once, because the plan depends on the answer: it
    reads the key column only, once, as the answer is written. Pass None where the caller
    knows that no key is hot.
    """
    if hot_rows is None:
        return None
    counts = df.groupBy(key).agg(F.count("*").alias("n_rows"))
    hot = stage(counts.where(F.col("n_rows") > hot_rows))
    return None if hot.isEmpty() else hot


def key_sizes(df: DataFrame, key: str | list[str]) -> tuple[int, int]:
    """The number of rows, and the most rows that a key has."""
    counts = df.groupBy(key).agg(F.count("*").alias("n_rows"))
    rows, most = counts.agg(F.sum("n_rows"), F.max("n_rows")).first()
    return rows or 0, most or 0


def tasks_for(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Into how many tasks so many rows are dealt: all cores have one, and none has too many rows.

    Adaptive execution keeps its hands off a given number. It would join partitions by their compressed
    bytes, and rows of a few popular values take ten times as much in a task's memory.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // task_rows))


def distinct_rows(df: DataFrame, tasks: int) -> DataFrame:
    """Distinct rows, dealt by the whole row first.

    A plain distinct stays where the join before it has put the rows: all those of a popular entity
    in one task, which holds them twice.
    """
    return df.repartition(tasks, *df.columns).distinct()


def number_copies(df: DataFrame, chunk: int = HOT_ROWS) -> DataFrame:
    """All rows, with a column ``copy`` that tells equal rows apart.

    Equal rows are counted before the shuffle, then written out again in chunks that are
    spread over the tasks, so that a hash of the whole row is a fair salt.
    """
    columns = df.columns
    n, block = F.col("n_copies"), F.col("copy_block")
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias("n_copies"))
        .withColumn("copy_block", F.explode(F.expr(f"sequence(0L, (n_copies - 1) div {chunk})")))
        .repartition(*columns, "copy_block")
        .withColumn(
            "copy",
            F.explode(F.sequence(block * chunk, F.least(n, (block + 1) * chunk) - 1)),
        )
        .select(*columns, "copy")
    )


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a table: true when its strings and 16 bytes per field stay below the limit."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
    total = df.agg(F.sum(size)).first()[0]
    return (total or 0) <= limit


def held_side(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` as the side of an inner join that is held while the rows of the other side pass: broadcast, or
    in parts of a shuffle.

    A sort-merge join sorts both sides, and one of its tasks would hold all rows of some popular keys. It is
    left to Spark only where ``df`` itself has too many rows of one key to be held.
    """
    if fits_broadcast(df):
        return F.broadcast(df)
    return df if key_sizes(df, keys)[1] > HOT_ROWS else df.hint("shuffle_hash")


def with_position(df: DataFrame, *order_by, name: str = "position") -> DataFrame:
    """Number all rows from 0 in the given total order, without a one-task window.

    The rows are range-sorted and written once with their place inside their own
    partition; adding the number of rows in earlier partitions gives the position.
    """
    rows = stage(df.orderBy(*order_by).withColumn("_slot", F.monotonically_increasing_id()))
    block = F.shiftright("_slot", 33).alias("_block")
    # One row per partition of the sort: small by construction.
    sizes = rows.groupBy(block).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    within = F.col("_slot").bitwiseAND((1 << 33) - 1)
    return (
        rows.withColumn("_block", block)
        .join(F.broadcast(starts), "_block")
        .withColumn(name, F.col("_start") + within)
        .drop("_block", "_slot", "_start")
    )
