"""What several operators share: tables, word rules, folds and hashes of word runs."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolink.staging import stage

# Words are what lies between ASCII blanks and control blanks; ``bytes.split()`` cuts there too.
WORD = r"[^\x20\x09-\x0D]+"


def shared(spark: SparkSession, value) -> Callable:
    """Broadcast an object of this package; the result, called in a task, gives it back.

    Its arrays lie in the broadcast itself, once for a worker, and cannot be written to. The driver writes
    them from where they are, without a copy.
    """
    arrays: list[pickle.PickleBuffer] = []
    data = cloudpickle.dumps(value, protocol=5, buffer_callback=arrays.append)
    held = spark.sparkContext.broadcast((data, [pickle.PickleBuffer(a.raw().toreadonly()) for a in arrays]))
    return lambda: pickle.loads(held.value[0], buffers=held.value[1])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text only, a missing text as an empty one."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


# Added to the numbers of rows without an id, so that rows with one come first.
_LATER = 1 << 62


def keyed(docs: DataFrame) -> DataFrame:
    """(_row, _key): the rows of ``docs``, whatever their columns are called, and a key for each.

    The key is the id where every row has one of its own, else a number; the numbered rows are written,
    so that all uses see the same numbers. A table of the ids' counts tells which.
    """
    row = F.struct(*docs.columns).alias("_row")
    unsure = docs.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
    if unsure.isEmpty():
        return docs.select(row, F.col("doc_id").cast("long").alias("_key"))
    later = F.when(F.col("doc_id").isNull(), F.lit(_LATER)).otherwise(F.lit(0))
    return stage(docs.select(row, (F.monotonically_increasing_id() + later).alias("_key")))


def without(docs: DataFrame, rejected: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns.

    ``rejected`` gets the rows with an id for each and returns the ids of those that go: rows without an
    id, or that share one, are decided one by one.
    """
    held = keyed(docs)
    others = [F.col("_row")[c].alias(c) for c in docs.columns if c != "doc_id"]
    ids = rejected(held.select(F.col("_key").alias("doc_id"), *others))
    out = ids.select(F.col(ids.columns[0]).alias("_out")).distinct()
    return held.join(out.hint("merge"), F.col("_key") == F.col("_out"), "left_anti").select("_row.*")


def remainder(id_column: Column, modulus: int) -> Column:
    """The crc32 of an id, as text, by ``modulus``; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix64(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a finaliser of shifts and odd products)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` word hashes, by doubling: one product per binary digit."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factor = 0x9E3779B97F4A7C15
    power, block, size = factor, words, 1
    result, done = None, 0
    rest = length
    while rest:
        if rest & 1:
            # ``block`` at i covers ``size`` words from i.
            part = block[done : done + n]
            result = part if result is None else result + part * np.uint64(pow(factor, done, 1 << 64))
            done += size
        rest >>= 1
        if rest:
            block = block[:-size] + block[size:] * np.uint64(power)
            power = power * power % (1 << 64)
            size *= 2
    return mix64(result)
