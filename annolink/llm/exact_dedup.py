"""Exact duplicates: groups by a 128-bit content hash, bytes compared inside each group.

1. Rows are grouped by (hash, text). The text in the key is the comparison of bytes: two
   texts with one hash stay two groups. Equal texts are merged before the shuffle, so a
   group of any size, up to most of the table, costs one row per task.
2. Every row then finds its group by hash and SHA-256 (the names of the group once the bytes
   are compared), without its text. The groups are shuffled anew for this join, so that
   Spark can split the rows of a hot group over several tasks.

Cases: a null text is an empty text. Rows without an id are below all ids; a group of such
rows only has a null ``keep_id``, and ``exact_groups`` marks all of them as kept, as it does repeated
rows of the id that stays; ``drop_exact_copies`` keeps one row of every group. Texts of any length are
compared whole. An empty table gives an empty result. Further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import keyed, texts

Digest = Callable[[Column], Column]


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _named(rows: DataFrame, text: Column, digest: Digest) -> DataFrame:
    return rows.withColumns({"_hash": digest(text), "_sha": F.sha2(text.cast("binary"), 256)})


def _groups(rows: DataFrame, keep: str, digest: Digest) -> DataFrame:
    """One row per distinct text: hashes, id that stays, number of rows."""
    best = F.max if keep == "max" else F.min
    return (
        rows.withColumn("_hash", digest(F.col("text")))
        .groupBy("_hash", "text")
        .agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("_hash", F.sha2(F.col("text").cast("binary"), 256).alias("_sha"), "keep_id", "group_size")
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    digest: Digest = content_hash,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = texts(docs, id_col, text_col)
    named = _named(rows, F.col("text"), digest).select("doc_id", "_hash", "_sha")
    return named.join(_groups(rows, keep, digest), ["_hash", "_sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    digest: Digest = content_hash,
) -> DataFrame:
    """One row of each group of equal texts, with all its columns: that of the id that stays.

    Of several rows with this id, and of rows without any, the one with the greatest key stays.
    """
    held = keyed(docs)
    text = F.coalesce(F.col("_row")[text_col], F.lit(""))
    own = F.col("_row")[id_col]
    # Rows with an id come before rows without one, whichever end is kept.
    first = (own.isNotNull() if keep == "max" else own.isNull()).alias("first")
    rows = held.select(F.struct(first, own.alias("id"), F.col("_key").alias("key")).alias("doc_id"), text.alias("text"))
    named = _named(held, text, digest)
    groups = _groups(rows, keep, digest)
    return named.join(groups, ["_hash", "_sha"]).where(F.col("_key") == F.col("keep_id.key")).select("_row.*")
