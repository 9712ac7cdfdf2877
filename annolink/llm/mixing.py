"""Mixing sources to target weights.

Every document gets a key from a hash, uniform over 2^60 values. The keys of a source are
cut into equal ranges; as the keys are uniform, a range holds about ``range_rows`` documents
at most, also in a source with most of the rows. Sums per (source, range), summed up over
the ranges, give every range its start; a running sum inside the range, in key order, gives
every document the number of words of its source before it. The source's budget is then cut
exactly: whole epochs first, the rest from the front, the last document in part.

Cases: a null text has size 0. A null source is a source of its own, the last in order.
Repeated rows count each. With no rows, or no words, all targets are 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolink.llm.common import n_words
from annolink.operators.skew import with_position
from annolink.staging import stage

KEY_BITS = 60
# Documents of one key range, sorted in one task.
RANGE_ROWS = 20_000


def random_key(doc_id: Column, text: Column, seed: int) -> Column:
    """The first 60 bits of an MD5 of seed, id and text."""
    parts = [F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text.cast("binary"))]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple, limit: float) -> DataFrame:
    """Add ``target`` to (source, source_size): shares by weight, none above limit times its size.

    With a level L, every target is min(limit * size, L * weight). Each round puts the excess
    of the sources over their limit on the others; the level only rises, and stays when no
    further source is above.
    """
    ranked = with_position(sizes, F.col("source").asc_nulls_last(), name="_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumns({"_weight": weight, "_most": F.col("source_size") * F.lit(float(limit))}))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = -1.0
    while True:
        above = F.col("_most") <= F.lit(level) * F.col("_weight")
        held, free = ranked.agg(
            F.sum(F.when(above, F.col("_most")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("_weight"))),
        ).first()
        if not free:
            level = math.inf if free == 0 else level
            break
        raised = (total - held) / free
        if raised <= level:
            break
        level = raised
    return ranked.select(
        "source",
        "source_size",
        F.least(F.col("_most"), F.lit(max(level, 0.0)) * F.col("_weight")).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple = (5, 2, 1),
    limit: float = 3.0,
    seed: int = 42,
    range_rows: int = RANGE_ROWS,
    carry: tuple = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken per row; further columns by ``carry``, as ``row``."""
    held = [F.struct(*carry).alias("row")] if carry else []
    rows = docs.select(
        "doc_id",
        # A key without nulls, so that windows and joins share one partitioning.
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source"),
        n_words(F.col("text")).alias("size"),
        random_key(F.col("doc_id"), F.coalesce("text", F.lit("")), seed).alias("_key"),
        *held,
    )
    plain = stage(rows.drop("row"))
    counts = stage(plain.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total / range_rows))))
    key_range = F.shiftright("_key", KEY_BITS - bits) if bits else F.lit(0).cast("long")

    targets = source_targets(
        counts.select(F.expr("nullif(_source, '')").alias("source"), "source_size"), weights, limit
    ).withColumn("_source", F.coalesce("source", F.lit(""))).drop("source")
    ranges = plain.groupBy("_source", key_range.alias("_range")).agg(F.sum("size").alias("_words"))
    # At most 2 ** bits rows a source.
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_start", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
    ranges = ranges.join(targets, "_source")

    inside = (
        Window.partitionBy("_source", "_range")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (rows if carry else plain).withColumn("_range", key_range)
    placed = placed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(ranges, ["_source", "_range"])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start") - F.col("_inside")))
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
        *(["row"] if carry else []),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows that the mix takes words of, with all their columns and ``taken``."""
    mixed = mix(docs, carry=tuple(docs.columns), **options).where(F.col("taken") > 0)
    plain = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    return mixed.select(*[F.col("row")[c].alias(c) for c in plain], "size", "source_size", "target", "taken")
