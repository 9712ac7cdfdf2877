"""Association rules between two items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolink.fixed_values import MIN_CONFIDENCE, MIN_SUPPORT
from annolink.operators.postings import as_words
from annolink.staging import stage

# Documents of equal size are told apart by this many hash classes.
CLASSES = 64
# How many times the allowed misses an item's small documents must outnumber.
MARGIN = 4


def association_rules(
    transactions: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules ``lhs`` -> ``rhs`` over (doc_id, item): support, confidence, lift, count.

    Exact, without writing out the pairs of every document. A rule with confidence c may
    miss at most (1 - c) of the documents of ``lhs``, so ``rhs`` occurs often in any
    sufficiently large choice of them. Candidates are therefore looked for in the smallest
    documents of ``lhs`` only, where there are few pairs: at a low confidence, in all but the
    largest half of those that the rule needs. So no document with most of the items is taken apart into
    pairs, unless a rule may rest on it alone.

    Candidates are counted on bitmaps: documents are numbered by size, an item is one 64-bit integer
    for each 64 documents that it occurs in, and a pair is counted by the bits that both have,
    starting from the rarer item.
    """
    tx = stage(transactions.select("doc_id", "item").distinct())
    n_docs = tx.agg(F.count_distinct("doc_id")).scalar()
    min_count = F.ceil(F.lit(min_support) * n_docs - F.lit(1e-6))

    counts = tx.groupBy("item").agg(F.count("*").alias("n_item"))
    frequent = counts.where(F.col("n_item") >= min_count)
    rows = tx.join(frequent, "item")
    sizes = rows.groupBy("doc_id").agg(F.count("*").alias("size"))
    # Documents of one size are neighbours: those with many items fill few words with many bits.
    numbered = stage(sizes.orderBy("size").withColumn("number", F.monotonically_increasing_id()))
    cls = F.pmod(F.xxhash64("doc_id"), F.lit(CLASSES))
    numbered = numbered.withColumn("weight", F.col("size") * CLASSES + cls)
    rows = stage(rows.join(numbered, "doc_id").select("doc_id", "item", "n_item", "weight", "number"))

    # How many documents a rule needs at least, and may miss at most (never underestimated).
    needed = F.greatest(F.ceil(F.col("n_item") * min_confidence - F.lit(1e-6)), min_count)
    misses = F.col("n_item") - needed
    # Per item: the smallest weight under which there are enough documents. Only counts
    # per distinct weight are ordered, not documents.
    by_weight = rows.groupBy("item", "n_item", "weight").agg(F.count("*").alias("n_rows"))
    up = Window.partitionBy("item").orderBy("weight")
    enough = F.least(F.col("n_item") - F.floor(needed / 2), misses * MARGIN + 1)
    choice = (
        by_weight.withColumn("chosen", F.sum("n_rows").over(up))
        .where((F.col("chosen") >= enough) & (F.col("chosen") - F.col("n_rows") < enough))
        .select(
            F.col("item").alias("lhs"),
            F.col("weight").alias("limit"),
            F.col("n_item").alias("n_lhs"),
            (F.col("chosen") - misses).alias("in_chosen"),
            needed.alias("needed"),
        )
    )
    left = rows.select(F.col("item").alias("lhs"), "doc_id", "weight").join(choice, "lhs")
    right = rows.select(F.col("item").alias("rhs"), "doc_id", F.col("n_item").alias("n_rhs"))
    candidates = stage(
        left.where(F.col("weight") <= F.col("limit"))
        .join(right, "doc_id")
        .where((F.col("lhs") != F.col("rhs")) & (F.col("n_rhs") >= F.col("needed")))
        .groupBy("lhs", "rhs", "n_lhs", "n_rhs", "in_chosen")
        .agg(F.count("*").alias("n_seen"))
        .where(F.col("n_seen") >= F.col("in_chosen"))
        .select("lhs", "rhs", "n_lhs", "n_rhs")
    )
    rare, common = _pair("lhs", "rhs", "n_lhs", "n_rhs")
    pairs = candidates.withColumns({"rare": rare, "common": common}).join(
        _count_pairs(rows, candidates), ["rare", "common"]
    )
    both, all_docs = F.col("n_both"), n_docs
    rules = pairs.select(
        "lhs",
        "rhs",
        (both / all_docs).alias("support"),
        (both / F.col("n_lhs")).alias("confidence"),
        (both * all_docs / (F.col("n_lhs") * F.col("n_rhs"))).alias("lift"),
        both.alias("n_both"),
    )
    return rules.where(
        (F.col("support") >= min_support) & (F.col("confidence") >= min_confidence)
    )


def _pair(*columns: str) -> list[Column]:
    """Two items in one order, the rarer first, whichever of them a rule begins with."""
    lhs, rhs, n_lhs, n_rhs = map(F.col, columns)
    swapped = (n_lhs > n_rhs) | ((n_lhs == n_rhs) & (lhs > rhs))
    return [F.when(swapped, rhs).otherwise(lhs), F.when(swapped, lhs).otherwise(rhs)]


def _count_pairs(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(rare, common, n_both): documents that have both items of a candidate."""
    words = stage(as_words(rows.select("item", "number"), "item"))
    rare, common = _pair("lhs", "rhs", "n_lhs", "n_rhs")
    asked = candidates.select(rare.alias("rare"), common.alias("common")).distinct()
    first = words.select(F.col("item").alias("rare"), "word", F.col("bits").alias("own"))
    second = words.select(F.col("item").alias("common"), "word", "bits")
    shared = F.bit_count(F.col("own").bitwiseAND(F.col("bits")))
    return asked.join(first, "rare").join(second, ["common", "word"]).groupBy("rare", "common").agg(
        F.sum(shared).cast("long").alias("n_both")
    )


def strong_rules(rules: DataFrame, min_support: float = 0.01) -> DataFrame:
    return rules.where(F.col("support") >= min_support)
