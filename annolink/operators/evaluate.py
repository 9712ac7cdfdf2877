"""Precision and recall of found documents against a gold set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolink.fixed_values import GENE_IDS, LATIN_NAMES, SYMBOL_OVERRIDES
from annolink.operators.clean import recode
from annolink.operators.stats import _sides


def confusion(gold: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Per query: size of gold and found, true and false positives, false negatives.

    ``gold`` and ``found`` hold (*keys, doc_id).
    """
    sides = _sides({"gold": gold, "found": found}, [*keys, "doc_id"])
    return (
        sides.groupBy(*keys)
        .agg(
            F.sum("gold").alias("gold"),
            F.sum("found").alias("found"),
            F.sum(F.col("gold") * F.col("found")).alias("tp"),
        )
        .withColumns({"fp": F.col("found") - F.col("tp"), "fn": F.col("gold") - F.col("tp")})
    )


def false_negatives(gold: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return gold.join(found, [*keys, "doc_id"], "left_anti").distinct()


def _share(part: str, *whole: str) -> Column:
    # Thousandths, cut off after the third decimal; 0 when there is nothing to divide by.
    total = " + ".join(whole)
    return F.expr(f"case when {total} = 0 then 0L else {part} * 1000 div ({total}) end")


def evaluation_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, true positive and false discovery rate in thousandths.

    Every step is cut off after the third decimal, not rounded.
    """
    empty = (F.col("found") == 0) | (F.col("gold") == 0)
    none = F.lit(0).cast("long")
    both = F.expr("2 * precision * recall div 1000 * 1000 div (precision + recall)")
    return (
        counts.withColumn("precision", F.when(empty, none).otherwise(_share("tp", "found")))
        .withColumn("recall", F.when(empty, none).otherwise(_share("tp", "gold")))
        .withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, none).otherwise(both))
        .withColumn("tpr", _share("tp", "tp", "fn"))
        .withColumn("fdr", _share("fp", "tp", "fp"))
    )


METRICS = ("precision", "recall", "f1", "tpr", "fdr")


def as_decimals(metrics: DataFrame) -> DataFrame:
    """Thousandths as decimals with three places."""
    return metrics.withColumns(
        {m: (F.col(m).cast("decimal(9,0)") / 1000).cast("decimal(6,3)") for m in METRICS}
    )


def queried_symbols(evaluation: DataFrame) -> DataFrame:
    """Gene symbols as they were queried in each species, in lower case."""
    spark = evaluation.sparkSession
    mapping = spark.createDataFrame(list(SYMBOL_OVERRIDES), "gene string, species string, value string")
    # The mapping is keyed by the old symbol; keep it apart from the column it replaces.
    renamed = evaluation.withColumn("symbol", F.col("gene"))
    recoded = recode(renamed, mapping, ["gene", "species"], "symbol")
    return recoded.withColumn("gene", F.lower("symbol")).drop("symbol")


def with_query_terms(evaluation: DataFrame) -> DataFrame:
    """Add how each service is asked: symbol, gene id, and the species' database and filter names."""
    spark = evaluation.sparkSession
    names = spark.createDataFrame(list(LATIN_NAMES), "_species string, latin_name string, filter_name string")
    ids = spark.createDataFrame(list(GENE_IDS), "_gene string, _species string, gene_id string")
    overrides = spark.createDataFrame(list(SYMBOL_OVERRIDES), "gene string, species string, value string")
    rows = recode(evaluation.withColumn("symbol", F.col("gene")), overrides, ["gene", "species"], "symbol")
    rows = rows.withColumn("symbol", F.lower("symbol"))
    # The mapping tables are the few fixed rows above.
    rows = rows.join(F.broadcast(names), F.col("species") == F.col("_species"), "left").drop("_species")
    same = (F.col("gene") == F.col("_gene")) & (F.col("species") == F.col("_species"))
    return rows.join(F.broadcast(ids), same, "left").drop("_gene", "_species")
