"""Mentions as they come from files to mentions that can be joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolink.fixed_values import DOCUMENT_PREFIX, FIRST_PUBLICATION_DATE, KINDS, SCORE_CUT
from annolink.functions.scalar import (
    default_score,
    lenient_int,
    multiword,
    normalise_doc_id,
    search_copy,
    with_id_prefix,
)
from annolink.operators.skew import distinct_rows, tasks_for


def parse_mentions(raw: DataFrame) -> DataFrame:
    """(kind, doc_raw, entity_id, score text) to (kind, doc_id, entity_id, score)."""
    return raw.select(
        "kind",
        normalise_doc_id(F.col("doc_raw")).alias("doc_id"),
        "entity_id",
        lenient_int(F.col("score")).alias("score"),
    )


def cut_below(mentions: DataFrame, cut: int = SCORE_CUT) -> DataFrame:
    return mentions.where(F.col("score") >= cut)


def multiword_only(df: DataFrame, name: str = "name") -> DataFrame:
    return df.where(multiword(F.col(name)))


def loadable(labelled: DataFrame) -> DataFrame:
    """Labelled mentions as they enter the lookup: prefixed ids, no blank score, distinct.

    The mentions are counted first, so they should be a written table.
    """
    rows = valid_rows(
        labelled.withColumn("doc_id", with_id_prefix(F.col("doc_id"))).withColumn(
            "score", default_score(F.col("score").cast("string")).cast("int")
        )
    )
    return distinct_rows(rows, tasks_for(labelled.sparkSession, labelled.count()))


def valid_rows(df: DataFrame, prefix: str = DOCUMENT_PREFIX) -> DataFrame:
    """Rows with a well-formed document id and something besides it."""
    named = F.coalesce(F.nullif("name", F.lit("")), F.nullif("entity_id", F.lit("")))
    return df.where(F.col("doc_id").rlike(f"^{prefix}[0-9]+$") & named.isNotNull())


def by_entity(df: DataFrame, entity_id: str) -> DataFrame:
    return df.where(F.col("entity_id") == entity_id)


def for_taxon(gene_taxon: DataFrame, taxon: str) -> DataFrame:
    """Distinct gene ids of one taxon."""
    return gene_taxon.where(F.col("taxon") == taxon).select("entity_id").distinct()


def published_until(
    df: DataFrame, until: str, date: str | Column = "date", since: str = FIRST_PUBLICATION_DATE
) -> DataFrame:
    day = (F.col(date) if isinstance(date, str) else date).cast("date")
    return df.where(day.between(F.lit(since).cast("date"), F.lit(until).cast("date")))


def with_search_columns(wide: DataFrame) -> DataFrame:
    """Lower-case copies of the five name columns, for search."""
    return wide.withColumns(
        {f"{s}_search": search_copy(F.col(f"{s}_name")) for s in KINDS.values()}
    )


def recode(
    df: DataFrame, mapping: DataFrame, on: list[str], column: str, value: str = "value"
) -> DataFrame:
    """Replace ``column`` by the mapped value where the keys ``on`` are in the mapping."""
    rename = mapping.select(*on, F.col(value).alias("_mapped"))
    return (
        df.join(rename, on, "left")
        .withColumn(column, F.coalesce("_mapped", column))
        .drop("_mapped")
        .select(*df.columns)
    )


def expand_synonyms(df: DataFrame, column: str, name: str = "synonym") -> DataFrame:
    """One row per alternative of a ``;`` list."""
    return df.withColumn(name, F.explode(F.split(column, ";"))).drop(column)


def extract_ids(
    df: DataFrame, text: str, pattern: str, group: int = 1, prefix: str = ""
) -> DataFrame:
    """Distinct ids that the pattern finds in a text column."""
    found = df.select(
        F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("found")
    )
    return found.select(F.concat(F.lit(prefix), F.col("found")).alias("doc_id")).distinct()
