"""All combinations of the entries that a document has in several lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.fixed_values import KINDS
from annolink.operators.clean import search_copy
from annolink.operators.factorised import expand, factorise, with_entry_field
from annolink.operators.skew import HOT_ROWS

LABELLED = (("name", "name"), ("entity_id", "id"), ("score", "score"))


def spread(wide: DataFrame, fields: Sequence[tuple[str, str]], kinds: Sequence[str] = tuple(KINDS)) -> DataFrame:
    """The fields of each kind's entry as columns named after the kind."""
    return wide.select(
        "doc_id",
        *[F.col(kind)[field].alias(f"{KINDS[kind]}_{label}") for kind in kinds for field, label in fields],
    )


def combine_kinds(mentions: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Eleven columns: document, then id and score of each of the five kinds."""
    return spread(expand(factorised_kinds(mentions, hot_rows), list(KINDS)), [("entity_id", "id"), ("score", "score")])


def factorised_kinds(mentions: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``combine_kinds`` before it is written out: cells of lists of (entity_id, score)."""
    rows = mentions.select("kind", "doc_id", "entity_id", "score", F.lit(True).alias("alive"))
    return factorise(rows, list(KINDS), ["entity_id", "score"], hot_rows)


def label_wide(mentions: DataFrame, labels: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Sixteen columns: document, then name, id and score of each of the five kinds.

    Same rows as labelling the combined table and dropping every row with an unlabelled
    id, but the labels are joined before the rows multiply.
    """
    return spread(expand(factorised_labels(mentions, labels, hot_rows), list(KINDS)), LABELLED)


def factorised_labels(mentions: DataFrame, labels: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``label_wide`` before it is written out: cells of lists of (name, entity_id, score)."""
    named = mentions.join(labels, ["entity_id", "kind"], "left")
    alive = F.col("entity_id").isNull() | F.col("name").isNotNull()
    rows = named.select("kind", "doc_id", "name", "entity_id", "score", alive.alias("alive"))
    return factorise(rows, list(KINDS), ["name", "entity_id", "score"], hot_rows)


def with_search_fields(cells: DataFrame) -> DataFrame:
    """Search copies of all names of factorised rows."""
    return with_entry_field(cells, list(KINDS), "search", lambda e: search_copy(e["name"]))


def wide_with_search(cells: DataFrame) -> DataFrame:
    """Twenty-one columns from cells with search copies; a missing kind has a blank copy."""
    wide = spread(expand(cells, list(KINDS)), LABELLED + (("search", "search"),))
    return wide.withColumns({f"{s}_search": F.coalesce(f"{s}_search", F.lit("")) for s in KINDS.values()})
