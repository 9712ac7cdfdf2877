"""Readable names for entity ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.functions.scalar import multiword
from annolink.operators.clean import multiword_only
from annolink.operators.skew import held_side
from annolink.unions import append


def label(mentions: DataFrame, labels: DataFrame) -> DataFrame:
    """Mentions with their name; ids without a label (obsolete terms) vanish.

    A popular entity skews this join: it is an inner join between two shuffles, which
    adaptive execution splits, and a small dictionary is broadcast by its own size. Tasks that
    hold no mentions take ``held_labels``.
    """
    return mentions.join(labels, ["entity_id", "kind"]).select(
        "kind", "doc_id", "name", "entity_id", "score"
    )


def held_labels(labels: DataFrame) -> DataFrame:
    """Labels to ``label`` with: they are held, and the mentions of a popular entity only pass."""
    return held_side(labels, ["entity_id", "kind"])


def readable_labels(labels: DataFrame) -> DataFrame:
    """Labels without one-word species names."""
    return labels.where((F.col("kind") != "species") | multiword(F.col("name")))


def species_whitelist(dictionary: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Distinct (name, taxon_id) of the dictionary names that name a species, not a genus."""
    return (
        multiword_only(taxonomy)
        .join(dictionary.select("name"), "name", "left_semi")
        .select("name", "taxon_id")
        .distinct()
    )


def whitelist_species(
    mentions: DataFrame,
    dictionary: DataFrame,
    taxonomy: DataFrame,
    keep_multiplicity: bool = False,
) -> DataFrame:
    """Species mentions of a listed taxon.

    ``keep_multiplicity`` repeats a mention once per listed name of its taxon.
    """
    listed = species_whitelist(dictionary, taxonomy).select(F.col("taxon_id").alias("entity_id"))
    species = mentions.where(F.col("kind") == "species")
    how = "inner" if keep_multiplicity else "left_semi"
    return species.join(listed, "entity_id", how).select(*mentions.columns)


def apply_whitelist(
    mentions: DataFrame,
    dictionary: DataFrame,
    taxonomy: DataFrame,
    keep_multiplicity: bool = False,
) -> DataFrame:
    """All mentions, with the species mentions restricted to the whitelist."""
    species = whitelist_species(mentions, dictionary, taxonomy, keep_multiplicity)
    return append(mentions.where(F.col("kind") != "species"), species)
