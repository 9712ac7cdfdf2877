"""Whole jobs. Tables used more than once are written, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.fixed_values import KINDS, MIN_CONFIDENCE, MIN_SUPPORT, SCORE_CUT, TOP_N
from annolink.operators import (
    clean,
    combine,
    evaluate,
    label,
    postings,
    publications,
    rules,
    search,
    stats,
)
from annolink.operators.factorised import expand
from annolink.sources.writers import REFUSE, write_corpus, write_index, write_lookup
from annolink.staging import stage
from annolink.unions import append


def filtered_mentions(
    raw: DataFrame,
    dictionary: DataFrame,
    taxonomy: DataFrame,
    cut: int = SCORE_CUT,
    keep_multiplicity: bool = False,
) -> DataFrame:
    """Raw mentions with clean ids, at or above the score cut, species on the whitelist."""
    mentions = clean.cut_below(clean.parse_mentions(raw), cut)
    return label.apply_whitelist(mentions, dictionary, taxonomy, keep_multiplicity)


def build_corpus(
    raw: DataFrame,
    dictionary: DataFrame,
    taxonomy: DataFrame,
    labels: DataFrame,
    dims: dict[str, DataFrame],
    path: str | None = None,
    mode: str = REFUSE,
    cut: int = SCORE_CUT,
    how: str = "inner",
) -> dict[str, DataFrame]:
    """Tables ``facts``, ``document_ids`` and ``publications`` (with entity lists).

    Publications cover the documents seen before labelling, the id list those after it.
    """
    mentions = stage(filtered_mentions(raw, dictionary, taxonomy, cut))
    facts = stage(label.label(mentions, label.held_labels(label.readable_labels(labels))))
    pubs = publications.publications(publications.document_ids(mentions), dims, how)
    tables = {
        "facts": facts,
        "document_ids": publications.document_ids(facts),
        "publications": publications.with_entity_lists(pubs, facts),
    }
    if path is not None:
        write_corpus(tables, path, mode)
    return tables


def build_wide_tables(
    raw: DataFrame,
    dictionary: DataFrame,
    taxonomy: DataFrame,
    labels: DataFrame,
    dims: dict[str, DataFrame] | None = None,
    cut: int = SCORE_CUT,
    search_columns: bool = False,
    how: str = "inner",
) -> dict[str, DataFrame]:
    """Tables of the denormalised form: ``cells``, ``wide`` and, with ``dims``, ``publications``.

    ``cells`` holds the rows of a document as the lists they are made of, ``wide`` writes them out:
    one row per document and combination of its entities. Publications cover the documents
    seen before labelling.
    """
    mentions = stage(filtered_mentions(raw, dictionary, taxonomy, cut))
    cells = combine.factorised_labels(mentions, label.readable_labels(labels))
    cells = stage(combine.with_search_fields(cells) if search_columns else cells)
    wide = combine.wide_with_search(cells) if search_columns else combine.spread(expand(cells, list(KINDS)), combine.LABELLED)
    tables = {"cells": cells, "wide": wide}
    if dims is not None:
        tables["publications"] = publications.publications(publications.document_ids(mentions), dims, how)
    return tables


def build_wide(
    raw: DataFrame,
    dictionary: DataFrame,
    taxonomy: DataFrame,
    labels: DataFrame,
    cut: int = SCORE_CUT,
    search_columns: bool = False,
) -> DataFrame:
    """The denormalised table alone."""
    return build_wide_tables(raw, dictionary, taxonomy, labels, None, cut, search_columns)["wide"]


def load_lookup(
    labelled: DataFrame, path: str, mode: str = REFUSE, strict_prefix: bool = False
) -> None:
    """Labelled mentions to the lookup table on disk."""
    rows = stage(labelled)
    # Not written again: the values are made where the facts are made distinct, a task's share at a time.
    write_lookup(search.lookup_table(clean.loadable(rows), strict_prefix, rows.count()), path, mode)


def load_index(facts: DataFrame, pubs: DataFrame, path: str, mode: str = REFUSE) -> None:
    """Facts and publications to the index that document queries are answered from."""
    write_index(postings.index_tables(facts, pubs), path, mode)


def release_stats(facts: DataFrame, strict_ids: bool = False) -> DataFrame:
    """Figures of a release: those of the corpus, then documents and entities of each kind."""
    own = stats.distinct_counts(facts)
    rows = F.explode(
        F.array(
            F.struct(F.concat(F.lit("documents with "), "kind").alias("figure"), F.col("n_documents").alias("value")),
            F.struct(F.concat(F.lit("entities of "), "kind").alias("figure"), F.col("n_entities").alias("value")),
        )
    )
    return append(stats.corpus_stats(facts, strict_ids), own.select(rows.alias("row")).select("row.*"))


def mine_rules(
    facts: DataFrame,
    accepted_genes: DataFrame,
    n: int = TOP_N,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    strong_support: float | None = None,
) -> DataFrame:
    """Rules between the top entities: genes of one taxon and the three ontologies."""
    tx = search.transactions(facts, n=n, accepted={"genes": accepted_genes})
    found = rules.association_rules(tx, min_support, min_confidence)
    return found if strong_support is None else rules.strong_rules(found, strong_support)


def evaluate_service(
    published: DataFrame,
    until: str,
    open_access: DataFrame,
    facts: DataFrame,
    requests: DataFrame,
) -> DataFrame:
    """Metrics per query: documents found for an entity against a gold set.

    ``published`` (query_key, doc_id, date) is the gold set before it is bounded by date
    and by the open-access list; ``requests`` (query_key, kind, entity_id) are looked up
    in ``facts`` as one join. Requests may instead hold (gene, species) and no ids: then
    they are recoded to gene ids first, and the rows carry the terms that each service is asked by.
    """
    terms = None
    if "entity_id" not in requests.columns:
        terms = evaluate.with_query_terms(requests)
        requests = terms.select("query_key", F.lit("genes").alias("kind"), F.col("gene_id").alias("entity_id"))
    gold = clean.published_until(published, until).join(open_access, "doc_id", "left_semi")
    found = search.lookup_batch(facts, requests)
    counts = evaluate.confusion(gold.select("query_key", "doc_id"), found, ["query_key"])
    metrics = evaluate.evaluation_metrics(counts)
    return metrics if terms is None else metrics.join(terms.drop("gene_id"), "query_key")


def compare_services(
    a: DataFrame, b: DataFrame, min_year: int, max_year: int | None = None
) -> dict[str, DataFrame]:
    """Overlap by doi, documents per year, and totals of two results with (doi, year)."""
    totals = {"in_a": a, "in_b": b}
    return {
        "overlap": stats.overlap(a, b, "doi"),
        "years": stats.year_histogram(a, b, max_year, min_year),
        "totals": stats.totals(totals),
    }
