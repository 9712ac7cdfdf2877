"""Entry points of the driver: flagship query, all queries, and their SQL counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import standins as s
from annolink.fixed_values import KINDS
from annolink.functions import scalar
from annolink.functions.lists import encode_list
from annolink.operators import (
    batches,
    clean,
    combine,
    evaluate,
    factorised,
    label,
    postings,
    publications,
    rules,
    search,
    sets,
    stats,
    tagging,
)
from annolink.operators.skew import tasks_for
from annolink.plans import jobs
from annolink.sources import readers, writers
from annolink.staging import new_folder, stage
from oracle import ORACLE

# The operators for training data are a subpackage of their own, which may be absent.
try:
    import annolink.llm.queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("annolink.llm", "annolink.llm.queries", "corpus_pipeline"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def entry(spark: SparkSession) -> DataFrame:
    return publication_table(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {**_QUERIES, **(llm.QUERIES if llm else {})}


def oracle_sql() -> dict[str, str]:
    own = {name: ORACLE[name] for name in _QUERIES if name in ORACLE}
    return {**own, **(llm.ORACLE if llm else {})}


# Projections and scalar functions


@_query
def normalise_doc_id(spark, sf):
    return s.mentions_raw(spark, sf).select(
        "doc_raw", scalar.normalise_doc_id(F.col("doc_raw")).alias("doc_id")
    )


@_query
def lenient_int(spark, sf):
    text = F.concat(F.lit(" "), F.col("score"), F.lit(".9x"))
    return s.mentions_raw(spark, sf).select(
        "doc_raw",
        scalar.lenient_int(F.col("score")).alias("score"),
        scalar.lenient_int(text).alias("score_with_rest"),
    )


@_query
def default_score(spark, sf):
    return s.mentions_raw(spark, sf).select(
        "doc_raw", scalar.default_score(F.col("score")).alias("score")
    )


@_query
def with_id_prefix(spark, sf):
    return publications.document_ids(s.mentions(spark, sf)).select(
        scalar.with_id_prefix(F.col("doc_id")).alias("doc_id")
    )


@_query
def score_band(spark, sf):
    rows = s.labelled(spark, sf).select(scalar.score_band(F.col("score")).alias("band"))
    return rows.groupBy("band").agg(F.count("*").alias("n"))


@_query
def link_out(spark, sf):
    return s.entity_labels(spark, sf).select(
        "kind", "entity_id", scalar.link_out(F.col("kind"), F.col("entity_id")).alias("link")
    )


@_query
def document_links(spark, sf):
    d = s.dims(spark, sf)
    docs = d["doi"].join(d["pmid"], "doc_id", "left")
    # Documents without a pmid stand for those that have no document id to link by.
    known = F.when(F.col("pmid").isNotNull(), F.col("doc_id"))
    return docs.select("doc_id", scalar.document_link(known, F.col("doi")).alias("link"))


@_query
def year_of(spark, sf):
    day = F.col("o_orderdate").cast("date").cast("string")
    return s.table(spark, sf, "orders").select("o_orderkey", scalar.year_of(day).alias("year"))


@_query
def recode(spark, sf):
    """Part names of given brands and types are overridden; others stay."""
    parts = s.table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    mapping = (
        parts.groupBy("p_brand", "p_type")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= 5)
        .select("p_brand", "p_type", F.concat_ws("-", "p_brand", "p_type").alias("value"))
    )
    return clean.recode(parts, mapping, ["p_brand", "p_type"], "p_name")


@_query
def expand_synonyms(spark, sf):
    return clean.expand_synonyms(s.synonyms(spark, sf), "synonym_list")


@_query
def extract_ids(spark, sf):
    return clean.extract_ids(s.table(spark, sf, "pages"), "html", r"track\(([0-9]+)\)", 1, "PMC")


# Filters


@_query
def cut_below(spark, sf):
    return s.kept(spark, sf)


@_query
def multiword_names(spark, sf):
    return clean.multiword_only(s.taxonomy(spark, sf))


@_query
def valid_rows(spark, sf):
    """Ids that were never normalised are not valid."""
    raw = s.mentions_raw(spark, sf)
    clean_rows = raw.withColumn("doc_raw", scalar.normalise_doc_id(F.col("doc_raw")))
    rows = raw.unionByName(clean_rows).select(
        "kind",
        scalar.with_id_prefix(F.col("doc_raw")).alias("doc_id"),
        F.lit("").alias("name"),
        "entity_id",
        "score",
    )
    return clean.valid_rows(rows)


@_query
def by_entity(spark, sf):
    return clean.by_entity(s.labelled(spark, sf), "DOID:12")


@_query
def for_taxon(spark, sf):
    return clean.for_taxon(readers.split_gene_taxon(s.gene_taxon(spark, sf)), "2")


@_query
def published_until(spark, sf):
    orders = s.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("date"))
    return clean.published_until(orders, "2000-08-15").select("o_orderkey")


# Joins


@_query
def label_mentions(spark, sf):
    return s.labelled(spark, sf)


@_query
def species_whitelist(spark, sf):
    return label.whitelist_species(
        s.kept(spark, sf), s.species_dictionary(spark, sf), s.taxonomy(spark, sf)
    )


@_query
def species_whitelist_multiplicity(spark, sf):
    return label.whitelist_species(
        s.kept(spark, sf), s.species_dictionary(spark, sf), s.taxonomy(spark, sf), True
    )


@_query
def combine_kinds(spark, sf):
    return combine.combine_kinds(s.kept(spark, sf))


@_query
def label_wide(spark, sf):
    return combine.label_wide(s.kept(spark, sf), s.entity_labels(spark, sf))


@_query
def search_columns(spark, sf):
    wide = combine.label_wide(s.kept(spark, sf), s.entity_labels(spark, sf))
    return clean.with_search_columns(wide)


@_query
def combination_counts(spark, sf):
    """Rows of the combined table per document, none of them written out."""
    return factorised.combination_counts(combine.factorised_kinds(s.kept(spark, sf)))


@_query
def combinations_of_entries(spark, sf):
    """In how many rows of the labelled wide table each entity takes part."""
    cells = combine.factorised_labels(s.kept(spark, sf), s.entity_labels(spark, sf))
    return factorised.entry_counts(cells, list(KINDS), "entity_id")


@_query
def wide_rows_found(spark, sf):
    """Rows of the wide table by search copies: filtered as lists, then written out."""
    cells = combine.factorised_labels(s.kept(spark, sf), s.entity_labels(spark, sf))
    cells = combine.with_search_fields(cells)
    cells = factorised.keep_entries(cells, list(KINDS), "terms_do", lambda e: e["search"].startswith("promo"))
    cells = factorised.keep_entries(cells, list(KINDS), "terms_go", lambda e: e["score"] >= 25)
    return combine.wide_with_search(cells)


@_query
def publication_attributes(spark, sf):
    return publications.publications(s.kept(spark, sf).select("doc_id"), s.dims(spark, sf))


@_query
def publication_attributes_left(spark, sf):
    return publications.publications(s.kept(spark, sf).select("doc_id"), s.dims(spark, sf), "left")


@_query
def overlap(spark, sf):
    return stats.overlap(*s.results(spark, sf), "doi")


# Aggregations


@_query
def entity_frequency(spark, sf):
    return stats.entity_frequency(s.labelled(spark, sf))


@_query
def entity_lists(spark, sf):
    lists = publications.entity_lists(stage(s.labelled(spark, sf)))
    return publications.encode_lists(lists)


@_query
def ranked_entries(spark, sf):
    """The lists as one row per entry, with its rank."""
    return publications.ranked_entries(s.labelled(spark, sf))


@_query
def entity_list_parts(spark, sf):
    """The lists in parts of one entry per kind: the second part and the following ones."""
    entries = publications.ranked_entries(s.labelled(spark, sf))
    return publications.encode_lists(publications.list_parts(entries, first=1, part_entries=1))


@_query
def publication_table(spark, sf):
    """The central product: documents, their attributes and their five ranked lists."""
    mentions = stage(s.kept(spark, sf))
    facts_table = stage(label.label(mentions, label.held_labels(s.entity_labels(spark, sf))))
    pubs = publications.publications(mentions.select("doc_id"), s.dims(spark, sf))
    return publications.encode_lists(publications.with_entity_lists(pubs, facts_table))


@_query
def decode_lists(spark, sf):
    lists = publications.entity_lists(stage(s.labelled(spark, sf)))
    chosen = [("genes", "small ring"), ("terms_do", "DOID:12")]
    return publications.decode_lists(publications.encode_lists(lists), chosen)


@_query
def distinct_counts(spark, sf):
    return stats.distinct_counts(s.labelled(spark, sf))


@_query
def approximate_counts(spark, sf):
    """Whether the sketches are within a tenth of the exact counts."""
    labelled = stage(s.labelled(spark, sf))
    exact = stats.distinct_counts(labelled)
    sketch = stats.approximate_counts(labelled).toDF("kind", "s_documents", "s_entities")

    def close(a, b):
        return F.abs(F.col(a) - F.col(b)) <= 0.1 * F.col(b)

    return exact.join(sketch, "kind").select(
        "kind",
        close("s_documents", "n_documents").alias("documents_close"),
        close("s_entities", "n_entities").alias("entities_close"),
    )


@_query
def release_stats(spark, sf):
    return jobs.release_stats(stage(s.labelled(spark, sf)))


def _batches(spark, sf) -> DataFrame:
    """Facts in batches of the documents' last digit."""
    return s.facts(spark, sf).withColumn("batch", F.concat(F.lit("b"), F.substr("doc_id", F.lit(-1))))


@_query
def batches_replaced(spark, sf):
    """All batches written, then two of them again: one with fewer kinds, one without any facts."""
    path = new_folder(spark, "batches")
    rows = stage(_batches(spark, sf))
    writers.write_batches(rows, path)
    again = rows.where((F.col("batch") == "b1") & (F.col("kind") != "genes"))
    writers.write_batches(again, path, ["b1", "b2"])
    return readers.read_batches(spark, path)


@_query
def batch_list(spark, sf):
    path = new_folder(spark, "batches")
    rows = stage(_batches(spark, sf))
    writers.write_batches(rows, path)
    writers.write_batches(rows.where(F.col("batch") == "b1"), path, ["b2"])
    return readers.read_batch_list(spark, path)


@_query
def sketched_stats(spark, sf):
    """Whether the figures united from the batches' sketches are within 4 % of the exact ones."""
    rows = stage(_batches(spark, sf))
    sketches = stage(stats.batch_sketches(rows))
    exact = stats.corpus_stats(rows).withColumnRenamed("value", "exact")
    close = F.abs(F.col("value") - F.col("exact")) <= 0.04 * F.col("exact")
    return stats.sketched_stats(sketches).join(exact, "figure").select("figure", close.alias("close"))


@_query
def publication_table_colocated(spark, sf):
    """The central product from tables bucketed by document: nothing is shuffled once they are written."""
    mentions = stage(s.kept(spark, sf))
    tables = {"facts": label.label(mentions, label.held_labels(s.entity_labels(spark, sf))), "docs": publications.document_ids(mentions)}
    dims = s.dims(spark, sf)
    prefix = f"colocated_{uuid.uuid4().hex}"
    held = writers.write_colocated({**tables, **dims}, prefix, tasks_for(spark, mentions.count()))
    pubs = publications.colocated_publications(held["docs"], {n: held[n] for n in dims}, held["facts"])
    return publications.encode_lists(pubs)


@_query
def evaluation_terms(spark, sf):
    """How the services are asked for genes and species, which the suppliers stand for."""
    rows = s.gene_requests(spark, sf).withColumnRenamed("query_key", "s_suppkey")
    return evaluate.with_query_terms(rows)


@_query
def refuse_then_replace(spark, sf):
    """Output that exists is refused, then replaced on demand: the second table is read."""
    path = new_folder(spark, "replaced")
    labelled = s.labelled(spark, sf)
    writers.write_corpus({"facts": labelled.where(F.col("kind") == "genes")}, path)
    species = {"facts": labelled.where(F.col("kind") == "species")}
    try:
        writers.write_corpus(species, path)
    except AnalysisException:
        writers.write_corpus(species, path, "overwrite")
    else:
        raise AssertionError("existing output was not refused")
    return readers.read_facts(spark, path)


@_query
def corpus_stats(spark, sf):
    return stats.corpus_stats(s.labelled(spark, sf))


@_query
def corpus_stats_strict(spark, sf):
    return stats.corpus_stats(s.labelled(spark, sf), strict_ids=True)


@_query
def cut_value(spark, sf):
    lines = s.table(spark, sf, "lineitem")
    values = [
        stats.cut_value(lines, "l_quantity", n, m).select(
            F.lit(f"{n}/{m}").alias("share"), "cut_value"
        )
        for n, m in ((1, 4), (1, 2), (3, 4))
    ]
    return values[0].unionByName(values[1]).unionByName(values[2])


@_query
def year_histogram(spark, sf):
    return stats.year_histogram(*s.results(spark, sf), max_year=2003, min_year=1993)


@_query
def confusion(spark, sf):
    return evaluate.confusion(s.gold(spark, sf), s.found(spark, sf), ["query_key"])


@_query
def evaluation_metrics(spark, sf):
    counts = evaluate.confusion(s.gold(spark, sf), s.found(spark, sf), ["query_key"])
    return evaluate.evaluation_metrics(counts)


@_query
def association_rules(spark, sf):
    """Rules between the hundred most frequent words of the documents."""
    items = stage(s.word_items(spark, sf))
    top = items.groupBy("item").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("item"))
    tx = items.join(F.broadcast(top.limit(100)), "item", "left_semi")
    return rules.association_rules(tx)


# Top-k and paging


@_query
def top_entities(spark, sf):
    return stats.top_entities(s.labelled(spark, sf), "genes", 100)


@_query
def top_entities_taxon(spark, sf):
    genes = clean.for_taxon(readers.split_gene_taxon(s.gene_taxon(spark, sf)), "2")
    return stats.top_entities(s.labelled(spark, sf), "genes", 100, genes)


# Set operations


@_query
def union_batches(spark, sf):
    """Facts and whitelisted species appended: two batches of one kind."""
    rows = s.kept(spark, sf)
    listed = label.whitelist_species(rows, s.species_dictionary(spark, sf), s.taxonomy(spark, sf))
    return rows.unionByName(listed)


@_query
def facts(spark, sf):
    return s.facts(spark, sf)


@_query
def document_ids(spark, sf):
    return publications.document_ids(s.kept(spark, sf))


@_query
def document_ids_labelled(spark, sf):
    return publications.document_ids(s.labelled(spark, sf))


@_query
def intersect_ids(spark, sf):
    return sets.intersect_ids(s.gold(spark, sf), s.found(spark, sf))


@_query
def except_ids(spark, sf):
    return sets.except_ids(s.gold(spark, sf), s.found(spark, sf))


@_query
def false_negatives(spark, sf):
    return evaluate.false_negatives(s.gold(spark, sf), s.found(spark, sf), ["query_key"])


@_query
def restrict_to(spark, sf):
    open_access = s.table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    return sets.restrict_to(s.gold(spark, sf), open_access.select(F.col("o_orderkey").alias("doc_id")))


# Query operators


@_query
def prefix_lookup(spark, sf):
    lookup = search.lookup_table(s.facts(spark, sf), n_facts=s.n_mentions(spark, sf))
    rows = search.starts_with(lookup, "gene_name", "SM")
    return rows.select("value", "doc_id", "entity_id", "score")


@_query
def suggest(spark, sf):
    lookup = search.lookup_table(s.facts(spark, sf), n_facts=s.n_mentions(spark, sf))
    return search.suggest(lookup, " sm").select("attr", "value")


@_query
def suggest_batch(spark, sf):
    lookup = search.lookup_table(s.facts(spark, sf), n_facts=s.n_mentions(spark, sf))
    rows = search.suggest_batch(lookup, s.query_texts(spark, sf))
    return rows.select("text", "attr", "value")


def _found(spark, sf, clauses, **options):
    # Only rows of the kinds that the clauses name are written and searched.
    kinds = [search.COLUMNS[column][0] for column in clauses]
    facts_table = stage(s.facts(spark, sf).where(F.col("kind").isin(kinds)))
    docs = search.matching_documents(facts_table, clauses)
    pubs = publications.publications(docs, s.prefixed_dims(spark, sf))
    return search.find_documents(facts_table, pubs, clauses, **options)


@_query
def find_documents(spark, sf):
    return _found(spark, sf, {"gene_name": ["small ring"], "do_name": ["PROMO"]})


@_query
def find_documents_page(spark, sf):
    """Second page, ordered by the best disease score."""
    clauses = {"go_name": ["small ring"], "do_name": ["PROMO"]}
    return _found(spark, sf, clauses, order_by_kind="terms_do", offset=25)


def _index(spark, sf):
    """An index of all facts and publications, written and read back."""
    path = new_folder(spark, "index")
    facts_table = stage(s.facts(spark, sf))
    pubs = publications.publications(facts_table.select("doc_id"), s.prefixed_dims(spark, sf))
    jobs.load_index(facts_table, pubs, path)
    return readers.read_index(spark, path)


@_query
def find_documents_indexed(spark, sf):
    """The first page from posting bitmaps, with the five lists of its documents."""
    clauses = {"go_name": ["small ring"], "do_name": ["PROMO"]}
    page = postings.find_page(_index(spark, sf), clauses, order_by_kind="terms_do", not_empty="doi")
    return postings.encode_page(page)


@_query
def find_documents_seek(spark, sf):
    """The second page, which begins after the last row of the first."""
    index = _index(spark, sf)
    clauses = {"go_name": ["small ring"], "do_name": ["PROMO"]}
    first = postings.find_page(index, clauses, order_by_kind="terms_do").select("best_score", "doc_id").collect()
    # Nothing comes after a page without rows.
    behind = {"after": tuple(first[-1])} if first else {"offset": 25}
    return postings.encode_page(postings.find_page(index, clauses, order_by_kind="terms_do", **behind))


@_query
def index_postings(spark, sf):
    """Numbers of documents per searchable value, from the bitmaps."""
    words = _index(spark, sf).postings
    return words.groupBy("attr", "value").agg(F.sum(F.bit_count("bits")).cast("long").alias("n"))


@_query
def documents_of(spark, sf):
    rows = search.documents_of(s.facts(spark, sf), ["12", "675"], "genes")
    return rows.select("doc_id", encode_list(F.col("entities")).alias("entities"))


@_query
def lookup_batch(spark, sf):
    return search.lookup_batch(s.facts(spark, sf), s.entity_requests(spark, sf))


@_query
def transactions(spark, sf):
    genes = clean.for_taxon(readers.split_gene_taxon(s.gene_taxon(spark, sf)), "2")
    return search.transactions(stage(s.labelled(spark, sf)), accepted={"genes": genes})


# Re-aimed as Spark jobs


@_query
def tag_documents(spark, sf):
    return tagging.tag_documents(s.documents(spark, sf), s.word_dictionary(spark, sf))


@_query
def assign_batches(spark, sf):
    docs = s.table(spark, sf, "documents").select("source", "doc_id")
    return batches.assign_batches(docs, ["source", "doc_id"], 200)


# Sources and sinks: written in the input format, then read


@_query
def mentions_roundtrip(spark, sf):
    path = new_folder(spark, "mentions")
    raw = s.mentions_raw(spark, sf)
    for kind in KINDS:
        rows = raw.where(F.col("kind") == kind).drop("kind")
        writers.export_tsv(rows, f"{path}/all__{kind}.tsv")
    return readers.read_mentions(spark, path, "al*")


@_query
def dictionaries_roundtrip(spark, sf):
    path = new_folder(spark, "labels")
    labels = s.entity_labels(spark, sf)
    paths = {kind: f"{path}/{kind}" for kind in KINDS}
    for kind, target in paths.items():
        rows = labels.where(F.col("kind") == kind).select("entity_id", "name")
        writers.export_tsv(rows, target)
    return readers.read_labels(spark, paths)


@_query
def taxonomy_roundtrip(spark, sf):
    path = new_folder(spark, "taxonomy")
    dump = s.taxonomy(spark, sf).select("taxon_id", F.lit("|").alias("bar"), "name", F.lit("|").alias("end"))
    writers.export_tsv(dump, path)
    return readers.read_taxonomy(spark, path)


@_query
def gene_taxon_roundtrip(spark, sf):
    path = new_folder(spark, "gene_taxon")
    writers.export_tsv(s.gene_taxon(spark, sf).select(F.lit("x").alias("source"), "taxon_gene"), path)
    return readers.read_gene_taxon(spark, path)


@_query
def publications_roundtrip(spark, sf):
    path = new_folder(spark, "attributes")
    dims = s.dims(spark, sf)
    for name, dim in dims.items():
        writers.export_tsv(dim, f"{path}/{name}")
    dims = readers.read_publications(spark, {name: f"{path}/{name}" for name in dims})
    return publications.publications(s.kept(spark, sf).select("doc_id"), dims)


@_query
def id_list_roundtrip(spark, sf):
    path = new_folder(spark, "index")
    index = s.table(spark, sf, "lineitem").select("l_shipdate", "l_partkey", "l_orderkey")
    writers.export_tsv(index, path)
    return readers.read_id_list(spark, path)


@_query
def transactions_roundtrip(spark, sf):
    path = new_folder(spark, "transactions")
    writers.export_tsv(s.labelled(spark, sf).select("doc_id", "name"), path)
    return readers.read_transactions(spark, path)


@_query
def evaluation_roundtrip(spark, sf):
    path = new_folder(spark, "evaluation")
    metrics = evaluate.as_decimals(evaluation_metrics(spark, sf))
    table = metrics.select(
        F.col("query_key").alias("gene"), F.lit("any").alias("species"), F.lit("own").alias("service"),
        "gold", "found", "tp", "fp", "fn", *evaluate.METRICS,
    )
    writers.export_tsv(writers.evaluation_headings(table), path, readable_headers=True)
    read = readers.read_evaluation(spark, path)
    thousandths = {m: (F.col(m) * 1000).cast("bigint") for m in evaluate.METRICS}
    return read.withColumns(thousandths).drop("species", "service")


@_query
def corpus_roundtrip(spark, sf):
    path = new_folder(spark, "corpus")
    writers.write_corpus({"facts": s.labelled(spark, sf)}, path)
    return readers.read_facts(spark, path)


@_query
def export_roundtrip(spark, sf):
    path = new_folder(spark, "export")
    writers.export_tsv(s.labelled(spark, sf), path)
    return spark.read.schema("kind string, doc_id string, name string, entity_id string, score int").csv(
        path, sep="\t", quote="", escape=""
    )


@_query
def lookup_roundtrip(spark, sf):
    path = new_folder(spark, "lookup")
    jobs.load_lookup(s.labelled(spark, sf), path)
    lookup = readers.read_lookup(spark, path)
    return search.starts_with(lookup, "gene_name", "sm").select("value", "doc_id", "entity_id", "score")


# Whole jobs


@_query
def build_corpus(spark, sf):
    tables = jobs.build_corpus(
        s.mentions_raw(spark, sf),
        s.species_dictionary(spark, sf),
        s.taxonomy(spark, sf),
        s.entity_labels(spark, sf),
        s.dims(spark, sf),
    )
    return publications.encode_lists(tables["publications"])


def _wide(spark, sf) -> dict[str, DataFrame]:
    return jobs.build_wide_tables(
        s.mentions_raw(spark, sf),
        s.species_dictionary(spark, sf),
        s.taxonomy(spark, sf),
        s.entity_labels(spark, sf),
        s.dims(spark, sf),
        search_columns=True,
    )


@_query
def build_wide(spark, sf):
    return _wide(spark, sf)["wide"]


@_query
def build_wide_publications(spark, sf):
    return _wide(spark, sf)["publications"]


@_query
def build_wide_counts(spark, sf):
    """Rows of the denormalised table per document, none of them written out."""
    return factorised.combination_counts(_wide(spark, sf)["cells"])


@_query
def mine_rules(spark, sf):
    genes = clean.for_taxon(readers.split_gene_taxon(s.gene_taxon(spark, sf)), "2")
    return jobs.mine_rules(stage(s.labelled(spark, sf)), genes, min_confidence=0.3)


@_query
def strong_rules(spark, sf):
    """The same rules with a share of the documents that is worth drawing."""
    genes = clean.for_taxon(readers.split_gene_taxon(s.gene_taxon(spark, sf)), "2")
    return jobs.mine_rules(
        stage(s.labelled(spark, sf)), genes, min_confidence=0.05, strong_support=0.01
    )


@_query
def evaluate_service(spark, sf):
    """Gold: returned line items per supplier; found: documents that mention the supplier."""
    published = (
        s.gold(spark, sf)
        .join(s.table(spark, sf, "orders").withColumnRenamed("o_orderkey", "doc_id"), "doc_id")
        .select(
            F.concat(F.lit("species/"), F.col("query_key").cast("string")).alias("query_key"),
            scalar.with_id_prefix(F.col("doc_id").cast("string")).alias("doc_id"),
            F.col("o_orderdate").alias("date"),
        )
    )
    open_access = s.table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    open_access = open_access.select(
        scalar.with_id_prefix(F.col("o_orderkey").cast("string")).alias("doc_id")
    )
    requests = s.entity_requests(spark, sf).where(F.col("kind") == "species")
    return jobs.evaluate_service(
        published, "2000-08-15", open_access, s.facts(spark, sf), requests
    )


@_query
def evaluate_genes(spark, sf):
    """Genes asked for by symbol and species: recoded to ids, looked up, and measured."""
    published = (
        s.gold(spark, sf)
        .join(s.table(spark, sf, "orders").withColumnRenamed("o_orderkey", "doc_id"), "doc_id")
        .select("query_key", scalar.with_id_prefix(F.col("doc_id").cast("string")).alias("doc_id"), F.col("o_orderdate").alias("date"))
    )
    open_access = s.table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    open_access = open_access.select(scalar.with_id_prefix(F.col("o_orderkey").cast("string")).alias("doc_id"))
    return jobs.evaluate_service(published, "2000-08-15", open_access, s.facts(spark, sf), s.gene_requests(spark, sf))


def _compared(spark, sf) -> dict[str, DataFrame]:
    a, b = s.results(spark, sf)
    return jobs.compare_services(a, b, 1993, 2003)


@_query
def compare_services(spark, sf):
    """Totals of two results."""
    return _compared(spark, sf)["totals"]


@_query
def compare_services_overlap(spark, sf):
    return _compared(spark, sf)["overlap"]


@_query
def compare_services_years(spark, sf):
    return _compared(spark, sf)["years"]
