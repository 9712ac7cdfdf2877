"""Inputs of the engine, derived by Spark from the given tables.

Orders play documents, line items play mentions, parts and suppliers play dictionaries.
All line items take part. The dictionaries have gaps on purpose (obsolete ids, one-word
species names, missing or blank attributes): those are the cases the operators decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolink.fixed_values import LATIN_NAMES
from annolink.operators.clean import cut_below, parse_mentions, with_id_prefix
from annolink.operators.label import held_labels, label
from annolink.operators.skew import distinct_rows, tasks_for
from annolink.operators.tagging import words_of


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf) -> DataFrame:
    """(doc_id, text), spread over all cores where the file has fewer splits than that.

    Tokenising is the work here, and a small file is a single split. A corpus with a split
    per core is left as it is.
    """
    docs = table(spark, sf, "documents").select("doc_id", "text")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def _text(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def mentions_raw(spark, sf) -> DataFrame:
    """(kind, doc_raw, entity_id, score): ids to normalise, blank scores, low scores."""
    part = F.col("l_partkey")
    kind = F.col("l_linenumber") % 5

    def by_kind(*values):
        chain = F.when(kind == 0, values[0])
        for i, value in enumerate(values[1:-1], 1):
            chain = chain.when(kind == i, value)
        return chain.otherwise(values[-1])

    return table(spark, sf, "lineitem").select(
        by_kind(*map(F.lit, ("genes", "species", "terms_go", "terms_do", "terms_chebi"))).alias("kind"),
        F.concat(F.lit("Ord-"), _text("l_linenumber"), F.lit("--"), _text("l_orderkey")).alias("doc_raw"),
        by_kind(
            _text("l_partkey"),
            _text("l_suppkey"),
            F.concat(F.lit("GO:"), F.lpad(_text(part % 50), 7, "0")),
            F.concat(F.lit("DOID:"), _text(part % 20)),
            F.concat(F.lit("CHEBI:"), _text(part % 30)),
        ).alias("entity_id"),
        F.when(F.col("l_quantity") == 7, F.lit(""))
        .otherwise(_text(F.col("l_quantity").cast("int")))
        .alias("score"),
    )


def mentions(spark, sf) -> DataFrame:
    return parse_mentions(mentions_raw(spark, sf))


def kept(spark, sf) -> DataFrame:
    """Mentions at or above the score cut."""
    return cut_below(mentions(spark, sf))


def entity_labels(spark, sf) -> DataFrame:
    part, key = table(spark, sf, "part"), F.col("p_partkey")
    supplier, supp = table(spark, sf, "supplier"), F.col("s_suppkey")
    species = F.when(supp % 3 == 0, F.lit("Genus")).otherwise(F.replace("s_name", F.lit("#"), F.lit(" ")))

    def labels(df, kind, entity_id, name):
        return df.select(F.lit(kind).alias("kind"), entity_id.alias("entity_id"), name.alias("name"))

    go = F.concat(F.lit("GO:"), F.lpad(_text(key), 7, "0"))
    return (
        labels(part.where(key % 10 != 0), "genes", _text(key), F.col("p_name"))
        .unionByName(labels(supplier, "species", _text(supp), species))
        .unionByName(labels(part.where(key < 45), "terms_go", go, F.col("p_name")))
        .unionByName(labels(part.where(key < 20), "terms_do", F.concat(F.lit("DOID:"), _text(key)), F.col("p_type")))
        .unionByName(labels(part.where(key < 30), "terms_chebi", F.concat(F.lit("CHEBI:"), _text(key)), F.col("p_brand")))
    )


def labelled(spark, sf) -> DataFrame:
    return label(kept(spark, sf), held_labels(entity_labels(spark, sf)))


def facts(spark, sf) -> DataFrame:
    """Distinct labelled mentions with prefixed document ids."""
    rows = labelled(spark, sf).withColumn("doc_id", with_id_prefix(F.col("doc_id")))
    return distinct_rows(rows, tasks_for(spark, n_mentions(spark, sf)))


def n_mentions(spark, sf) -> int:
    """Counted by the footers of the file."""
    return table(spark, sf, "lineitem").count()


def taxonomy(spark, sf) -> DataFrame:
    supplier, key = table(spark, sf, "supplier"), F.col("s_suppkey")
    name = F.when(key % 3 == 0, F.col("s_name")).otherwise(F.replace("s_name", F.lit("#"), F.lit(" ")))
    aliases = supplier.where(key % 2 == 0).select(
        F.concat(F.lit("Alias "), _text(key)).alias("name"), _text(key).alias("taxon_id")
    )
    return supplier.select(name.alias("name"), _text(key).alias("taxon_id")).unionByName(aliases)


def species_dictionary(spark, sf) -> DataFrame:
    return taxonomy(spark, sf).where(F.col("taxon_id").cast("int") % 4 != 1).select("name")


def gene_taxon(spark, sf) -> DataFrame:
    taxon = F.substring("p_brand", 7, 100)
    return table(spark, sf, "part").select(
        F.concat(taxon, F.lit("|"), _text("p_partkey")).alias("taxon_gene")
    )


def dims(spark, sf) -> dict[str, DataFrame]:
    """Publication attributes (doc_id, value); some pmid missing, some doi and year blank."""
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    customer = table(spark, sf, "customer")
    doc = _text(key).alias("doc_id")
    doi = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.concat(F.lit("10.1/"), _text(key)))
    title = F.concat(F.lit("Order "), _text(key), F.lit(" "), F.col("o_orderpriority"))
    year = F.when(key % 13 == 0, F.lit("")).otherwise(_text(F.year("o_orderdate")))
    journal = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return {
        "pmid": orders.where(key % 11 != 0).select(doc, _text(key + 10_000_000).alias("pmid")),
        "doi": orders.select(doc, doi.alias("doi")),
        "title": orders.select(doc, title.alias("title")),
        "journal": journal.select(doc, F.col("c_mktsegment").alias("journal")),
        "year": orders.select(doc, year.alias("year")),
    }


def prefixed_dims(spark, sf) -> dict[str, DataFrame]:
    prefixed = with_id_prefix(F.col("doc_id"))
    return {n: d.withColumn("doc_id", prefixed) for n, d in dims(spark, sf).items()}


def gold(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return rows.select(F.col("l_suppkey").alias("query_key"), F.col("l_orderkey").alias("doc_id")).distinct()


def found(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").where(F.col("l_quantity") >= 25)
    return rows.select(F.col("l_suppkey").alias("query_key"), F.col("l_orderkey").alias("doc_id")).distinct()


def synonyms(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        _text("p_partkey").alias("entity_id"),
        F.concat_ws(";", "p_name", "p_brand", "p_type").alias("synonym_list"),
    )


def results(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Two search results with (doi, year): orders of 1997, and urgent orders."""
    orders = table(spark, sf, "orders")
    attributes = dims(spark, sf)
    both = attributes["doi"].join(attributes["year"], "doc_id").select("doc_id", "doi", "year")

    def result(condition):
        docs = orders.where(condition).select(_text("o_orderkey").alias("doc_id"))
        return both.join(docs, "doc_id", "left_semi").select("doi", "year")

    return result(F.year("o_orderdate") == 1997), result(F.col("o_orderpriority") == "1-URGENT")


def word_items(spark, sf) -> DataFrame:
    """Distinct (doc_id, item): all words of each document."""
    words = F.explode(F.array_distinct(words_of(F.col("text"))))
    return documents(spark, sf).select("doc_id", words.alias("item")).distinct()


def word_dictionary(spark, sf) -> DataFrame:
    """Words, and pairs of neighbouring words, of the benchmark texts."""
    words = table(spark, sf, "benchmark").select(words_of(F.col("text")).alias("words"))
    single = words.select(F.explode("words").alias("name"))
    neighbours = F.transform(
        F.when(F.size("words") >= 2, F.sequence(F.lit(1), F.size("words") - 1)),
        lambda i: F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1)),
    )
    pairs = words.select(F.explode(neighbours).alias("name"))
    names = single.unionByName(pairs).distinct()
    return names.select(F.lit("terms_go").alias("kind"), F.col("name").alias("entity_id"), "name")


def query_texts(spark, sf) -> DataFrame:
    """Texts that users type on their way to a name or an id: its first 2 to 6 characters."""
    labels = entity_labels(spark, sf)
    values = labels.select(F.col("name").alias("value")).unionByName(labels.select(F.col("entity_id").alias("value")))
    begun = F.explode(F.transform(F.sequence(F.lit(2), F.lit(6)), lambda n: F.substr("value", F.lit(1), n)))
    return values.distinct().select(begun.alias("text")).distinct()


def entity_requests(spark, sf) -> DataFrame:
    """One request per labelled entity, keyed by kind and id."""
    asked = entity_labels(spark, sf)
    return asked.select(F.concat_ws("/", "kind", "entity_id").alias("query_key"), "kind", "entity_id")


def gene_requests(spark, sf) -> DataFrame:
    """(query_key, gene, species): suppliers stand for pairs of a gene and a species to be asked for."""
    genes = F.array(*[F.lit(g) for g in ("BRCA2", "Myc", "APC", "DCC")])
    species = F.array(*[F.lit(name) for name, _, _ in LATIN_NAMES], F.lit("other"))
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("query_key"),
        F.get(genes, (F.col("s_suppkey") % 4).cast("int")).alias("gene"),
        F.get(species, (F.col("s_nationkey") % 5).cast("int")).alias("species"),
    )
