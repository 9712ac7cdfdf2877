"""Tab-separated inputs, each with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolink import schemas
from annolink.fixed_values import KINDS, PUBLICATION_ATTRIBUTES
from annolink.operators.postings import Index
from annolink.unions import append


def _read_tsv(spark: SparkSession, path, schema: T.StructType, **options) -> DataFrame:
    # Quotes are ordinary characters in these files; a blank field is NULL.
    reader = spark.read.schema(schema).options(sep="\t", quote="", escape="", **options)
    return reader.csv(path)


def read_mentions(spark: SparkSession, path: str, prefix: str = "*") -> DataFrame:
    """Mention files ``<batch>__<kind>.tsv``: (kind, batch, doc_raw, entity_id, score).

    ``prefix`` is a glob for the batch, e.g. ``BMC_*``. A missing kind is an empty one.
    Each may also be a folder of that name, as Spark writes them.
    """
    files = _read_tsv(spark, f"{path}/{prefix}__*.tsv", schemas.RAW_MENTIONS)
    # No regular expression, since every mention passes here: the folder, else the file, that ends like one.
    kind, batch = F.lit(None).cast("string"), F.lit(None).cast("string")
    path = F.col("_metadata.file_path")
    for named in (F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)):
        for k in KINDS:
            end = f"__{k}.tsv"
            fits = named.endswith(end) & (F.length(named) > len(end))
            kind = F.when(fits, F.lit(k)).otherwise(kind)
            batch = F.when(fits, F.substring(named, F.lit(1), F.length(named) - len(end))).otherwise(batch)
    # The path is URL-encoded, but for the plus sign.
    decoded = F.url_decode(F.replace("batch", F.lit("+"), F.lit("%2B")))
    rows = files.select(kind.alias("kind"), batch.alias("batch"), "doc_raw", "entity_id", "score")
    rows = rows.where(F.col("kind").isNotNull())
    return rows.withColumn("batch", F.when(F.col("batch").contains("%"), decoded).otherwise(F.col("batch")))


def read_labels(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Label files (entity_id, name); ``paths`` maps a file to its kind, or to ``terms``.

    The file of terms serves the three ontologies.
    """
    tables = []
    for kind, path in paths.items():
        names = _read_tsv(spark, path, schemas.LABELS)
        kinds = [k for k in KINDS if k.startswith("terms_")] if kind == "terms" else [kind]
        tables.append(
            names.select(F.explode(F.array(*map(F.lit, kinds))).alias("kind"), "entity_id", "name")
        )
    return append(*tables)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy dump: (name, taxon_id)."""
    return _read_tsv(spark, path, schemas.TAXONOMY_DUMP).select("name", "taxon_id")


def read_species_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return _read_tsv(spark, path, T.StructType([T.StructField("name", T.StringType())]))


def read_gene_taxon(spark: SparkSession, path: str) -> DataFrame:
    """Gene list with ``taxon|gene`` in its second field: (taxon, entity_id)."""
    return split_gene_taxon(_read_tsv(spark, path, schemas.GENE_TAXON))


def split_gene_taxon(df: DataFrame) -> DataFrame:
    parts = F.split("taxon_gene", r"\|")
    return df.select(
        F.get(parts, F.lit(0)).alias("taxon"), F.get(parts, F.lit(1)).alias("entity_id")
    )


def read_publications(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Attribute files (doc_id, value), one per attribute; a blank value stays blank."""
    unknown = set(paths) - set(PUBLICATION_ATTRIBUTES)
    if unknown:
        raise ValueError(f"unknown attributes: {sorted(unknown)}")
    return {
        name: _read_tsv(
            spark,
            paths[name],
            T.StructType([T.StructField("doc_id", T.StringType()), T.StructField(name, T.StringType())]),
        ).withColumn(name, F.coalesce(name, F.lit("")))
        for name in PUBLICATION_ATTRIBUTES
        if name in paths
    }


def read_id_list(spark: SparkSession, path: str, col: int = 2) -> DataFrame:
    """Distinct ids of one field of an index file; lines without that field are skipped."""
    fields = [T.StructField(f"f{i}", T.StringType()) for i in range(col + 1)]
    rows = _read_tsv(spark, path, T.StructType(fields))
    return rows.select(F.col(f"f{col}").alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct()


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return _read_tsv(spark, path, schemas.TRANSACTIONS).distinct()


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation table with a header line."""
    # The service writes ".539" and "0": read as text, then as decimals.
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.EVALUATION])
    rows = _read_tsv(spark, path, text, header=True, enforceSchema=True)
    return rows.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.EVALUATION]
    )


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Labelled mentions as written by ``write_corpus``."""
    return spark.read.schema(schemas.FACTS).parquet(f"{path}/facts").select(*schemas.FACTS.names)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Facts of all batches, with their ``batch``, as written by ``write_batches``."""
    rows = spark.read.schema(schemas.BATCHES).parquet(path)
    return rows.where(F.col("kind") != schemas.BATCH_HEADER).select("batch", *schemas.FACTS.names)


def read_batch_list(spark: SparkSession, path: str) -> DataFrame:
    """(batch, n_facts) of every batch written, also of those without facts."""
    rows = spark.read.schema(schemas.BATCHES).parquet(path)
    return rows.groupBy("batch").agg(F.count(F.when(F.col("kind") != schemas.BATCH_HEADER, 1)).alias("n_facts"))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LOOKUP).parquet(path)


def read_index(spark: SparkSession, path: str) -> Index:
    """A document index as written by ``write_index``; publications keep their own columns."""
    tables = {n: spark.read.schema(t).parquet(f"{path}/{n}") for n, t in schemas.INDEX.items()}
    return Index(publications=spark.read.parquet(f"{path}/publications"), **tables)
