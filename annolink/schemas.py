"""Explicit schemas of the tables; nothing is inferred."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_MENTIONS = _strings("doc_raw", "entity_id", "score")
LABELS = _strings("entity_id", "name")
# Fields of the dump are separated by tab, pipe, tab: the pipes are columns of their own.
TAXONOMY_DUMP = _strings("taxon_id", "bar", "name")
GENE_TAXON = _strings("source", "taxon_gene")
TRANSACTIONS = _strings("doc_id", "item")

ENTITY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("score", T.IntegerType()),
    ]
)
FACTS = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("doc_id", T.StringType()), *ENTITY.fields]
)
# The kind of the first row of a batch.
BATCH_HEADER = "_batch"
BATCHES = T.StructType([*FACTS.fields, T.StructField("batch", T.StringType())])
EVALUATION = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("gene", "species", "service")]
    + [T.StructField(n, T.LongType()) for n in ("gold", "found", "tp", "fp", "fn")]
    + [
        T.StructField(n, T.DecimalType(6, 3))
        for n in ("precision", "recall", "f1", "tpr", "fdr")
    ]
)
# ``attr`` and ``first`` are folders: without a schema they would be guessed from the values.
LOOKUP = T.StructType(
    [
        T.StructField(n, T.IntegerType() if n == "score" else T.StringType())
        for n in ("value", "doc_id", "name", "entity_id", "score", "value_lower", "prefix", "attr", "first")
    ]
)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# The tables of a document index whose columns are the same for every corpus.
INDEX = {
    "documents": _table(doc_id=T.StringType(), number=T.LongType()),
    "postings": _table(
        value=T.StringType(), word=T.LongType(), bits=T.LongType(), attr=T.StringType(), first=T.StringType()
    ),
    "scores": _table(score=T.IntegerType(), word=T.LongType(), bits=T.LongType(), kind=T.StringType()),
    "entries": _table(
        doc_id=T.StringType(), kind=T.StringType(), rank=T.LongType(),
        name=T.StringType(), entity_id=T.StringType(), score=T.IntegerType(),
    ),
}
