"""Tables and exports. Existing output is refused unless ``mode`` is ``overwrite``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolink.fixed_values import EVALUATION_COLUMNS, HEADINGS
from annolink.functions.lists import encode_list
from annolink.operators.skew import tasks_for
from annolink.schemas import BATCH_HEADER, FACTS
from annolink.staging import stage
from annolink.unions import append

REFUSE = "errorifexists"
# Rows of a file that is sorted before it is written.
FILE_ROWS = 1_000_000


def write_corpus(tables: dict[str, DataFrame], path: str, mode: str = REFUSE) -> None:
    """Write the staged tables as Parquet; facts are partitioned by kind.

    The rebalance hint makes adaptive execution cut a kind that holds most rows into
    several files and join small remainders.
    """
    for name, table in tables.items():
        target = f"{path}/{name}"
        if "kind" in table.columns:
            table.hint("rebalance", "kind").write.mode(mode).partitionBy("kind").parquet(target)
        else:
            table.hint("rebalance").write.mode(mode).parquet(target)


def write_lookup(lookup: DataFrame, path: str, mode: str = REFUSE) -> None:
    """Write the lookup table, partitioned by column and first character, sorted by value.

    Range partitioning includes the document, so a prefix or value shared by most rows is
    spread over many files instead of filling one.
    """
    order = ["attr", "first", "value_lower", "doc_id"]
    _ranges(lookup, order).write.mode(mode).partitionBy("attr", "first").parquet(path)


def _ranges(table: DataFrame, order: list[str]) -> DataFrame:
    """Sorted ranges of a number of rows that one task sorts in memory. The bounds are sampled from the
    table and its rows are counted, so it is written before it is dealt, and not computed three times."""
    rows = stage(table)
    tasks = tasks_for(rows.sparkSession, rows.count(), FILE_ROWS)
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def write_batches(facts: DataFrame, path: str, batches: list[str] | None = None) -> None:
    """Facts with a ``batch`` column to a table that holds every batch once.

    A batch that was there is replaced as a whole, others are not touched. Each batch begins with a header
    row of its own, so one that has lost all its facts is replaced, too, when it is named in ``batches``;
    by default the batches are those of the rows. Two jobs may write different batches.
    """
    rows = facts.select("batch", *FACTS.names)
    named = rows.select("batch").distinct()
    if batches is not None:
        listed = facts.sparkSession.createDataFrame([(b,) for b in batches], "batch string")
        named = append(named, listed).distinct()
    blank = {n: F.lit(None).cast(FACTS[n].dataType) for n in FACTS.names}
    headers = named.withColumns(blank | {"kind": F.lit(BATCH_HEADER)}).select("batch", *FACTS.names)
    # Only the batch is a folder: with the kind as one, a kind that a batch has lost would stay.
    # Ranges of a number of rows: by their compressed bytes, a task would sort some millions.
    order = ["batch", "kind", "doc_id"]
    tasks = max(1, -(-rows.count() // FILE_ROWS))
    out = append(rows, headers).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def write_colocated(tables: dict[str, DataFrame], prefix: str, buckets: int, mode: str = REFUSE) -> dict[str, DataFrame]:
    """Tables of the session's catalog, all bucketed and sorted by document: joins and groups by document
    need no shuffle. The number of buckets suits the largest table; all have the same."""
    spark = next(iter(tables.values())).sparkSession
    held = {}
    for name, table in tables.items():
        rows = table.repartition(buckets, "doc_id")
        rows.write.mode(mode).bucketBy(buckets, "doc_id").sortBy("doc_id").format("parquet").saveAsTable(f"{prefix}_{name}")
        held[name] = spark.table(f"{prefix}_{name}")
    return held


def write_index(tables: dict[str, DataFrame], path: str, mode: str = REFUSE) -> None:
    """Write the tables of a document index, each sorted by what queries look it up by.

    Range partitioning includes the word, so a value or score of most documents fills many files.
    """
    layout = {
        "documents": ((), ["number"]),
        "postings": (("attr", "first"), ["attr", "first", "value", "word"]),
        "scores": (("kind",), ["kind", "score", "word"]),
        "publications": ((), ["doc_id"]),
        "entries": ((), ["doc_id", "kind", "rank"]),
    }
    for name, (folders, order) in layout.items():
        _ranges(tables[name], order).write.mode(mode).partitionBy(*folders).parquet(f"{path}/{name}")


def export_tsv(
    df: DataFrame, path: str, readable_headers: bool = False, mode: str = REFUSE
) -> None:
    """Write tab-separated text: lists encoded, NULL blank, no quoting.

    Tabs and line breaks inside a value would break the row; they become blanks.
    """
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            value = encode_list(value)
        text = F.translate(F.coalesce(value.cast("string"), F.lit("")), "\t\n\r", "   ")
        columns.append(text.alias(HEADINGS.get(field.name, field.name) if readable_headers else field.name))
    (
        df.select(*columns)
        .write.mode(mode)
        .options(
            sep="\t", quote="", escape="", emptyValue="", header=readable_headers,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def evaluation_headings(metrics: DataFrame) -> DataFrame:
    """The thirteen columns of the evaluation table under their published headings."""
    names = ("gene", "species", "service", "gold", "found", "tp", "fp", "fn",
             "precision", "recall", "f1", "tpr", "fdr")
    return metrics.select(*[F.col(n).alias(h) for n, h in zip(names, EVALUATION_COLUMNS)])
