"""Document queries on posting bitmaps.

Documents are numbered in the order of their ids; 64 neighbouring numbers make a *word*. The
postings of a value are one 64-bit integer for each word that it occurs in, so a clause reads
the rows of its value only, an intersection is a bitwise and per word, and a total is a
count of bits. The best scores of a kind are postings too, one list for each score, which gives
pages in order of score without a look at the documents that are not on them.

A value of most documents has a row per 64 of them, sorted and spread like all others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolink.fixed_values import KINDS, PAGE_SIZE
from annolink.functions.scalar import lookup_prefix
from annolink.operators.publications import encode_lists, list_parts, ranked_entries, unite_parts
from annolink.operators.search import order_kind, searchable
from annolink.operators.skew import HOT_ROWS, tasks_for, with_position
from annolink.staging import stage
from annolink.unions import append

WORD = 64


@dataclass
class Index:
    """The tables of an index, as read from disk."""

    documents: DataFrame
    postings: DataFrame
    scores: DataFrame
    publications: DataFrame
    entries: DataFrame


def _word() -> Column:
    return F.expr(f"number div {WORD}").alias("word")


def _bit() -> Column:
    """The bit of a number in its word."""
    return F.expr(f"shiftleft(1L, cast(number % {WORD} as int))").alias("bit")


def as_words(numbered: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """(*keys, number) to (*keys, word, bits): one row per key and 64 numbers.

    Where most rows have a word of their own, which no task could unite before the shuffle, they are
    dealt to a number of tasks first.
    """
    rows = numbered.select(*keys, _word(), _bit())
    rows = rows if tasks is None else rows.repartition(tasks, *keys, "word")
    return rows.groupBy(*keys, "word").agg(F.bit_or("bit").alias("bits"))


def numbers_of(words: DataFrame) -> DataFrame:
    """Words back to rows: one per bit, with its ``number``."""
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit("bits", i) == 1)
    rows = words.withColumn("place", F.explode(places))
    return rows.withColumn("number", F.col("word") * WORD + F.col("place")).drop("word", "bits", "place")


def index_tables(facts: DataFrame, pubs: DataFrame) -> dict[str, DataFrame]:
    """The tables of an index over the documents that have a publication row."""
    pubs = stage(pubs)
    documents = stage(with_position(pubs.select("doc_id").distinct(), "doc_id", name="number"))
    known = stage(facts.join(documents, "doc_id"))
    # Equal values of a document set the same bit.
    fields = ["name", "entity_id", "doc_id"]
    tasks = tasks_for(facts.sparkSession, len(fields) * known.count())
    words = as_words(searchable(known, fields, "number"), "attr", "first", "value", tasks=tasks)
    best = known.groupBy("kind", "number").agg(F.max("score").alias("score"))
    return {
        "documents": documents,
        "postings": append(words, _filled_words(pubs, documents)),
        "scores": as_words(best, "kind", "score"),
        "publications": pubs,
        "entries": ranked_entries(known),
    }


def _filled_words(pubs: DataFrame, documents: DataFrame) -> DataFrame:
    """The words of each publication column's filled fields: one row per word while they are gathered."""
    filled = {c: F.col(c).isNotNull() & (F.col(c).cast("string") != "") for c in pubs.columns}
    flags = pubs.select("doc_id", *[held.alias(f"_{c}") for c, held in filled.items()])
    numbered = flags.join(documents, "doc_id")
    words = numbered.groupBy(_word()).agg(
        *[F.bit_or(F.when(F.col(f"_{c}"), _bit())).alias(f"_{c}") for c in filled]
    )
    columns = F.array(*[F.struct(F.lit(c).alias("value"), F.col(f"_{c}").alias("bits")) for c in filled])
    rows = words.select("word", F.explode(columns).alias("column")).where("column.bits is not null")
    return rows.select(
        F.lit("filled").alias("attr"), F.lit("_").alias("first"), "column.value", "word", "column.bits"
    )


def _clauses(wanted: Sequence[tuple[str, str]]) -> Column:
    """Rows of the clauses' values; the folders to read are a condition of their own."""
    folders, values = [], []
    for attr, value in wanted:
        first = F.lit("_") if attr == "filled" else F.substring(lookup_prefix(F.lit(value)), 1, 1)
        folder = (F.col("attr") == attr) & (F.col("first") == first)
        folders.append(folder)
        values.append(folder & (F.col("value") == value))
    return reduce(Column.__or__, folders) & reduce(Column.__or__, values)


def matching_words(index: Index, clauses: dict[str, list[str]], not_empty: str | None = None) -> DataFrame:
    """(word, bits) of the documents that fulfil every value of every clause."""
    wanted = list(dict.fromkeys((a, v) for a, values in clauses.items() for v in values))
    if not wanted:
        raise ValueError("a query needs at least one clause")
    if not_empty is not None:
        wanted.append(("filled", not_empty))
    words = index.postings.where(_clauses(wanted)).groupBy("word")
    met = words.agg(F.bit_and("bits").alias("bits"), F.count("*").alias("n"))
    return met.where((F.col("n") == len(wanted)) & (F.col("bits") != 0)).drop("n")


def total(words: DataFrame) -> int:
    return words.agg(F.sum(F.bit_count("bits")).cast("long")).first()[0] or 0


def _after(index: Index, score: int | None, doc_id: str) -> tuple[Column, Column]:
    """The condition on rows of words behind a page token, and the bits of a row that are behind it."""
    last = index.documents.where(F.col("doc_id") <= doc_id).agg(F.max("number")).first()[0]
    last = -1 if last is None else last
    word, place = last // WORD, last % WORD
    best = F.col("best_score")
    # Documents without a score come last, in the order of their ids.
    same = best.isNull() if score is None else best.eqNullSafe(score)
    later = F.lit(False) if score is None else best.isNull() | (best < score)
    behind, here = later | (same & (F.col("word") >= word)), same & (F.col("word") == word)
    # In the word of the token only the places above it are behind.
    upper = (-1 << (place + 1)) if place < WORD - 1 else 0
    return behind, F.when(here, F.col("bits").bitwiseAND(F.lit(upper))).otherwise(F.col("bits"))


def find_page(
    index: Index,
    clauses: dict[str, list[str]],
    order_by_kind: str | None = None,
    after: tuple[int | None, str] | None = None,
    offset: int = 0,
    limit: int = PAGE_SIZE,
    not_empty: str | None = None,
) -> DataFrame:
    """One page of the documents that fulfil all clauses: attributes, five lists, ``total``.

    Ordered by the document's best score of ``order_by_kind``, then by document id. A page begins
    after the row whose (best_score, doc_id) is given as ``after``, which costs the same for
    every page, or after ``offset`` documents, which reads that many more. ``total`` counts the documents
    of all pages. The lists are whole: a document has a row for each ``part`` of them, as in ``list_parts``,
    and most have part 0 only; a page is counted in documents. Only the entries of the page's
    documents are read. ``not_empty`` names a publication column that must be filled.
    """
    words = stage(matching_words(index, clauses, not_empty))
    found = total(words)
    kind = order_kind(clauses, order_by_kind)
    if kind is None:
        ranked = words.withColumn("best_score", F.lit(None).cast("int"))
    else:
        own = index.scores.where(F.col("kind") == kind)
        own = own.select("word", F.col("bits").alias("having"), F.col("score").alias("best_score"))
        if after is not None:
            best = F.col("best_score")
            own = own.where(best.isNull() if after[0] is None else best.isNull() | (best <= after[0]))
        ranked = own.join(words, "word").withColumn("bits", F.col("bits").bitwiseAND(F.col("having"))).drop("having")
    if after is not None:
        behind, bits = _after(index, after[0] if kind is not None else None, after[1])
        ranked = ranked.where(behind).withColumn("bits", bits)
    # Every row has a document at least, so these rows hold the page.
    order = [F.desc_nulls_last("best_score"), "word"]
    rows = ranked.where(F.col("bits") != 0).orderBy(*order).limit(offset + limit)
    page = numbers_of(rows).orderBy(F.desc_nulls_last("best_score"), "number").offset(offset).limit(limit)
    # At most ``limit`` rows: their numbers and ids are put into the conditions of the scans.
    shown = {r.number: r.best_score for r in page.collect()}
    spark = index.documents.sparkSession
    ids = index.documents.where(F.col("number").isin(list(shown))).select("doc_id", "number").collect()
    schema = "doc_id string, best_score int, total long"
    heads = spark.createDataFrame([(r.doc_id, shown[r.number], found) for r in ids], schema)
    mine = F.col("doc_id").isin([r.doc_id for r in ids])
    entries = index.entries.where(mine)
    # Usually no list goes beyond part 0, as the footers tell; then the scan is bounded to it.
    longer = not entries.where(F.col("rank") >= HOT_ROWS).isEmpty()
    lists = list_parts(entries, last=None if longer else 0)
    # Documents are found by their entries, so all have a part. An inner join leaves the parts where they
    # are gathered; an outer one would bring all of a document to one task.
    result = heads.join(index.publications.where(mine), "doc_id").join(lists, "doc_id")
    columns = [c for c in result.columns if c not in ("part", *KINDS)]
    return result.select(*columns, *KINDS, "part").orderBy(F.desc_nulls_last("best_score"), "doc_id", "part")


def encode_page(page: DataFrame) -> DataFrame:
    """Text form of a page: one row per document, its lists whole, in the order of the page."""
    return unite_parts(encode_lists(page)).orderBy(F.desc_nulls_last("best_score"), "doc_id")
