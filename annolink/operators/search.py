"""Lookup table, prefix suggestions and document queries."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolink.fixed_values import (
    KINDS,
    MIN_SUGGESTION_LENGTH,
    PAGE_SIZE,
    SUGGESTION_ROUTES,
    SUGGESTIONS_PER_COLUMN,
    TOP_N,
)
from annolink.functions.scalar import lookup_prefix
from annolink.operators.publications import HOT_ROWS, gather
from annolink.operators.skew import distinct_rows, fits_broadcast, held_side, tasks_for
from annolink.operators.stats import top_entities
from annolink.staging import stage
from annolink.unions import append

# Lookup column to (kind, fact column).
COLUMNS = {
    f"{short}_{label}": (kind, field)
    for kind, short in KINDS.items()
    for field, label in (("name", "name"), ("entity_id", "id"))
}


def lookup_table(facts: DataFrame, strict_prefix: bool = False, n_facts: int | None = None) -> DataFrame:
    """Facts in long form: one row per searchable value, with its prefix.

    ``strict_prefix`` leaves out values whose first two characters are not letters or digits.
    ``n_facts`` is how many facts there are at most; without it they are counted first.
    """
    rest = ("name", "entity_id", "score")
    own = [F.col(c).alias(c) for c in rest]
    blank = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in rest]

    def entry(field, others):
        return F.struct(_attr(field), F.col(field).alias("value"), "doc_id", *others)

    entries = [entry("name", own), entry("entity_id", own), entry("doc_id", blank)]
    rows = facts.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*").where(F.col("value") != "")
    n_facts = facts.count() if n_facts is None else n_facts
    tasks = tasks_for(facts.sparkSession, len(entries) * n_facts)
    table = (
        distinct_rows(rows, tasks)
        .withColumns({"value_lower": F.lower("value"), "prefix": lookup_prefix(F.col("value"))})
        .withColumn("first", F.substring("prefix", 1, 1))
    )
    return table.where(F.col("prefix") != "_other") if strict_prefix else table


def _attr(field: str) -> Column:
    """The lookup column that a field of a fact is searched in."""
    if field == "doc_id":
        return F.lit("doc_id").alias("attr")
    short = F.coalesce(*[F.when(F.col("kind") == k, F.lit(s)) for k, s in KINDS.items()])
    return F.concat(short, F.lit("_name" if field == "name" else "_id")).alias("attr")


def searchable(facts: DataFrame, fields: list[str], *kept: str) -> DataFrame:
    """(attr, value, first, *kept): the values of ``lookup_table`` in some fields of facts, equal rows repeated."""
    entries = [F.struct(_attr(f), F.col(f).alias("value")) for f in fields]
    rows = facts.select(*kept, F.explode(F.array(*entries)).alias("entry")).select("entry.*", *kept)
    rows = rows.where(F.col("value") != "")
    return rows.withColumn("first", F.substring(lookup_prefix(F.col("value")), 1, 1))


def starts_with(
    lookup: DataFrame, attr: str, text: str, case_insensitive: bool = True
) -> DataFrame:
    """Lookup rows of one column whose value starts with the text.

    Adds the conditions on the partition columns, so that only files of that column and
    first character are read.
    """
    return lookup.where(_starts_with([attr], text, case_insensitive))


def _starts_with(attrs: list[str], text: str, case_insensitive: bool) -> Column:
    lower = text.lower()
    condition = F.col("attr").isin(attrs) & F.col("value_lower").startswith(lower)
    if re.match("[a-z0-9]{2}", lower):
        condition &= (F.col("first") == lower[0]) & (F.col("prefix") == lower[:2])
    elif len(lower) > 1:
        condition &= F.col("first") == "_"
    if not case_insensitive:
        condition &= F.col("value").startswith(text)
    return condition


def _top_values(values: DataFrame, by: list[str], limit: int) -> DataFrame:
    # The filter on the row number keeps at most ``limit`` rows per task before the shuffle.
    place = F.row_number().over(Window.partitionBy(*by).orderBy("value"))
    return values.withColumn("place", place).where(F.col("place") <= limit)


def suggest(
    lookup: DataFrame,
    text: str,
    limit: int = SUGGESTIONS_PER_COLUMN,
    case_sensitive: bool = False,
) -> DataFrame:
    """The first values of each searched column that start with the text."""
    text = text.strip(" ")
    attrs = [a for p, names in SUGGESTION_ROUTES if re.match(p, text.upper()) for a in names]
    if len(text) < MIN_SUGGESTION_LENGTH:
        attrs = []
    matching = lookup.where(_starts_with(attrs, text, not case_sensitive))
    return _top_values(matching.select("attr", "value").distinct(), ["attr"], limit)


def route_texts(texts: DataFrame) -> DataFrame:
    """(text) to distinct (text, attr): the columns that each trimmed text is matched with."""
    text = F.trim("text")
    upper = F.upper("text")
    routed = F.flatten(
        F.array(
            *[
                F.when(upper.rlike(p), F.array(*map(F.lit, names))).otherwise(
                    F.array().cast("array<string>")
                )
                for p, names in SUGGESTION_ROUTES
            ]
        )
    )
    return (
        texts.select(text.alias("text"))
        .where(F.length("text") >= MIN_SUGGESTION_LENGTH)
        .distinct()
        .select("text", F.explode(routed).alias("attr"))
    )


def suggest_batch(
    lookup: DataFrame, texts: DataFrame, limit: int = SUGGESTIONS_PER_COLUMN
) -> DataFrame:
    """``suggest`` for a table of texts, case-insensitive.

    Only values that share column and first characters with some text are cut, and only to
    the lengths that texts with these characters have. The first values of each such
    beginning are found once and then joined to the texts by equality, so no text is
    compared with all values of its first letters.
    """
    routed = route_texts(texts).withColumn("start", F.lower("text"))
    head = F.substring("start", 1, MIN_SUGGESTION_LENGTH).alias("head")
    lengths = routed.groupBy("attr", head).agg(F.collect_set(F.length("start")).alias("lengths"))
    fitting = F.filter("lengths", lambda n: n <= F.length("value_lower"))
    starts = (
        lookup.select("attr", "value", "value_lower")
        .distinct()
        .withColumn("head", F.substring("value_lower", 1, MIN_SUGGESTION_LENGTH))
        .join(lengths, ["attr", "head"])
        .select("attr", "value", "value_lower", F.explode(fitting).alias("length"))
        .select("attr", "value", F.expr("substring(value_lower, 1, length)").alias("start"))
        .join(routed.select("attr", "start").distinct(), ["attr", "start"], "left_semi")
    )
    first = _top_values(starts, ["attr", "start"], limit)
    return routed.join(first, ["attr", "start"]).select("text", "attr", "value", "place")


def _clause(column: str, value: str) -> Column:
    if column == "doc_id":
        return F.col("doc_id") == value
    kind, field = COLUMNS[column]
    return (F.col("kind") == kind) & (F.col(field) == value)


def matching_documents(facts: DataFrame, clauses: dict[str, list[str]]) -> DataFrame:
    """Distinct documents that fulfil every value of every clause."""
    conditions = [_clause(column, v) for column, values in clauses.items() for v in values]
    if not conditions:
        raise ValueError("a query needs at least one clause")
    # Rows that meet no clause are dropped at the scan; one flag per clause and document.
    hits = facts.where(reduce(Column.__or__, conditions))
    flags = hits.groupBy("doc_id").agg(
        *[F.max(c.cast("int")).alias(f"c{i}") for i, c in enumerate(conditions)]
    )
    met = reduce(Column.__and__, [F.col(f"c{i}") == 1 for i in range(len(conditions))])
    return flags.where(met).select("doc_id")


def order_kind(clauses: dict[str, list[str]], wanted: str | None = None) -> str | None:
    """The kind to order by: the wanted one if a clause names it, else the first named one."""
    available = [k for k in KINDS if any(COLUMNS.get(c, ("",))[0] == k for c in clauses)]
    return wanted if wanted in available else next(iter(available), None)


def find_documents(
    facts: DataFrame,
    pubs: DataFrame,
    clauses: dict[str, list[str]],
    order_by_kind: str | None = None,
    offset: int = 0,
    limit: int | None = PAGE_SIZE,
    not_empty: str = "doc_id",
) -> DataFrame:
    """One page of the documents that fulfil all clauses, with their publication columns.

    Ordered by the document's best score of ``order_by_kind``, then by document id.
    ``total`` is the number of documents on all pages. ``limit`` None gives all of them.
    Where ``pubs`` has parts, documents are counted and paged by their part 0, and all
    parts of the documents on the page are given.
    """
    found = matching_documents(facts, clauses)
    kind = order_kind(clauses, order_by_kind)
    if kind is not None:
        scores = facts.where(F.col("kind") == kind).join(found, "doc_id", "left_semi")
        best = scores.groupBy("doc_id").agg(F.max("score").alias("best_score"))
        ranked = found.join(best, "doc_id", "left")
    else:
        ranked = found.withColumn("best_score", F.lit(None).cast("int"))
    result = ranked.join(pubs, "doc_id").where(
        F.col(not_empty).isNotNull() & (F.col(not_empty) != "")
    )
    heads = result.where(F.col("part") == 0) if "part" in pubs.columns else result
    total = heads.agg(F.count("*")).scalar()
    heads = page(heads.withColumn("total", total), offset, limit)
    if "part" not in pubs.columns:
        return heads
    shown = heads.select("doc_id", "best_score", "total")
    return shown.join(pubs, "doc_id").orderBy(F.desc_nulls_last("best_score"), "doc_id", "part")


def page(result: DataFrame, offset: int = 0, limit: int | None = PAGE_SIZE) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by best score, then document id."""
    ordered = result.orderBy(F.desc_nulls_last("best_score"), "doc_id")
    if limit is None:
        return ordered.offset(offset) if offset else ordered
    return ordered.offset(offset).limit(limit)


def documents_of(
    facts: DataFrame, entity_ids: list[str], kind: str = "genes", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Documents that mention one of the entities, with the matching (name, id, score)."""
    rows = facts.where((F.col("kind") == kind) & F.col("entity_id").isin(entity_ids)).distinct()
    return gather(rows, {"entities": F.lit(True)}, hot_rows)


def lookup_batch(facts: DataFrame, requests: DataFrame) -> DataFrame:
    """Distinct (query_key, doc_id) for requests (query_key, kind, entity_id), as one join."""
    keys = ["entity_id", "kind"]
    pairs = stage(facts.join(held_side(requests, keys), keys).select("query_key", "doc_id"))
    return distinct_rows(pairs, tasks_for(pairs.sparkSession, pairs.count()))


def transactions(
    facts: DataFrame,
    kinds: list[str] | None = None,
    n: int = TOP_N,
    accepted: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Distinct (doc_id, item): the names of each kind's top entities, per document.

    Genes are usually restricted to one taxon by ``accepted``; species take no part.
    """
    kinds = kinds or ["genes", "terms_go", "terms_do", "terms_chebi"]
    top = append(*[top_entities(facts, k, n, (accepted or {}).get(k)) for k in kinds])
    top = top.select("kind", "entity_id")
    # At most n rows per kind; measured, because n is the caller's.
    side = F.broadcast(top) if n <= TOP_N or fits_broadcast(top) else top
    return (
        facts.join(side, ["entity_id", "kind"], "left_semi")
        .select("doc_id", F.col("name").alias("item"))
        .distinct()
    )
