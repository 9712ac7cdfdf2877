"""Documents with their attributes and their entity lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolink.fixed_values import ENTRY_SEPARATOR, KINDS
from annolink.functions.lists import decode_list, encode_list
from annolink.functions.scalar import link_out, score_band
from annolink.operators.factorised import expand, factorise
from annolink.operators.skew import HOT_ROWS, hot_keys, key_sizes, number_copies, tasks_for, with_position
from annolink.unions import append


def document_ids(mentions: DataFrame) -> DataFrame:
    """Documents seen in any kind."""
    return mentions.select("doc_id").distinct()


def publications(
    docs: DataFrame,
    dims: dict[str, DataFrame],
    how: str = "inner",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Attach attributes to documents: ``dims`` maps a column name to (doc_id, value).

    ``inner`` drops documents that lack an attribute, ``left`` gives NULL. Every table is
    shuffled by document once: that serves both its deduplication and all the joins.
    """
    attributes = {name: dim.select("doc_id", name) for name, dim in dims.items()}
    given = append(*[d.select("doc_id") for d in attributes.values()])
    rows, most = key_sizes(given, "doc_id")
    # All tables are dealt to the same tasks, as many as all their rows need.
    tasks = tasks_for(docs.sparkSession, rows)
    listed = docs.select("doc_id").repartition(tasks, "doc_id").distinct()
    hot = hot_keys(given, "doc_id", hot_rows if hot_rows is not None and most > hot_rows else None)
    if hot is None:
        return _attach(listed, attributes, how, tasks)
    keys = hot.select("doc_id")
    ordinary = {n: d.join(keys, "doc_id", "left_anti") for n, d in attributes.items()}
    rows = [
        d.select(F.lit(n).alias("kind"), "doc_id", F.col(n).alias("value"))
        for n, d in attributes.items()
    ]
    rows = append(*rows).join(keys, "doc_id", "left_semi").distinct()
    rows = rows.join(listed, "doc_id", "left_semi").withColumn("alive", F.lit(True))
    wide = expand(factorise(rows, list(dims), ["value"], hot_rows, required=how == "inner"), list(dims))
    wide = wide.select("doc_id", *[F.col(n)["value"].alias(n) for n in dims])
    return append(_attach(listed.join(keys, "doc_id", "left_anti"), ordinary, how, tasks), wide)


def _attach(docs: DataFrame, attributes: dict[str, DataFrame], how: str, tasks: int) -> DataFrame:
    for attribute in attributes.values():
        docs = docs.join(attribute.repartition(tasks, "doc_id").distinct(), "doc_id", how)
    return docs


def ranked_entries(facts: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The base form of the entity lists: (doc_id, kind, rank, name, entity_id, score), one row per entry.

    Ranks count from 0 in each list: highest score first, then name, then id. Entries of hot documents
    are ranked by a range sort over many tasks, so a list may have any length.
    """
    rows = facts.select("kind", "doc_id", "name", "entity_id", "score")
    columns = ["doc_id", "kind", "rank", "name", "entity_id", "score"]
    order = Window.partitionBy("doc_id", "kind").orderBy(F.desc("score"), "name", "entity_id")
    rank = (F.row_number().over(order) - 1).cast("long")

    def by_window(part: DataFrame) -> DataFrame:
        return part.repartition("doc_id").withColumn("rank", rank).select(*columns)

    hot = hot_keys(rows, "doc_id", hot_rows)
    if hot is None:
        return by_window(rows)
    keys = hot.select("doc_id")
    ranked = _ranked_by_range(rows.join(keys, "doc_id", "left_semi"))
    return append(by_window(rows.join(keys, "doc_id", "left_anti")), ranked.select(*columns))


def _ranked_by_range(entries: DataFrame) -> DataFrame:
    numbered = with_position(number_copies(entries), "doc_id", "kind", F.desc("score"), "name", "entity_id", "copy")
    # One row per hot document and kind.
    starts = numbered.groupBy("doc_id", "kind").agg(F.min("position").alias("_start"))
    return numbered.join(starts, ["doc_id", "kind"]).withColumn("rank", F.col("position") - F.col("_start"))


def list_parts(
    entries: DataFrame, first: int = 0, last: int | None = None, part_entries: int = HOT_ROWS
) -> DataFrame:
    """Lists as a view of ranked entries: (doc_id, part, five lists) of parts ``first`` to ``last``.

    Part p of a document holds the entries of rank p * part_entries and following of each kind. Where
    ``entries`` is a written table, the bounds on the rank are pushed to its scan.
    """
    rows = entries.where(F.col("rank") >= first * part_entries)
    if last is not None:
        rows = rows.where(F.col("rank") < (last + 1) * part_entries)
    part = F.floor(F.col("rank") / part_entries).cast("int").alias("part")
    entry = F.struct("rank", "name", "entity_id", "score")
    gathered = rows.select("doc_id", "kind", part, entry.alias("entry")).repartition("doc_id", "part").groupBy("doc_id", "part").agg(
        *[F.collect_list(F.when(F.col("kind") == k, F.col("entry"))).alias(k) for k in KINDS]
    )
    plain = {
        k: F.transform(F.sort_array(k), lambda e: F.struct(e["name"], e["entity_id"], e["score"])) for k in KINDS
    }
    return gathered.select("doc_id", "part", *[c.alias(n) for n, c in plain.items()])


def gather(
    rows: DataFrame, lists: dict[str, Column], part_entries: int | None = HOT_ROWS
) -> DataFrame:
    """Lists of (name, entity_id, score) per document: highest score first, then name, id.

    The key is (doc_id, part), as in ``list_parts``; every document has a part 0 and most have no
    other. Documents with ``part_entries`` entries at most are gathered at once, without ranks;
    larger ones by their ranked entries. Both give the same rows.
    """
    hot = hot_keys(rows, "doc_id", part_entries)
    if hot is None:
        return _gather(rows, lists).withColumn("part", F.lit(0))
    keys = hot.select("doc_id")
    ordinary = _gather(rows.join(keys, "doc_id", "left_anti"), lists)
    entries = rows.join(keys, "doc_id", "left_semi").select("kind", "doc_id", "name", "entity_id", "score")
    part = F.floor(F.col("rank") / F.lit(part_entries)).cast("int").alias("part")
    stretches = _ranked_by_range(entries).select("kind", "doc_id", "name", "entity_id", "score", part)
    return append(ordinary.withColumn("part", F.lit(0)), _gather(stretches, lists, "part"))


def _gather(rows: DataFrame, lists: dict[str, Column], *part: str, placed: bool = False) -> DataFrame:
    # Ascending order of the negated score puts the highest score first.
    entry = F.struct((-F.col("score")).alias("minus"), "name", "entity_id")
    # Collecting does not shrink the rows, so they are shuffled before it, not after; a
    # join of the lists by document needs no further shuffle.
    rows = rows if placed else rows.repartition("doc_id", *part)
    gathered = rows.groupBy("doc_id", *part).agg(
        *[F.collect_list(F.when(condition, entry)).alias(name) for name, condition in lists.items()]
    )
    plain = {
        name: F.transform(
            F.sort_array(name),
            lambda e: F.struct(e["name"], e["entity_id"], (-e["minus"]).alias("score")),
        )
        for name in lists
    }
    return gathered.select("doc_id", *part, *[c.alias(n) for n, c in plain.items()])


def entity_lists(facts: DataFrame, part_entries: int | None = HOT_ROWS) -> DataFrame:
    """One ranked list per kind for each document, in columns named after the kinds."""
    return gather(facts, {k: F.col("kind") == k for k in KINDS}, part_entries)


def colocated_publications(
    docs: DataFrame, dims: dict[str, DataFrame], facts: DataFrame, how: str = "inner"
) -> DataFrame:
    """Publications with their lists, from tables bucketed by document with the same number of buckets.

    All joins, distinct rows and lists find the rows of a document in one place: nothing is shuffled.
    For documents whose entries one task can gather; others are for ``with_entity_lists``.
    """
    pubs = docs.select("doc_id").distinct()
    for name, dim in dims.items():
        pubs = pubs.join(dim.select("doc_id", name).distinct().hint("merge"), "doc_id", how)
    lists = _gather(facts, {k: F.col("kind") == k for k in KINDS}, placed=True)
    empty = {k: F.coalesce(F.col(k), F.array().cast(lists.schema[k].dataType)) for k in KINDS}
    return pubs.join(lists.hint("merge"), "doc_id", "left").withColumns(empty).withColumn("part", F.lit(0))


def with_entity_lists(
    pubs: DataFrame, facts: DataFrame, part_entries: int | None = HOT_ROWS
) -> DataFrame:
    """Publications with their five entity lists; empty lists where there are none."""
    lists = entity_lists(facts, part_entries)
    empty = {k: F.coalesce(F.col(k), F.array().cast(lists.schema[k].dataType)) for k in KINDS}
    joined = pubs.join(lists, "doc_id", "left").withColumns(empty)
    return joined.withColumn("part", F.coalesce("part", F.lit(0)))


def encode_lists(pubs: DataFrame) -> DataFrame:
    """Text form of the five lists."""
    return pubs.withColumns({k: encode_list(F.col(k)) for k in KINDS})


def unite_parts(encoded: DataFrame) -> DataFrame:
    """One row per document of encoded publications: the texts of its parts, joined in their order.

    Parts are encoded where they are gathered; a document's texts alone come to one task, as its row must.
    Copies of a row count once.
    """
    own = [c for c in encoded.columns if c not in ("part", *KINDS)]
    parts = encoded.groupBy(*own).agg(F.sort_array(F.collect_set(F.struct("part", *KINDS))).alias("_parts"))
    # Lists that end in an earlier part are blank in the later ones.
    whole = {k: F.array_join(F.filter(f"_parts.{k}", lambda t: t != ""), ENTRY_SEPARATOR) for k in KINDS}
    return parts.select(*own, *[c.alias(k) for k, c in whole.items()])


def decode_lists(
    pubs: DataFrame, selected: list[tuple[str, str]] | None = None, part_entries: int = HOT_ROWS
) -> DataFrame:
    """One row per list entry of encoded publications, with band, link and selection flag.

    ``selected`` holds (kind, name or id) pairs chosen in a query. ``rank`` counts through all parts
    of a document; ``part_entries`` is what the lists were made with.
    """
    part = F.col("part") if "part" in pubs.columns else F.lit(0)
    kinds = F.explode(
        F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("text")) for k in KINDS])
    )
    entries = pubs.select("doc_id", part.alias("part"), kinds.alias("list")).select(
        "doc_id",
        "part",
        F.col("list.kind").alias("kind"),
        F.posexplode(decode_list(F.col("list.text"))).alias("place", "entity"),
    )
    rank = (F.col("part").cast("long") * part_entries + F.col("place")).alias("rank")
    rows = entries.select("doc_id", "kind", rank, "entity.*")
    chosen = reduce(
        Column.__or__,
        [
            (F.col("kind") == k) & ((F.col("name") == v) | (F.col("entity_id") == v))
            for k, v in selected or []
        ],
        F.lit(False),
    )
    return rows.withColumns(
        {
            "band": score_band(F.col("score")),
            "link": link_out(F.col("kind"), F.col("entity_id")),
            "is_selected": chosen,
        }
    )
