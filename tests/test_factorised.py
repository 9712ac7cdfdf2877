"""Factorised rows stand for the same combinations as the rows written out."""

from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from annolink.fixed_values import KINDS
from annolink.operators import combine, factorised, publications

FIELDS = ["entity_id", "score"]
SCHEMA = "kind string, doc_id string, entity_id string, score int, alive boolean"
NAMES = list(KINDS)


def entries():
    rows = [(k, "big", f"{k}{i}", i, True) for k, n in zip(NAMES, (9, 4, 0, 7, 3), strict=True) for i in range(n)]
    rows += [("genes", "big", "genes0", 0, True)] * 2 + [("genes", "big", "dead", 1, False)]
    rows += [("genes", "one", "g", 5, True), ("genes", "dies", "g", 5, True), ("species", "dies", "s", 1, False)]
    rows += [("terms_do", None, "d", 2, True), ("species", "null", None, None, True), ("species", "null", "s", 3, True)]
    return rows


def reference(rows, required=False):
    out = Counter()
    for doc in {r[1] for r in rows}:
        lists = {k: [r for r in rows if r[1] == doc and r[0] == k] for k in NAMES}
        alive = {k: [(r[2], r[3]) for r in v if r[4]] for k, v in lists.items()}
        if any((required or lists[k]) and not alive[k] for k in NAMES):
            continue
        for combination in product(*[alive[k] or [None] for k in NAMES]):
            out[(doc, combination)] += 1
    return out


def written(cells):
    return Counter((r.doc_id, tuple(r[k] and tuple(r[k]) for k in NAMES)) for r in factorised.expand(cells, NAMES).collect())


@pytest.mark.parametrize("hot_rows", [None, 6])
@pytest.mark.parametrize("cell_rows", [1, 5, 100, 65_536])
def test_cells_hold_every_combination_once(spark, hot_rows, cell_rows):
    df = spark.createDataFrame(entries(), SCHEMA)
    cells = factorised.factorise(df, NAMES, FIELDS, hot_rows, cell_rows)
    want = reference(entries())
    rows = cells.collect()
    assert written(cells) == want
    assert max(r.n_rows for r in rows) <= cell_rows and sum(r.n_rows for r in rows) == sum(want.values())
    assert len({(r.doc_id, r.cell) for r in rows}) == len(rows)
    totals = Counter(d for d, _ in want.elements())
    assert {r.doc_id: int(r.n_rows) for r in factorised.combination_counts(cells).collect()} == totals


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_required_kinds(spark, hot_rows):
    rows = [r for r in entries() if r[0] in NAMES[:2]]
    cells = factorised.factorise(spark.createDataFrame(rows, SCHEMA), NAMES[:2], FIELDS, hot_rows, 4, required=True)
    assert {r.doc_id for r in cells.collect()} == {"big"}
    assert sum(r.n_rows for r in cells.collect()) == 11 * 4


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_a_large_document_is_dealt_evenly(spark, hot_rows):
    """20 x 20 x 20 x 20 x 20 combinations: counted without writing them, cut into cells over all tasks."""
    df = spark.range(100).select(
        F.element_at(F.array(*map(F.lit, NAMES)), (F.col("id") % 5 + 1).cast("int")).alias("kind"), F.lit("d").alias("doc_id"),
        F.col("id").cast("string").alias("entity_id"), F.lit(3).alias("score"), F.lit(True).alias("alive"),
    )
    cells = factorised.factorise(df, NAMES, FIELDS, hot_rows).cache()
    sizes = [r.n_rows for r in cells.collect()]
    assert sum(sizes) == 20**5 and max(sizes) <= factorised.CELL_ROWS and min(sizes) > max(sizes) / 4
    # No task has more than twice its share of 64 cells over four partitions.
    tasks = Counter(r[0] for r in cells.select(F.spark_partition_id()).collect())
    assert len(tasks) >= 2 and max(tasks.values()) <= 2 * len(sizes) / len(tasks) + 4
    assert factorised.expand(cells, NAMES).count() == 20**5
    kept = factorised.keep_entries(cells, NAMES, "species", lambda e: e["entity_id"] == "1")
    assert int(factorised.combination_counts(kept).first().n_rows) == 20**4
    counts = factorised.entry_counts(kept, NAMES, "entity_id").collect()
    assert {(r.kind, int(r.n_rows)) for r in counts} == {("species", 20**4)} | {(k, 20**3) for k in NAMES if k != "species"}


def test_filters_and_search_copies(spark):
    df = spark.createDataFrame(entries(), SCHEMA)
    named = df.where("alive").withColumn("name", F.concat(F.lit("Name "), "entity_id"))
    cells = factorised.factorise(named, NAMES, ["name", *FIELDS], None, 20)
    cells = combine.with_search_fields(cells)
    kept = factorised.keep_entries(cells, NAMES, "genes", lambda e: e["search"].endswith("genes0"))
    rows = combine.wide_with_search(kept).collect()
    assert {(r.gene_id, r.gene_search) for r in rows} == {("genes0", "name genes0")}
    assert len(rows) == 3 * 4 * 7 * 3 and {r.go_search for r in rows} == {""}


def test_ranked_entries_and_parts(spark):
    rows = [("genes", "big", f"n{i % 3}", str(i), i % 4) for i in range(30)] + [("genes", "big", "n", "7", 3)] * 5
    rows += [("species", "big", None, "9", 2), ("terms_go", "small", "x", "GO:1", 3), ("genes", "small", "y", "1", 1)]
    facts = spark.createDataFrame(rows, "kind string, doc_id string, name string, entity_id string, score int")
    order = sorted(rows, key=lambda r: (r[1], r[0], -r[4], r[2] or "", r[3]))
    want, place = [], Counter()
    for k, d, name, e, score in order:
        want.append((d, k, place[d, k], name, e, score))
        place[d, k] += 1
    for hot in (None, 10):
        got = sorted(map(tuple, publications.ranked_entries(facts, hot).collect()), key=lambda r: r[:3])
        assert got == want
    entries = publications.ranked_entries(facts)
    parts = sorted(publications.list_parts(entries, part_entries=10).collect(), key=lambda r: (r.doc_id, r.part))
    assert parts == sorted((r for r in publications.entity_lists(facts, 10).select("doc_id", "part", *NAMES).collect()), key=lambda r: (r.doc_id, r.part))
    second = publications.list_parts(entries, 1, 2, 10).collect()
    assert {(r.doc_id, r.part, len(r.genes)) for r in second} == {("big", 1, 10), ("big", 2, 10)}
    encoded = publications.encode_lists(publications.entity_lists(facts, 10))
    decoded = publications.decode_lists(encoded, part_entries=10).collect()
    assert {(r.doc_id, r.kind, r["rank"]) for r in decoded} == {w[:3] for w in want} and len(decoded) == len(want)


def test_parts_united(spark):
    rows = [(k, "big", f"n{i % 7}", str(i), i % 4) for k, n in (("genes", 30), ("terms_do", 11)) for i in range(n)]
    rows += [("species", "big", None, "9", 2), ("terms_go", "small", "x", "GO:1", 3), ("genes", "small", "y", "1", 1)]
    facts = spark.createDataFrame(rows, "kind string, doc_id string, name string, entity_id string, score int")
    whole = publications.encode_lists(publications.entity_lists(facts, None)).drop("part")
    parts = publications.encode_lists(publications.entity_lists(facts, 10))
    titled = parts.withColumn("title", F.when(F.col("doc_id") == "big", "a"))
    united = publications.unite_parts(titled)
    assert parts.count() == 4 and united.columns == ["doc_id", "title", *NAMES]
    assert sorted(map(tuple, united.select("doc_id", *NAMES).collect())) == sorted(map(tuple, whole.select("doc_id", *NAMES).collect()))
    assert {(r.doc_id, r.title) for r in united.collect()} == {("big", "a"), ("small", None)}
