"""Rows are dealt to as many tasks as they need, whatever they hold."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from annolink import schemas
from annolink.operators import clean, factorised, postings, publications, search, skew
from annolink.sources import readers, writers

# What explain() shows for a number of tasks that adaptive execution keeps.
GIVEN = "REPARTITION_BY_NUM"
FACTS = [("genes", f"PMC{d}", "one", "7", s) for d in range(40) for s in (3, 4)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [skew.tasks_for(spark, n, 10) for n in (0, 10 * cores, 10 * cores + 1, 1000)] == [cores, cores, cores + 1, 100]


def test_distinct_rows_leave_the_place_of_a_join(spark):
    facts = spark.createDataFrame(FACTS, schemas.FACTS)
    names = spark.createDataFrame([("7", "x"), ("7", "x")], "entity_id string, label string")
    joined = facts.join(names.hint("merge"), "entity_id")
    got = skew.distinct_rows(joined, 6)
    assert GIVEN in plan(got) and got.rdd.getNumPartitions() == 6
    assert got.count() == len(FACTS)
    assert max(len(p) for p in got.rdd.glom().collect()) < len(FACTS)


def test_lookups_of_a_popular_entity(spark, rows):
    facts = spark.createDataFrame(FACTS * 2, schemas.FACTS)
    asked = spark.createDataFrame([("q", "genes", "7"), ("q", "genes", "7")], "query_key string, kind string, entity_id string")
    found = search.lookup_batch(facts, asked)
    lookup = search.lookup_table(facts)
    loaded = clean.loadable(facts.withColumn("doc_id", F.substring("doc_id", 4, 9)))
    assert all(GIVEN in plan(df) for df in (found, lookup, loaded))
    assert rows(found) == sorted(("q", f"PMC{d}") for d in range(40))
    # The name and the id of each fact, and the document.
    assert lookup.count() == 2 * len(FACTS) + 40
    assert loaded.count() == len(FACTS)


def test_facts_of_the_tables(spark, tmp_path):
    n = 30
    spark.range(n).selectExpr(
        "id % 10 as l_orderkey", "1L as l_partkey", "1L as l_suppkey", "3 as l_linenumber", "25.0D as l_quantity"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(2).selectExpr("id as p_partkey", "'n' as p_name", "'t' as p_type", "'b' as p_brand").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(2).selectExpr("id as s_suppkey", "'s' as s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    facts = entry.queries()["facts"](spark, str(tmp_path))
    assert GIVEN in plan(facts) and facts.count() == 10


def test_publications_are_dealt_by_rows(spark):
    docs = spark.createDataFrame([(f"{d}",) for d in range(5)], "doc_id string")
    dims = {c: docs.withColumn(c, F.lit(c)) for c in ("a", "b")}
    got = publications.publications(docs, dims)
    assert GIVEN in plan(got) and "REPARTITION_BY_COL" not in plan(got)
    assert got.count() == 5


def test_values_are_not_joined_for_the_postings(spark):
    facts = spark.createDataFrame(FACTS, schemas.FACTS)
    pubs = spark.createDataFrame([(f"PMC{d}", "x" if d % 2 else "") for d in range(50)], "doc_id string, doi string")
    words = postings.index_tables(facts, pubs)["postings"]
    # One join, which numbers the publications.
    assert plan(words).count("Join") == 1 and GIVEN in plan(words)
    n = {(r.attr, r.value): r.n for r in words.groupBy("attr", "value").agg(F.sum(F.bit_count("bits")).alias("n")).collect()}
    assert n["gene_name", "one"] == n["gene_id", "7"] == 40 and n["doc_id", "PMC3"] == 1
    assert n["filled", "doc_id"] == 50 and n["filled", "doi"] == 25


def test_small_documents_are_one_cell(spark):
    for kinds, cell_rows in itertools.product((1, 2, 3), (1, 2, 5, 9, 30)):
        small = factorised._small(kinds, cell_rows)
        sizes = [s for s in itertools.product(range(small + 1), repeat=kinds) if sum(s) <= small]
        assert all(math.prod(max(1, n) for n in s) <= cell_rows for s in sizes)
    schema = "kind string, doc_id string, entity_id string, alive boolean"
    df = spark.createDataFrame([(k, str(d), str(e), e < 2) for k in "ab" for d in range(6) for e in range(3)], schema)
    whole = factorised.factorise(df, ["a", "b"], ["entity_id"])
    # The lists are gathered once (two steps of one aggregate), not for whole and for cut documents.
    assert plan(whole).count("ObjectHashAggregate") <= 2
    cut = factorised.factorise(df, ["a", "b"], ["entity_id"], cell_rows=2)
    for cells in (whole, cut):
        assert cells.agg(F.sum("n_rows")).first()[0] == 6 * 4
    assert cut.count() == 12


@pytest.mark.parametrize("name", ["a b+c%d__x", "x__genes", "x__y"])
def test_batches_by_path(spark, tmp_path, rows, name):
    (tmp_path / f"{name}__genes.tsv").write_text("d1\t7\t3\n")
    (tmp_path / f"{name}__terms_do.tsv").mkdir()
    (tmp_path / f"{name}__terms_do.tsv" / "part-0__species.tsv").write_text("d2\t8\t4\n")
    (tmp_path / f"{name}__other.tsv").write_text("d3\t9\t5\n")
    read = readers.read_mentions(spark, str(tmp_path))
    assert rows(read) == [("genes", name, "d1", "7", "3"), ("terms_do", name, "d2", "8", "4")]
    assert "regexp" not in plan(read).lower() and "rlike" not in plan(read).lower()


def test_sorted_files_hold_so_many_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "FILE_ROWS", 10)
    writers.write_lookup(search.lookup_table(spark.createDataFrame(FACTS, schemas.FACTS)), str(tmp_path / "lookup"))
    sizes = readers.read_lookup(spark, str(tmp_path / "lookup")).groupBy("_metadata.file_path").count()
    assert sizes.agg(F.max("count")).first()[0] <= 30


def test_lookup_of_facts_that_are_not_written(spark):
    facts = spark.createDataFrame(FACTS * 2, schemas.FACTS)
    lookup = search.lookup_table(facts, n_facts=10**6)
    assert f"{GIVEN}, " in plan(lookup) and lookup.rdd.getNumPartitions() == 12
    assert lookup.count() == 2 * len(FACTS) + 40


@pytest.fixture
def no_broadcasts(spark):
    """Joins as they are of tables that Spark itself would not broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_mentions_of_a_popular_entity_are_not_sorted(spark, tmp_path, no_broadcasts, monkeypatch, rows):
    spark.range(30).selectExpr(
        "id % 10 as l_orderkey", "1L as l_partkey", "1L as l_suppkey", "3 as l_linenumber", "25.0D as l_quantity"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(2).selectExpr("id as p_partkey", "'n' as p_name", "'t' as p_type", "'b' as p_brand").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(2).selectExpr("id as s_suppkey", "'s' as s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    small = entry.queries()["facts"](spark, str(tmp_path))
    monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)
    large = entry.queries()["facts"](spark, str(tmp_path))
    assert "BroadcastHashJoin" in plan(small) and "ShuffledHashJoin" in plan(large)
    assert "SortMergeJoin" not in plan(small) + plan(large)
    assert rows(small) == rows(large) and small.count() == 10


def test_held_side(spark, no_broadcasts, monkeypatch):
    names = spark.createDataFrame([("7", "x")] * 3 + [("8", "y")], "entity_id string, label string")
    facts = spark.createDataFrame(FACTS, schemas.FACTS)

    def joined():
        return facts.join(skew.held_side(names, ["entity_id"]), "entity_id")

    assert "BroadcastHashJoin" in plan(joined())
    monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)
    assert "ShuffledHashJoin" in plan(joined())
    # A key with too many rows to be held is left to a join that can spill.
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    assert "SortMergeJoin" in plan(joined()) and joined().count() == 3 * len(FACTS)


def test_looked_up_facts_are_not_sorted(spark, no_broadcasts, monkeypatch, rows):
    facts = spark.createDataFrame(FACTS, schemas.FACTS)
    asked = spark.createDataFrame([("q", "genes", "7"), ("r", "genes", None)], "query_key string, kind string, entity_id string")
    joins = []
    monkeypatch.setattr(search, "stage", lambda df: joins.append(plan(df)) or df)
    assert rows(search.lookup_batch(facts, asked)) == sorted(("q", f"PMC{d}") for d in range(40))
    assert "SortMergeJoin" not in joins[0]


def test_files_of_a_batch_hold_a_number_of_rows(spark, tmp_path, monkeypatch, rows):
    facts = spark.createDataFrame(FACTS, schemas.FACTS).withColumn("batch", F.lit("b"))
    monkeypatch.setattr(writers, "FILE_ROWS", 20)
    writers.write_batches(facts, str(tmp_path / "t"))
    written = readers.read_batches(spark, str(tmp_path / "t"))
    assert rows(written) == rows(facts.select("batch", *schemas.FACTS.names))
    per_file = written.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) <= 2 * 20
