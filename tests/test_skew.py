"""The paths for hot keys give the same rows as the ordinary ones."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from annolink import schemas
from annolink.fixed_values import KINDS
from annolink.operators import combine, publications, search, skew
from annolink.operators.batches import assign_batches
from annolink.operators.label import label

MENTIONS = "kind string, doc_id string, entity_id string, score int"


def mentions(spark):
    """Document 'big' holds most rows, many of them copies; 'bare' has one kind only."""
    data = [("genes", "big", str(i % 7), 5 + i % 3) for i in range(30)]
    data += [("species", "big", "9606", 4)] * 20
    data += [("terms_do", "big", f"DOID:{i}", 3) for i in range(4)]
    data += [("genes", "small", "675", 9), ("terms_go", "small", "GO:1", 3), ("terms_go", "small", "GO:2", 3)]
    data += [("terms_chebi", "bare", "CHEBI:1", 7)]
    return spark.createDataFrame(data, MENTIONS)


def bag(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_combine_hot_equals_ordinary(spark):
    df = mentions(spark)
    ordinary = bag(combine.combine_kinds(df, None))
    assert sum(ordinary.values()) == 30 * 20 * 4 + 2 + 1
    assert bag(combine.combine_kinds(df, 10)) == ordinary


def test_label_wide_hot_equals_ordinary(spark):
    df = mentions(spark)
    labels = [("genes", str(i), f"gene {i}") for i in range(5)] + [("species", "9606", "Homo sapiens")]
    labels += [("terms_do", f"DOID:{i}", f"disease {i}") for i in range(3)]
    labels += [("terms_go", "GO:1", "term"), ("genes", "675", "BRCA2")]
    labels = spark.createDataFrame(labels, "kind string, entity_id string, name string")
    ordinary = bag(combine.label_wide(df, labels, None))
    # 'bare' dies: its only term has no label.
    assert {r[df_index(combine.label_wide(df, labels, None), "doc_id")] for r in ordinary} == {"big", "small"}
    assert bag(combine.label_wide(df, labels, 10)) == ordinary


def df_index(df, column):
    return sorted(df.columns).index(column)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_publications_hot_equals_ordinary(spark, how):
    docs = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "doc_id string")
    titles = [("a", f"title {i % 5}") for i in range(50)] + [("b", "x"), ("b", "x"), ("d", "y")]
    dims = {
        "title": spark.createDataFrame(titles, "doc_id string, title string"),
        "year": spark.createDataFrame([("a", "1"), ("a", "2"), ("b", ""), ("c", "3")], "doc_id string, year string"),
    }
    ordinary = bag(publications.publications(docs, dims, how, None))
    assert sum(ordinary.values()) == 10 + 1 + (how == "left")
    assert set(ordinary.values()) == {1}
    assert bag(publications.publications(docs, dims, how, 10)) == ordinary


def test_gather_parts_hold_the_whole_list_in_order(spark):
    facts = mentions(spark).withColumn("name", F.concat(F.lit("n"), "entity_id"))
    whole = {r["doc_id"]: r for r in publications.entity_lists(facts, None).collect()}
    parted = sorted(publications.entity_lists(facts, 10).collect(), key=lambda r: (r["doc_id"], r["part"]))
    assert {r["doc_id"]: r["part"] for r in parted if r["doc_id"] != "big"} == {"small": 0, "bare": 0}
    big = [r for r in parted if r["doc_id"] == "big"]
    # 30 genes, 20 species, 4 terms: three parts, numbered from 0, whatever the partitioning.
    assert [r["part"] for r in big] == [0, 1, 2]
    assert [[len(r[k]) for k in ("genes", "species", "terms_do")] for r in big] == [[10, 10, 4], [10, 10, 0], [10, 0, 0]]
    again = publications.entity_lists(facts.repartition(3), 10).collect()
    assert sorted(again, key=lambda r: (r["doc_id"], r["part"])) == parted
    for kind in KINDS:
        assert [e for r in big for e in r[kind]] == whole["big"][kind]


def test_a_document_query_counts_documents_not_parts(spark):
    rows = [("genes", d, f"g{i}", str(i), i) for d in ("A", "B") for i in range(30)]
    facts = spark.createDataFrame(rows, schemas.FACTS)
    pubs = spark.createDataFrame([("A", "a"), ("B", "b")], "doc_id string, title string")
    clauses = {"gene_name": ["g29"]}
    found = {}
    for size in (10, None):
        listed = publications.with_entity_lists(pubs, facts, size)
        got = search.find_documents(facts, listed, clauses).collect()
        assert {r["total"] for r in got} == {2} and {r["doc_id"] for r in got} == {"A", "B"}
        assert len(got) == (6 if size else 2)
        found[size] = {d: [e for r in got if r["doc_id"] == d for e in r["genes"]] for d in "AB"}
        second = search.find_documents(facts, listed, clauses, offset=1, limit=1).collect()
        assert {r["doc_id"] for r in second} == {"B"} and sum(len(r["genes"]) for r in second) == 30
    assert found[10] == found[None]
    parts = search.documents_of(facts, ["1", "2"], hot_rows=1).collect()
    assert {r["doc_id"] for r in parts if r["part"] == 0} == {"A", "B"} and len(parts) == 4


def test_number_copies_keeps_every_row(spark):
    df = spark.createDataFrame([("a", 1)] * 25 + [("b", None)] * 2, "x string, y int")
    numbered = skew.number_copies(df, chunk=10)
    assert bag(numbered.drop("copy")) == bag(df)
    assert numbered.distinct().count() == 27


def test_hot_keys(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2, "k string")
    assert [r["k"] for r in skew.hot_keys(df, "k", 3).collect()] == ["a"]
    assert skew.hot_keys(df, "k", 5) is None
    assert skew.hot_keys(df, "k", None) is None


def test_fits_broadcast(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "k string")
    assert skew.fits_broadcast(df, 10 * 116)
    assert not skew.fits_broadcast(df, 10 * 116 - 1)
    assert skew.fits_broadcast(df.limit(0), 0)


def test_position_numbers_all_rows(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("v")).repartition(7)
    got = skew.with_position(df, "v").collect()
    assert all(r["position"] == r["v"] for r in got) and len(got) == 1000


def test_batches(spark):
    df = spark.createDataFrame([("s0", i) for i in range(7)] + [("s1", i) for i in range(4)], "source string, doc_id int")
    got = {(r["source"], r["doc_id"]): r["batch"] for r in assign_batches(df, ["source", "doc_id"], 5).collect()}
    order = sorted(got)
    assert [got[k] for k in order] == [i // 5 for i in range(11)]


def test_hot_entity_is_split_in_the_label_join(spark):
    """With sizes scaled down, adaptive execution splits the partition of a hot entity."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.xxhash64("id") % 2 == 0
        entity = F.when(hot, F.lit(7)).otherwise(F.col("id") % 1000).cast("string")
        rows = spark.range(200_000).select(
            F.lit("genes").alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("doc_id"),
            entity.alias("entity_id"), F.lit(3).alias("score"),
        ).repartition(8, "doc_id")
        labels = spark.range(1000).select(
            F.lit("genes").alias("kind"), F.col("id").cast("string").alias("entity_id"),
            F.concat(F.lit("gene "), F.col("id").cast("string")).alias("name"),
        )
        counted = label(rows, labels).groupBy("doc_id").agg(F.count("*").alias("n"))
        assert len(counted.collect()) == 200_000
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
