"""The published evaluation table: metrics follow from the counts."""

from pathlib import Path

from annolink.operators.evaluate import (
    as_decimals,
    confusion,
    evaluation_metrics,
    false_negatives,
    queried_symbols,
    with_query_terms,
)
from annolink.sources.readers import read_evaluation

# The published table as it stands, but for the name of the own service.
PATH = Path(__file__).parent / "data" / "evaluation_fixed_values.tsv"


def test_metrics_of_golden_rows(spark):
    golden = read_evaluation(spark, str(PATH))
    metrics = ("precision", "recall", "f1", "tpr", "fdr")
    key = ("gene", "species", "service")
    want = {tuple(r[k] for k in key): [r[m] for m in metrics] for r in golden.collect()}
    got = as_decimals(evaluation_metrics(golden.drop(*metrics))).collect()
    assert len(want) == 32
    assert {tuple(r[k] for k in key): [r[m] for m in metrics] for r in got} == want


def test_counts_from_document_sets(spark):
    ids = "query_key string, doc_id string"
    gold = spark.createDataFrame([("q", f"PMC{i}") for i in range(6)] + [("q", "PMC0"), ("none", "PMC1")], ids)
    found = spark.createDataFrame([("q", "PMC4"), ("q", "PMC5"), ("q", "PMC9"), ("other", "PMC1")], ids)
    got = {r["query_key"]: tuple(r)[1:] for r in confusion(gold, found, ["query_key"]).collect()}
    assert got == {"q": (6, 3, 2, 1, 4), "none": (1, 0, 0, 0, 1), "other": (0, 1, 0, 1, 0)}


def test_false_negatives_compare_whole_ids(spark):
    ids = "query_key string, doc_id string"
    gold = spark.createDataFrame([("q", "PMC12"), ("q", "PMC123")], ids)
    found = spark.createDataFrame([("q", "PMC12")], ids)
    assert [r["doc_id"] for r in false_negatives(gold, found, ["query_key"]).collect()] == ["PMC123"]


def test_symbols_as_queried(spark):
    rows = [("Myc", "drosophila+melanogaster"), ("Myc", "mice"), ("DCC", "drosophila+melanogaster"), ("Myc", "danio+rerio")]
    got = queried_symbols(spark.createDataFrame(rows, "gene string, species string")).collect()
    assert sorted((r["gene"], r["species"]) for r in got) == [
        ("dm", "drosophila+melanogaster"), ("fra", "drosophila+melanogaster"), ("myc", "mice"), ("myca", "danio+rerio"),
    ]


def test_query_terms(spark):
    rows = [("Myc", "drosophila+melanogaster"), ("BRCA2", "humans"), ("other", "mice"), ("APC", "cats")]
    got = {tuple(r)[:2]: tuple(r)[2:] for r in with_query_terms(spark.createDataFrame(rows, "gene string, species string")).collect()}
    assert got == {
        ("Myc", "drosophila+melanogaster"): ("dm", "dmelanogaster", "flybasename_gene", "31310"),
        ("BRCA2", "humans"): ("brca2", "hsapiens", "hgnc_symbol", "675"),
        ("other", "mice"): ("other", "mmusculus", "mgi_symbol", None),
        ("APC", "cats"): ("apc", None, None, None),
    }
