import pytest
from pyspark.sql import functions as F

from annolink import schemas
from annolink.operators import search

DATA = [
    ("genes", "PMC1", "BRCA2", "675", 9), ("genes", "PMC2", "BRCA1", "672", 3),
    ("genes", "PMC2", "brca2", "12190", 30), ("genes", "PMC3", "BRCA2", "675", 5),
    ("species", "PMC1", "Brassica rapa", "3711", 4), ("species", "PMC3", "Homo sapiens", "9606", 8),
    ("terms_go", "PMC1", "brain development", "GO:0007420", 3), ("terms_do", "PMC3", "breast cancer", "DOID:1612", 7),
    ("terms_do", "PMC1", "breast cancer", "DOID:1612", 40), ("terms_chebi", "PMC3", "bromine", "CHEBI:22927", 6),
]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(DATA, schemas.FACTS).cache()


@pytest.fixture(scope="module")
def lookup(facts):
    return search.lookup_table(facts).cache()


def hits(df):
    return sorted((r["attr"], r["value"]) for r in df.collect())


def test_suggestions_follow_the_routes(lookup):
    assert hits(search.suggest(lookup, " br ")) == [
        ("chebi_name", "bromine"), ("do_name", "breast cancer"), ("gene_name", "BRCA1"),
        ("gene_name", "BRCA2"), ("gene_name", "brca2"), ("go_name", "brain development"),
        ("species_name", "Brassica rapa"),
    ]
    assert hits(search.suggest(lookup, "go:00")) == [("go_id", "GO:0007420")]
    assert hits(search.suggest(lookup, "67")) == [("gene_id", "672"), ("gene_id", "675")]
    assert hits(search.suggest(lookup, "DOID")) == []
    assert hits(search.suggest(lookup, "DOID:")) == [("do_id", "DOID:1612")]
    assert hits(search.suggest(lookup, "PMC")) == [("doc_id", f"PMC{i}") for i in (1, 2, 3)]
    assert hits(search.suggest(lookup, "br", case_sensitive=True)) == [
        ("chebi_name", "bromine"), ("do_name", "breast cancer"), ("gene_name", "brca2"), ("go_name", "brain development"),
    ]
    assert hits(search.suggest(lookup, "  ")) == []
    assert hits(search.suggest(lookup, "b")) == []
    assert len(hits(search.suggest(lookup, "br", limit=1))) == 5


def test_batch_equals_single(spark, lookup):
    texts = ["br", "BRCA2", "go:00", "67", "DOID", "DOID:", "PMC", "PMC1", "  ", "b", " bro", "CHEBI:2", "x" * 600]
    batch = search.suggest_batch(lookup, spark.createDataFrame([(t,) for t in texts], "text string"), limit=2)
    got = {}
    for r in batch.collect():
        got.setdefault(r["text"], []).append((r["attr"], r["value"]))
    for text in texts:
        assert sorted(got.get(text.strip(" "), [])) == hits(search.suggest(lookup, text, limit=2)), text


def pubs(spark):
    return spark.createDataFrame([(f"PMC{i}", f"title {i}") for i in (1, 2, 3)], "doc_id string, title string")


def test_all_clauses_must_hold(spark, facts):
    def found(clauses, **options):
        rows = search.find_documents(facts, pubs(spark), clauses, **options).collect()
        return [(r["doc_id"], r["best_score"], r["total"]) for r in rows]

    assert found({"gene_name": ["BRCA2"]}) == [("PMC1", 9, 2), ("PMC3", 5, 2)]
    both = {"gene_name": ["BRCA2"], "do_id": ["DOID:1612"]}
    assert found(both) == [("PMC1", 9, 2), ("PMC3", 5, 2)]
    assert found(both, order_by_kind="terms_do") == [("PMC1", 40, 2), ("PMC3", 7, 2)]
    assert found(both, order_by_kind="terms_chebi") == found(both)
    assert found(both, offset=1, limit=1) == [("PMC3", 5, 2)]
    # Two values for one column: the document needs both; its best gene score counts.
    assert found({"gene_name": ["BRCA1", "brca2"]}) == [("PMC2", 30, 1)]
    assert found({"doc_id": ["PMC3"]}) == [("PMC3", None, 1)]
    assert found({"gene_name": ["BRCA2"], "doc_id": ["PMC3"]}) == [("PMC3", 5, 1)]
    assert found({"gene_name": ["none"]}) == []
    with pytest.raises(ValueError):
        found({})


def test_documents_of(facts):
    got = search.documents_of(facts, ["675", "672"]).collect()
    assert {r["doc_id"]: [tuple(e) for e in r["entities"]] for r in got} == {
        "PMC1": [("BRCA2", "675", 9)], "PMC2": [("BRCA1", "672", 3)], "PMC3": [("BRCA2", "675", 5)],
    }


def test_lookup_batch(spark, facts, rows):
    requests = [("a", "genes", "675"), ("b", "species", "9606"), ("c", "genes", "0")]
    requests = spark.createDataFrame(requests, "query_key string, kind string, entity_id string")
    assert rows(search.lookup_batch(facts, requests)) == [("a", "PMC1"), ("a", "PMC3"), ("b", "PMC3")]


def test_transactions(spark, facts, rows):
    human = spark.createDataFrame([("675",), ("672",)], "entity_id string")
    got = search.transactions(facts, n=1, accepted={"genes": human})
    assert rows(got) == [
        ("PMC1", "BRCA2"), ("PMC1", "brain development"), ("PMC1", "breast cancer"),
        ("PMC3", "BRCA2"), ("PMC3", "breast cancer"), ("PMC3", "bromine"),
    ]
