"""Small hand-made rows for the rules of each operator."""

from collections import Counter

from pyspark.sql import functions as F

from annolink.operators import clean, combine, label, publications, stats
from annolink.operators.tagging import tag_documents
from annolink.plans import jobs

MENTIONS = "kind string, doc_id string, entity_id string, score int"
LABELS = "kind string, entity_id string, name string"


def test_labels(spark, rows):
    mentions = spark.createDataFrame([("genes", "1", "675", 5), ("genes", "1", "0", 5), ("species", "1", "675", 5)], MENTIONS)
    labels = spark.createDataFrame([("genes", "675", "BRCA2"), ("species", "675", "Homo"), ("species", "1", "Homo sapiens")], LABELS)
    assert rows(label.label(mentions, labels)) == [("genes", "1", "BRCA2", "675", 5), ("species", "1", "Homo", "675", 5)]
    assert rows(label.readable_labels(labels), "name") == [("BRCA2",), ("Homo sapiens",)]


def test_whitelist_and_multiplicity(spark, rows):
    mentions = spark.createDataFrame([("species", "1", "9606", 5), ("species", "1", "9605", 5), ("genes", "1", "9606", 5)], MENTIONS)
    taxonomy = spark.createDataFrame([("Homo sapiens", "9606"), ("human being", "9606"), ("Homo", "9605")], "name string, taxon_id string")
    names = spark.createDataFrame([("Homo sapiens",), ("human being",), ("Homo",), ("Homo sapiens",)], "name string")
    assert rows(label.whitelist_species(mentions, names, taxonomy), "entity_id") == [("9606",)]
    assert rows(label.whitelist_species(mentions, names, taxonomy, True), "entity_id") == [("9606",)] * 2
    assert label.apply_whitelist(mentions, names, taxonomy).count() == 2


def test_combinations(spark):
    mentions = [("genes", "1", "a", 5), ("genes", "1", "a", 5), ("species", "1", "s", 4), ("species", "1", "t", 3), ("terms_do", "2", "d", 9)]
    wide = combine.combine_kinds(spark.createDataFrame(mentions, MENTIONS))
    got = Counter((r["doc_id"], r["gene_id"], r["species_id"], r["do_id"], r["do_score"]) for r in wide.collect())
    assert got == {("1", "a", "s", None, None): 2, ("1", "a", "t", None, None): 2, ("2", None, None, "d", 9): 1}
    assert len(wide.columns) == 11


def test_unlabelled_id_kills_its_rows_only(spark):
    mentions = [("genes", "1", "a", 5), ("genes", "1", "old", 5), ("species", "1", "s", 4), ("genes", "2", "old", 5), ("species", "2", "s", 4)]
    labels = spark.createDataFrame([("genes", "a", "A"), ("species", "s", "S t")], LABELS)
    wide = combine.label_wide(spark.createDataFrame(mentions, MENTIONS), labels)
    assert [(r["doc_id"], r["gene_name"], r["species_name"]) for r in wide.collect()] == [("1", "A", "S t")]
    searched = clean.with_search_columns(wide).first()
    assert (searched["gene_search"], searched["go_search"]) == ("a", "")
    assert len(clean.with_search_columns(wide).columns) == 21


def test_publications_drop_or_keep(spark, rows):
    docs = spark.createDataFrame([("1",), ("2",), ("1",)], "doc_id string")
    dims = {
        "pmid": spark.createDataFrame([("1", "11"), ("1", "11")], "doc_id string, pmid string"),
        "year": spark.createDataFrame([("1", ""), ("2", "2011")], "doc_id string, year string"),
    }
    assert rows(publications.publications(docs, dims)) == [("1", "11", "")]
    assert rows(publications.publications(docs, dims, "left")) == [("1", "11", ""), ("2", None, "2011")]


def test_lists_and_decoding(spark, rows):
    schema = "kind string, doc_id string, name string, entity_id string, score int"
    facts = spark.createDataFrame([("genes", "1", "b", "2", 5), ("genes", "1", "a", "1", 5), ("genes", "1", "c", "3", 9)], schema)
    pubs = spark.createDataFrame([("1", "t"), ("2", "u")], "doc_id string, title string")
    table = publications.encode_lists(publications.with_entity_lists(pubs, facts))
    got = {r["doc_id"]: (r["genes"], r["species"], r["part"]) for r in table.collect()}
    assert got == {"1": ("c@!@3@!@9#!#a@!@1@!@5#!#b@!@2@!@5", "", 0), "2": ("", "", 0)}
    entries = publications.decode_lists(table, [("genes", "a"), ("species", "b")])
    assert rows(entries, "doc_id", "kind", "rank", "name", "band", "is_selected") == [
        ("1", "genes", 0, "c", 5, False), ("1", "genes", 1, "a", 5, True), ("1", "genes", 2, "b", 5, False),
    ]


def test_valid_rows(spark):
    data = [("PMC1", "a", None), ("PMC1", "", ""), ("PMC1", None, None), ("PMCx", "a", "1"), ("1", "a", "1"), ("PMC2", "", "7")]
    df = spark.createDataFrame(data, "doc_id string, name string, entity_id string")
    assert sorted(r["doc_id"] for r in clean.valid_rows(df).collect()) == ["PMC1", "PMC2"]


def test_top_entities_ties_and_taxon(spark):
    facts = spark.createDataFrame([("genes", str(i), e, 5) for i, e in enumerate(["9", "9", "10", "10", "7"])], MENTIONS)
    assert [r["entity_id"] for r in stats.top_entities(facts, "genes", 2).collect()] == ["9", "10"]
    accepted = spark.createDataFrame([("7",), ("10",)], "entity_id string")
    assert [r["entity_id"] for r in stats.top_entities(facts, "genes", 2, accepted).collect()] == ["10", "7"]


def test_cut_value(spark):
    def cut(values, n, m):
        df = spark.createDataFrame([(v,) for v in values], "score int")
        return [r[0] for r in stats.cut_value(df, "score", n, m).collect()]

    def expected(values, n, m):
        ordered = sorted(values, reverse=True)
        return [ordered[max(1, sum(v != 1 for v in values) * n // m) - 1]]

    for values in ([5, 3, 1, 1, 9], [1, 1], [7], [-5, 70000, 65536, 65535, 0, 0, 1, 131072, -70000], list(range(50)) * 3):
        for n, m in ((1, 2), (1, 4), (3, 4)):
            assert cut(values, n, m) == expected(values, n, m), (values, n, m)


def test_corpus_stats_strict_ids(spark):
    facts = spark.createDataFrame([("genes", "1", "7", 5), ("genes", "2", "12", 5), ("terms_do", "3", "DOID:1", 5), ("terms_go", "3", "GO:1", 5)], MENTIONS)
    def figures(strict):
        return {r["figure"]: r["value"] for r in stats.corpus_stats(facts, strict).collect()}
    assert figures(False)["publications"] == figures(True)["publications"] == 3
    assert (figures(False)["distinct genes"], figures(True)["distinct genes"]) == (2, 1)
    assert (figures(False)["publications with genes"], figures(True)["publications with genes"]) == (2, 1)
    assert figures(True)["publications with terms"] == 1 and figures(True)["distinct ontology terms"] == 2


def test_year_histogram(spark):
    a = spark.createDataFrame([("2009",), ("2011",), ("",), (None,), ("20",)], "year string")
    b = spark.createDataFrame([("2013",)], "year string")
    got = {r["year"]: (r["n_a"], r["n_b"]) for r in stats.year_histogram(a, b, max_year=2012).collect()}
    assert got == {"2009": (1, 0), "2010": (0, 0), "2011": (1, 0), "2012": (0, 0), "2013": (0, 1), "no e-publication date": (2, 0), "other": (1, 0)}
    alone = stats.year_histogram(b, max_year=2011).collect()
    assert [r["year"] for r in sorted(alone)] == ["2011", "2012", "2013"]


def test_overlap_leaves_out_blank(spark):
    a = spark.createDataFrame([("x",), ("x",), ("",), ("y",)], "doi string")
    b = spark.createDataFrame([("x",), ("",), ("z",), (None,)], "doi string")
    assert tuple(stats.overlap(a, b, "doi").first()) == (1, 1, 1)


def test_recode_and_dates(spark, rows):
    df = spark.createDataFrame([("Myc", "fly", "Myc"), ("Myc", "mouse", "Myc")], "gene string, species string, symbol string")
    mapping = spark.createDataFrame([("Myc", "fly", "dm")], "gene string, species string, value string")
    assert rows(clean.recode(df, mapping, ["gene", "species"], "symbol"), "symbol") == [("Myc",), ("dm",)]
    dates = spark.createDataFrame([("1899-12-31",), ("1900-01-01",), ("2009-02-05",), ("2009-02-06",)], "date string")
    assert rows(clean.published_until(dates, "2009-02-05")) == [("1900-01-01",), ("2009-02-05",)]


def test_tagging(spark, rows, monkeypatch):
    docs = spark.createDataFrame([("1", "Breast cancer; breast-cancer, and BRCA2!"), ("2", ""), ("3", None), ("4", "cancer")], "doc_id string, text string")
    names = [("terms_do", "D1", "breast cancer"), ("terms_do", "D2", "Cancer"), ("genes", "675", "BRCA2"), ("genes", "1", "breast cancer breast cancer and")]
    names = spark.createDataFrame(names, LABELS)
    want = [("genes", "1", "1", 1), ("genes", "1", "675", 1), ("terms_do", "1", "D1", 2), ("terms_do", "1", "D2", 2), ("terms_do", "4", "D2", 1)]
    assert rows(tag_documents(docs, names)) == want
    monkeypatch.setattr("annolink.operators.tagging.fits_broadcast", lambda df: False)
    assert rows(tag_documents(docs, names)) == want
    assert rows(tag_documents(docs, names, max_words=4)) == want[1:]


def test_jobs(spark, tmp_path):
    raw = [("genes", "J-1--10", "675", "5"), ("genes", "10", "0", "5"), ("species", "10", "9606", "4"),
           ("species", "11", "9606", "9"), ("terms_go", "12", "GO:9", "9"), ("terms_do", "10", "D", "2")]
    raw = spark.createDataFrame(raw, "kind string, doc_raw string, entity_id string, score string")
    names = spark.createDataFrame([("Homo sapiens",)], "name string")
    taxonomy = spark.createDataFrame([("Homo sapiens", "9606")], "name string, taxon_id string")
    labels = spark.createDataFrame([("genes", "675", "BRCA2"), ("species", "9606", "Homo sapiens")], LABELS)
    dims = {"year": spark.createDataFrame([("10", "2011"), ("12", "2012")], "doc_id string, year string")}
    tables = jobs.build_corpus(raw, names, taxonomy, labels, dims, str(tmp_path / "corpus"))
    assert sorted(r[0] for r in tables["document_ids"].collect()) == ["10", "11"]
    # Document 12 has no labelled entity any more, but it is still a publication.
    pubs = spark.read.parquet(str(tmp_path / "corpus" / "publications"))
    assert {r["doc_id"]: (len(r["genes"]), len(r["species"])) for r in pubs.collect()} == {"10": (1, 1), "12": (0, 0)}
    wide = jobs.build_wide(raw, names, taxonomy, labels, search_columns=True).collect()
    assert sorted((r["doc_id"], r["gene_search"], r["species_id"]) for r in wide) == [("10", "brca2", "9606"), ("11", "", "9606")]
    one = spark.createDataFrame([("x", "2011"), ("y", "2012")], "doi string, year string")
    compared = jobs.compare_services(one, one.where(F.col("doi") == "x"), 2011, 2012)
    assert tuple(compared["overlap"].first()) == (1, 0, 1)
    assert compared["years"].count() == 2
    assert {r["source"]: r["n"] for r in compared["totals"].collect()} == {"in_a": 2, "in_b": 1}
