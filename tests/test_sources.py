import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from annolink import schemas
from annolink.operators import clean, search
from annolink.plans import jobs
from annolink.sources import readers, writers


def put(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_mentions(spark, tmp_path, rows):
    put(tmp_path, "BMC_A__genes.tsv", "BMC_Genomics-6--554113\t675\t5\n554114\t676\t\n")
    put(tmp_path, "BMC_A__terms_go.tsv", "554113\tGO:1\t3\n")
    put(tmp_path, "PLoS__species.tsv", "1\t9606\t\"4\n")
    put(tmp_path, "notes.tsv", "1\t2\t3\n")
    got = readers.read_mentions(spark, str(tmp_path))
    assert rows(got) == [
        ("genes", "BMC_A", "554114", "676", None),
        ("genes", "BMC_A", "BMC_Genomics-6--554113", "675", "5"),
        ("species", "PLoS", "1", "9606", '"4'),
        ("terms_go", "BMC_A", "554113", "GO:1", "3"),
    ]
    assert readers.read_mentions(spark, str(tmp_path), "BMC_*").count() == 3
    parsed = clean.cut_below(clean.parse_mentions(got))
    assert rows(parsed, "doc_id", "entity_id", "score") == [("554113", "675", 5), ("554113", "GO:1", 3)]


def test_id_rewrite_stays_in_its_column(spark, tmp_path, rows):
    put(tmp_path, "b__genes.tsv", "A-1\tx-22\t5\n")
    parsed = clean.parse_mentions(readers.read_mentions(spark, str(tmp_path)))
    assert rows(parsed) == [("genes", "1", "x-22", 5)]


def test_dictionaries(spark, tmp_path, rows):
    genes = put(tmp_path, "gene_names.tsv", "675\tBRCA2\n676\t5'-nucleotidase \"x\"\n")
    terms = put(tmp_path, "term_names.tsv", "GO:1\tcell\n")
    labels = readers.read_labels(spark, {"genes": genes, "terms": terms})
    assert rows(labels) == [
        ("genes", "675", "BRCA2"), ("genes", "676", "5'-nucleotidase \"x\""),
        ("terms_chebi", "GO:1", "cell"), ("terms_do", "GO:1", "cell"), ("terms_go", "GO:1", "cell"),
    ]
    dump = put(tmp_path, "names.dmp", "9606\t|\tHomo sapiens\t|\t\t|\tscientific name\t|\n")
    assert rows(readers.read_taxonomy(spark, dump)) == [("Homo sapiens", "9606")]
    species = put(tmp_path, "species", "Homo sapiens\tx\ty\nMus musculus\tx\n")
    assert rows(readers.read_species_dictionary(spark, species)) == [("Homo sapiens",), ("Mus musculus",)]
    taxon = put(tmp_path, "entrez_genes", "BRCA2\t9606|675\nBrca2\t10090|12190\n")
    genes = readers.read_gene_taxon(spark, taxon)
    assert rows(clean.for_taxon(genes, "9606")) == [("675",)]


def test_publications_and_lists(spark, tmp_path, rows):
    year = put(tmp_path, "year.tsv", "1\t2011\n2\t\n")
    dims = readers.read_publications(spark, {"year": year})
    assert rows(dims["year"]) == [("1", "2011"), ("2", "")]
    with pytest.raises(ValueError):
        readers.read_publications(spark, {"colour": year})
    index = put(tmp_path, "file_list.txt", "2011-01-01 header\na\tb\tPMC1\nc\td\tPMC2\te\nc\td\tPMC2\n")
    assert rows(readers.read_id_list(spark, index)) == [("PMC1",), ("PMC2",)]
    single = put(tmp_path, "single.tsv", "1\tBRCA2\n1\tBRCA2\n2\tcell\n")
    assert rows(readers.read_transactions(spark, single)) == [("1", "BRCA2"), ("2", "cell")]


def test_evaluation_table(spark, tmp_path):
    text = "\t".join(writers.EVALUATION_COLUMNS) + "\nAPC\tmice\tx\t7845\t79\t15\t64\t7830\t.189\t.001\t0\t.001\t1.000\n"
    row = readers.read_evaluation(spark, put(tmp_path, "eval.tsv", text)).first()
    assert row["gold"] == 7845 and float(row["precision"]) == 0.189 and float(row["fdr"]) == 1.0
    headed = writers.evaluation_headings(readers.read_evaluation(spark, str(tmp_path / "eval.tsv")))
    assert tuple(headed.columns) == writers.EVALUATION_COLUMNS


def facts(spark):
    data = [
        ("genes", "PMC1", "BRCA2", "675", 9), ("genes", "PMC2", "5'-nucleotidase", "12", 3),
        ("species", "PMC1", "Homo sapiens", "9606", 4), ("terms_go", "PMC1", "cell", "GO:0000001", 3),
    ]
    return spark.createDataFrame(data, schemas.FACTS)


def test_corpus_round_trip_and_refusal(spark, tmp_path, rows):
    path = str(tmp_path / "corpus")
    tables = {"facts": facts(spark), "document_ids": facts(spark).select("doc_id").distinct()}
    writers.write_corpus(tables, path)
    assert rows(readers.read_facts(spark, path)) == rows(facts(spark))
    with pytest.raises(AnalysisException):
        writers.write_corpus(tables, path)
    writers.write_corpus(tables, path, mode="overwrite")
    plan = readers.read_facts(spark, path).where(F.col("kind") == "genes")
    assert "PartitionFilters: [isnotnull(kind" in plan._jdf.queryExecution().toString()


def test_lookup_round_trip_prunes_files(spark, tmp_path, rows):
    path = str(tmp_path / "lookup")
    labelled = facts(spark).withColumn("doc_id", F.substring("doc_id", 4, 9))
    jobs.load_lookup(labelled.unionByName(labelled), path)
    lookup = readers.read_lookup(spark, path)
    hit = search.starts_with(lookup, "gene_name", "BR")
    assert rows(hit, "value", "doc_id", "score") == [("BRCA2", "PMC1", 9)]
    plan = hit._jdf.queryExecution().toString()
    partition_filters = plan.split("PartitionFilters: [")[-1].split("], PushedFilters")[0]
    assert "attr" in partition_filters and "first" in partition_filters
    assert "StartsWith" in plan.split("PushedFilters: [")[-1]
    assert rows(search.starts_with(lookup, "gene_name", "br", False), "value") == []
    assert rows(search.starts_with(lookup, "gene_name", "5'"), "prefix") == [("_other",)]
    assert rows(search.starts_with(lookup, "doc_id", "pmc"), "value") == [("PMC1",), ("PMC2",)]
    with pytest.raises(AnalysisException):
        jobs.load_lookup(labelled, path)
    strict = search.lookup_table(facts(spark), strict_prefix=True)
    assert strict.where("prefix = '_other'").count() == 0


def test_export(spark, tmp_path):
    from annolink.operators.publications import entity_lists

    df = spark.createDataFrame([("PMC1", 'a "b"', None, " x\ty "), ("PMC2", "", "z", "w")], "doc_id string, title string, doi string, note string")
    path = str(tmp_path / "out")
    writers.export_tsv(df.coalesce(1), path, readable_headers=True)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text == 'PMC ID\tTitle\tdoi\tnote\nPMC1\ta "b"\t\t x y \nPMC2\t\tz\tw\n'
    lists = entity_lists(facts(spark)).where("doc_id = 'PMC1'").select("doc_id", "genes", "terms_do").coalesce(1)
    writers.export_tsv(lists, str(tmp_path / "lists"))
    text = "".join(p.read_text() for p in (tmp_path / "lists").glob("*.csv"))
    assert text == "PMC1\tBRCA2@!@675@!@9\t\n"
