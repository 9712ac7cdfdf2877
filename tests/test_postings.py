"""Document queries on bitmaps against plain Python, and what their plans read."""

import random

import pytest
from pyspark.sql import functions as F

from annolink import schemas
from annolink.operators import postings, publications
from annolink.operators.skew import HOT_ROWS
from annolink.plans import jobs
from annolink.sources import readers


def test_words_and_numbers(spark):
    numbers = [0, 1, 63, 64, 127, 128, 1000, 10**12]
    df = spark.createDataFrame([(k, n) for k in "ab" for n in numbers[:: 1 + (k == "b")]], "k string, number long")
    words = postings.as_words(df, "k")
    assert words.count() == 5 + 4 - 1
    back = {(r.k, r.number) for r in postings.numbers_of(words).collect()}
    assert back == {(k, n) for k in "ab" for n in numbers[:: 1 + (k == "b")]}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    draw = random.Random(7)
    facts = []
    for d in range(300):
        for kind, names in (("genes", "abc"), ("species", "st"), ("terms_do", "xyz")):
            for _ in range(draw.randint(0, 3)):
                n = draw.choice(names)
                facts.append((kind, f"PMC{d}", f"Name {n}", f"{kind}:{n}", draw.randint(3, 6)))
    facts = sorted(set(facts))
    pubs = [(f"PMC{d}", "" if d % 5 == 0 else f"10.1/{d}", f"title {d}") for d in range(300) if d % 7]
    path = str(tmp_path_factory.mktemp("index") / "index")
    facts_table = spark.createDataFrame(facts, schemas.FACTS)
    pubs_table = spark.createDataFrame(pubs, "doc_id string, doi string, title string")
    jobs.load_index(facts_table, pubs_table, path)
    return facts, pubs, readers.read_index(spark, path)


def reference(facts, pubs, clauses, kind, filled=None):
    short = {"gene": "genes", "species": "species", "do": "terms_do"}
    hits = None
    for column, values in clauses.items():
        for v in values:
            name, _, field = column.rpartition("_")
            place = 2 if field == "name" else 3
            docs = {f[1] for f in facts if f[1] == v} if column == "doc_id" else {f[1] for f in facts if f[0] == short[name] and f[place] == v}
            hits = docs if hits is None else hits & docs
    dims = {p[0]: p for p in pubs}
    hits = [d for d in hits if d in dims and (filled is None or dims[d][1] != "")]
    best = {d: max((f[4] for f in facts if f[1] == d and f[0] == kind), default=None) for d in hits}
    return [(d, best[d], len(hits)) for d in sorted(hits, key=lambda d: (-(best[d] or 0), d))]


def shown(page):
    return [(r.doc_id, r.best_score, r.total) for r in page.collect()]


CASES = [
    ({"gene_name": ["Name a"]}, None, "genes"),
    ({"gene_name": ["Name a", "Name b"], "do_id": ["terms_do:x"]}, "terms_do", "terms_do"),
    ({"species_name": ["Name s"], "do_name": ["Name y"]}, "genes", "species"),
    ({"doc_id": ["PMC8"]}, None, None),
    ({"gene_name": ["none"]}, None, "genes"),
]


@pytest.mark.parametrize("clauses,wanted,kind", CASES)
def test_pages(corpus, clauses, wanted, kind):
    facts, pubs, index = corpus
    want = reference(facts, pubs, clauses, kind)
    assert shown(postings.find_page(index, clauses, wanted)) == want[:25]
    assert shown(postings.find_page(index, clauses, wanted, offset=3, limit=4)) == want[3:7]
    filled = reference(facts, pubs, clauses, kind, "doi")
    assert shown(postings.find_page(index, clauses, wanted, not_empty="doi", limit=400)) == filled


def test_every_page_by_its_token(corpus):
    facts, pubs, index = corpus
    clauses = {"gene_name": ["Name a"]}
    want, got, after = reference(facts, pubs, clauses, "genes"), [], None
    while page := shown(postings.find_page(index, clauses, after=after, limit=23)):
        got += page
        after = page[-1][1], page[-1][0]
    assert got == want and len(want) > 69


def test_tokens_reach_documents_without_a_score(spark, tmp_path):
    """The best score of a kind may be null: such documents come last and are on the pages behind a token."""
    facts = [("genes", f"PMC{d:03}", "Name a", "a", None if d % 3 == 0 else d % 5) for d in range(200)]
    facts += [("genes", f"PMC{d:03}", "Name b", "b", None) for d in range(0, 200, 2)]
    pubs = spark.createDataFrame([(f"PMC{d:03}", f"title {d}") for d in range(200)], "doc_id string, title string")
    jobs.load_index(spark.createDataFrame(facts, schemas.FACTS), pubs, str(tmp_path / "index"))
    index = readers.read_index(spark, str(tmp_path / "index"))
    best = {f[1]: f[4] for f in facts[:200]}
    want = sorted(((d, s, 200) for d, s in best.items()), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got, after = [], None
    while page := shown(postings.find_page(index, {"gene_id": ["a"]}, after=after, limit=57)):
        got += page
        after = page[-1][1], page[-1][0]
        assert len(got) <= len(want)
    assert got == want


def test_lists_of_the_page(corpus, spark):
    facts, pubs, index = corpus
    page = postings.find_page(index, {"gene_name": ["Name b"]}, limit=5)
    whole = {r.doc_id: r for r in publications.entity_lists(spark.createDataFrame(facts, schemas.FACTS)).collect()}
    rows = page.collect()
    assert len(rows) == 5
    for r in rows:
        assert (r.genes, r.species, r.terms_go) == (whole[r.doc_id].genes, whole[r.doc_id].species, [])
        assert r.title == f"title {r.doc_id[3:]}"


def test_lists_beyond_a_part_are_whole(spark, tmp_path):
    """A list of more entries than a part holds comes in parts on the page, and as one text in its text form."""
    n = HOT_ROWS + 3
    genes = [(f"name {i:06}", f"{i}", 3 + i % 2) for i in range(n)]
    many = spark.range(n).select(
        F.lit("genes").alias("kind"), F.lit("PMC1").alias("doc_id"), F.format_string("name %06d", "id").alias("name"),
        F.col("id").cast("string").alias("entity_id"), (F.lit(3) + F.col("id") % 2).cast("int").alias("score"),
    )
    few = [("genes", "PMC2", "name 000000", "0", 9), ("genes", "PMC3", "name 000000", "0", 3), ("species", "PMC1", "Name s", "s", 5)]
    pubs = spark.createDataFrame([("PMC1", None), ("PMC2", "b"), ("PMC3", "c")], "doc_id string, title string")
    jobs.load_index(many.unionByName(spark.createDataFrame(few, schemas.FACTS)), pubs, str(tmp_path / "index"))
    index = readers.read_index(spark, str(tmp_path / "index"))
    ranked = sorted(genes, key=lambda g: (-g[2], g[0], g[1]))
    page = postings.find_page(index, {"gene_id": ["0"]}, limit=2).persist()
    rows = page.collect()
    assert sum(len(r.genes) for r in rows) == n + 1
    assert [(r.doc_id, r.part, r.best_score, r.total) for r in rows] == [("PMC2", 0, 9, 3), ("PMC1", 0, 4, 3), ("PMC1", 1, 4, 3)]
    assert [tuple(e) for r in rows[1:] for e in r.genes] == ranked
    assert [tuple(e) for r in rows[1:] for e in r.species] == [("Name s", "s", 5)]
    texts = [tuple(r) for r in postings.encode_page(page).select("doc_id", "total", "title", "genes", "species", "terms_go").collect()]
    assert texts[0] == ("PMC2", 3, "b", "name 000000@!@0@!@9", "", "")
    assert texts[1] == ("PMC1", 3, None, "#!#".join(f"{a}@!@{b}@!@{c}" for a, b, c in ranked), "Name s@!@s@!@5", "")
    assert len(texts) == 2
    page.unpersist()


def scans(df):
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [x for x in plan.split("\n\n") if ") Scan parquet" in x]


def test_a_query_reads_its_clauses_and_its_documents_only(corpus):
    _, _, index = corpus
    words = postings.matching_words(index, {"gene_name": ["Name a"], "do_name": ["Name x"]})
    scan = scans(words)[0]
    assert "gene_name" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "EqualTo(value,Name a)" in scan.split("PushedFilters")[1]
    shown_rows = postings.find_page(index, {"gene_name": ["Name a"]}, limit=2)
    pushed = [x.split("PushedFilters")[1] for x in scans(shown_rows)]
    assert sum("In(doc_id" in x for x in pushed) == 2 and any("LessThan(rank,100000)" in x for x in pushed)


def test_a_hot_value_takes_a_row_per_word(spark):
    rows = spark.range(100_000).select(F.lit("v").alias("value"), F.col("id").alias("number"))
    words = postings.as_words(rows, "value")
    assert words.count() == -(-100_000 // 64) and postings.total(words) == 100_000
