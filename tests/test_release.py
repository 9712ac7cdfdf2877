"""Tagging by anchors, batches that are written again, united sketches, tables placed by document."""

import random
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from annolink import schemas
from annolink.operators import publications, stats, tagging
from annolink.sources import readers, writers


def tag_reference(docs, names):
    out = Counter()
    for d, text in docs:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        for kind, entity, name in {(k, e, tuple(re.findall(r"[^\W_]+", n.lower()))) for k, e, n in names}:
            n = sum(tuple(words[i : i + len(name)]) == name for i in range(len(words) - len(name) + 1)) if name else 0
            if n:
                out[kind, d, entity] += n
    return dict(out)


@pytest.mark.parametrize("small", [True, False])
def test_tagging_by_anchors(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(tagging, "fits_broadcast", lambda *_: False)
    draw = random.Random(3)
    docs = [(d, " ".join(draw.choices("a b c d e f the the the".split(), k=draw.randint(0, 60)))) for d in range(80)]
    docs += [(200, None), (201, ""), (202, "A-b C"), (203, "z"), (204, "the " * 300 + "a the b")]
    names = [("k", f"e{i}", " ".join(draw.choices("a b c d e f the".split(), k=draw.randint(1, 5)))) for i in range(60)]
    names += [("k", "e1", "a b"), ("l", "e1", "a b"), ("k", "same", "A b"), ("k", "none", "unseen word a"), ("k", "blank", "--"), ("k", "end", "a the b")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame(names, "kind string, entity_id string, name string")
    want = tag_reference(docs, names)
    got = {(r.kind, r.doc_id, r.entity_id): r.score for r in tagging.tag_documents(df, table).collect()}
    assert got == want
    flat = spark.createDataFrame([(w, 1) for w in "abcdef"] + [("the", 1)], "word string, n_docs long")
    given = tagging.tag_documents(df, table, frequencies=flat).collect()
    assert {(r.kind, r.doc_id, r.entity_id): r.score for r in given} == want


def test_a_name_is_looked_for_at_its_rarest_word(spark):
    names = [("of the gene", ["of", "the", "gene"]), ("the the", ["the", "the"]), ("of unseen", ["of", "unseen"])]
    table = spark.createDataFrame(names, "phrase string, words array<string>")
    frequencies = spark.createDataFrame([("of", 90), ("the", 100), ("gene", 2)], "word string, n_docs long")
    got = {r.phrase: (r.word, r.before, r.n_words) for r in tagging.anchored_names(table, frequencies).collect()}
    assert got == {"of the gene": ("gene", 2, 3), "the the": ("the", 0, 2)}


FACTS = [("genes", f"d{i}", f"name {i % 7}", str(i % 7), 3 + i % 5) for i in range(60)]
FACTS += [("species", f"d{i}", "s", "9", 4) for i in range(0, 60, 3)]


def facts_of(spark, rows, batch):
    return spark.createDataFrame([(*r, batch) for r in rows], schemas.BATCHES)


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "batches")
    first, second = FACTS[:40], FACTS[40:]
    writers.write_batches(facts_of(spark, first, "a").union(facts_of(spark, second, "b")), path)
    for _ in range(2):
        writers.write_batches(facts_of(spark, second, "b"), path)
    read = readers.read_batches(spark, path)
    assert Counter(map(tuple, read.drop("batch").collect())) == Counter(FACTS)
    # A batch that has lost a kind, and one that has lost all its rows.
    genes = [f for f in first if f[0] == "genes"][:5]
    writers.write_batches(facts_of(spark, genes, "a"), path, ["a", "b", "c"])
    read = readers.read_batches(spark, path)
    assert Counter(map(tuple, read.drop("batch").collect())) == Counter(genes)
    assert {(r.batch, r.n_facts) for r in readers.read_batch_list(spark, path).collect()} == {("a", 5), ("b", 0), ("c", 0)}


def test_sketches_of_batches_are_united(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "genes").when(F.col("id") % 3 == 1, "terms_go").otherwise("terms_do").alias("kind"),
        (F.col("id") % 9_000).cast("string").alias("doc_id"), F.lit("x").alias("name"),
        (F.col("id") % 5_000).cast("string").alias("entity_id"), F.lit(3).alias("score"),
        F.when(F.col("id") < 15_000, "a").otherwise("b").alias("batch"),
    )
    sketches = stats.batch_sketches(rows)
    assert sketches.count() == 6
    apart = {r.figure: r.value for r in stats.sketched_stats(sketches).collect()}
    whole = {r.figure: r.value for r in stats.sketched_stats(stats.batch_sketches(rows, by=())).collect()}
    exact = {r.figure: r.value for r in stats.corpus_stats(rows.drop("batch")).collect()}
    assert apart.keys() == whole.keys() == exact.keys()
    for figure, value in exact.items():
        # Four standard errors; the sketch of two batches is the sketch of their union.
        assert abs(apart[figure] - value) <= 0.033 * value + 0.5, figure
        assert abs(apart[figure] - whole[figure]) <= 0.01 * value, figure


def test_colocated_tables_are_not_shuffled(spark):
    facts = spark.createDataFrame(FACTS, schemas.FACTS)
    dims = {
        "doi": spark.createDataFrame([(f"d{i}", f"10.1/{i}") for i in range(50)] * 2, "doc_id string, doi string"),
        "year": spark.createDataFrame([(f"d{i}", "2011") for i in range(10, 60)], "doc_id string, year string"),
    }
    docs = publications.document_ids(facts)
    prefix = f"t{uuid.uuid4().hex}"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = writers.write_colocated({"docs": docs, "facts": facts, **dims}, prefix, 4)
        got = publications.colocated_publications(held["docs"], {n: held[n] for n in dims}, held["facts"])
        rows = sorted(map(str, got.select(sorted(got.columns)).collect()))
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        want = publications.with_entity_lists(publications.publications(docs, dims), facts)
        assert rows == sorted(map(str, want.select(sorted(want.columns)).collect())) and len(rows) == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("docs", "facts", *dims):
            spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")
