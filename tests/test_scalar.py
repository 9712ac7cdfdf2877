import pytest
from pyspark.sql import functions as F

from annolink.functions import lists, scalar


def one(spark, function, *values):
    columns = [F.lit(v) if v is not None else F.lit(None).cast("string") for v in values]
    return spark.range(1).select(function(*columns)).first()[0]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("BMC_Genomics-6--554113", "554113"),
        ("554113", "554113"),
        ("A-1", "1"),
        ("A-1x", "A-1x"),
        ("A-", "A-"),
        ("-5", "-5"),
        ("a-b-7", "7"),
        ("", ""),
    ],
)
def test_document_id(spark, raw, clean):
    assert one(spark, scalar.normalise_doc_id, raw) == clean


@pytest.mark.parametrize(
    "text, number",
    [("5", 5), ("3.9", 3), ("x", 0), (" 4", 4), ("", 0), ("-2", -2), ("+7a", 7), ("12 3", 12), (None, 0)],
)
def test_lenient_int(spark, text, number):
    assert one(spark, scalar.lenient_int, text) == number


@pytest.mark.parametrize("score, band", [(4, 5), (23, 11), (60, 15), (10, 5), (31, 15), (0, 5)])
def test_score_band(spark, score, band):
    assert one(spark, scalar.score_band, score) == band


def test_score_band_of_negative_is_the_highest(spark):
    assert one(spark, scalar.score_band, -1) == 15


@pytest.mark.parametrize(
    "value, prefix",
    [("BRCA2", "br"), ("5'-nucleotidase", "_other"), ("2", "_other"), ("GO:1", "go"), ("9606", "96"), ("é1", "_other")],
)
def test_lookup_prefix(spark, value, prefix):
    assert one(spark, scalar.lookup_prefix, value) == prefix


@pytest.mark.parametrize("name, kept", [("Homo", False), ("Homo sapiens", True), ("Homo ", False), ("", False)])
def test_multiword(spark, name, kept):
    assert one(spark, scalar.multiword, name) is kept


@pytest.mark.parametrize("name, copy", [("BRCA2", "brca2"), ("---", ""), (None, ""), ("Ä", ""), ("ÄB", "äb")])
def test_search_copy(spark, name, copy):
    assert one(spark, scalar.search_copy, name) == copy


def test_default_score(spark):
    assert one(spark, scalar.default_score, "") == "0"
    assert one(spark, scalar.default_score, "7") == "7"
    assert one(spark, scalar.default_score, None) == "0"


def test_links(spark):
    assert one(spark, scalar.link_out, "genes", "675").endswith("/gene/675")
    assert one(spark, scalar.link_out, "terms_do", "DOID:162").endswith("DOID%3A162")
    assert one(spark, scalar.link_out, "terms_go", "GO:1").endswith("term=GO:1")
    assert one(spark, scalar.document_link, "PMC1", "10.1/x").endswith("/PMC1")
    assert one(spark, scalar.document_link, None, "10.1/x") == "doi://10.1/x"


def test_year(spark):
    assert one(spark, scalar.year_of, "2011-08-15") == "2011"


def entity_array(entries):
    made = [
        F.struct(F.lit(n).alias("name"), F.lit(i).alias("entity_id"), F.lit(s).alias("score"))
        for n, i, s in entries
    ]
    return F.array(*made)


def test_list_codec(spark):
    df = spark.range(1).select(entity_array([("a", "1", 9), ("b", "2", 5)]).alias("l"))
    text = df.select(lists.encode_list(F.col("l")).alias("t"))
    assert text.first()[0] == "a@!@1@!@9#!#b@!@2@!@5"
    back = text.select(lists.decode_list(F.col("t")).alias("l")).first()[0]
    assert [tuple(e) for e in back] == [("a", "1", 9), ("b", "2", 5)]


def test_empty_list(spark):
    assert one(spark, lists.decode_list, "") == []
    empty = F.array().cast("array<struct<name:string,entity_id:string,score:int>>")
    assert spark.range(1).select(lists.encode_list(empty)).first()[0] == ""
