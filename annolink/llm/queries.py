"""Registered queries: each applies one operator, as used in production, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from annolink.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    html_extraction,
    lm_scoring,
    merkle_manifest,
    mixing,
    near_dedup,
    quality,
    substring_dedup,
    token_counts,
    toxicity,
    vector_codes,
)
from annolink.llm.common import table
from annolink.llm.oracle import ORACLE as _ORACLE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_lm_scoring(spark, sf):
    return lm_scoring.lm_scores(table(spark, sf, "documents"))


@_query
def op2_html_extraction(spark, sf):
    return html_extraction.main_texts(table(spark, sf, "pages"))


@_query
def op3_decontaminate(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@_query
def op4_toxicity(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@_query
def op5_token_counts(spark, sf):
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op6_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


@_query
def op7_quality(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf, "labels")))


@_query
def op8_near_dedup(spark, sf):
    return near_dedup.near_duplicates(table(spark, sf, "documents"), size=3, percent=85)


@_query
def op9_substring_dedup(spark, sf):
    cut = substring_dedup.remove_repeats(table(spark, sf, "documents"))
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return cut.select("doc_id", "n_words", "n_removed", sha)


@_query
def op10_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@_query
def op11_vector_codes(spark, sf):
    coded, books = vector_codes.vector_codes(table(spark, sf, "embeddings"))
    return vector_codes.with_label_errors(coded).select(
        F.col("id").alias("vec_id"),
        vector_codes.code_text(F.col("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256"),
    )


@_query
def op12_merkle_manifest(spark, sf):
    docs = table(spark, sf, "documents")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = F.translate("text", letters, letters.lower())
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    values = [lower if c == "text" else F.col(c) for c in merkle_manifest.COLUMNS]
    tampered = F.when(hit, merkle_manifest.leaf_digest(values))
    tree = merkle_manifest.manifest(docs, carry={"tampered": tampered})
    tree = tree.withColumn("folded_root", merkle_manifest.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return tree.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle_manifest.digest(merkle_manifest.siblings(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@_query
def op13_bpe(spark, sf):
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    decoded = bpe.decode(bpe.encode(table(spark, sf, "documents"), tokenizer), tokenizer)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)


ORACLE = {name: sql for name, sql in _ORACLE.items() if name in QUERIES}
