"""Mentions of dictionary names in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolink.operators.skew import fits_broadcast
from annolink.staging import stage

WORD = r"[\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_frequencies(docs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(word, n_docs): in how many documents a word occurs, of all words or of those listed."""
    found = docs.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    if words is not None:
        found = found.join(_held(words), "word", "left_semi")
    return found.groupBy("word").agg(F.count("*").alias("n_docs"))


def _held(table: DataFrame) -> DataFrame:
    """Broadcast where it was measured to be small; a shuffle join beyond."""
    return F.broadcast(table) if fits_broadcast(table) else table


def anchored_names(names: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(word, before, names): the names that are looked for where a word occurs.

    ``names`` holds (phrase, words, ...). A name's anchor is its word of the fewest documents, the first of
    equal ones; ``before`` is the number of its words before it. Names with a word of no document drop out.
    """
    phrases = names.select("phrase", "words").distinct()
    places = phrases.select("phrase", "words", F.posexplode("words").alias("before", "word"))
    rare = places.join(frequencies, "word", "left").groupBy("phrase", "words")
    best = rare.agg(
        F.min(F.struct("n_docs", "before", "word")).alias("best"), F.count("n_docs").alias("n_found")
    )
    met = best.where(F.col("n_found") == F.size("words"))
    return met.select("best.word", "best.before", "phrase", F.size("words").alias("n_words"))


def tag_documents(
    docs: DataFrame,
    dictionary: DataFrame,
    max_words: int | None = None,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, text) and (kind, entity_id, name) to mentions (kind, doc_id, entity_id, score).

    Names are compared with the word sequences of the whole text, without case; the score
    is the number of occurrences. Names of more than ``max_words`` words, if given, are not looked for.

    Each name is looked for at its rarest word only, and compared there in place. ``frequencies``
    (word, n_docs) tells which words are rare; by default they are counted in ``docs``. Any
    frequencies of all words of the names give the same mentions.
    """
    name_words = words_of(F.col("name"))
    names = dictionary.select("kind", "entity_id", name_words.alias("words")).where(F.size("words") >= 1)
    if max_words is not None:
        names = names.where(F.size("words") <= max_words)
    names = stage(names.withColumn("phrase", F.array_join("words", " ")).distinct())
    if frequencies is None:
        frequencies = word_frequencies(docs, names.select(F.explode("words").alias("word")).distinct())
    anchors = stage(anchored_names(names, frequencies))
    # One row: the longest stretches before and after an anchor.
    reach = anchors.agg(F.max("before").alias("before"), F.max(F.col("n_words") - F.col("before")).alias("after")).first()
    before, after = reach.before or 0, reach.after or 0
    entities = names.select("kind", "entity_id", "phrase")

    # The outer form keeps the optimizer from testing the tokenised text for emptiness
    # first, which would tokenise every text twice.
    tokens = docs.select("doc_id", words_of(F.col("text")).alias("words")).select(
        "doc_id", "words", F.posexplode_outer("words").alias("at", "word")
    )
    if fits_broadcast(anchors):
        hits = tokens.join(F.broadcast(anchors), "word")
        found = hits.where(_stands(F.col("words"), F.col("at")))
    else:
        # Without a broadcast a word travels with its neighbours, not with the whole text.
        start = F.greatest(F.lit(0), F.col("at") - before)
        near = F.slice("words", start + 1, before + after).alias("words")
        hits = tokens.where(F.col("word").isNotNull()).select("doc_id", "word", (F.col("at") - start).alias("at"), near)
        found = hits.join(anchors, "word").where(_stands(F.col("words"), F.col("at")))
    # A document's phrases are counted before they travel.
    counted = found.groupBy("doc_id", "phrase").agg(F.count("*").alias("n"))
    mentions = counted.join(_held(entities), "phrase").groupBy("kind", "doc_id", "entity_id")
    return mentions.agg(F.sum("n").cast("int").alias("score"))


def _stands(words: Column, at: Column) -> Column:
    """Whether the anchored name stands around the word at this place."""
    first, n = at - F.col("before"), F.col("n_words")
    inside = (first >= 0) & (first + n <= F.size(words))
    # The guard keeps the slice of a name that would begin before the text from being made.
    stretch = F.slice(words, F.greatest(first, F.lit(0)) + 1, n)
    return inside & (F.array_join(stretch, " ") == F.col("phrase"))
