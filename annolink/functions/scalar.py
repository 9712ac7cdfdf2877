"""Scalar functions: every one is a Column built from Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from annolink.fixed_values import DOCUMENT_LINK, DOCUMENT_PREFIX, DOI_LINK, LINK_OUT


def normalise_doc_id(doc_raw: Column) -> Column:
    """``Journal-6--554113`` becomes ``554113``; a clean id stays as it is."""
    # The digits behind the last hyphen, if something stands before it; no regular
    # expression, since every mention passes here.
    tail = F.substring_index(doc_raw, "-", -1)
    digits = (tail != "") & (F.translate(tail, "0123456789", "") == "")
    return F.when(digits & (F.length(doc_raw) > F.length(tail) + 1), tail).otherwise(doc_raw)


def lenient_int(text: Column) -> Column:
    """The integer at the start of the text, 0 when there is none."""
    # Most scores are plain integers: the pattern is only tried on the others.
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1)
    return F.coalesce(text.try_cast("int"), digits.try_cast("int"), F.lit(0))


def default_score(score: Column) -> Column:
    """A blank score counts as 0."""
    return F.coalesce(F.nullif(score, F.lit("")), F.lit("0"))


def with_id_prefix(doc_id: Column, prefix: str = DOCUMENT_PREFIX) -> Column:
    return F.concat(F.lit(prefix), doc_id)


def search_copy(name: Column) -> Column:
    """Lower-case copy of a name that holds an ASCII letter or digit, else blank."""
    return F.when(name.rlike("[A-Za-z0-9]"), F.lower(name)).otherwise(F.lit(""))


def multiword(name: Column) -> Column:
    """True for names of two or more words: one-word names stand for a whole genus."""
    return name.rlike(".+ [^ ]")


def score_band(score: Column) -> Column:
    """Half the score, held between 5 and 15."""
    half = F.shiftrightunsigned(score.cast("int"), 1)
    return F.greatest(F.lit(5), F.least(F.lit(15), half))


def link_out(kind: Column, entity_id: Column) -> Column:
    """Address of the page of an entity."""
    # Only the disease ontology wants the bare number behind the first colon.
    bare = F.when(kind == "terms_do", F.regexp_replace(entity_id, "^[^:]+:", ""))
    base = F.coalesce(*[F.when(kind == k, F.lit(url)) for k, url in LINK_OUT.items()])
    return F.concat(base, F.coalesce(bare, entity_id))


def document_link(doc_id: Column, doi: Column) -> Column:
    """By document id where there is one, else by doi."""
    return F.when(doc_id.isNotNull(), F.concat(F.lit(DOCUMENT_LINK), doc_id)).otherwise(
        F.concat(F.lit(DOI_LINK), doi)
    )


def year_of(date_text: Column) -> Column:
    return F.substring(date_text, 1, 4)


def lookup_prefix(value: Column) -> Column:
    """First two characters in lower case; ``_other`` unless both are ASCII letters or digits."""
    two = F.lower(F.substring(value, 1, 2))
    return F.when(two.rlike("^[a-z0-9]{2}$"), two).otherwise(F.lit("_other"))
