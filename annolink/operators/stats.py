"""Counts, statistics, top lists and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolink.fixed_values import FIRST_CHART_YEAR, KINDS, ONTOLOGIES, TOP_N
from annolink.unions import append

# Registers of a sketch, as a power of two.
SKETCH_LG_K = 14


def entity_frequency(facts: DataFrame, kind: str | None = None) -> DataFrame:
    """Rows per entity; of one kind, or of each."""
    rows = facts if kind is None else facts.where(F.col("kind") == kind)
    return rows.groupBy("kind", "entity_id").agg(F.count("*").alias("n"))


def top_entities(
    facts: DataFrame, kind: str, n: int = TOP_N, accepted: DataFrame | None = None
) -> DataFrame:
    """The ``n`` most frequent entities of a kind, ties by id descending.

    ``accepted`` (entity_id) is applied before the limit.
    """
    counts = entity_frequency(facts, kind)
    if accepted is not None:
        counts = counts.join(accepted, "entity_id", "left_semi")
    return counts.select("kind", "entity_id", "n").orderBy(F.desc("n"), F.desc("entity_id")).limit(n)


def distinct_counts(facts: DataFrame) -> DataFrame:
    """Distinct documents and distinct entities per kind."""
    # Deduplicate on the full key first: a kind with most of the rows is no hot group then.
    docs = facts.select("kind", "doc_id").distinct().groupBy("kind")
    entities = facts.select("kind", "entity_id").distinct().groupBy("kind")
    return docs.agg(F.count("*").alias("n_documents")).join(
        entities.agg(F.count("*").alias("n_entities")), "kind"
    )


def approximate_counts(facts: DataFrame, error: float = 0.02) -> DataFrame:
    """``distinct_counts`` by sketches: one pass, fixed memory per kind."""
    return facts.groupBy("kind").agg(
        F.approx_count_distinct("doc_id", error).alias("n_documents"),
        F.approx_count_distinct("entity_id", error).alias("n_entities"),
    )


def batch_sketches(facts: DataFrame, by: tuple[str, ...] = ("batch",), lg_k: int = SKETCH_LG_K) -> DataFrame:
    """(*by, kind, documents, entities): sketches of distinct values, at most some KB each, to be kept per batch.

    Sketches of any batches can be united later, so a release is counted without its facts. The
    relative standard error of an estimate is about 1.04 / sqrt(2 ** lg_k): 0.8 % with 2 ** 14.
    """
    key = F.concat_ws(":", "kind", "entity_id")
    return facts.groupBy(*by, "kind").agg(
        F.hll_sketch_agg("doc_id", lg_k).alias("documents"), F.hll_sketch_agg(key, lg_k).alias("entities")
    )


def sketched_stats(sketches: DataFrame) -> DataFrame:
    """The figures of ``corpus_stats`` from sketches of any number of batches: (figure, value), estimated.

    Ontologies, and all kinds, are united from the kinds' sketches: no value is counted again.
    """
    kind = F.col("kind")
    groups = {"genes": kind == "genes", "species": kind == "species", "terms": kind.isin(*ONTOLOGIES)}

    def united(column: str, condition: Column) -> Column:
        estimate = F.hll_sketch_estimate(F.hll_union_agg(F.when(condition, F.col(column))))
        return F.coalesce(estimate, F.lit(0).cast("long"))

    figures = {"publications": united("documents", F.lit(True))}
    figures |= {f"publications with {name}": united("documents", c) for name, c in groups.items()}
    figures |= {f"distinct {k}": united("entities", kind == k) for k in KINDS}
    figures["distinct ontology terms"] = united("entities", groups["terms"])
    return _figures(sketches.agg(*[column.alias(name) for name, column in figures.items()]))


def corpus_stats(facts: DataFrame, strict_ids: bool = False) -> DataFrame:
    """Published statistics, one row per figure.

    ``strict_ids`` counts gene and species ids of two or more digits only.
    """
    kind = F.col("kind")
    counted = F.lit(True)
    if strict_ids:
        counted = ~kind.isin("genes", "species") | F.col("entity_id").rlike("^[1-9][0-9]")
    has = {
        "genes": kind == "genes",
        "species": kind == "species",
        "terms": kind.isin(*ONTOLOGIES),
    }
    flags = facts.groupBy("doc_id").agg(
        *[F.max(F.when(c & counted, 1).otherwise(0)).alias(n) for n, c in has.items()]
    )
    documents = flags.agg(
        F.count("*").alias("publications"),
        *[F.sum(n).alias(f"publications with {n}") for n in has],
    )
    ids = facts.where(counted).select("kind", "entity_id").distinct()
    of_kind = [F.count(F.when(F.col("kind") == k, 1)).alias(f"distinct {k}") for k in KINDS]
    total = F.count(F.when(F.col("kind").isin(*ONTOLOGIES), 1)).alias("distinct ontology terms")
    return append(_figures(documents), _figures(ids.agg(*of_kind, total)))


def _figures(one_row: DataFrame) -> DataFrame:
    pairs = ", ".join(f"'{c}', cast(`{c}` as bigint)" for c in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) as (figure, value)")


def cut_value(df: DataFrame, column: str, n: int, m: int) -> DataFrame:
    """The score at place max(1, count * n div m) of the descending scores.

    The count leaves out scores of 1; the place is looked up among all scores. Works on
    the counts per 65,536 neighbouring scores, then on the counts inside one such block,
    so that neither step ever orders more than 65,536 rows.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("int").alias("value"))
        .agg(F.count("*").alias("n_rows"))
        .withColumn("block", F.shiftright("value", 16))
    )
    place = counts.agg(
        F.greatest(
            F.lit(1),
            F.expr(f"coalesce(sum(if(value = 1, 0, n_rows)), 0) * {n} div {m}"),
        )
    ).scalar()
    blocks = counts.groupBy("block").agg(F.sum("n_rows").alias("n_rows"))
    down = Window.orderBy(F.desc("block"))
    block = (
        blocks.withColumn("upto", F.sum("n_rows").over(down))
        .where((F.col("upto") >= place) & (F.col("upto") - F.col("n_rows") < place))
        .select("block", (F.col("upto") - F.col("n_rows")).alias("above"))
    )
    inside = counts.join(block, "block")
    within = Window.partitionBy("block").orderBy(F.desc("value"))
    reached = F.col("above") + F.sum("n_rows").over(within)
    return (
        inside.withColumn("reached", reached)
        .where((F.col("reached") >= place) & (F.col("reached") - F.col("n_rows") < place))
        .select(F.col("value").alias("cut_value"))
    )


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys only in a, only in b, in both. Blank keys are left out."""
    sides = _sides({"in_a": a.select(key), "in_b": b.select(key)}, [key])
    found_a, found_b = F.col("in_a") == 1, F.col("in_b") == 1
    return sides.where(F.col(key) != "").agg(
        F.count(F.when(found_a & ~found_b, 1)).alias("only_a"),
        F.count(F.when(found_b & ~found_a, 1)).alias("only_b"),
        F.count(F.when(found_a & found_b, 1)).alias("both"),
    )


def _sides(tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Distinct keys with a 0/1 column for each table: one shuffle, copies merged before it."""
    flagged = [
        df.select(*keys, *[F.lit(int(other == name)).alias(other) for other in tables])
        for name, df in tables.items()
    ]
    return append(*flagged).groupBy(*keys).agg(*[F.max(name).alias(name) for name in tables])


def year_histogram(
    a: DataFrame,
    b: DataFrame | None = None,
    max_year: int | Column | None = None,
    min_year: int = FIRST_CHART_YEAR,
    year: str = "year",
) -> DataFrame:
    """Documents per year in one or two results; missing years count 0. Blank years and other texts
    have a row each (the latter if there are any), so the sums are the numbers of rows.

    The years run from ``min_year`` to ``max_year`` (default: this year), further where
    the data has earlier or later ones.
    """
    b = a.limit(0) if b is None else b
    rows = append(
        a.select(year, F.lit(1).alias("a"), F.lit(0).alias("b")),
        b.select(year, F.lit(0).alias("a"), F.lit(1).alias("b")),
    )
    label = F.coalesce(F.col(year), F.lit(""))
    counts = rows.groupBy(label.alias("year")).agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))
    number = F.when(F.col("year").rlike("^[0-9]{4}$"), F.col("year").try_cast("int"))
    latest = F.year(F.current_date()) if max_year is None else max_year
    latest = F.lit(latest) if isinstance(latest, int) else latest
    # One row: the span of years, at most four digits wide.
    span = counts.agg(
        F.least(F.lit(min_year), F.min(number)).alias("first"),
        F.greatest(latest, F.max(number)).alias("last"),
    )
    years = span.select(F.explode(F.sequence("first", "last")).alias("year"))
    years = years.select(F.lpad(F.col("year").cast("string"), 4, "0").alias("year"))
    filled = years.join(counts, "year", "left").select(
        "year",
        F.coalesce("n_a", F.lit(0).cast("long")).alias("n_a"),
        F.coalesce("n_b", F.lit(0).cast("long")).alias("n_b"),
    )
    blank = counts.where(F.col("year") == "").withColumn("year", F.lit("no e-publication date"))
    in_span = (F.length("year") == 4) & F.col("year").rlike("^[0-9]{4}$")
    other = counts.where((F.col("year") != "") & ~in_span)
    other = other.agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b")).where("n_a is not null")
    other = other.select(F.lit("other").alias("year"), "n_a", "n_b")
    return append(filled, blank, other)


def totals(results: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of each result."""
    names = [df.select(F.lit(name).alias("source")) for name, df in results.items()]
    return append(*names).groupBy("source").agg(F.count("*").alias("n"))
