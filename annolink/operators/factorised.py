"""Combinations of a document's entries, held as the lists they are made of.

A *cell* is one row: a stretch of each of the document's lists, and ``n_rows``, the number of
combinations it stands for. A document whose product of lists is small is one cell. Others
are cut into cells of at most ``cell_rows`` combinations, so that the work of writing
combinations out is dealt by the size of the output, and no row, task or list grows with the product.

Counts, filters and search columns work on the lists; ``expand`` writes the combinations.
A list without entries stands for one combination with NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolink.operators.skew import HOT_ROWS, hot_keys, key_sizes, number_copies, with_position
from annolink.staging import stage
from annolink.unions import append

# Combinations that one cell stands for at most.
CELL_ROWS = 65_536
# Tasks that the lists of a hot document are copied to at most, for the joins with its cells.
SALTS = 64


def factorise(
    rows: DataFrame,
    kinds: Sequence[str],
    fields: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
    cell_rows: int = CELL_ROWS,
    required: bool = False,
) -> DataFrame:
    """(doc_id, cell, one list of structs per kind, n_rows) from (kind, doc_id, *fields, alive).

    A document is dropped when it has entries of a kind and none of them is alive, or, with
    ``required``, when a kind has no entry that is alive. Dead entries never appear. Cells of a
    document are numbered from 0; the lists of all its cells are the same for any ``hot_rows``
    but for their order.
    """
    small = _small(len(kinds), cell_rows)
    _, most = key_sizes(rows, "doc_id")
    if most <= small and (hot_rows is None or most <= hot_rows):
        return _whole(_lists(rows, kinds, fields, required), kinds)
    hot = hot_keys(rows, "doc_id", hot_rows)
    if hot is None:
        return _from_lists(_lists(rows, kinds, fields, required), kinds, cell_rows)
    keys = hot.select("doc_id")
    ordinary = _lists(rows.join(keys, "doc_id", "left_anti"), kinds, fields, required)
    return append(
        _from_lists(ordinary, kinds, cell_rows),
        _from_entries(rows.join(keys, "doc_id", "left_semi"), kinds, fields, cell_rows, required),
    )


def _complete(counts: DataFrame, kinds: Sequence[str], alive: Callable, required: bool) -> DataFrame:
    for k in kinds:
        counts = counts.where(alive(k) > 0 if required else (alive(k) > 0) | (F.col(f"n_{k}") == 0))
    return counts


def _lists(rows: DataFrame, kinds, fields, required) -> DataFrame:
    # One shuffle. Collecting does not shrink the rows, so they are shuffled before it, not after.
    entry = F.struct(*fields)
    lists = rows.repartition("doc_id").groupBy("doc_id").agg(
        *[F.collect_list(F.when((F.col("kind") == k) & F.col("alive"), entry)).alias(k) for k in kinds],
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in kinds],
    )
    return _complete(lists, kinds, F.size, required).select("doc_id", *kinds)


def _product(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(1.0), lambda done, n: done * n)


def _steps(sizes: Column, cell_rows: int) -> Column:
    """How much of each list a cell takes: the longest stretch is halved until the product fits."""

    def halved(steps):
        longest = F.array_position(steps, F.array_max(steps)) - 1
        return F.transform(steps, lambda n, i: F.when(i == longest, F.ceil(n / 2)).otherwise(n))

    # 2 ** 320 combinations are more than five lists of 2 ** 63 entries have.
    cut = F.aggregate(
        F.sequence(F.lit(1), F.lit(320)),
        sizes,
        lambda steps, _: F.when(_product(steps) <= cell_rows, steps).otherwise(halved(steps)),
    )
    return F.when(_product(sizes) <= cell_rows, sizes).otherwise(cut)


def _grid(lists: DataFrame, sizes: list[Column], cell_rows: int) -> DataFrame:
    """Add ``steps`` and ``pieces``: the stretch and the number of stretches of each list."""
    lists = lists.withColumn("sizes", F.array(*[F.greatest(F.lit(1), n).cast("long") for n in sizes]))
    lists = lists.withColumn("steps", _steps(F.col("sizes"), cell_rows))
    pieces = F.zip_with("sizes", "steps", lambda n, step: F.ceil(n / step))
    lists = lists.withColumn("pieces", pieces)
    n_cells = F.aggregate("pieces", F.lit(1).cast("long"), lambda done, n: done * n)
    return lists.withColumn("n_cells", n_cells)


def _place(number: int, n_kinds: int) -> Column:
    """Which stretch of a list a cell takes: the digits of the cell's number, the last list first."""
    below = reduce(lambda a, i: a * F.get("pieces", F.lit(i)), range(number + 1, n_kinds), F.lit(1).cast("long"))
    return F.floor(F.col("cell") / below) % F.get("pieces", F.lit(number))


def _n_rows(kinds: Sequence[str]) -> Column:
    return reduce(lambda a, k: a * F.greatest(F.lit(1), F.size(k)), kinds, F.lit(1).cast("long")).alias("n_rows")


def _small(n_kinds: int, cell_rows: int) -> int:
    """As many entries of a document make a single cell, however they are dealt to the kinds."""
    # A product is largest where all lists are equally long; an empty one counts as one entry.
    side = 1
    while (side + 1) ** n_kinds <= cell_rows:
        side += 1
    return n_kinds * (side - 1) + 1


def _whole(lists: DataFrame, kinds: Sequence[str]) -> DataFrame:
    return lists.select("doc_id", F.lit(0).cast("long").alias("cell"), *kinds, _n_rows(kinds))


def _from_lists(lists: DataFrame, kinds: Sequence[str], cell_rows: int) -> DataFrame:
    # Read for the whole documents and for the cut ones.
    lists = stage(lists)
    grid = _grid(lists, [F.size(k) for k in kinds], cell_rows)
    whole = grid.where(F.col("n_cells") == 1).select("doc_id", F.lit(0).cast("long").alias("cell"), *kinds)
    cells = grid.where(F.col("n_cells") > 1).withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_cells") - 1)))
    stretches = []
    for i, k in enumerate(kinds):
        step = F.get("steps", F.lit(i))
        stretches.append(F.slice(k, (_place(i, len(kinds)) * step + 1).cast("int"), step.cast("int")).alias(k))
    return append(whole, _dealt(cells.select("doc_id", "cell", *stretches))).select("doc_id", "cell", *kinds, _n_rows(kinds))


def _dealt(cells: DataFrame) -> DataFrame:
    """The cells of one document over all tasks. Adaptive execution, which sees the bytes of cells and
    not the rows they stand for, keeps its hands off a given number of partitions."""
    return cells.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "cell")


def _from_entries(rows: DataFrame, kinds, fields, cell_rows: int, required: bool) -> DataFrame:
    """The cells of documents whose lists are too long for one task: no list is ever whole."""
    counts = rows.groupBy("doc_id").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in kinds],
        *[F.count(F.when((F.col("kind") == k) & F.col("alive"), 1)).alias(f"a_{k}") for k in kinds],
    )
    counts = _complete(counts, kinds, lambda k: F.col(f"a_{k}"), required)
    grid = _grid(counts, [F.col(f"a_{k}") for k in kinds], cell_rows).select("doc_id", "steps", "pieces", "n_cells")
    alive = rows.where("alive").drop("alive").join(grid.select("doc_id"), "doc_id", "left_semi")
    numbered = with_position(number_copies(alive), "doc_id", "kind", *fields, "copy")
    # One row per hot document and kind.
    starts = numbered.groupBy("doc_id", "kind").agg(F.min("position").alias("_start"))
    own_step = F.coalesce(*[F.when(F.col("kind") == k, F.get("steps", F.lit(i))) for i, k in enumerate(kinds)])
    place = F.floor((F.col("position") - F.col("_start")) / own_step)
    placed = numbered.join(starts, ["doc_id", "kind"]).join(grid.select("doc_id", "steps"), "doc_id")
    stretches = (
        placed.select("doc_id", "kind", place.alias("place"), F.struct(*fields).alias("entry"))
        .groupBy("doc_id", "kind", "place")
        .agg(F.collect_list("entry").alias("entries"))
    )
    cells = grid.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_cells") - 1)))
    cells = cells.withColumn("salt", (F.col("cell") % SALTS).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    for i, k in enumerate(kinds):
        side = stretches.where(F.col("kind") == k).select("doc_id", F.col("place").alias("at"), F.col("entries").alias(k), copies)
        cells = cells.withColumn("at", _place(i, len(kinds))).join(side, ["doc_id", "at", "salt"], "left").drop("at")
        cells = cells.withColumn(k, F.coalesce(k, F.array().cast(side.schema[k].dataType)))
    return _dealt(cells.select("doc_id", "cell", *kinds)).select("doc_id", "cell", *kinds, _n_rows(kinds))


def expand(cells: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One row per combination, one struct column per kind."""
    wide = cells.select("doc_id", *kinds)
    for k in kinds:
        wide = wide.withColumn(k, F.explode_outer(k))
    return wide


def combination_counts(cells: DataFrame) -> DataFrame:
    """(doc_id, n_rows): how many combinations a document has, exact up to 38 digits."""
    return cells.groupBy("doc_id").agg(F.sum(F.col("n_rows").cast("decimal(28,0)")).alias("n_rows"))


def keep_entries(cells: DataFrame, kinds: Sequence[str], kind: str, condition: Callable[[Column], Column]) -> DataFrame:
    """The combinations whose entry of ``kind`` fulfils the condition, none of them written out."""
    kept = cells.withColumn(kind, F.filter(kind, condition)).where(F.size(kind) > 0)
    return kept.withColumn("n_rows", _n_rows(kinds))


def with_entry_field(cells: DataFrame, kinds: Sequence[str], name: str, value: Callable[[Column], Column]) -> DataFrame:
    """A further field of every entry: computed once per entry, not once per combination."""
    return cells.withColumns({k: F.transform(k, lambda e: e.withField(name, value(e))) for k in kinds})


def entry_counts(cells: DataFrame, kinds: Sequence[str], *fields: str) -> DataFrame:
    """(kind, *fields, n_rows): in how many combinations each entry of a kind takes part."""
    lists = [
        F.struct(F.lit(k).alias("kind"), F.transform(k, lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias("entries"),
                 F.expr(f"n_rows div greatest(1, size({k}))").alias("times"))
        for k in kinds
    ]
    rows = cells.select(F.explode(F.array(*lists)).alias("list")).select("list.kind", "list.times", F.explode("list.entries").alias("entry"))
    summed = rows.groupBy("kind", *[F.col("entry")[f].alias(f) for f in fields])
    return summed.agg(F.sum(F.col("times").cast("decimal(28,0)")).alias("n_rows"))
