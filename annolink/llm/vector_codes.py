"""Product codes of vectors, by ball k-means over integers.

A vector is cut into equal parts; each part position has a codebook of its own. The parts
given to an entry are its ball. A round gives every part to its nearest entry, then moves
each entry to the floor of the mean of its ball.

The first assignment compares each part with all entries. In later ones, with r the radius of an
entry's ball, d the distance of a part from its entry, and D that of two entries:

- entries with D > 2 r are no neighbours of the ball, and no part of it looks at them;
- parts with 2 d below the least D are the stable core: they stay without another look;
- the others lie in rings, between one neighbour's D / 2 and the next one's; a part compares
  itself exactly with the neighbours up to its own ring.

By the triangle inequality an entry left out is farther than the part's own entry, so
nothing is lost; all tests are made on squares of integers. The radius of a moved ball is bounded
by the old one and the way the entry moved.

The codebooks (parts x entries x width integers) have a size fixed by the parameters: they are
collected and broadcast in each round. Sums travel as one row per task, part and entry.

Cases: a vector that is null, or has null or non-finite components, is dropped. The kept vector of
the smallest id sets the dimension; a kept vector of another length stays, with a null code and a null
error. Vectors without an id come last in the order of ids; repeated ids are coded each, and order
by their components. With fewer vectors than entries, the codebooks have as many entries as there are
vectors. Ties go to the lower entry. An empty table gives an empty result. Components whose
squares would leave 64 bits (beyond 16,384 with the defaults and 64 dimensions) raise an error, as
does a dimension that the parts do not divide. Further columns do not matter.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import shared
from annolink.staging import stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Vectors that are compared together.
ROWS = 4_000


def integers(vectors: Column, scale: int) -> Column:
    """floor(scale * x) of all components."""
    return F.transform(vectors, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vectors: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    infinite = F.lit(float("inf"))
    return vectors.isNotNull() & F.forall(
        vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < infinite)
    )


def _first_vectors(rows: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the smallest ids: a table of at most ``entries`` rows."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).select(F.size("vector").alias("n")).collect()
    if not first:
        return np.empty((0, 0), np.int64)
    same = rows.where(F.size("vector") == first[0].n)
    chosen = same.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    return np.array([r.vector for r in chosen], np.int64).reshape(len(chosen), first[0].n)


class Balls:
    """Codebooks of all parts, with the neighbours of each ball in order of their distance."""

    def __init__(self, books: np.ndarray, radii: np.ndarray | None = None):
        """``books``: parts x entries x width. ``radii``: squares, a bound for each ball; none before the first round."""
        self.books, self.radii = books, radii
        if radii is None:
            return
        n_parts, n, _ = books.shape
        self.order, self.steps, self.starts = [], [], []
        self.far = 1 << (62 - n.bit_length())
        for part in range(n_parts):
            between = ((books[part][:, None, :] - books[part][None, :, :]) ** 2).sum(2)
            orders, steps, starts = [], [], [0]
            for entry in range(n):
                near = np.argsort(between[entry], kind="stable")
                near = near[(near != entry) & (between[entry][near] <= 4 * radii[part][entry])]
                orders.append(near)
                # One sorted row of numbers for all balls of the part: each ball has a range of its own.
                steps.append(between[entry][near] + entry * self.far)
                starts.append(starts[-1] + len(near))
            self.order.append(np.concatenate(orders).astype(np.int64))
            self.steps.append(np.concatenate(steps).astype(np.int64))
            self.starts.append(np.array(starts, np.int64))

    def own(self, part: int, values: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distance of parts from their entries."""
        return ((values - self.books[part][codes]) ** 2).sum(1)

    def first(self, part: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance, by all entries."""
        squares = ((values[:, None, :] - self.books[part][None, :, :]) ** 2).sum(2)
        codes = squares.argmin(1)
        return codes, squares[np.arange(len(values)), codes]

    def again(self, part: int, values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance, by the rings around the parts' present entries."""
        squares = self.own(part, values, codes)
        starts = self.starts[part][codes]
        reach = np.minimum(4 * squares, self.far - 1) + codes * self.far
        rings = np.minimum(np.searchsorted(self.steps[part], reach, "right"), self.starts[part][codes + 1]) - starts
        moving = np.flatnonzero(rings > 0)
        if not len(moving):
            return codes, squares
        # One row for each part outside its stable core and neighbour up to its ring.
        counts = rings[moving]
        offsets = np.cumsum(counts) - counts
        place = np.arange(counts.sum()) - np.repeat(offsets, counts) + np.repeat(starts[moving], counts)
        neighbour = self.order[part][place]
        apart = ((values[np.repeat(moving, counts)] - self.books[part][neighbour]) ** 2).sum(1)
        least = np.minimum(np.minimum.reduceat(apart, offsets), squares[moving])
        candidates = np.where(apart == np.repeat(least, counts), neighbour, len(self.books[part]))
        entry = np.minimum.reduceat(candidates, offsets)
        entry = np.where(squares[moving] == least, np.minimum(entry, codes[moving]), entry)
        codes, squares = codes.copy(), squares.copy()
        codes[moving], squares[moving] = entry, least
        return codes, squares


def _values(column: pa.Array, *shape: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), *shape)


def _assigned(rows: DataFrame, balls: Balls) -> DataFrame:
    """(id, label, vector) with the ``codes`` of each row, an entry number for each part, and its ``error``."""
    held = shared(rows.sparkSession, balls)
    coded = "codes" in rows.columns

    def task(batches):
        balls = held()
        n_parts = len(balls.books)
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            values = _values(batch.column(2), n_parts, -1)
            before = _values(batch.column(3), n_parts) if coded else None
            codes, errors = np.empty((len(values), n_parts), np.int64), np.zeros(len(values), np.int64)
            for part in range(n_parts):
                if coded:
                    codes[:, part], squares = balls.again(part, values[:, part], before[:, part])
                else:
                    codes[:, part], squares = balls.first(part, values[:, part])
                errors += squares
            ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * n_parts)
            numbers = pa.ListArray.from_arrays(ends, pa.array(codes.reshape(-1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], numbers, pa.array(errors)], ["id", "label", "vector", "codes", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    columns = ["id", "label", "vector", *(["codes"] if coded else [])]
    out = f"id {kinds['id']}, label {kinds['label']}, vector array<long>, codes array<int>, error long"
    return rows.select(*columns).mapInArrow(task, out)


def _moved(rows: DataFrame, balls: Balls) -> Balls:
    """The codebooks after a round, with a bound of each ball's radius."""
    held = shared(rows.sparkSession, balls)
    n_parts, n, width = balls.books.shape

    def task(batches):
        balls = held()
        sums, counts = np.zeros((n_parts, n, width), np.int64), np.zeros((n_parts, n), np.int64)
        radii = np.zeros((n_parts, n), np.int64)
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            values, codes = _values(batch.column(0), n_parts, -1), _values(batch.column(1), n_parts)
            for part in range(n_parts):
                np.add.at(sums[part], codes[:, part], values[:, part])
                counts[part] += np.bincount(codes[:, part], minlength=n)
                np.maximum.at(radii[part], codes[:, part], balls.own(part, values[:, part], codes[:, part]))
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), pa.array(radii[part, entry])]
            + [pa.array(sums[part, entry, i]) for i in range(width)],
            ["part", "entry", "n", "radius", *[f"s{i}" for i in range(width)]],
        )

    names = [f"s{i}" for i in range(width)]
    partial = rows.select("vector", "codes").mapInArrow(task, ", ".join(f"{c} long" for c in ["part", "entry", "n", "radius", *names]))
    total = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"), *[F.sum(c).alias(c) for c in names]
    )
    books, radii = balls.books.copy(), np.zeros((n_parts, n), np.int64)
    for row in total.collect():
        books[row.part, row.entry] = [row[c] // row.n for c in names]
        way = int(((books[row.part, row.entry] - balls.books[row.part, row.entry]) ** 2).sum())
        radii[row.part, row.entry] = (math.isqrt(row.radius) + 1 + math.isqrt(way) + 1) ** 2
    return Balls(books, radii)


def codebooks_text(books: np.ndarray) -> str:
    """All components in decimal, by part, entry and place, joined by commas."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def vector_codes(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes: array of entry numbers, error) per kept vector, and the codebooks."""
    kept = table.where(usable(F.col(vector_col)))
    rows = stage(kept.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), integers(F.col(vector_col), scale).alias("vector")))
    first = _first_vectors(rows, entries)
    dimension = first.shape[1]
    if dimension % parts or len(first) and not dimension:
        raise ValueError(f"{dimension} dimensions cannot be cut into {parts} equal parts")
    none = [F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error")]
    if not len(first):
        return rows.select("id", "label", *none), np.empty((parts, 0, 0), np.int64)
    same = rows.where(F.size("vector") == dimension)
    largest = same.agg(F.max(F.greatest(F.array_max("vector"), -F.array_min("vector")))).first()[0]
    if 16 * entries * dimension * (2 * largest) ** 2 >= 1 << 62:
        raise ValueError(f"components of up to {largest / scale} are too large for squares of 64 bits")
    balls = Balls(first.reshape(len(first), parts, -1).transpose(1, 0, 2).copy())
    for _ in range(rounds):
        same = stage(_assigned(same, balls).drop("error"))
        balls = _moved(same, balls)
    result = _assigned(same, balls).select("id", "label", "codes", "error")
    others = rows.where(F.size("vector") != dimension).select("id", "label", *none)
    return result.unionByName(others), balls.books


def code_text(codes: Column) -> Column:
    """Two hex digits for each entry number."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors of equal labels summed, missing labels together."""
    # A key without nulls, so that the join can be spread where a label is hot.
    rows = stage(coded.withColumn("_label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))))
    sums = stage(rows.groupBy("_label").agg(F.sum("error").alias("label_error")))
    return rows.join(sums, "_label").drop("_label")


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(codebooks_text(books).encode()).hexdigest()
