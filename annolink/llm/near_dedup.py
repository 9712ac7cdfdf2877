"""Near duplicates by a chosen-path similarity join over word shingles.

1. One pass over the texts gives each document's distinct shingles as 64-bit hashes, their
   number, a 128-bit name of the set, and ``COORDINATES`` minwise values (the least image of
   the set under that many permutations). Documents with one set are one *class*; its
   smallest id stands for it.
2. Each of ``trees`` trees has ``OWN`` coordinates of its own. A node chooses some of them, by its own hash, and
   sends each document to the child named by the document's minwise value there. A node
   chooses one coordinate, and a second one with probability 1 / threshold - 1, so that a
   pair at the threshold keeps one common child on average. The first two levels are taken
   at once. Nodes with one document end. Nodes of up to ``node_rows`` are compared
   exhaustively. Larger nodes branch again, level by level, without ever being gathered; what
   is still large after ``DEEPEST`` levels, so all but equal, is compared with pivots instead.
   Two levels keep a pair at the threshold with probability over 0.7, so 10 trees lose less
   than one in 100,000 of such pairs; more similar pairs are safer.
3. Comparing a node means comparing minwise sketches, with five standard deviations of
   slack, and it emits a spanning forest of what is close, never pairs of everything.
   Components of these forests hold all links that any tree has found.
4. Inside each component the full shingle sets are compared exactly: a document is compared
   with all those that are not yet reached, which are soon few. A component of more than
   ``block_rows`` documents, or of too many shingles, is not gathered: all its members are first compared with one
   pivot, and only those that are not linked to it are compared with the rest, block by block.

Cases: a null text is an empty text. A text without words has no shingles and is linked with
nothing; one with fewer words than a shingle is a single shingle. A row without an id is a
class of its own, is linked with nothing (null ``component_id``) and is kept. Rows that share
an id are one vertex. An empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import mix64, texts, window_hashes, without
from annolink.llm.components import components
from annolink.llm.grouping import groups
from annolink.llm.hashing import WordHash
from annolink.staging import stage

# Coordinates in all, of one tree, and of the sketches that are compared.
COORDINATES, OWN, SKETCH = 160, 16, 64
TREES, MORE_TREES = 10, 9
NODE_ROWS = 5_000
# What one task compares exactly: documents, and shingles of all of them (16 MB of hashes).
BLOCK_ROWS, BLOCK_SHINGLES = 3_000, 2_000_000
# Levels after which a node that is still large is not branched any further.
DEEPEST = 8


def shingles(text: bytes, size: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words."""
    words = hashes.of(text.lower().split())
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(size, len(words))))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    odd = draw.integers(0, 2**31, (COORDINATES, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, draw.integers(0, 2**32, (COORDINATES, 1), dtype=np.uint32)


def minwise(sets: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The least image of the set under each permutation of 32-bit values."""
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    low = (sets >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(low), 4096):
        np.minimum(least, (odd * low[start : start + 4096] + add).min(axis=1), out=least)
    return least


def _signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b, signature (binary: the low 16 bits of each minwise value)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (odd, add) = WordHash(), _permutations()
        for batch in batches:
            counts, names_a, names_b, signatures = [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), size, hashes)
                counts.append(len(found))
                with np.errstate(over="ignore"):
                    names_a.append(int(found.sum(dtype=np.uint64).view(np.int64)) if len(found) else 0)
                    names_b.append(int(mix64(found).sum(dtype=np.uint64).view(np.int64)) if len(found) else 0)
                signatures.append(minwise(found, odd, add).astype(np.uint16).tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(names_a, pa.int64()), pa.array(names_b, pa.int64()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )

    rows = texts(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(task, "doc_id long, n_shingles long, set_a long, set_b long, signature binary")


def _children(nodes: np.ndarray, values: np.ndarray, threshold: float, level: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, node) of the children of each row's node; ``values`` has a row per coordinate value."""
    salted = mix64(nodes + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
    first = (salted % np.uint64(OWN)).astype(np.int64)
    second = ((salted >> np.uint64(16)) % np.uint64(OWN)).astype(np.int64)
    twice = ((salted >> np.uint64(40)) % np.uint64(10_000)).astype(np.int64) < (1 / threshold - 1) * 10_000
    twice &= first != second
    every = np.arange(len(nodes))
    found = []
    for rows, chosen in ((every, first), (every[twice], second[twice])):
        value = values[rows, chosen].astype(np.uint64)
        below = mix64(salted[rows] + (value << np.uint64(7)) + chosen.astype(np.uint64) + np.uint64(1))
        found.append((rows, below))
    return found


def _descend(nodes, values, threshold, levels, first_level=0):
    """(rows, node) after so many levels."""
    rows = np.arange(len(nodes))
    for level in range(first_level, first_level + levels):
        parts = _children(nodes, values[rows], threshold, level)
        nodes = np.concatenate([node for _, node in parts])
        rows = np.concatenate([rows[at] for at, _ in parts])
    return rows, nodes


def own_coordinates(tree: int) -> np.ndarray:
    """The coordinates of a tree: each its own as far as they go, then drawn from all."""
    if (tree + 1) * OWN <= COORDINATES:
        return np.arange(tree * OWN, (tree + 1) * OWN)
    return np.random.default_rng(tree).choice(COORDINATES, OWN, replace=False)


_NODES = "node long, doc_id long, sketch binary, own binary"


def _first_nodes(members: DataFrame, threshold: float, trees: range) -> DataFrame:
    """(node, doc_id, sketch, own) after two levels of every tree; a byte per coordinate, compared and of the tree."""

    def task(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(ids), COORDINATES)
            # The low byte of a least value is all but uniform.
            low = (values & 0xFF).astype(np.uint8)
            sketches = pa.array([row.tobytes() for row in low[:, :SKETCH]], pa.binary())
            for tree in trees:
                columns = own_coordinates(tree)
                roots = mix64(np.full(len(ids), tree + 1, np.uint64))
                rows, nodes = _descend(roots, values[:, columns], threshold, 2)
                own = pa.array([row.tobytes() for row in low[:, columns]], pa.binary())
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes.view(np.int64)), pa.array(ids[rows]), sketches.take(take), own.take(take)],
                    ["node", "doc_id", "sketch", "own"],
                )

    return members.select("doc_id", "signature").mapInArrow(task, _NODES)


def _next_nodes(rows: DataFrame, threshold: float, level: int) -> DataFrame:
    def task(batches):
        for batch in batches:
            nodes = batch.column(0).to_numpy().view(np.uint64)
            values = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(len(nodes), OWN)
            at, below = _descend(nodes, values, threshold, 1, level)
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(below.view(np.int64)), *(batch.column(i).take(take) for i in (1, 2, 3))],
                ["node", "doc_id", "sketch", "own"],
            )

    return rows.select("node", "doc_id", "sketch", "own").mapInArrow(task, _NODES)


def _spread(count: int, unreached_of) -> Iterator[tuple[int, np.ndarray]]:
    """(member, those first reached from it): each member meets only what is not yet reached."""
    unreached = np.arange(count)
    while len(unreached):
        queue, unreached = [unreached[0]], unreached[1:]
        while queue and len(unreached):
            pivot = queue.pop()
            near = unreached_of(pivot, unreached)
            if near.any():
                yield pivot, unreached[near]
                queue.extend(unreached[near])
                unreached = unreached[~near]


def _sketch_forest(rows: DataFrame, least_equal: int) -> DataFrame:
    """Edges (a, b): a spanning forest of each node, over documents with close sketches."""

    def task(batches):
        for table in groups(batches):
            nodes, ids = table.column(0).to_numpy(), table.column(1).to_numpy()
            sketches = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(len(ids), SKETCH)
            starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
            sizes = np.diff(np.r_[starts, len(nodes)])
            pairs = starts[sizes == 2]
            close = (sketches[pairs] == sketches[pairs + 1]).sum(axis=1) >= least_equal
            a, b = [ids[pairs[close]]], [ids[pairs[close] + 1]]
            for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                own, names = sketches[start : start + size], ids[start : start + size]
                for pivot, near in _spread(size, lambda p, rest, own=own: (own[rest] == own[p]).sum(axis=1) >= least_equal):
                    a.append(names[near])
                    b.append(np.full(len(near), names[pivot]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    held = rows.repartition("node").sortWithinPartitions("node", "doc_id").select("node", "doc_id", "sketch")
    return held.mapInArrow(task, "a long, b long").distinct()


def _pivot_forest(rows: DataFrame, least_equal: int) -> list[DataFrame]:
    """Edges to a pivot of each node, round by round, until every document is close to one."""

    def task(batches):
        for batch in batches:
            own, pivots = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH) for i in (2, 4))
            near = pa.array((own == pivots).sum(axis=1) >= least_equal)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), near], ["node", "doc_id", "sketch", "pivot", "near"])

    edges = []
    while True:
        best = rows.groupBy(F.col("node").alias("_of")).agg(F.min(F.struct("doc_id", "sketch")).alias("_best"))
        best = stage(best.select("_of", F.col("_best.doc_id").alias("pivot"), F.col("_best.sketch").alias("pivot_sketch")))
        met = rows.join(best.hint("merge"), F.col("node") == F.col("_of")).select("node", "doc_id", "sketch", "pivot", "pivot_sketch")
        met = stage(met.mapInArrow(task, "node long, doc_id long, sketch binary, pivot long, near boolean"))
        edges.append(met.where("near and doc_id != pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")))
        # The pivot is near itself, so each round ends at least one document of every node.
        rows = met.where("not near").select("node", "doc_id", "sketch")
        if rows.isEmpty():
            return edges


def _candidate_edges(members: DataFrame, threshold: float, trees: int, node_rows: int) -> DataFrame:
    edges, deep = _tree_edges(_first_nodes(members, threshold, range(trees)), threshold, node_rows)
    if deep is not None:
        again = members.join(deep.hint("merge"), F.col("doc_id") == F.col("_deep")).drop("_deep")
        more = range(trees, trees + math.ceil(MORE_TREES * trees / TREES))
        edges += _tree_edges(_first_nodes(again, threshold, more), threshold, node_rows)[0]
    found = edges[0]
    for more in edges[1:]:
        found = found.union(more)
    return found


def _tree_edges(rows: DataFrame, threshold: float, node_rows: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Edges of all nodes below the given ones; and the documents in large nodes, if there are any."""
    slack = 5 * math.sqrt(SKETCH * threshold * (1 - threshold))
    least_equal = math.floor(SKETCH * threshold - slack)
    level, edges, deep = 2, [], None
    while True:
        sizes = stage(rows.groupBy(F.col("node").alias("_of")).agg(F.count("*").alias("n")).where(F.col("n") > 1))
        rows = stage(rows.join(sizes.hint("merge"), F.col("node") == F.col("_of")).drop("_of"))
        edges.append(_sketch_forest(rows.where(F.col("n") <= node_rows), least_equal))
        large = rows.where(F.col("n") > node_rows)
        if large.isEmpty():
            break
        if deep is None:
            deep = stage(large.select(F.col("doc_id").alias("_deep")).distinct())
        if level == DEEPEST:
            edges += _pivot_forest(large, least_equal)
            break
        rows, level = _next_nodes(large, threshold, level), level + 1
    return edges, deep


class _Sets:
    """Shingle sets of a group of documents, with exact comparison against one of them."""

    def __init__(self, group_texts: list[bytes], size: int, hashes: WordHash):
        sets = [shingles(text, size, hashes) for text in group_texts]
        self.size = np.array([len(s) for s in sets], np.int64)
        values, numbers = np.unique(np.concatenate(sets), return_inverse=True)
        self.starts = np.r_[0, np.cumsum(self.size)]
        self.numbers, self.marks = numbers, np.zeros(len(values), bool)

    def linked(self, pivot: int, rest: np.ndarray, percent: int) -> np.ndarray:
        own = self.numbers[self.starts[pivot] : self.starts[pivot + 1]]
        self.marks[own] = True
        # Sums of marks between the ends of each set.
        held = np.array([np.count_nonzero(self.marks[self.numbers[self.starts[r] : self.starts[r + 1]]]) for r in rest])
        self.marks[own] = False
        return 100 * held >= percent * (self.size[rest] + self.size[pivot] - held)


def _exact_small(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, root) for components that fit a task; rows: coarse, doc_id, text."""

    def task(batches):
        hashes = WordHash()
        for table in groups(batches):
            coarse, ids, held = table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2)
            starts = np.flatnonzero(np.r_[True, coarse[1:] != coarse[:-1]])
            roots = ids.copy()
            for start, end in zip(starts, np.r_[starts[1:], len(ids)], strict=True):
                sets = _Sets([held[i].as_py() for i in range(start, end)], size, hashes)
                own = roots[start:end]
                # Sorted by id: the first of a component is its smallest.
                for pivot, near in _spread(end - start, lambda p, rest, sets=sets: sets.linked(p, rest, percent)):
                    own[near] = own[pivot]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(roots)], ["doc_id", "root"])

    held = rows.repartition("coarse").sortWithinPartitions("coarse", "doc_id").select("coarse", "doc_id", "text")
    return held.mapInArrow(task, "doc_id long, root long")


def _pivot_links(rows: DataFrame, pivots: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) of documents linked to their component's pivot; rows and pivots by ``coarse``."""

    def task(batches):
        hashes, known, marked = WordHash(), None, None
        for batch in batches:
            a, b = [], []
            for doc, text, pivot, of in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if pivot != known:
                    known, marked = pivot, shingles(of, size, hashes)
                own = shingles(text, size, hashes)
                both = np.intersect1d(own, marked, assume_unique=True).size
                if 100 * both >= percent * (len(own) + len(marked) - both):
                    a.append(doc)
                    b.append(pivot)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    joined = rows.join(pivots, F.col("coarse") == F.col("_coarse")).select("doc_id", "text", "_pivot", "_text")
    return joined.mapInArrow(task, "a long, b long")


def _block_links(rows: DataFrame, linked: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges between documents not linked to the pivot and all of their component, by blocks.

    A unit is a block of the former with a block of all; only a forest of it is emitted.
    """
    apart = rows.join(linked.select(F.col("a").alias("_a")), F.col("doc_id") == F.col("_a"), "left_anti")
    def blocks(name):
        return F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias(name)

    left = stage(apart.select("coarse", "doc_id", "text", blocks("left")))
    if left.isEmpty():
        return left.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    present = left.select("coarse", "left").distinct()
    right_blocks = rows.select("coarse", "doc_id", "text", blocks("right"))
    right = right_blocks.join(present, "coarse").select("coarse", "left", "right", "doc_id", "text", F.lit(True).alias("all"))
    again = left.join(right_blocks.select("coarse", "right").distinct(), "coarse")
    again = again.select("coarse", "left", "right", "doc_id", "text", F.lit(False).alias("all"))
    unit = F.xxhash64("coarse", "left", "right").alias("unit")
    units = right.union(again).select(unit, "all", "doc_id", "text")

    def task(batches):
        hashes = WordHash()
        for table in groups(batches):
            names = table.column(0).to_numpy()
            starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
            a, b = [], []
            for start, end in zip(starts, np.r_[starts[1:], len(names)], strict=True):
                part = table.slice(start, end - start)
                whole, ids = part.column(1).to_numpy(), part.column(2).to_numpy()
                sets = _Sets(part.column(3).to_pylist(), size, hashes)
                _, label = np.unique(ids, return_inverse=True)
                for pivot in np.flatnonzero(~whole):
                    rest = np.flatnonzero(whole & (label != label[pivot]))
                    near = rest[sets.linked(pivot, rest, percent)]
                    # One edge for each part that is joined here.
                    joined, first = np.unique(label[near], return_index=True)
                    a += ids[near[first]].tolist()
                    b += [int(ids[pivot])] * len(first)
                    label[np.isin(label, joined)] = label[pivot]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    held = units.repartition("unit").sortWithinPartitions("unit").select("unit", "all", "doc_id", "text")
    return held.mapInArrow(task, "a long, b long")


def _exact_large(rows: DataFrame, edges: DataFrame, size: int, percent: int) -> DataFrame:
    """Exact edges of the components that no task gathers; the pivot is the busiest document."""
    degree = edges.groupBy("b").agg(F.count("*").alias("_degree"))
    ranked = rows.select("coarse", "doc_id").join(degree, F.col("doc_id") == F.col("b"))
    chosen = ranked.groupBy("coarse").agg(F.max(F.struct("_degree", F.negative("doc_id").alias("_id"))).alias("_best"))
    chosen = chosen.select(F.col("coarse").alias("_coarse"), F.negative(F.col("_best._id")).alias("_pivot"))
    pivots = stage(
        chosen.join(rows.select("doc_id", F.col("text").alias("_text")), F.col("doc_id") == F.col("_pivot")).drop("doc_id")
    )
    linked = stage(_pivot_links(rows, pivots, size, percent))
    return linked.union(_block_links(rows, linked, size, percent))


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    trees: int = TREES,
    node_rows: int = NODE_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; links are 100 * common >= percent * union."""
    base = stage(_signatures(docs, size))
    name = ["set_a", "set_b", "n_shingles"]
    known = base.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stage(known.groupBy(*name, "signature").agg(F.min("doc_id").alias("doc_id")))
    edges = stage(_candidate_edges(classes, percent / 100, trees, node_rows))
    coarse = stage(components(edges).select(F.col("vertex").alias("_vertex"), F.col("root").alias("coarse")))

    lengths = classes.groupBy("doc_id").agg(F.sum("n_shingles").alias("_shingles"))
    parts = F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("_shingles") / BLOCK_SHINGLES)).alias("parts")
    sizes = coarse.join(lengths, F.col("_vertex") == F.col("doc_id")).groupBy(F.col("coarse").alias("_of")).agg(parts)
    sized = coarse.join(sizes, F.col("coarse") == F.col("_of")).drop("_of")
    rows = texts(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    # By shuffles at any size: the texts are moved once, not the table of members to all tasks.
    rows = stage(rows.join(sized.hint("merge"), F.col("doc_id") == F.col("_vertex")).drop("_vertex"))
    roots = _exact_small(rows.where(F.col("parts") == 1), size, percent).where("doc_id != root")
    large = rows.where(F.col("parts") > 1)
    if not large.isEmpty():
        links = stage(_exact_large(large, edges, size, percent))
        roots = roots.union(components(links).select("vertex", "root").where("vertex != root"))
    roots = stage(roots)
    repeated = known.groupBy("doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        # Rows that share an id join the classes that each of them belongs to.
        ties = known.join(repeated.select(F.col("doc_id").alias("a")), F.col("doc_id") == F.col("a")).select(*name, "a")
        ties = ties.join(classes.select(*name, F.col("doc_id").alias("b")), name).select("a", "b")
        roots = components(roots.toDF("a", "b").union(ties)).where("vertex != root").toDF("doc_id", "root")

    of_class = classes.drop("signature").join(roots.withColumnRenamed("doc_id", "_vertex"), F.col("doc_id") == F.col("_vertex"), "left")
    of_class = stage(of_class.select(*name, F.coalesce("root", "doc_id").alias("component_id")))
    placed = base.drop("signature").join(of_class, name, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their component, with all their columns."""
    return without(docs, lambda rows: near_duplicates(rows, **options).where(~F.col("kept")).select("doc_id"))
