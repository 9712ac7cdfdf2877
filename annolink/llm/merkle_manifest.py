"""Merkle manifest of a table: a hash tree per source, and one over the sources.

Every node is labelled with the interval [lo, hi) of leaf ranks that it covers, so one node
is above another exactly where its interval contains the other's.

1. Every row is hashed to a leaf. All rows are ranked by a range sort over (source, id, leaf), written
   once; a source covers a stretch of ranks, and a rank less the start of its stretch is the
   rank of the leaf in its source.
2. Nodes of a level are the runs of ``fan`` nodes below, so the nodes of level v sit in buckets
   of fan ** v ranks. Every level is written; each has a fan-th of the rows of the one below.
3. From the top down, every node finds its ancestor by an equality of (tree, bucket) and the
   containment of intervals. What the ancestor covers besides the node's own interval are its
   siblings, to the left and to the right; with the ancestor's own steps they make the node's path.

A bucket has ``fan`` nodes at most, so no key is hot, however large a source is. A path has a
step of at most ``fan`` - 1 digests per level.

Cases: a null value hashes as ``-``; the null source is a tree of its own, the first. Rows of
one id are ranked by leaf; repeated rows are leaves each, and sit side by side. Rows without an id come
first in their source. A source with one row has its leaf as its root. Texts of any length are
hashed whole. An empty table gives an empty result. Only the columns named take part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolink.operators.skew import with_position
from annolink.staging import stage
from annolink.unions import append

FAN = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The hash of a row: each value as its length in bytes and itself, so none runs into the next."""
    texts = [c.cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return digest(F.concat(*fields))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along its path."""
    return F.aggregate(path, leaf, lambda below, s: digest(F.concat(s["left"], below, s["right"])))


def siblings(path: Column) -> Column:
    """All siblings' digests of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _bucket(level: int, fan: int) -> Column:
    """The place of the level's node that covers the rank ``lo``."""
    return F.expr(f"lo div {fan ** level}L").alias("bucket")


def _height(size: int, fan: int) -> int:
    level = 0
    while fan**level < size:
        level += 1
    return level


def _levels(leaves: DataFrame, fan: int) -> list[DataFrame]:
    """Nodes of every level from 0: tree, size of the tree, lo, hi, digest, and children above 0.

    ``leaves`` holds (tree, size, lo, digest), written.
    """
    most = leaves.agg(F.max("size")).first()[0] or 0
    nodes = leaves.select("tree", "size", "lo", (F.col("lo") + 1).alias("hi"), "digest")
    levels = [nodes]
    for level in range(1, _height(most, fan) + 1):
        below = levels[-1].where(F.col("size") > fan ** (level - 1))
        run = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        runs = below.groupBy("tree", "size", _bucket(level, fan)).agg(run.alias("children"))
        joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        levels.append(
            stage(
                runs.select(
                    "tree",
                    "size",
                    F.col("children")[0]["lo"].alias("lo"),
                    F.element_at("children", -1)["hi"].alias("hi"),
                    digest(joined).alias("digest"),
                    "children",
                )
            )
        )
    return levels


def _is_top(level: int, fan: int) -> Column:
    low = F.col("size") > fan ** (level - 1) if level else F.col("size") > 0
    return low & (F.col("size") <= fan**level)


def _tops(levels: list[DataFrame], fan: int) -> DataFrame:
    """(tree, digest) of each tree's root."""
    return append(*[nodes.where(_is_top(v, fan)).select("tree", "digest") for v, nodes in enumerate(levels)])


def _attached(levels: list[DataFrame], leaves: DataFrame, tops: DataFrame, fan: int) -> DataFrame:
    """``leaves`` with the columns of ``tops`` (tree, path, ...) and their whole ``path``.

    ``levels`` as by ``_levels``; the paths of ``tops`` are those above each tree's root.
    """
    above = None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level] if level else leaves.withColumn("hi", F.col("lo") + 1)
        found = nodes.where(_is_top(level, fan)).join(tops, "tree")
        if above is not None:
            inner = nodes.where(F.col("size") > fan**level).select("*", _bucket(level + 1, fan))
            covers = (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            found = append(found, _with_step(inner.join(above, ["tree", "bucket"]).where(covers)).select(*found.columns))
        if not level:
            return found.drop("hi")
        rest = [c for c in tops.columns if c not in ("tree", "path")]
        above = stage(
            found.select("tree", _bucket(level, fan), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("children").alias("_children"), "path", *rest)
        )
    raise AssertionError("unreachable")


def _with_step(nodes: DataFrame) -> DataFrame:
    """The path of the ancestor, with the node's own siblings put in front."""

    def digests(beside) -> Column:
        return F.array_join(F.transform(F.filter("_children", beside), lambda c: c["digest"]), "")

    left, right = digests(lambda c: c["hi"] <= F.col("lo")), digests(lambda c: c["lo"] >= F.col("hi"))
    step = F.array(F.struct(left.alias("left"), right.alias("right"))).cast(PATH)
    return nodes.withColumn("path", F.concat(step, "path"))


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    source_col: str = "source",
    carry: dict[str, Column] | None = None,
    fan: int = FAN,
) -> DataFrame:
    """doc_id, leaf, subroot, root, path per row, and the columns of ``carry``.

    ``path`` holds the steps from the leaf to the root, each with the digests left and right of
    the node, joined; ``folded`` follows it and ``siblings`` lists it.
    """
    carry = carry or {}
    hashed = docs.select(
        F.col(id_col).alias("doc_id"),
        # A key without nulls, in the order of the sources.
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("_source"),
        leaf_digest([F.col(c) for c in columns]).alias("digest"),
        F.struct(F.lit(True).alias("_"), *[c.alias(n) for n, c in carry.items()]).alias("_carry"),
        # Tells repeated rows apart, so that the range sort can split them.
        F.monotonically_increasing_id().alias("_row"),
    )
    ranked = with_position(stage(hashed), "_source", F.col("doc_id").asc_nulls_first(), "digest", "_row", name="_rank")
    ranked = stage(ranked.drop("_row"))
    sources = ranked.groupBy("_source").agg(F.min("_rank").alias("_first"), F.count("*").alias("size"))
    sources = stage(with_position(sources, "_source", name="tree"))
    placed = ranked.join(sources, "_source").withColumn("lo", F.col("_rank") - F.col("_first"))
    leaves = stage(placed.select("tree", "size", "lo", "digest", "doc_id", "_carry"))

    levels = _levels(leaves, fan)
    subroots = stage(_tops(levels, fan))
    n_sources = subroots.count()
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(n_sources).cast("long").alias("size"), F.col("tree").alias("lo"), "digest"
    )
    upper = _levels(tops, fan)
    root = _tops(upper, fan).first()
    start = _tops(upper, fan).select("tree", F.array().cast(PATH).alias("path"))
    over = _attached(upper, tops, start, fan)
    over = stage(over.select(F.col("lo").alias("tree"), "path", F.col("digest").alias("subroot")))

    found = _attached(levels, leaves, over, fan)
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        "path",
        *[F.col("_carry")[n].alias(n) for n in carry],
    )
