"""Set operations on document ids."""

from __future__ import annotations

from pyspark.sql import DataFrame


def intersect_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that are not in ``b``; copies in ``a`` stay."""
    return a.join(b, a.columns, "left_anti")


def restrict_to(ids: DataFrame, allowed: DataFrame, key: str = "doc_id") -> DataFrame:
    return ids.join(allowed, key, "left_semi")
