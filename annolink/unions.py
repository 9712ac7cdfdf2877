"""Appending tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name.

    Spark 4.1 treats a union of equally partitioned tables as partitioned and leaves out
    the next shuffle. Adaptive execution may change one of the tables afterwards, and the
    query fails; so the session is told not to do that.
    """
    tables[0].sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return reduce(DataFrame.unionByName, tables)
