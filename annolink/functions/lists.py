"""Entity lists: arrays of (name, entity_id, score) inside, text at the edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from annolink.fixed_values import ENTRY_SEPARATOR, FIELD_SEPARATOR


def encode_list(entities: Column) -> Column:
    """Text form of a list; blank for an empty or missing one."""
    entries = F.transform(
        entities,
        lambda e: F.array_join(
            F.array(e["name"], e["entity_id"], e["score"].cast("string")), FIELD_SEPARATOR, ""
        ),
    )
    return F.coalesce(F.array_join(entries, ENTRY_SEPARATOR), F.lit(""))


def decode_list(text: Column) -> Column:
    """Array of (name, entity_id, score) from the text form; empty for a blank text."""
    entries = F.filter(F.split(text, ENTRY_SEPARATOR), lambda e: e != "")
    fields = F.transform(entries, lambda e: F.split(e, FIELD_SEPARATOR))
    return F.transform(
        fields,
        lambda f: F.struct(
            F.get(f, F.lit(0)).alias("name"),
            F.get(f, F.lit(1)).alias("entity_id"),
            F.get(f, F.lit(2)).try_cast("int").alias("score"),
        ),
    )
