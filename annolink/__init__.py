"""Annotated document collections on Spark: filter, label, gather, search, mine, evaluate."""
