"""Registered queries over the driver tables (one per operator family member).

Each query is a ``(spark, sf_dir) -> DataFrame`` function plus an independent DuckDB
SQL statement computing the same table; ``registry.QUERIES`` / ``registry.ORACLES``
collect them for ``__spark_entry__``.
"""
