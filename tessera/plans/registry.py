"""Query registry.

``@query(name, sql, floats=(...))`` registers a Spark query together with its DuckDB
oracle.  Columns listed in ``floats`` are normalised identically on both sides:
sums of doubles in a different order differ in the last bits, so values are snapped
to single precision after scaling by an irrational constant (``SNAP``) and scaled
back.  Decimal rounding would split exact decimal ties (frequent with money and
percent data), plain float32 snapping splits exact dyadic ties (.5, .25, .1875, ...);
after the irrational scaling neither structure survives.  Other columns compare exactly.

``sql=None`` registers a query without an oracle (rows-only check); such queries are
checked against brute force on small fixtures in ``tests/``.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAP = 0.7853981633974483  # pi / 4
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _wrap_sql(sql: str, floats: Sequence[str]) -> str:
    if not floats:
        return sql.strip()
    k = f"CAST({SNAP!r} AS DOUBLE)"
    rep = ", ".join(f"CAST(CAST(CAST({c} AS DOUBLE) * {k} AS FLOAT) AS DOUBLE) / {k} AS {c}" for c in floats)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql.strip()}\n) AS q"


def query(name: str, sql: str | None, floats: Sequence[str] = ()):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            for c in floats:
                k = F.lit(SNAP)
                df = df.withColumn(c, (F.col(c).cast("double") * k).cast("float").cast("double") / k)
            return df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _wrap_sql(sql, floats)
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their decorators run."""
    from . import retail, cleaning, profile, evaluation, timeseries, text, commerce, sampling, io, features, ml, linear, neighbours, extras, completeness  # noqa: F401
