"""Driver-table reader: one Parquet file per table under an ``sf`` directory."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Tables whose rows carry heavy per-row work (whole texts: regexes, tokenising,
# n-grams) and their unique key, used to spread an under-split scan.  Numeric tables
# are not spread: their scans feed partial aggregation directly and an extra exchange
# costs more than it saves.
KEYS = {"documents": "doc_id", "pages": "page_id", "benchmark": "item_id", "conversations": "conv_id"}


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``; projecting here keeps the scan's ReadSchema narrow.

    Scan parallelism is bounded by Parquet row groups.  When a text table yields fewer
    splits than the session's default parallelism (e.g. one large row group), the
    projected columns are hash-partitioned on the table key so that CPU-heavy row work
    (regexes, tokenising, explode) does not run in a single task.  With many files or
    row groups (the normal case at scale) the scan is left as it is.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df, KEYS.get(name))


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    target = df.sparkSession.sparkContext.defaultParallelism
    if key is None or target <= 1:
        return df
    if df.rdd.getNumPartitions() >= target:
        return df
    cols = [key] if key in df.columns else df.columns
    return df.repartition(target, *cols)
