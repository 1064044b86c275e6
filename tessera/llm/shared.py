"""Shared folder, scans and key exchange for the operators of this subpackage."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir`` (the folder all executors share)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Lineage ends there: a lost executor later on costs the running tasks, not the stage
    that made the table.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch between the JVM and Python, so that a batch of long texts or of
#: binary rows stays small beside the arrays made from it.
ARROW_BATCH = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Whole table ``name``, projected at the scan; Arrow batches of the session are bounded."""
    bound_batches(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def with_extra(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, tuple[str, ...], Callable[[DataFrame], DataFrame]]:
    """Carry a table's further columns through an operator, whatever they are called.

    Returns ``docs`` with all columns but ``used`` in one struct ``_extra``, the columns to keep,
    and a function that restores the original columns from a result that has those.
    """
    others = [c for c in docs.columns if c not in used]
    if not others:
        return docs, used, lambda out: out.select(*docs.columns)
    packed = docs.select(*used, F.struct(*[F.col(f"`{c}`") for c in others]).alias("_extra"))
    restored = [F.col(c) if c in used else F.col("_extra").getField(c).alias(c) for c in docs.columns]
    return packed, (*used, "_extra"), lambda out: out.select(*restored)
