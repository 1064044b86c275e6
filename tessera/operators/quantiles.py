"""Exact quantiles, medians and modes whose memory does not grow with the distinct values.

Values are counted first (partial aggregation), the counted values are range-partitioned by
(group, column, value) so that every task holds a run of the order, and running counts are
stitched with one offset per task and key.  A quantile is interpolated between the two
values at its neighbouring positions; nothing gathers a group's values in one buffer.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., column, q) with ``q`` = array of the linearly interpolated quantiles ``probs``
    of each column, nulls left out; a column without values in a group has no row."""
    g = list(groups)
    keys = [*g, "column"]
    long = df.select(*g, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in cols]))).where("_v is not null")
    counted = long.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = cut_lineage(counted.repartitionByRange(n, *keys, "_v").withColumn("_pid", F.spark_partition_id()))
    per = run.groupBy(*keys, "_pid").agg(F.sum("_c").alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    per = per.select(*keys, "_pid", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"),
                     F.sum("_s").over(whole).alias("_n"))  # a row per task and key
    inside = Window.partitionBy(*keys, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (run.join(per, [*keys, "_pid"]).withColumn("_hi", F.col("_off") + F.sum("_c").over(inside))
              .withColumn("_lo", F.col("_hi") - F.col("_c")))
    aggs, outs = [F.max("_n").alias("_n")], []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        k = F.floor(h)
        at = lambda pos: F.max(F.when((F.col("_lo") <= pos) & (pos < F.col("_hi")), F.col("_v")))
        aggs += [at(k).alias(f"_a{i}"), at(F.least(k + 1, F.col("_n") - 1)).alias(f"_b{i}")]
        f = h - k
        outs.append(F.when(f == 0, F.col(f"_a{i}")).otherwise((1 - f) * F.col(f"_a{i}") + f * F.col(f"_b{i}")))
    return placed.groupBy(*keys).agg(*aggs).select(*keys, F.array(*outs).alias("q"))


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """``exact_quantiles`` of whole columns as plain numbers (one row per column comes to the
    driver); a column without values gives nulls."""
    found = {r["column"]: list(r["q"]) for r in exact_quantiles(df, cols, probs).collect()}
    return {c: found.get(c, [None] * len(probs)) for c in cols}


def exact_median(df: DataFrame, col: str, groups: Sequence[str], out: str) -> DataFrame:
    """(groups..., out): median of ``col`` per group."""
    return exact_quantiles(df, [col], [0.5], groups).select(*groups, F.col("q")[0].alias(out))


def exact_mode(df: DataFrame, col: str, groups: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """(groups..., out): most frequent non-null value, the smallest on ties; values are counted
    first, so a group's buffer is one value."""
    counted = df.where(F.col(col).isNotNull()).groupBy(*groups, col).agg(F.count(F.lit(1)).alias("_c"))
    return counted.groupBy(*groups).agg(F.min_by(col, F.struct(-F.col("_c"), F.col(col))).alias(out or col))


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict:
    """Mode of each column as a plain value."""
    return {c: (exact_mode(df, c).first() or [None])[0] for c in cols}
