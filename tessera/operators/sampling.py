"""Splits, folds and re-balancing.

Randomness is a stable hash of (seed, key) (or any caller-given order expression), so
an assignment never depends on partitioning or task retries, unlike ``rand()`` or
``randomSplit``.  Per-class ranks use the range-partitioned index, so a class holding
a third of all rows is spread over many tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import sequence_index_sized, stable_hash


def _order(df: DataFrame, key_cols: Sequence[str], seed: int, order: Column | None) -> DataFrame:
    return df.withColumn("_ord", order if order is not None else stable_hash(seed, *key_cols))


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str], test_frac: float = 0.2,
                     seed: int = 42, order: Column | None = None, names=("train", "test")) -> DataFrame:
    """Per class, the first round(test_frac * n_c) rows in hash order are test."""
    d = _order(df, key_cols, seed, order)
    d = sequence_index_sized(d, ["_ord", *key_cols], [label], "_p", "_n")
    return d.withColumn("split", F.when(F.col("_p") <= F.round(F.col("_n") * test_frac), names[1])
                        .otherwise(names[0])).drop("_ord", "_p", "_n")


def stratified_folds(df: DataFrame, label: str | None, key_cols: Sequence[str], k: int = 5, seed: int = 42,
                     order: Column | None = None) -> DataFrame:
    """fold = (rank within class in hash order - 1) mod k (k-fold when label=None)."""
    d = _order(df, key_cols, seed, order)
    d = sequence_index_sized(d, ["_ord", *key_cols], [label] if label else [], "_p", "_n")
    return d.withColumn("fold", ((F.col("_p") - 1) % k).cast("int")).drop("_ord", "_p", "_n")


def timeseries_folds(df: DataFrame, ts: str, tiebreak: Sequence[str], n_splits: int = 3) -> DataFrame:
    """Expanding-window folds (TimeSeriesSplit): test size n // (n_splits + 1);
    fold i tests rows (n - (n_splits - i) * t, n - (n_splits - i - 1) * t], trains on
    everything before.  Returns (fold, role) rows per input row (train rows repeat)."""
    d = sequence_index_sized(df, [ts, *tiebreak], [], "_p", "_n")
    t = F.floor(F.col("_n") / (n_splits + 1))
    roles = []
    for i in range(n_splits):
        lo = F.col("_n") - (n_splits - i) * t
        hi = lo + t
        roles.append(F.when(F.col("_p") <= lo, F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role")))
                      .when(F.col("_p") <= hi, F.struct(F.lit(i).alias("fold"), F.lit("test").alias("role"))))
    e = d.withColumn("_r", F.explode(F.filter(F.array(*roles), lambda x: x.isNotNull())))
    return e.withColumn("fold", F.col("_r.fold")).withColumn("role", F.col("_r.role")).drop("_r", "_p", "_n")


def group_split(df: DataFrame, label: str, group: str, test_frac: float = 0.2, seed: int = 42,
                order: Column | None = None) -> DataFrame:
    """I4: group-aware stratified split: a group goes to test while the rows already
    assigned to test in its class are below test_frac of the class.  One row per
    (class, group) is ordered (hash), so groups never cross splits; joined back."""
    g = df.groupBy(label, group).agg(F.count(F.lit(1)).alias("_size"))
    g = g.withColumn("_ord", order if order is not None else stable_hash(seed, label, group))
    w = Window.partitionBy(label).orderBy("_ord", group).rowsBetween(Window.unboundedPreceding, -1)
    tot = g.groupBy(label).agg(F.sum("_size").alias("_tot"))
    g = g.join(tot, label).withColumn("_before", F.coalesce(F.sum("_size").over(w), F.lit(0)))
    g = g.withColumn("split", F.when(F.col("_before") < F.col("_tot") * test_frac, "test").otherwise("train"))
    return df.join(g.select(label, group, "split"), [label, group])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    st = c.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    return c.withColumn("weight", st.select(F.col("n")).scalar() / (st.select(F.col("k")).scalar() * F.col("n_c")))


def pos_weight(df: DataFrame, label: str) -> Column:
    """Negatives / positives (scale_pos_weight) as a scalar column."""
    return df.select(F.sum(F.when(F.col(label) == 0, 1).otherwise(0)) / F.sum(F.when(F.col(label) == 1, 1).otherwise(0))).scalar()


def fractional_subsample(df: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str], frac: float,
                         seed: int = 42, order: Column | None = None) -> DataFrame:
    """Per group (e.g. split x class) keep the first round(frac * n) rows in hash order."""
    d = _order(df, key_cols, seed, order)
    d = sequence_index_sized(d, ["_ord", *key_cols], list(group_cols), "_p", "_n")
    return d.filter(F.col("_p") <= F.round(F.col("_n") * frac)).drop("_ord", "_p", "_n")


def resplit_pooled(df: DataFrame, split: str, label: str, key_cols: Sequence[str], pool=("train", "val"),
                   val_frac: float = 0.15, seed: int = 42, order: Column | None = None) -> DataFrame:
    """I8: pool train+val and re-split them stratified; other splits (test) untouched."""
    pooled = df.filter(F.col(split).isin(*pool)).drop(split)
    rest = df.filter(~F.col(split).isin(*pool))
    re = stratified_split(pooled, label, key_cols, val_frac, seed, order, names=pool)
    return re.unionByName(rest)
