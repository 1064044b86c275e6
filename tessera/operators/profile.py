"""Profiling and aggregation operators.

Rules followed throughout: every per-column statistic for all columns comes out of
one ``agg`` (one pass, partial aggregation per task); shares divide by a scalar
subquery total instead of a window over the whole table; long (metric) layouts are
produced with ``inline`` of one row, not by unions of per-column jobs.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_mode, exact_quantiles, quantile_values


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rate_by(df: DataFrame, keys: Sequence[str], target, scale: float = 100.0) -> DataFrame:
    """Rows, positives and mean target (x scale) per group."""
    t = _c(target)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.sum(t).cast("long").alias("positives"),
                                 (F.avg(t) * scale).alias("rate"))


def conditional_share(df: DataFrame, keys: Sequence[str], cond: Column, out: str = "share",
                      scale: float = 100.0) -> DataFrame:
    """Percent of rows meeting ``cond`` per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 (F.avg(F.when(cond, 1.0).otherwise(0.0)) * scale).alias(out))


def gated_top_k(df: DataFrame, keys: Sequence[str], cond: Column, min_n: int, k: int,
                out: str = "rate") -> DataFrame:
    """E5: groups with at least ``min_n`` rows, the ``k`` highest rates (ties by key)."""
    g = conditional_share(df, keys, cond, out).filter(F.col("n") >= min_n)
    return g.orderBy(F.desc(out), *[F.asc(c) for c in keys]).limit(k)


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Counts and normalised frequency of each value."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
              .withColumn("share", F.col(out) / total))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence, aliases: Sequence[str] | None = None,
             agg: Column | None = None) -> DataFrame:
    """Pivot with a fixed list of column values (no extra distinct job), zero-filled."""
    a = agg if agg is not None else F.count(F.lit(1))
    p = df.groupBy(row).pivot(col, list(values)).agg(a).fillna(0)
    if aliases:
        p = p.select(row, *[F.col(f"`{v}`").alias(n) for v, n in zip(values, aliases)])
    return p


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pandas ``describe().T``: count, mean, std (ddof 1), min, exact quartiles, max."""
    q = quantile_values(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                             *[F.lit(v).cast("double").alias(n) for n, v in zip(("p25", "p50", "p75"), q[c])],
                             F.max(x).alias("max")).alias(c))
    return df.agg(*aggs).select(F.inline(F.array(*cols)))


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair (a < b in list order), pairwise-complete rows,
    all pairs in a single aggregate; long (a, b, r) layout."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    return agg.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                                   F.col(f"{a}__{b}").alias("r")) for a, b in pairs])))


def correlation_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    agg = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    return agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("r"))
                                         for c in cols])))


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population skewness (Spark, scipy) and the bias-corrected form (pandas):
    G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    agg = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("n"),
                            F.skewness(c).alias("skew_population")).alias(c) for c in cols])
    out = agg.select(F.inline(F.array(*cols)))
    n = F.col("n").cast("double")
    return out.withColumn("skew_sample", F.col("skew_population") * F.sqrt(n * (n - 1)) / (n - 2))


def group_mode(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """Most frequent value per group, smallest on ties."""
    return exact_mode(df, col, list(keys), out)


def least_squares(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Slope, intercept and r of y on x."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"),
                                 F.regr_intercept(y, x).alias("intercept"),
                                 F.corr(x, y).alias("r"))


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None,
              hi: float | None = None) -> DataFrame:
    """Equal-width histogram including empty bins (spine of ``bins`` rows);
    optional clipping range, otherwise the data range; the maximum falls in the last bin."""
    x = F.col(col).cast("double")
    d = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    if lo is not None and hi is not None:
        d = d.select(F.least(F.greatest("_x", F.lit(lo)), F.lit(hi)).alias("_x"))
        lo_c, hi_c = F.lit(float(lo)), F.lit(float(hi))
    else:
        mm = d.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
        lo_c, hi_c = mm.select("lo").scalar(), mm.select("hi").scalar()
    width = (hi_c - lo_c) / bins
    b = F.least(F.lit(bins - 1), F.floor((F.col("_x") - lo_c) / width)).cast("int")
    counts = d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (F.broadcast(spine).join(counts, "bin", "left").fillna(0, ["n"])
              .withColumn("bin_lo", lo_c + F.col("bin") * width)
              .withColumn("bin_hi", lo_c + (F.col("bin") + 1) * width))


def box_stats(df: DataFrame, keys: Sequence[str], col: str, factor: float = 1.5) -> DataFrame:
    """Quartiles, fences, whisker ends (extreme values inside the fences) and
    outlier counts per group: exact quartiles, then one conditional aggregate."""
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], list(keys))
    q = q.select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("lower", F.col("q1") - factor * (F.col("q3") - F.col("q1"))) \
         .withColumn("upper", F.col("q3") + factor * (F.col("q3") - F.col("q1")))
    x = F.col(col)
    inside = (x >= F.col("lower")) & (x <= F.col("upper"))
    s = (df.join(q, list(keys))
           .groupBy(*keys, "q1", "median", "q3", "lower", "upper")
           .agg(F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
                F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("n_outliers")))
    return s


def zscores(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / sample std, statistics from one aggregate."""
    st = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols])
    return df.withColumns({f"{c}{suffix}": (F.col(c) - st.select(f"m_{c}").scalar()) / st.select(f"s_{c}").scalar()
                           for c in cols})


def kpi_table(df: DataFrame, metrics: Sequence[tuple[str, Column]]) -> DataFrame:
    """(metric, value) rows from a single aggregate."""
    agg = df.agg(*[m.cast("double").alias(n) for n, m in metrics])
    return agg.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"))
                                         for n, _ in metrics])))


def breakdown(df: DataFrame, dim: str, order: Sequence[str], flag: Column, score: Column) -> DataFrame:
    """E19 + G3: per category in a fixed order (absent categories kept with zeros):
    rows, flagged rows, flagged share, mean score."""
    spark = df.sparkSession
    od = spark.createDataFrame([(v, i) for i, v in enumerate(order)], f"{dim} string, dim_order int")
    g = df.groupBy(dim).agg(F.count(F.lit(1)).alias("n"),
                            F.sum(F.when(flag, 1).otherwise(0)).cast("long").alias("flagged"),
                            F.avg(score).alias("mean_score"))
    return (F.broadcast(od).join(g, dim, "left")
              .fillna(0, ["n", "flagged"])
              .withColumn("flagged_share", F.try_divide(F.col("flagged"), F.col("n"))))


def imbalance(df: DataFrame, label: str, group: str | None = None) -> DataFrame:
    """Per-label rows (and distinct groups), with max/min imbalance ratios."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if group:
        aggs.append(F.count_distinct(group).alias("n_groups"))
    g = df.groupBy(label).agg(*aggs)
    st = g.agg(F.max("n").alias("mx"), F.min("n").alias("mn"),
               *([F.max("n_groups").alias("gmx"), F.min("n_groups").alias("gmn")] if group else []))
    out = g.withColumn("ratio_rows", st.select(F.col("mx") / F.col("mn")).scalar())
    if group:
        out = out.withColumn("ratio_groups", st.select(F.col("gmx") / F.col("gmn")).scalar()) \
                 .withColumn("rows_per_group", F.col("n") / F.col("n_groups"))
    return out


def class_split_inventory(df: DataFrame, label: str, split: str) -> DataFrame:
    """M6: rows per class and split, their share of the split and of the class, and each
    split's largest over smallest class.  Sums come from the small count table."""
    g = df.groupBy(label, split).agg(F.count(F.lit(1)).alias("n"))
    by_split = g.groupBy(split).agg(F.sum("n").alias("_s"), (F.max("n") / F.min("n")).alias("imbalance"))
    by_label = g.groupBy(label).agg(F.sum("n").alias("_c"))
    return (g.join(by_split, split).join(by_label, label)
            .select(label, split, "n", (F.col("n") / F.col("_s")).alias("share_of_split"),
                    (F.col("n") / F.col("_c")).alias("share_of_class"), "imbalance"))


def class_means_minmax(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each feature per class, min-max normalised across classes
    (long layout: label, feature, mean, scaled)."""
    means = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])
    long = means.select(label, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean"))
                                                  for c in cols])))
    rng = long.groupBy("feature").agg(F.min("mean").alias("_lo"), F.max("mean").alias("_hi"))
    return (long.join(rng, "feature")
                .withColumn("scaled", F.try_divide(F.col("mean") - F.col("_lo"), F.col("_hi") - F.col("_lo")))
                .drop("_lo", "_hi"))


def array_position_means(df: DataFrame, label: str, arr: str) -> DataFrame:
    """Per class and array position, mean value and rows (works on any numeric
    array column: pixel channels, embeddings, probability vectors)."""
    e = df.select(label, F.posexplode(arr).alias("position", "_v"))
    return e.groupBy(label, "position").agg(F.avg("_v").alias("mean"), F.count(F.lit(1)).alias("n"))


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, out: str = "share") -> DataFrame:
    """Grouped sums with their share of the grand total (scalar total)."""
    total = df.select(F.sum(value)).scalar()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias(value)) \
             .withColumn(out, F.col(value) / total)
