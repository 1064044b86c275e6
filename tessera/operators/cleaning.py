"""Cleaning operators (B1-B30): normalisation, de-duplication, rule funnels,
imputation, outlier handling.  Per-column statistics are computed in a single
``agg`` pass whatever the number of columns.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_median, mode_values, quantile_values
from pyspark.sql import types as T

# Stock codes that are not sellable products (compared after strip+upper).
NON_PRODUCT_CODES = [
    "POST", "DOT", "D", "M", "C2", "BANK CHARGES", "BANK_CHARGE", "AMAZONFEE", "CRUK",
    "S", "GIFT", "PADS", "TEST001", "TEST002", "ADJUST", "ADJUST2",
]

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


# ---------------------------------------------------------------- B1, B4, B5, B6
def normalize_text(df: DataFrame, cols: Sequence[str], lower: bool = False) -> DataFrame:
    """B1: strip (and optionally lower-case) text columns."""
    return df.withColumns({c: (F.lower(F.trim(c)) if lower else F.trim(c)) for c in cols})


def is_blank(x) -> Column:
    """Null or empty after strip."""
    x = _c(x)
    return x.isNull() | (F.length(F.trim(x)) == 0)


def is_non_product(code) -> Column:
    """Code in the fixed non-product list, or letters only (after strip+upper);
    null -> True."""
    c = F.upper(F.trim(_c(code)))
    return F.coalesce(c.isin(*NON_PRODUCT_CODES) | c.rlike("^[A-Za-z]+$"), F.lit(True))


def is_cancellation(invoice) -> Column:
    """Invoice starts with "C"; null -> False."""
    return F.coalesce(_c(invoice).startswith("C"), F.lit(False))


# ---------------------------------------------------------------- B8 funnel
def rule_funnel(df: DataFrame, rules: Sequence[tuple[str, Column]], dedupe: bool = True,
                flags: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Rows removed by each ordered rule, as a (step, rows, step_order) table.

    ``rules`` are (name, predicate-that-removes) in order; a row is charged to the
    *first* rule it fails, which equals applying the filters one after the other.
    Exact duplicates go first: one aggregate over all columns keeps each distinct row
    with its multiplicity (partial per task, so a row repeated a billion times costs
    one entry per task).  ``flags`` (e.g. cancellations) are counted on the raw rows.
    The whole funnel is that one shuffle plus one global aggregate.
    """
    cols = df.columns
    if dedupe:
        base = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    else:
        base = df.withColumn("_m", F.lit(1))
    first = F.lit(None).cast("string")
    for name, pred in reversed(rules):
        first = F.when(pred, F.lit(name)).otherwise(first)
    kept = base.withColumn("_rule", first)
    one = F.lit(1)
    aggs = [F.sum("_m").cast("long").alias("raw_rows")]
    aggs += [F.sum(F.when(p, F.col("_m")).otherwise(0)).cast("long").alias(n) for n, p in flags]
    if dedupe:
        aggs.append((F.sum("_m") - F.count(one)).cast("long").alias("dropped_duplicates"))
    aggs += [F.sum(F.when(F.col("_rule") == n, 1).otherwise(0)).cast("long").alias(n) for n, _ in rules]
    aggs.append(F.sum(F.when(F.col("_rule").isNull(), 1).otherwise(0)).cast("long").alias("clean_rows"))
    stats = kept.agg(*aggs)
    names = stats.columns
    return stats.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("step"), F.col(n).alias("rows"), F.lit(i).alias("step_order"))
        for i, n in enumerate(names)])))


def rule_split(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows passing every rule, and the removed rows labelled with their first rule."""
    first = F.lit(None).cast("string")
    for name, pred in reversed(rules):
        first = F.when(pred, F.lit(name)).otherwise(first)
    d = df.withColumn("_rule", first)
    return d.filter(F.col("_rule").isNull()).drop("_rule"), d.filter(F.col("_rule").isNotNull())


# ---------------------------------------------------------------- B9, B10, B11-B14
def map_categories(df: DataFrame, col: str, mapping: Mapping[str, str | None], out: str) -> DataFrame:
    """Dictionary consolidation; unmapped or None-mapped rows are dropped.
    The mapping is a parameter-sized table, so broadcasting it is bounded."""
    spark = df.sparkSession
    m = spark.createDataFrame([(k, v) for k, v in mapping.items() if v is not None],
                              T.StructType([T.StructField(col, T.StringType()),
                                            T.StructField(out, T.StringType())]))
    return df.join(F.broadcast(m), col, "inner")


def lenient_double(x) -> Column:
    """``to_numeric(errors="coerce")`` -> null on bad input (ANSI-safe)."""
    return _c(x).try_cast("double")


def impossible_to_null(x, lo: float = 0.0) -> Column:
    """Values below ``lo`` become null."""
    return F.when(_c(x) >= lo, _c(x))


# ---------------------------------------------------------------- B15, B16, B24, B25
def column_cardinality(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column counting null as a value; one aggregate pass.
    Returns (column, n_distinct, is_constant)."""
    cols = list(cols or df.columns)
    agg = df.agg(*[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in cols])
    return (agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"),
                                                    F.col(c).cast("long").alias("n_distinct"))
                                          for c in cols])))
               .withColumn("is_constant", F.col("n_distinct") <= 1))


def drop_constant_columns(df: DataFrame, configured: Sequence[str] = (),
                          exclude: Sequence[str] = ()) -> DataFrame:
    """Drop the configured list plus any column with <= 1 distinct value incl. null.
    The (tiny) per-column profile is read on the driver to build the projection."""
    prof = column_cardinality(df, [c for c in df.columns if c not in exclude]).filter("is_constant")
    const = {r["column"] for r in prof.collect()}
    return df.drop(*[c for c in df.columns if c in const or c in configured])


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B16."""
    return df.drop(*[c for c in cols if c in df.columns])


# ---------------------------------------------------------------- B19-B23
def winsorize(df: DataFrame, cols: Sequence[str], lo: float = 0.005, hi: float = 0.995) -> DataFrame:
    """Clip to the ``lo``/``hi`` percentiles (linear interpolation)."""
    edges = quantile_values(df, cols, [lo, hi])
    return df.withColumns({c: F.least(F.greatest(F.col(c), F.lit(edges[c][0])), F.lit(edges[c][1])) for c in cols})


def fill_absent(df: DataFrame, categorical: Sequence[str] = (), numeric: Sequence[str] = (),
                cat_value: str = "None", num_value: float = 0) -> DataFrame:
    """Absence means "none": categoricals -> "None", numerics -> 0."""
    fill = {c: cat_value for c in categorical}
    fill.update({c: num_value for c in numeric})
    return df.fillna(fill)


def group_median_fill(df: DataFrame, col: str, group_cols: Sequence[str]) -> DataFrame:
    """Fill nulls with the group median, else the global median."""
    g = list(group_cols)
    med = exact_median(df, col, g, "_gmed")
    glob = F.lit(quantile_values(df, [col], [0.5])[col][0])
    return (df.join(med, g, "left")
              .withColumn(col, F.coalesce(F.col(col), F.col("_gmed"), glob)).drop("_gmed"))


def mode_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls with the column mode (smallest value on ties)."""
    modes = mode_values(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(modes[c])) for c in cols})


def fallback_fill(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """B22 second half: any remaining null column -> median if numeric, else mode."""
    num = numeric_columns(df, exclude)
    oth = [c for c in df.columns if c not in num and c not in exclude]
    stats = {c: q[0] for c, q in quantile_values(df, num, [0.5]).items()} if num else {}
    stats |= mode_values(df, oth)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(stats[c])) for c in num + oth})


class Imputer:
    """Train-fitted imputer (median for numerics, most-frequent for strings).
    ``fit`` reads the training rows; ``transform`` is a projection."""

    def __init__(self, numeric: Sequence[str] = (), categorical: Sequence[str] = ()):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.values: dict = {}

    def fit(self, train: DataFrame) -> "Imputer":
        medians = quantile_values(train, self.numeric, [0.5]) if self.numeric else {}
        self.values = {c: q[0] for c, q in medians.items()} | mode_values(train, self.categorical)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.fillna({k: v for k, v in self.values.items() if v is not None})


# ---------------------------------------------------------------- B26, B27, B28, B30
def iqr_outliers(df: DataFrame, cols: Sequence[str], factor: float = 1.5,
                 upper_only: bool = False) -> DataFrame:
    """Per column q1, q3, fences and the count/percent of rows strictly outside.
    Quartiles of every column first, then one aggregate of conditional sums.  Returns (column, q1, q3, lower, upper, n_outliers, pct)."""
    q = quantile_values(df, cols, [0.25, 0.75])
    sums, rows = [], []
    for c in cols:
        q1, q3 = (F.lit(x).cast("double") for x in q[c])
        lo, hi = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
        cond = (F.col(c) > hi) if upper_only else ((F.col(c) < lo) | (F.col(c) > hi))
        sums.append(F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(c))
        rows.append((c, q1, q3, lo, hi))
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *sums)
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), q1.alias("q1"), q3.alias("q3"), lo.alias("lower"),
                 hi.alias("upper"), F.col(c).alias("n_outliers"),
                 (F.col(c) * 100.0 / F.col("_n")).alias("pct"))
        for c, q1, q3, lo, hi in rows])))


def missing_table(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percent per column, only columns with nulls, in one pass."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"),
                                                  (F.col(c) * 100.0 / F.col("_n")).alias("missing_pct"))
                                         for c in cols])))
    return long.filter(F.col("missing") > 0)


def identical_columns(df: DataFrame, key_cols: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """(column, same_as) for every column that equals an earlier one of ``cols`` in every row
    (nulls equal nulls, numbers by value; ``same_as`` the first such column).

    One aggregate sums a hash of (key, value) per column: equal columns have equal sums whatever the
    order of rows, and no pair of columns is compared row by row unless their sums agree.  A second
    aggregate confirms those candidates with null-safe equality."""
    cols = list(cols or [c for c in df.columns if c not in key_cols])
    numeric = {c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")}
    value = {c: F.col(c).cast("double") if c in numeric else F.col(c) for c in cols}
    kind = {c: "number" if c in numeric else t for c, t in df.dtypes}
    sums = df.agg(*[F.sum(F.xxhash64(*key_cols, value[c], F.col(c).isNull()).cast("decimal(38,0)")).alias(f"h{i}")
                    for i, c in enumerate(cols)]).first()
    groups: dict = {}
    for i, c in enumerate(cols):
        groups.setdefault((kind[c], sums[f"h{i}"]), []).append(c)
    pairs = [(a, b) for same in groups.values() for k, b in enumerate(same) for a in same[:k]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, same_as string")
    checked = df.agg(*[F.min(F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]).first()
    first: dict = {}
    for i, (a, b) in enumerate(pairs):
        if checked[f"p{i}"] is not False:
            first.setdefault(b, a)
    return df.sparkSession.createDataFrame([(c, first[c]) for c in cols if c in first], "column string, same_as string")


def quality_report(df: DataFrame, ts: str, numeric: Sequence[str], lo: float = 0.0) -> DataFrame:
    """Rows, columns, time range, nulls, duplicate timestamps and impossible
    readings as a (metric, value) table from a single aggregate."""
    agg = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.date_format(F.min(ts), "yyyy-MM-dd HH:mm:ss").alias("ts_min"),
                 F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss").alias("ts_max"),
                 (F.count(F.lit(1)) - F.count_distinct(ts)).alias("duplicate_ts"),
                 F.sum(sum(F.col(c).isNull().cast("long") for c in df.columns)).alias("null_cells"),
                 *[F.sum((F.col(c) < lo).cast("long")).alias(f"impossible_{c}") for c in numeric])
    metrics = [c for c in agg.columns]
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics]
        + [F.struct(F.lit("columns").alias("metric"), F.lit(str(len(df.columns))).alias("value"))])))
