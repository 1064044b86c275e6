"""Time-series operators.

A series is identified by ``series`` columns and ordered by a time column.  Row-based
operators first give every row its dense position inside its series
(``sequence_index``, range-partitioned), then run bounded-frame windows over
fixed-size *chunks* of positions with halo rows copied across chunk borders
(``halo_chunks``): one long series is spread over many tasks and every lag, lead and
rolling statistic is computed in a single shuffle.  Whole-series scans (forward fill,
interpolation) carry the last value of earlier chunks through a small per-chunk table.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .ordering import halo_chunks, sequence_index, sequence_index_sized

CHUNK = 1 << 16


def _frame_mean_std(col: str, w: WindowSpec, lo: int, hi: int) -> tuple[Column, Column, Column]:
    """(full, mean, sample std) over the frame [lo, hi]."""
    fr = w.rowsBetween(lo, hi)
    return F.count(col).over(fr) == hi - lo + 1, F.avg(col).over(fr), F.stddev_samp(col).over(fr)


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def add_position(df: DataFrame, series, ts: str, pos: str = "pos", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Dense 1-based position per series in (ts, tiebreak) order."""
    return sequence_index(df, [ts, *tiebreak], _names(series), pos)


def bounded_window(df: DataFrame, series, pos: str, preceding: int, following: int,
                   build: Callable[[WindowSpec], dict[str, Column]], chunk_rows: int = CHUNK) -> DataFrame:
    """Evaluate row-frame window expressions that look at most ``preceding`` rows back
    and ``following`` rows ahead, chunk by chunk.  ``build(w)`` returns the new
    columns for a window spec ``w`` partitioned by (series, chunk) ordered by ``pos``."""
    s = _names(series)
    h = halo_chunks(df, pos, preceding, following, chunk_rows)
    w = Window.partitionBy(*s, "_chunk").orderBy(pos)
    return h.withColumns(build(w)).filter(F.col("_core")).drop("_chunk", "_core")


def lag_features(df: DataFrame, series, pos: str, col: str, lags: Sequence[int] = (),
                 leads: Sequence[int] = (), rolls: Sequence[int] = (), shifted_rolls: Sequence[int] = (),
                 chunk_rows: int = CHUNK) -> DataFrame:
    """Lags / leads by rows, rolling mean & sample std (null until the window is
    full), and leak-safe rolling means over the ``k`` rows strictly before."""
    back = max([0, *lags, *[r - 1 for r in rolls], *shifted_rolls])
    ahead = max([0, *leads])

    def build(w: WindowSpec) -> dict[str, Column]:
        out = {}
        for k in lags:
            out[f"{col}_lag_{k}"] = F.lag(col, k).over(w)
        for k in leads:
            out[f"{col}_lead_{k}"] = F.lead(col, k).over(w)
        for r in rolls:
            full, mean, std = _frame_mean_std(col, w, -(r - 1), 0)
            out[f"{col}_roll_mean_{r}"] = F.when(full, mean)
            out[f"{col}_roll_std_{r}"] = F.when(full, std)
        for r in shifted_rolls:
            full, mean, _ = _frame_mean_std(col, w, -r, -1)
            out[f"{col}_past_mean_{r}"] = F.when(full, mean)
        return out

    return bounded_window(df, series, pos, back, ahead, build, chunk_rows)


def history_windows(df: DataFrame, series, pos: str, col: str, window: int, horizon: int = 1,
                    chunk_rows: int = CHUNK) -> DataFrame:
    """``history`` = the ``window`` values before each row, ``future`` = the
    ``horizon`` values from the row on; rows without a full history / future dropped."""
    def build(w: WindowSpec) -> dict[str, Column]:
        return {"history": F.collect_list(col).over(w.rowsBetween(-window, -1)),
                "future": F.collect_list(col).over(w.rowsBetween(0, horizon - 1))}
    out = bounded_window(df, series, pos, window, horizon - 1, build, chunk_rows)
    return out.filter((F.size("history") == window) & (F.size("future") == horizon))


def _carry(df: DataFrame, series: list[str], pos: str, col: str, forward: bool, out: str,
           chunk_rows: int) -> DataFrame:
    """Nearest non-null (value, position) before (forward) or after each row, across
    the whole series: inside the chunk by window, from earlier chunks by a carry table."""
    ch = F.floor((F.col(pos) - 1) / chunk_rows).cast("long")
    d = df.withColumn("_ck", ch)
    st = F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("v"), F.col(pos).alias("p")))
    if forward:
        w = Window.partitionBy(*series, "_ck").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
        inner = F.last(st, ignorenulls=True).over(w)
        edge = F.max_by(st, F.when(st.isNotNull(), F.col(pos)))
        wc = Window.partitionBy(*series).orderBy("_ck").rowsBetween(Window.unboundedPreceding, -1)
        carry_expr = F.last("_edge", ignorenulls=True).over(wc)
    else:
        w = Window.partitionBy(*series, "_ck").orderBy(pos).rowsBetween(0, Window.unboundedFollowing)
        inner = F.first(st, ignorenulls=True).over(w)
        edge = F.min_by(st, F.when(st.isNotNull(), F.col(pos)))
        wc = Window.partitionBy(*series).orderBy("_ck").rowsBetween(1, Window.unboundedFollowing)
        carry_expr = F.first("_edge", ignorenulls=True).over(wc)
    d = d.withColumn("_in", inner)
    edges = df.withColumn("_ck", ch).groupBy(*series, "_ck").agg(edge.alias("_edge"))
    carry = edges.select(*series, "_ck", carry_expr.alias("_carry"))
    return d.join(carry, [*series, "_ck"], "left").withColumn(out, F.coalesce("_in", "_carry")) \
            .drop("_ck", "_in", "_carry")


def ffill_bfill(df: DataFrame, series, pos: str, col: str, chunk_rows: int = CHUNK) -> DataFrame:
    """forward fill then backward fill over the whole series (exact across chunks)."""
    s = _names(series)
    d = _carry(df, s, pos, col, True, "_f", chunk_rows)
    d = _carry(d, s, pos, col, False, "_b", chunk_rows)
    return d.withColumn(col, F.coalesce(F.col(col), F.col("_f.v"), F.col("_b.v"))).drop("_f", "_b")


def interpolate_linear(df: DataFrame, series, pos: str, col: str, chunk_rows: int = CHUNK) -> DataFrame:
    """linear interpolation by position between the previous and next non-null
    values; leading / trailing nulls stay null (pandas ``interpolate()`` default
    limit_direction='forward' fills trailing nulls with the last value)."""
    s = _names(series)
    d = _carry(df, s, pos, col, True, "_f", chunk_rows)
    d = _carry(d, s, pos, col, False, "_b", chunk_rows)
    frac = (F.col(pos) - F.col("_f.p")) / (F.col("_b.p") - F.col("_f.p"))
    interp = F.when(F.col("_b").isNull(), F.col("_f.v")) \
              .otherwise(F.col("_f.v") + (F.col("_b.v") - F.col("_f.v")) * frac)
    return d.withColumn(col, F.coalesce(F.col(col), interp)).drop("_f", "_b")


def every_nth(df: DataFrame, series, pos: str, step: int) -> DataFrame:
    """F8: first row of every block of ``step`` rows (a pick, not an average)."""
    return df.filter((F.col(pos) - 1) % step == 0)


def resample(df: DataFrame, series, ts: str, value: str, unit: str = "hour", how: str = "mean",
             out: str | None = None) -> DataFrame:
    """calendar resample (hour/day/month/year) with empty bins present: grouped
    aggregate left-joined to a per-series spine from the first to the last bin."""
    s = _names(series)
    b = F.date_trunc(unit, ts).alias("bucket")
    agg = {"mean": F.avg(value), "sum": F.sum(value), "count": F.count(value),
           "max": F.max(value), "min": F.min(value)}[how]
    g = df.groupBy(*s, b).agg(agg.alias(out or value))
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    spine = (g.groupBy(*s).agg(F.min("bucket").alias("_lo"), F.max("bucket").alias("_hi"))
              .select(*s, F.explode(F.sequence("_lo", "_hi", step)).alias("bucket")))
    res = spine.join(g, [*s, "bucket"], "left")
    if how == "count":
        res = res.fillna(0, [out or value])
    return res


def seasonal_decompose(df: DataFrame, series, pos: str, col: str, period: int,
                       chunk_rows: int = CHUNK) -> DataFrame:
    """additive decomposition: centred moving-average trend (half weights at both
    ends for an even period, null where the window is incomplete), seasonal = mean
    detrended value per phase ((pos-1) % period) minus the mean of those means,
    residual = value - trend - seasonal."""
    s = _names(series)
    half = period // 2

    def build(w: WindowSpec) -> dict[str, Column]:
        if period % 2:
            fr = w.rowsBetween(-half, half)
            return {"trend": F.when(F.count(col).over(fr) == period, F.avg(col).over(fr))}
        fr = w.rowsBetween(-half, half)
        full = F.count(col).over(fr) == period + 1
        ssum = F.sum(col).over(fr) - 0.5 * F.lag(col, half).over(w) - 0.5 * F.lead(col, half).over(w)
        return {"trend": F.when(full, ssum / period)}

    t = bounded_window(df, s, pos, half, half, build, chunk_rows)
    t = t.withColumn("phase", ((F.col(pos) - 1) % period).cast("int"))
    ph = t.groupBy(*s, "phase").agg(F.avg(F.col(col) - F.col("trend")).alias("_pm"))
    cen = ph.groupBy(*s).agg(F.avg("_pm").alias("_c"))
    seas = ph.join(cen, s).select(*s, "phase", (F.col("_pm") - F.col("_c")).alias("seasonal"))
    return (t.join(seas, [*s, "phase"], "left")
             .withColumn("resid", F.col(col) - F.col("trend") - F.col("seasonal")))


def acf(df: DataFrame, series, pos: str, col: str, nlags: int, chunk_rows: int = CHUNK) -> DataFrame:
    """biased autocorrelation (full-series mean) for lags 0..nlags, and the
    Pearson lag-k correlation (pandas ``autocorr``): one windowed pass, one aggregate."""
    s = _names(series)
    mean = df.groupBy(*s).agg(F.avg(col).alias("_m"))
    d = df.join(mean, s)

    def build(w: WindowSpec) -> dict[str, Column]:
        return {f"_l{k}": F.lag(col, k).over(w) for k in range(1, nlags + 1)}

    lagged = bounded_window(d, s, pos, nlags, 0, build, chunk_rows).withColumn("_l0", F.col(col))
    x = F.col(col) - F.col("_m")
    aggs = []
    for k in range(nlags + 1):
        aggs.append(F.sum(x * (F.col(f"_l{k}") - F.col("_m"))).alias(f"_s{k}"))
        aggs.append(F.corr(col, f"_l{k}").alias(f"_r{k}"))
    a = lagged.groupBy(*s).agg(*aggs)
    return a.select(*s, F.inline(F.array(*[
        F.struct(F.lit(k).alias("lag"), (F.col(f"_s{k}") / F.col("_s0")).alias("acf"),
                 F.col(f"_r{k}").alias("autocorr")) for k in range(nlags + 1)])))


def pacf(acf_table: DataFrame, series, lag: str = "lag", acf_col: str = "acf") -> DataFrame:
    """PACF per series from its ACF rows (lags 0..n, one row each) by the Durbin-Levinson
    recursion (Yule-Walker), as one ``aggregate`` over the lags of each series' array."""
    s = _names(series)
    arrays = acf_table.groupBy(*s).agg(F.transform(
        F.sort_array(F.collect_list(F.struct(F.col(lag).alias("l"), F.col(acf_col).cast("double").alias("a")))),
        lambda x: x["a"]).alias("_r"))
    r = F.col("_r")
    at = lambda a, i: F.try_element_at(a, i.cast("int"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    def step(acc: Column, k: Column) -> Column:
        phi = acc["phi"]  # k - 1 coefficients of the previous order
        num = at(r, k + 1) - total(F.transform(phi, lambda p, j: p * at(r, k - j)))
        den = F.lit(1.0) - total(F.transform(phi, lambda p, j: p * at(r, j + 2)))
        kk = F.when(den == 0, F.lit(float("nan"))).otherwise(num / den)
        new = F.concat(F.transform(phi, lambda p, j: p - kk * at(phi, k - 1 - j)), F.array(kk))
        return F.struct(new.alias("phi"), F.concat(acc["out"], F.array(kk)).alias("out"))

    start = F.struct(F.array().cast("array<double>").alias("phi"), F.array(F.lit(1.0)).alias("out"))
    lags = F.when(F.size(r) > 1, F.sequence(F.lit(1), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
    out = F.aggregate(lags, start, step, lambda acc: acc["out"])
    return arrays.select(*s, F.posexplode(out).alias(lag, "pacf"))


def chrono_split(df: DataFrame, series, ts: str, fracs: Sequence[float] = (0.7, 0.15),
                 names: Sequence[str] = ("train", "val", "test"), tiebreak: Sequence[str] = ()) -> DataFrame:
    """chronological split by row fraction with ``int()`` truncation of the
    boundaries (train = first int(n*f1) rows, val up to int(n*(f1+f2)), rest test)."""
    s = _names(series)
    d = sequence_index_sized(df, [ts, *tiebreak], s, "_p", "_n")
    cum, expr = 0.0, None
    for f, name in zip(fracs, names):
        cum += f
        cond = F.col("_p") <= F.floor(F.col("_n") * cum)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return d.withColumn("split", expr.otherwise(names[len(fracs)])).drop("_p", "_n")


def fit_standardizer(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """F16: train-only mean and population std (0 -> 1), one aggregate."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in cols}


def standardize(df: DataFrame, params: dict[str, tuple[float, float]], inverse: bool = False) -> DataFrame:
    return df.withColumns({c: (F.col(c) * s + m) if inverse else (F.col(c) - m) / s
                           for c, (m, s) in params.items()})


def calendar_spine(df: DataFrame, ts: str, unit: str = "day") -> DataFrame:
    """every day (or other unit) from the first to the last timestamp."""
    r = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    return r.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL 1 {unit.upper()}"))).alias("date"))


def cadence_audit(df: DataFrame, series, pos: str, ts: str) -> DataFrame:
    """Per series the modal gap (seconds, smallest on ties), number of distinct
    gaps and a regular flag.  Gaps come from an equi-join of position p with p-1."""
    s = _names(series)
    prev = df.select(*s, (F.col(pos) + 1).alias(pos), F.col(ts).alias("_prev"))
    g = df.join(prev, [*s, pos]).select(
        *s, (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_prev").cast("timestamp"))).alias("_gap_us"))
    counted = g.groupBy(*s, "_gap_us").agg(F.count(F.lit(1)).alias("_c"))  # then a group's buffer is one gap
    return counted.groupBy(*s).agg(
        F.min_by("_gap_us", F.struct(-F.col("_c"), F.col("_gap_us"))).alias("modal_gap_us"),
        F.count(F.lit(1)).alias("distinct_gaps")).withColumn("regular", F.col("distinct_gaps") == 1)
