"""Binning with pandas ``cut`` / ``qcut`` semantics, as native expressions.

* ``cut``   : fixed edges, right-closed ``(lo, hi]``; optional inclusion of the lowest edge.
* ``qcut``  : edges = linearly interpolated quantiles (``percentile``), right-closed, the
              first bin includes its left end.  Duplicate edges raise (lazily, through
              ``raise_error``) unless ``duplicates="drop"``.
* ``qcut_first_rank``: ``qcut(x.rank(method="first"), q)``; ranks 1..n have arithmetic
              quantiles, so the bin is integer arithmetic on the position: no percentile.
* equal-width ``cut(x, bins)`` with pandas' 0.1 % widening of the lowest edge.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import sequence_index_sized


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cut(x, edges: Sequence[float], labels: Sequence | None = None,
        include_lowest: bool = False) -> Column:
    """Right-closed fixed-edge bins.  Values outside the edges -> null (pandas NaN)."""
    x = _c(x)
    codes = None
    for i in range(1, len(edges)):
        lo, hi = edges[i - 1], edges[i]
        cond = (x > lo) & (x <= hi)
        if i == 1 and include_lowest:
            cond = (x >= lo) & (x <= hi)
        val = F.lit(labels[i - 1] if labels is not None else i - 1)
        codes = F.when(cond, val) if codes is None else codes.when(cond, val)
    return codes


def code_from_edges(x, edges: Column, q: int, duplicates: str = "raise") -> Column:
    """Bin code 0..q-1 for value ``x`` and an edge array ``[e0..eq]`` (right-closed,
    first bin closed on the left).  Code = number of inner edges strictly below x;
    unrolled over the q-1 inner edges (no higher-order function, stays in codegen)."""
    x = _c(x)
    e = F.array_distinct(edges) if duplicates == "drop" else edges
    code = F.lit(0)
    for j in range(2, q + 1):  # inner edges are elements 2..q (1-based)
        hit = (F.size(e) > j) & (x > F.element_at(e, j))
        code = code + F.when(hit, 1).otherwise(0)
    inside = (x >= F.element_at(e, 1)) & (x <= F.element_at(e, -1))
    code = F.when(x.isNull(), F.lit(None)).when(inside, code)
    if duplicates == "raise":
        code = F.when(F.size(F.array_distinct(edges)) < F.size(edges),
                      F.raise_error(F.lit("qcut: bin edges must be unique"))).otherwise(code)
    return code


def quantile_probs(q: int | Sequence[float]) -> list[float]:
    if isinstance(q, int):
        return [i / q for i in range(q + 1)]
    return list(q)


def qcut(df: DataFrame, col: str, q, out: str, labels: Sequence | None = None,
         duplicates: str = "raise", group_cols: Sequence[str] = ()) -> DataFrame:
    """pandas ``qcut`` (globally, or per ``group_cols``).

    Edges are exact interpolated quantiles (``operators/quantiles.py``).
    """
    probs = quantile_probs(q)
    from ..operators.quantiles import exact_quantiles, quantile_values
    if group_cols:
        e = exact_quantiles(df, [col], probs, list(group_cols)).select(*group_cols, F.col("q").alias("_edges"))
        d = df.join(e, list(group_cols), "left")
        ecol = F.col("_edges")
    else:
        d = df
        ecol = F.array(*[F.lit(x).cast("double") for x in quantile_values(df, [col], probs)[col]])
    code = code_from_edges(F.col(col).cast("double"), ecol, len(probs) - 1, duplicates)
    if labels is not None:
        code = F.element_at(F.array(*[F.lit(v) for v in labels]), code + 1)
    return d.withColumn(out, code).drop("_edges")


def first_rank_code(pos: Column, n: Column, q: int) -> Column:
    """Bin code of position ``pos`` (1..n) in ``qcut(rank_first, q)``:
    #{j in 1..q-1 : q*(pos-1) > j*(n-1)} in exact integer arithmetic."""
    a = F.lit(q) * (pos - 1)
    b = n - 1
    c = F.floor((a + b - 1) / b) - 1  # ceil(a / b) - 1
    return F.when(b <= 0, F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(F.lit(q - 1), c))).cast("int")


def qcut_first_rank(df: DataFrame, col: str, tiebreak: Sequence[str], q: int, out: str,
                    labels: Sequence | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """pandas ``qcut(s.rank(method="first"), q)``; ties broken by ``tiebreak`` (the
    row order pandas would have seen).  Distributed: range-partitioned positions."""
    d = sequence_index_sized(df, [col, *tiebreak], group_cols, name="_pos", size_name="_n")
    code = first_rank_code(F.col("_pos"), F.col("_n"), q)
    if labels is not None:
        code = F.element_at(F.array(*[F.lit(v) for v in labels]), code + 1)
    return d.withColumn(out, code).drop("_pos", "_n")


def equal_width_code(x, lo: Column, hi: Column, bins: int) -> Column:
    """pandas ``cut(x, bins)``: ``bins`` equal-width right-closed intervals over [lo, hi];
    the lowest edge is widened by 0.1 % of the range so the minimum is in bin 0."""
    x = _c(x)
    width = (hi - lo) / bins
    raw = F.ceil((x - lo) / width) - 1
    return F.when(hi == lo, F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(bins - 1), raw))).cast("int")


def percent_rank_average(df: DataFrame, col: str, out: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """pandas ``rank(pct=True)`` (average method): (count below + (ties+1)/2) / n.

    Works on the table of distinct values (one row per value and group), so the
    ordering step never sees more rows than distinct values."""
    g = list(group_cols)
    cnt = df.filter(F.col(col).isNotNull()).groupBy(*g, col).agg(F.count(F.lit(1)).alias("_k"))
    idx = sequence_index_sized(cnt, [col], g, name="_p", size_name="_nd")
    from ..operators.ordering import running_sum
    cum = running_sum(idx, "_p", ["_k"], g)
    tot = cnt.groupBy(*g).agg(F.sum("_k").alias("_n"))
    ranks = (cum.join(tot, g) if g else cum.withColumn("_n", tot.scalar()))
    ranks = ranks.select(*g, col, ((F.col("_k_cum") - F.col("_k") + (F.col("_k") + 1) / 2)
                                   / F.col("_n")).alias(out))
    return df.join(ranks, [*g, col], "left")
