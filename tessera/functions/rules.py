"""Rule ladders written as ``CASE WHEN`` chains."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rfm_label(r, f, m) -> Column:
    """First matching of five rules, default "Regular"."""
    r, f, m = _c(r), _c(f), _c(m)
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
             .when((f >= 4) & (m >= 4), "Loyal")
             .when((r >= 4) & (f <= 2), "New / Promising")
             .when((r <= 2) & (f >= 3) & (m >= 3), "At-Risk")
             .when((r <= 2) & (f <= 2), "Lost")
             .otherwise("Regular"))


def band(x, bands: Sequence[tuple[float, float, str]], fallback: str | None = None) -> Column:
    """Half-open bands ``[lo, hi)`` -> label; the last band is the fallback when none
    match (as a ``for ... return`` loop with a final default does)."""
    x = _c(x)
    out = None
    for lo, hi, label in bands:
        cond = (x >= lo) & (x < hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(fallback if fallback is not None else bands[-1][2])


def severity_from_area(area_pct, has_defect) -> Column:
    """None if no defect; then [0,2) Minor, [2,5) Moderate, [5,100] Severe."""
    a = _c(area_pct)
    return (F.when(~_c(has_defect), "None")
             .when(a < 2, "Minor").when(a < 5, "Moderate").otherwise("Severe"))


def decision_from_severity(sev) -> Column:
    s = _c(sev)
    return (F.when(s == "None", "Accept").when(s == "Minor", "Accept")
             .when(s == "Moderate", "Rework").otherwise("Reject"))


def risk_score(p) -> Column:
    """round(p*100, 1) with 80/50/20 levels."""
    return F.round(_c(p) * 100, 1)


def risk_level(score) -> Column:
    s = _c(score)
    return (F.when(s >= 80, "Critical").when(s >= 50, "High")
             .when(s >= 20, "Medium").otherwise("Low"))


def yes_no_to_int(x) -> Column:
    """Yes/No, True/False strings (after strip+lower) -> 1/0, else null."""
    v = F.lower(F.trim(_c(x)))
    return (F.when(v.isin("yes", "true", "1"), 1).when(v.isin("no", "false", "0"), 0)).cast("int")


def safe_ratio(a, b) -> Column:
    """a / b with 0 or null denominator -> 0."""
    return F.coalesce(F.try_divide(_c(a), _c(b)), F.lit(0.0))


def ordinal_map(x, mapping: dict, default=0) -> Column:
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.try_element_at(m, _c(x)), F.lit(default))


def row_mean(*cols) -> Column:
    """Mean of the non-null values of several columns (pandas ``mean(axis=1)``)."""
    cs = [_c(c) for c in cols]
    s = sum(F.coalesce(c, F.lit(0.0)) for c in cs)
    n = sum(c.isNotNull().cast("int") for c in cs)
    return F.try_divide(s, n)


def rating_to_sentiment(rating) -> Column:
    r = F.round(_c(rating)).cast("int")
    return F.when(r <= 2, "negative").when(r == 3, "neutral").when(r >= 4, "positive")


def truncate_text(x, n: int = 160) -> Column:
    return F.substring(_c(x), 1, n)


def group_key_from_name(name, sep: str = "___") -> Column:
    return F.substring_index(_c(name), sep, 1)


def weighted_minmax_score(cols_weights: dict, stats: dict, digits: int = 2) -> Column:
    """C20: sum_i w_i * (x_i - min_i) / (max_i - min_i) * 100 (range 0 -> term 0), rounded."""
    s = None
    for c, w in cols_weights.items():
        lo, hi = stats[c]
        term = F.coalesce(F.try_divide(F.col(c) - lo, hi - lo), F.lit(0.0)) * w
        s = term if s is None else s + term
    return F.round(s * 100, digits)


def points_ladder(x, steps: list[tuple[float, int]]) -> Column:
    """Points from an ascending ladder of (threshold, points): first threshold the
    value is below wins; above all -> last points."""
    xc = _c(x)
    out = None
    for thr, pts in steps[:-1]:
        out = F.when(xc < thr, pts) if out is None else out.when(xc < thr, pts)
    return out.otherwise(steps[-1][1])


def action_lookup(label, conf, actions: dict, default: str, low_conf: float = 0.6,
                  prefix: str = "Low confidence - verify: ") -> Column:
    """Action text by predicted class with a default, prefixed below ``low_conf``."""
    m = F.create_map(*[F.lit(v) for kv in actions.items() for v in kv])
    act = F.coalesce(F.try_element_at(m, _c(label)), F.lit(default))
    return F.when(_c(conf) < low_conf, F.concat(F.lit(prefix), act)).otherwise(act)
