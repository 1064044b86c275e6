"""Date and time expressions with pandas semantics."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Meteorological seasons by (month % 12) // 3.
SEASONS = ["Winter", "Spring", "Summer", "Autumn"]

MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def calendar_parts(ts, prefix: str = "") -> dict[str, Column]:
    """hour, day, month, day-of-week (Monday=0 like pandas), day-of-year, weekend, day name."""
    t = _c(ts)
    return {
        f"{prefix}hour": F.hour(t),
        f"{prefix}day": F.dayofmonth(t),
        f"{prefix}month": F.month(t),
        f"{prefix}dayofweek": F.weekday(t),
        f"{prefix}dayofyear": F.dayofyear(t),
        f"{prefix}is_weekend": (F.weekday(t) >= 5).cast("int"),
        f"{prefix}day_name": F.date_format(t, "EEEE"),
    }


def night_flag(hour, start: int = 22, end: int = 6, end_inclusive: bool = False) -> Column:
    """``h >= start or h < end`` (or ``<= end``); both definitions occur."""
    h = _c(hour)
    return ((h >= start) | ((h <= end) if end_inclusive else (h < end))).cast("int")


def season(month) -> Column:
    m = _c(month)
    return F.element_at(F.array(*[F.lit(s) for s in SEASONS]), (F.floor((m % 12) / 3) + 1).cast("int"))


def cyclic(x, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period."""
    a = _c(x) * (2 * math.pi / period)
    return F.sin(a), F.cos(a)


def cyclic_degrees(deg) -> tuple[Column, Column]:
    r = F.radians(_c(deg))
    return F.sin(r), F.cos(r)


def whole_days(later, earlier) -> Column:
    """Floor of the exact time difference in days (pandas ``Timedelta.days``),
    not the calendar ``datediff``: 23:00 -> next day 22:00 is 0 days."""
    d = F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))
    return F.floor(d / F.lit(MICROS_PER_DAY)).cast("long")


def age_years(now, birth) -> Column:
    """Whole days // 365."""
    return F.floor(whole_days(now, birth) / 365).cast("long")


def log1p_clipped(x) -> Column:
    return F.log1p(F.greatest(_c(x), F.lit(0.0)))


def expm1_clipped(x) -> Column:
    return F.greatest(F.expm1(_c(x)), F.lit(0.0))


def haversine_km(lat1, lon1, lat2, lon2, radius: float = 6371.0) -> Column:
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return 2 * radius * F.asin(F.sqrt(a))


def date_key(ts) -> Column:
    """yyyyMMdd as int."""
    return F.date_format(_c(ts), "yyyyMMdd").cast("int")


def month_start(ts) -> Column:
    return F.date_trunc("month", _c(ts))
