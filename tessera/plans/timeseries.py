"""Time-series queries over ``events``: series = event_type, hourly mean of value."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import calendar_parts, date_key, season
from ..operators import timeseries as ts
from ..sources.tables import read_table
from ..session import materialize
from .registry import query

FMT = "yyyy-MM-dd HH:mm:ss"

SPINE_SQL = """
h AS (SELECT event_type, date_trunc('hour', ts) AS bucket, avg(value) AS value FROM events GROUP BY ALL),
b AS (SELECT event_type, min(bucket) AS lo, max(bucket) AS hi FROM h GROUP BY event_type),
sp AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket FROM b),
s AS (SELECT sp.event_type, sp.bucket, h.value,
             row_number() OVER (PARTITION BY sp.event_type ORDER BY sp.bucket) AS pos
      FROM sp LEFT JOIN h USING (event_type, bucket))"""

INTERP_SQL = SPINE_SQL + """,
i AS (SELECT *,
  last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
  last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fv,
  first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bp,
  first_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bv FROM s),
x AS (SELECT event_type, bucket, pos,
             coalesce(value, CASE WHEN bp IS NULL THEN fv ELSE fv + (bv - fv) * ((pos - fp) / (bp - fp)) END) AS value
      FROM i)"""


def hourly(spark, sf):
    """Hourly mean per event type on a complete hourly spine (empty hours null), with
    the dense position of each hour inside its series."""
    e = read_table(spark, sf, "events", "event_type", "ts", "value")
    r = ts.resample(e, "event_type", "ts", "value", "hour")
    return ts.add_position(r, "event_type", "bucket")


def hourly_filled(spark, sf):
    return materialize(ts.interpolate_linear(hourly(spark, sf), "event_type", "pos", "value"))


def _fmt(df):
    return df.withColumn("bucket", F.date_format("bucket", FMT))


@query("hourly_resample", f"""
WITH {SPINE_SQL}
SELECT event_type, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, value, pos FROM s""", floats=("value",))
def hourly_resample(spark, sf):
    """hourly mean with empty bins present."""
    return _fmt(hourly(spark, sf)).select("event_type", "bucket", "value", "pos")


@query("hourly_interpolated", f"""
WITH {INTERP_SQL}
SELECT event_type, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, value FROM x""", floats=("value",))
def hourly_interpolated(spark, sf):
    """missing hours filled by linear interpolation between neighbours."""
    return _fmt(hourly_filled(spark, sf)).select("event_type", "bucket", "value")


@query("hourly_ffill", f"""
WITH {SPINE_SQL},
f AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fv,
              first_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bv FROM s)
SELECT event_type, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, coalesce(value, fv, bv) AS value FROM f""",
       floats=("value",))
def hourly_ffill(spark, sf):
    """forward fill then backward fill over each whole series."""
    return _fmt(ts.ffill_bfill(hourly(spark, sf), "event_type", "pos", "value")).select("event_type", "bucket", "value")


@query("hourly_lag_roll", f"""
WITH {INTERP_SQL}
SELECT event_type, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, value,
  lag(value, 1) OVER w AS value_lag_1, lag(value, 24) OVER w AS value_lag_24, lead(value, 1) OVER w AS value_lead_1,
  CASE WHEN count(value) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) = 24
       THEN (lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24 END AS value_roll_mean_24,
  CASE WHEN count(value) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) = 24
       THEN sqrt(((lag(value, 23) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 23) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 22) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 22) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 21) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 21) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 20) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 20) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 19) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 19) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 18) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 18) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 17) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 17) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 16) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 16) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 15) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 15) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 14) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 14) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 13) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 13) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 12) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 12) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 11) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 11) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 10) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 10) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 9) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 9) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 8) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 8) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 7) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 7) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 6) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 6) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 5) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 5) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 4) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 4) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 3) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 3) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 2) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 2) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (lag(value, 1) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (lag(value, 1) OVER w - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) + (value - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24)) * (value - ((lag(value, 23) OVER w + lag(value, 22) OVER w + lag(value, 21) OVER w + lag(value, 20) OVER w + lag(value, 19) OVER w + lag(value, 18) OVER w + lag(value, 17) OVER w + lag(value, 16) OVER w + lag(value, 15) OVER w + lag(value, 14) OVER w + lag(value, 13) OVER w + lag(value, 12) OVER w + lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 24))) / 23) END AS value_roll_std_24,
  CASE WHEN count(value) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) = 6
       THEN (lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w) / 6 END AS value_past_mean_6
FROM x WINDOW w AS (PARTITION BY event_type ORDER BY pos)""",
       floats=("value", "value_lag_1", "value_lag_24", "value_lead_1", "value_roll_mean_24", "value_roll_std_24",
               "value_past_mean_6"))
def hourly_lag_roll(spark, sf):
    """F1 + F2 + F3: lags 1/24, lead 1 (target), rolling mean/std 24 (full windows only),
    leak-safe mean of the 6 previous hours."""
    d = ts.lag_features(hourly_filled(spark, sf), "event_type", "pos", "value", lags=[1, 24], leads=[1],
                        rolls=[24], shifted_rolls=[6])
    return _fmt(d).select("event_type", "bucket", "value", "value_lag_1", "value_lag_24", "value_lead_1",
                          "value_roll_mean_24", "value_roll_std_24", "value_past_mean_6")


@query("hourly_decomposition", f"""
WITH {INTERP_SQL},
t AS (SELECT *, CASE WHEN count(value) OVER (w ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25
           THEN (0.5 * lag(value, 12) OVER w + (lag(value, 11) OVER w + lag(value, 10) OVER w + lag(value, 9) OVER w + lag(value, 8) OVER w + lag(value, 7) OVER w + lag(value, 6) OVER w + lag(value, 5) OVER w + lag(value, 4) OVER w + lag(value, 3) OVER w + lag(value, 2) OVER w + lag(value, 1) OVER w + value + lead(value, 1) OVER w + lead(value, 2) OVER w + lead(value, 3) OVER w + lead(value, 4) OVER w + lead(value, 5) OVER w + lead(value, 6) OVER w + lead(value, 7) OVER w + lead(value, 8) OVER w + lead(value, 9) OVER w + lead(value, 10) OVER w + lead(value, 11) OVER w) + 0.5 * lead(value, 12) OVER w) / 24 END AS trend,
           CAST((pos - 1) % 24 AS INTEGER) AS phase
      FROM x WINDOW w AS (PARTITION BY event_type ORDER BY pos)),
pm AS (SELECT event_type, phase, avg(value - trend) AS m FROM t GROUP BY ALL),
se AS (SELECT event_type, phase, m - avg(m) OVER (PARTITION BY event_type) AS seasonal FROM pm)
SELECT event_type, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, value, trend, seasonal,
       value - trend - seasonal AS resid FROM t JOIN se USING (event_type, phase)""",
       floats=("value", "trend", "seasonal", "resid"))
def hourly_decomposition(spark, sf):
    """additive decomposition with period 24 (daily seasonality)."""
    d = ts.seasonal_decompose(hourly_filled(spark, sf), "event_type", "pos", "value", 24)
    return _fmt(d).select("event_type", "bucket", "value", "trend", "seasonal", "resid")


_ACF_SQL = f"""
WITH {INTERP_SQL},
m AS (SELECT event_type, avg(value) AS mu FROM x GROUP BY 1),
l AS (SELECT x.event_type, x.value, mu, """ + ", ".join(
    f"lag(x.value, {k}) OVER (PARTITION BY x.event_type ORDER BY pos) AS l{k}" for k in range(1, 25)) + """
      FROM x JOIN m USING (event_type))
""" + " UNION ALL ".join(
    f"SELECT event_type, {k} AS lag, sum((value - mu) * ({'value' if k == 0 else f'l{k}'} - mu)) / sum((value - mu) * (value - mu)) AS acf, "
    f"corr(value, {'value' if k == 0 else f'l{k}'}) AS autocorr FROM l GROUP BY event_type" for k in range(25))


@query("hourly_acf", _ACF_SQL, floats=("acf", "autocorr"))
def hourly_acf(spark, sf):
    """biased ACF (full-series mean) and Pearson lag-k autocorrelation, lags 0-24."""
    return ts.acf(hourly_filled(spark, sf), "event_type", "pos", "value", 24)


@query("hourly_pacf", f"""
WITH RECURSIVE a AS ({_ACF_SQL}),
s AS (SELECT event_type, list(acf ORDER BY lag) AS r FROM a GROUP BY 1),
p AS (
  SELECT event_type, 0 AS lag, CAST([] AS DOUBLE[]) AS phi, CAST(1.0 AS DOUBLE) AS pacf, r FROM s
  UNION ALL
  SELECT event_type, lag + 1, list_concat([phi[j] - kk * phi[lag + 1 - j] for j in range(1, lag + 1)], [kk]), kk, r
  FROM (SELECT *, (r[lag + 2] - coalesce(list_sum([phi[j] * r[lag + 2 - j] for j in range(1, lag + 1)]), 0))
                  / (1 - coalesce(list_sum([phi[j] * r[j + 1] for j in range(1, lag + 1)]), 0)) AS kk
        FROM p WHERE lag < 24))
SELECT event_type, lag, pacf FROM p""", floats=("pacf",))
def hourly_pacf(spark, sf):
    """PACF (Yule-Walker, Durbin-Levinson) per series from its ACF."""
    return ts.pacf(hourly_acf(spark, sf).withColumn("lag", F.col("lag").cast("int")), "event_type")


@query("hourly_windows", f"""
WITH {INTERP_SQL},
w AS (SELECT event_type, bucket, pos,
        list(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS history,
        list(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS future
      FROM x)
SELECT event_type, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket,
       list_sum(history) AS history_sum, history[1] AS history_first, history[6] AS history_last,
       list_sum(future) AS future_sum, future[3] AS future_last
FROM w WHERE len(history) = 6 AND len(future) = 3""",
       floats=("history_sum", "history_first", "history_last", "future_sum", "future_last"))
def hourly_windows(spark, sf):
    """F13 + F14: 6-hour history windows and 3-hour direct multi-horizon targets."""
    d = ts.history_windows(hourly_filled(spark, sf), "event_type", "pos", "value", 6, 3)
    return _fmt(d).select("event_type", "bucket",
                          F.aggregate("history", F.lit(0.0), lambda a, x: a + x).alias("history_sum"),
                          F.element_at("history", 1).alias("history_first"),
                          F.element_at("history", 6).alias("history_last"),
                          F.aggregate("future", F.lit(0.0), lambda a, x: a + x).alias("future_sum"),
                          F.element_at("future", 3).alias("future_last"))


@query("lead_time_rmse", f"""
WITH {INTERP_SQL},
w AS (SELECT event_type, pos,
        list(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS history,
        list(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS future
      FROM x),
f AS (SELECT * FROM w WHERE len(history) = 6 AND len(future) = 3),
e AS (SELECT event_type, CAST(st AS INTEGER) AS step, future[st + 1] - history[6] AS err
      FROM f, range(0, 3) r(st))
SELECT event_type, step, sqrt(avg(err * err)) AS rmse FROM e GROUP BY ALL""", floats=("rmse",))
def lead_time_rmse(spark, sf):
    """F23 + F17: persistence forecast error (RMSE) per lead step 0..2."""
    d = ts.history_windows(hourly_filled(spark, sf), "event_type", "pos", "value", 6, 3)
    e = d.select("event_type", F.element_at("history", 6).alias("last"), F.posexplode("future").alias("step", "y"))
    return e.groupBy("event_type", F.col("step").cast("int").alias("step")).agg(
        F.sqrt(F.avg((F.col("y") - F.col("last")) * (F.col("y") - F.col("last")))).alias("rmse"))


@query("every_sixth_event", """
SELECT event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos FROM events)
WHERE (pos - 1) % 6 = 0""")
def every_sixth_event(spark, sf):
    """F8: first row of every block of 6 per series (a pick, not a mean)."""
    e = read_table(spark, sf, "events", "event_id", "event_type", "ts", "value")
    p = ts.add_position(e, "event_type", "ts", "pos", ["event_id"])
    return ts.every_nth(p, "event_type", "pos", 6).select("event_id", "event_type", "value")


@query("chrono_split_counts", """
WITH p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events),
s AS (SELECT *, CASE WHEN pos <= floor(n * 0.7) THEN 'train' WHEN pos <= floor(n * (0.7 + 0.15)) THEN 'val'
                     ELSE 'test' END AS split FROM p)
SELECT event_type, split, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ts_min,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts_max FROM s GROUP BY ALL""")
def chrono_split_counts(spark, sf):
    """chronological 70/15/15 split per series with int() truncation."""
    e = read_table(spark, sf, "events", "event_id", "event_type", "ts")
    s = ts.chrono_split(e, "event_type", "ts", (0.7, 0.15), tiebreak=["event_id"])
    return s.groupBy("event_type", "split").agg(F.count(F.lit(1)).alias("n"),
                                                F.date_format(F.min("ts"), FMT).alias("ts_min"),
                                                F.date_format(F.max("ts"), FMT).alias("ts_max"))


@query("train_standardized", """
WITH p AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS pos, count(*) OVER () AS n FROM events),
s AS (SELECT *, CASE WHEN pos <= floor(n * 0.7) THEN 'train' WHEN pos <= floor(n * 0.85) THEN 'val' ELSE 'test' END AS split FROM p),
st AS (SELECT avg(value) AS m, coalesce(nullif(stddev_pop(value), 0), 1) AS sd FROM s WHERE split = 'train')
SELECT split, count(*) AS n, avg((value - m) / sd) AS mean_z, stddev_pop((value - m) / sd) AS std_z
FROM s, st GROUP BY split""", floats=("mean_z", "std_z"))
def train_standardized(spark, sf):
    """F16: standardisation fitted on the chronological train part only."""
    e = read_table(spark, sf, "events", "event_id", "ts", "value")
    s = ts.chrono_split(e, [], "ts", (0.7, 0.15), tiebreak=["event_id"])
    params = ts.fit_standardizer(s.filter(F.col("split") == "train"), ["value"])
    z = ts.standardize(s, params)
    return z.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_z"),
                                  F.stddev_pop("value").alias("std_z"))


@query("persistence_scores", f"""
WITH {INTERP_SQL},
p AS (SELECT event_type, bucket, pos, value AS predicted, lead(value, 1) OVER (PARTITION BY event_type ORDER BY pos) AS actual,
             count(*) OVER (PARTITION BY event_type) AS n FROM x)
SELECT event_type, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, actual, predicted, actual - predicted AS residual,
       CASE WHEN pos <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split
FROM p WHERE actual IS NOT NULL""", floats=("actual", "predicted", "residual"))
def persistence_scores(spark, sf):
    """F17 + F22: persistence forecast export with residual and split flag (80/20 by time)."""
    d = ts.lag_features(hourly_filled(spark, sf), "event_type", "pos", "value", leads=[1])
    d = ts.chrono_split(d, "event_type", "pos", (0.8,), ("train", "test"))
    return _fmt(d).filter(F.col("value_lead_1").isNotNull()).select(
        "event_type", "bucket", F.col("value_lead_1").alias("actual"), F.col("value").alias("predicted"),
        (F.col("value_lead_1") - F.col("value")).alias("residual"), "split")


@query("clv_calibration", """
WITH c AS (SELECT max(o_orderdate) - INTERVAL 12 MONTH AS cutoff FROM orders),
cal AS (SELECT o_custkey, count(*) AS frequency, sum(o_totalprice) AS monetary FROM orders, c
        WHERE o_orderdate < cutoff GROUP BY o_custkey),
hold AS (SELECT o_custkey, sum(o_totalprice) AS target FROM orders, c
         WHERE o_orderdate >= cutoff AND o_orderdate < cutoff + INTERVAL 6 MONTH GROUP BY o_custkey)
SELECT o_custkey, frequency, monetary, coalesce(target, 0) AS target FROM cal LEFT JOIN hold USING (o_custkey)""",
       floats=("monetary", "target"))
def clv_calibration(spark, sf):
    """F18 + D1: calibration features before a cutoff, 6-month holdout target (half-open
    windows), left-joined with missing -> 0."""
    o = read_table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    cutoff = o.select(F.add_months(F.max("o_orderdate"), -12).cast("timestamp_ntz")).scalar()
    cal = o.filter(F.col("o_orderdate") < cutoff).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("frequency"), F.sum("o_totalprice").alias("monetary"))
    hold = o.filter((F.col("o_orderdate") >= cutoff) &
                    (F.col("o_orderdate") < F.add_months(cutoff, 6).cast("timestamp_ntz"))) \
            .groupBy("o_custkey").agg(F.sum("o_totalprice").alias("target"))
    return cal.join(hold, "o_custkey", "left").fillna(0.0, ["target"])


@query("date_dimension", """
WITH r AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM r)
SELECT strftime(date, '%Y-%m-%d') AS date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, strftime(date, '%B') AS month_name,
       CAST(quarter(date) AS INTEGER) AS quarter, CAST(isodow(date) - 1 AS INTEGER) AS weekday FROM d""")
def date_dimension(spark, sf):
    """date dimension from the first to the last order date."""
    o = read_table(spark, sf, "orders", "o_orderdate")
    d = ts.calendar_spine(o, "o_orderdate")
    return d.select(F.date_format("date", "yyyy-MM-dd").alias("date"), date_key("date").alias("date_key"),
                    F.year("date").alias("year"), F.month("date").alias("month"),
                    F.date_format("date", "MMMM").alias("month_name"), F.quarter("date").alias("quarter"),
                    F.weekday("date").alias("weekday"))


@query("hour_profile", """
WITH h AS (SELECT hour(ts) AS hour, avg(value) AS mean_value FROM events GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY mean_value DESC, hour) AS rk_hi,
             row_number() OVER (ORDER BY mean_value, hour) AS rk_lo FROM h)
SELECT CAST(hour AS INTEGER) AS hour, mean_value, rk_hi <= 3 AS is_peak, rk_lo <= 3 AS is_off_peak FROM r""",
       floats=("mean_value",))
def hour_profile(spark, sf):
    """hour-of-day profile with top-3 peak and off-peak hours (24-row table)."""
    e = read_table(spark, sf, "events", "ts", "value")
    h = e.groupBy(F.hour("ts").alias("hour")).agg(F.avg("value").alias("mean_value"))
    peak = h.orderBy(F.desc("mean_value"), "hour").limit(3).select("hour", F.lit(True).alias("is_peak"))
    off = h.orderBy("mean_value", "hour").limit(3).select("hour", F.lit(True).alias("is_off_peak"))
    return (h.join(F.broadcast(peak), "hour", "left").join(F.broadcast(off), "hour", "left")
              .fillna(False, ["is_peak", "is_off_peak"]))


@query("weekday_weekend_profile", """
SELECT CAST(isodow(ts) - 1 >= 5 AS INTEGER) AS is_weekend, avg(value) AS mean_value, count(*) AS n
FROM events GROUP BY 1""", floats=("mean_value",))
def weekday_weekend_profile(spark, sf):
    """F21 + C1: weekday versus weekend mean."""
    e = read_table(spark, sf, "events", "ts", "value")
    return e.groupBy(calendar_parts("ts")["is_weekend"].alias("is_weekend")).agg(
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n"))


@query("season_weekday_profile", """
SELECT ['Winter', 'Spring', 'Summer', 'Autumn'][CAST(floor((month(l_shipdate) % 12) / 3) AS INTEGER) + 1] AS season,
       CAST(isodow(l_shipdate) - 1 AS INTEGER) AS weekday, avg(l_quantity) AS mean_quantity, count(*) AS n
FROM lineitem GROUP BY ALL""", floats=("mean_quantity",))
def season_weekday_profile(spark, sf):
    """F24 + C3: season x weekday mean quantity."""
    li = read_table(spark, sf, "lineitem", "l_shipdate", "l_quantity")
    return li.groupBy(season(F.month("l_shipdate")).alias("season"), F.weekday("l_shipdate").alias("weekday")) \
             .agg(F.avg("l_quantity").alias("mean_quantity"), F.count(F.lit(1)).alias("n"))


@query("events_cadence", """
WITH p AS (SELECT event_type, date_diff('microsecond', lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id), ts) AS g
           FROM events),
k AS (SELECT event_type, g, count(*) AS n FROM p WHERE g IS NOT NULL GROUP BY ALL)
SELECT event_type, first(g ORDER BY n DESC, g) AS modal_gap_us, count(*) AS distinct_gaps,
       count(*) = 1 AS regular FROM k GROUP BY event_type""")
def events_cadence(spark, sf):
    """Modal gap, number of distinct gaps and regularity per series."""
    e = read_table(spark, sf, "events", "event_id", "event_type", "ts")
    p = ts.add_position(e, "event_type", "ts", "pos", ["event_id"])
    return ts.cadence_audit(p, "event_type", "pos", "ts")
