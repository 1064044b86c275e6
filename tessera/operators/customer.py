"""Customer-grain analytics: RFM features, scores and segments, Pareto share (E2, F5,
F6, F19, C12-C15, E24).

Input is a *sales* table at line grain with the columns named by the keyword
arguments.  Every step is an aggregate, an equi-join or a range-partitioned ordering,
so a customer holding a third of all lines is reduced map-side before any shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binning import qcut, qcut_first_rank
from ..functions.dates import whole_days
from ..functions.rules import rfm_label
from ..session import materialize
from .ordering import sequence_index, sequence_index_sized, running_sum


def order_grain(sales: DataFrame, customer: str, invoice: str, revenue: str, ts: str) -> DataFrame:
    return (sales.groupBy(customer, invoice)
                 .agg(F.sum(revenue).alias("order_revenue"), F.max(ts).alias("order_date")))


def mean_gap_days(orders: DataFrame, customer: str, invoice: str, date: str = "order_date",
                  out: str = "avg_interpurchase", digits: int = 1) -> DataFrame:
    """Mean whole-day gap between consecutive orders per customer; single order -> 0.

    Consecutive pairs come from an equi-join of position p with p-1 (positions from a
    range-partitioned index), not from ``lag`` over a window partitioned by customer,
    so one very active customer does not land in one task."""
    idx = sequence_index(orders.select(customer, invoice, date), [date, invoice], [customer], "_p")
    prev = idx.select(customer, (F.col("_p") + 1).alias("_p"), F.col(date).alias("_prev"))
    gaps = (idx.join(prev, [customer, "_p"])
               .groupBy(customer).agg(F.avg(whole_days(F.col(date), F.col("_prev"))).alias("_g")))
    base = orders.select(customer).distinct()
    return (base.join(gaps, customer, "left")
                .select(customer, F.bround(F.coalesce("_g", F.lit(0.0)), digits).alias(out)))


def customer_features(sales: DataFrame, customer: str = "customer_id", invoice: str = "invoice",
                      product: str = "product", quantity: str = "quantity",
                      revenue: str = "revenue", ts: str = "ts", country: str = "country",
                      snapshot_offset_days: int = 1) -> DataFrame:
    """One row per customer: frequency, monetary, products bought, diversity, recency,
    tenure, average basket, average inter-purchase days, primary country (mode)."""
    snapshot = sales.select(F.max(ts) + F.make_interval(days=F.lit(snapshot_offset_days))).scalar()
    feats = sales.groupBy(customer).agg(
        F.max(ts).alias("_last"), F.min(ts).alias("_first"),
        F.count_distinct(invoice).alias("frequency"),
        F.sum(revenue).alias("monetary"),
        F.sum(quantity).alias("products_bought"),
        F.count_distinct(product).alias("product_diversity"),
        F.mode(country, True).alias("country"),
    )
    feats = (feats.withColumn("recency", whole_days(snapshot, F.col("_last")))
                  .withColumn("tenure", whole_days(F.col("_last"), F.col("_first")))
                  .withColumn("avg_basket_value", F.bround(F.col("monetary") / F.col("frequency"), 2)))
    gaps = mean_gap_days(order_grain(sales, customer, invoice, revenue, ts), customer, invoice)
    return feats.join(gaps, customer, "left").drop("_last", "_first")


def rfm_scores(feats: DataFrame, customer: str = "customer_id", q: int = 5) -> DataFrame:
    """R = qcut(recency) with reversed labels; F, M = qcut(rank(method="first")),
    ties in row order = ascending customer id; label = first matching rule.

    The customer table is materialised once: three ranking passes read it."""
    f = qcut(materialize(feats), "recency", q, "r_score", labels=list(range(q, 0, -1)))
    f = qcut_first_rank(f, "frequency", [customer], q, "f_score", labels=list(range(1, q + 1)))
    f = qcut_first_rank(f, "monetary", [customer], q, "m_score", labels=list(range(1, q + 1)))
    return (f.withColumn("rfm_sum", F.col("r_score") + F.col("f_score") + F.col("m_score"))
             .withColumn("rfm_segment", rfm_label("r_score", "f_score", "m_score")))


def segment_share(scored: DataFrame, segment: str = "rfm_segment", value: str = "monetary") -> DataFrame:
    """Customers and value share per segment."""
    total = scored.select(F.sum(value)).scalar()
    return (scored.groupBy(segment)
                  .agg(F.count(F.lit(1)).alias("customers"), F.sum(value).alias("revenue"))
                  .withColumn("revenue_share", F.col("revenue") / total))


def pareto(feats: DataFrame, customer: str = "customer_id", value: str = "monetary",
           top_frac: float = 0.2) -> DataFrame:
    """Cumulative value share by descending value (ties by key) and the top-``top_frac``
    flag (``int(n*frac)`` rows).  Running sums are chunked, never one global window."""
    d = feats.select(customer, F.col(value).alias("_v"))
    idx = sequence_index_sized(d, [F.desc("_v"), F.asc(customer)], (), "rank", "_n")
    cum = running_sum(idx, "rank", ["_v"])
    total = d.select(F.sum("_v")).scalar()
    return cum.select(customer, "rank", F.col("_v").alias(value),
                      (F.col("_v_cum") / total).alias("cum_share"),
                      (F.col("rank") <= F.floor(F.col("_n") * top_frac)).alias("is_top"))
