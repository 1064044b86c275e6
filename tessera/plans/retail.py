"""Retail analytics over lineitem/orders/customer/nation: RFM, segments, Pareto."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import customer as cust
from .common import SALES_SQL, sales, sql_code_from_edges, sql_days, sql_first_rank_code
from .registry import query

_FEATS_SQL = f"""
WITH {SALES_SQL},
snap AS (SELECT max(ts) + INTERVAL 1 DAY AS s FROM sales),
ord AS (SELECT customer_id, invoice, max(ts) AS d FROM sales GROUP BY customer_id, invoice),
gap AS (SELECT customer_id, {sql_days('d', 'lag(d) OVER (PARTITION BY customer_id ORDER BY d, invoice)')} AS g FROM ord),
gaps AS (SELECT customer_id, round_even(coalesce(avg(g), 0.0), 1) AS avg_interpurchase FROM gap GROUP BY customer_id),
cc AS (SELECT customer_id, country, count(*) AS k FROM sales GROUP BY customer_id, country),
ctry AS (SELECT customer_id, first(country ORDER BY k DESC, country) AS country FROM cc GROUP BY customer_id),
feats AS (
  SELECT s.customer_id,
         count(DISTINCT invoice) AS frequency, sum(revenue) AS monetary,
         sum(quantity) AS products_bought, count(DISTINCT product) AS product_diversity,
         {sql_days('(SELECT s FROM snap)', 'max(ts)')} AS recency,
         {sql_days('max(ts)', 'min(ts)')} AS tenure,
         round_even(sum(revenue) / count(DISTINCT invoice), 2) AS avg_basket_value
  FROM sales s GROUP BY s.customer_id),
f2 AS (
  SELECT f.*, g.avg_interpurchase, c.country FROM feats f
  JOIN gaps g USING (customer_id) JOIN ctry c USING (customer_id)),
e AS (SELECT quantile_cont(recency, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM f2),
ranked AS (
  SELECT f2.*,
         row_number() OVER (ORDER BY frequency, customer_id) AS pf,
         row_number() OVER (ORDER BY monetary, customer_id) AS pm,
         count(*) OVER () AS n,
         (SELECT q FROM e) AS q
  FROM f2),
scored AS (
  SELECT customer_id, frequency, monetary, products_bought, product_diversity, recency, tenure,
         avg_basket_value, avg_interpurchase, country,
         CAST(5 - ({sql_code_from_edges('recency', 'q', 5)}) AS INTEGER) AS r_score,
         CAST(1 + {sql_first_rank_code('pf', 'n', 5)} AS INTEGER) AS f_score,
         CAST(1 + {sql_first_rank_code('pm', 'n', 5)} AS INTEGER) AS m_score
  FROM ranked)
SELECT *, r_score + f_score + m_score AS rfm_sum,
       CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
            WHEN f_score >= 4 AND m_score >= 4 THEN 'Loyal'
            WHEN r_score >= 4 AND f_score <= 2 THEN 'New / Promising'
            WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At-Risk'
            WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost'
            ELSE 'Regular' END AS rfm_segment
FROM scored
"""


def rfm_table(spark, sf):
    return cust.rfm_scores(cust.customer_features(sales(spark, sf)))


@query("rfm_customers", _FEATS_SQL, floats=("monetary", "products_bought"))
def rfm_customers(spark, sf):
    """E2 + F5 + F19 + C6 + C12 + C13 + C15 + E13: one scored row per customer."""
    return rfm_table(spark, sf).select(
        "customer_id", "frequency", "monetary", "products_bought", "product_diversity",
        "recency", "tenure", "avg_basket_value", "avg_interpurchase", "country",
        F.col("r_score").cast("int").alias("r_score"), F.col("f_score").cast("int").alias("f_score"),
        F.col("m_score").cast("int").alias("m_score"), F.col("rfm_sum").cast("int").alias("rfm_sum"),
        "rfm_segment")


@query("rfm_segment_share", f"""
WITH base AS ({_FEATS_SQL})
SELECT rfm_segment, count(*) AS customers, sum(monetary) AS revenue,
       sum(monetary) / (SELECT sum(monetary) FROM base) AS revenue_share
FROM base GROUP BY rfm_segment""", floats=("revenue", "revenue_share"))
def rfm_segment_share(spark, sf):
    """Customers and revenue share per RFM segment."""
    return cust.segment_share(rfm_table(spark, sf))


@query("customer_pareto", f"""
WITH {SALES_SQL},
m AS (SELECT customer_id, sum(revenue) AS monetary FROM sales GROUP BY customer_id),
r AS (SELECT customer_id, monetary,
             row_number() OVER (ORDER BY monetary DESC, customer_id) AS rank,
             sum(monetary) OVER (ORDER BY monetary DESC, customer_id ROWS UNBOUNDED PRECEDING) AS cum,
             count(*) OVER () AS n FROM m)
SELECT customer_id, rank, monetary, cum / (SELECT sum(monetary) FROM m) AS cum_share,
       rank <= floor(n * 0.2) AS is_top
FROM r""", floats=("monetary", "cum_share"))
def customer_pareto(spark, sf):
    """cumulative revenue share by customer rank and the top-20 % flag."""
    m = sales(spark, sf).groupBy("customer_id").agg(F.sum("revenue").alias("monetary"))
    return cust.pareto(m)
