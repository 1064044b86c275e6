"""Profiling / aggregation queries (E1-E26) over the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as pr
from ..sources.tables import read_table
from .common import SALES_SQL, sales
from ..operators.quantiles import exact_quantiles, quantile_values
from .registry import query

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("country_summary", f"""
WITH {SALES_SQL}
SELECT country, sum(revenue) AS revenue, count(DISTINCT customer_id) AS customers,
       count(DISTINCT product) AS products, count(DISTINCT invoice) AS orders
FROM sales GROUP BY country""", floats=("revenue",))
def country_summary(spark, sf):
    """Revenue, distinct customers / products / orders per country."""
    return sales(spark, sf).groupBy("country").agg(
        F.sum("revenue").alias("revenue"), F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("product").alias("products"), F.count_distinct("invoice").alias("orders"))


@query("quality_rate_by_lang", """
SELECT d.lang, count(*) AS n, CAST(sum(l.quality) AS BIGINT) AS positives, avg(l.quality) * 100 AS rate
FROM labels l JOIN documents d USING (doc_id) GROUP BY d.lang""", floats=("rate",))
def quality_rate_by_lang(spark, sf):
    """Target rate x100 by category (labels joined to documents)."""
    lab = read_table(spark, sf, "labels", "doc_id", "quality")
    docs = read_table(spark, sf, "documents", "doc_id", "lang")
    return pr.rate_by(lab.join(docs, "doc_id"), ["lang"], "quality")


@query("return_share_by_year", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS n,
       avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) * 100 AS share
FROM lineitem GROUP BY 1""", floats=("share",))
def return_share_by_year(spark, sf):
    """Conditional share (returned lines, %) inside each ship year."""
    li = read_table(spark, sf, "lineitem", "l_shipdate", "l_returnflag")
    return pr.conditional_share(li.withColumn("ship_year", F.year("l_shipdate")), ["ship_year"],
                                F.col("l_returnflag") == "R")


@query("worst_nations_by_returns", """
WITH j AS (SELECT n.n_name, l.l_returnflag FROM lineitem l
           JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
           JOIN nation n ON c.c_nationkey = n.n_nationkey),
g AS (SELECT n_name, count(*) AS n, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) * 100 AS rate
      FROM j GROUP BY n_name)
SELECT * FROM g WHERE n >= 25 ORDER BY rate DESC, n_name LIMIT 10""", floats=("rate",))
def worst_nations_by_returns(spark, sf):
    """E5 + G1: minimum-volume gate (>= 25 lines) then the 10 worst return rates."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_returnflag")
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey")
    c = read_table(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation", "n_nationkey", "n_name")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(c, F.col("o_custkey") == F.col("c_custkey"))
           .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")))
    return pr.gated_top_k(j, ["n_name"], F.col("l_returnflag") == "R", 25, 10)


@query("priority_value_counts", """
SELECT o_orderpriority, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share
FROM orders GROUP BY o_orderpriority""", floats=("share",))
def priority_value_counts(spark, sf):
    """Value counts with normalised frequency."""
    return pr.value_counts(read_table(spark, sf, "orders", "o_orderpriority"), "o_orderpriority")


_PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_PRI_ALIAS = ["p1_urgent", "p2_high", "p3_medium", "p4_not_specified", "p5_low"]


@query("status_priority_crosstab", "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{v}') AS {a}" for v, a in zip(_PRI, _PRI_ALIAS))
    + " FROM orders GROUP BY o_orderstatus")
def status_priority_crosstab(spark, sf):
    """Zero-filled cross-tab of order status x priority with a fixed column order."""
    o = read_table(spark, sf, "orders", "o_orderstatus", "o_orderpriority")
    return pr.crosstab(o, "o_orderstatus", "o_orderpriority", _PRI, _PRI_ALIAS)


@query("top_decile_cohort", """
WITH c AS (SELECT o_custkey, count(*) AS orders, avg(o_totalprice) AS spend,
                  avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS fulfilled FROM orders GROUP BY o_custkey),
t AS (SELECT quantile_cont(orders, 0.9) AS q FROM c)
SELECT 'top10' AS cohort, count(*) AS customers, avg(orders) AS avg_orders, avg(spend) AS avg_spend,
       avg(fulfilled) * 100 AS fulfilled_pct FROM c WHERE orders >= (SELECT q FROM t)
UNION ALL
SELECT 'all', count(*), avg(orders), avg(spend), avg(fulfilled) * 100 FROM c""",
       floats=("avg_orders", "avg_spend", "fulfilled_pct"))
def top_decile_cohort(spark, sf):
    """Quantile-cut cohort (top 10 % of customers by orders) versus everyone."""
    o = read_table(spark, sf, "orders", "o_custkey", "o_totalprice", "o_orderstatus")
    c = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.avg("o_totalprice").alias("spend"),
                                   F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("fulfilled"))
    q = F.lit(quantile_values(c, ["orders"], [0.9])["orders"][0])
    stats = [F.count(F.lit(1)).alias("customers"), F.avg("orders").alias("avg_orders"),
             F.avg("spend").alias("avg_spend"), (F.avg("fulfilled") * 100).alias("fulfilled_pct")]
    # one pass: each customer contributes to "all" and, if in the top decile, to "top10"
    tagged = c.withColumn("cohort", F.explode(F.when(F.col("orders") >= q, F.array(F.lit("top10"), F.lit("all")))
                                              .otherwise(F.array(F.lit("all")))))
    return tagged.groupBy("cohort").agg(*stats)


@query("doc_length_summary", """
SELECT lang, avg(n_chars) AS mean_chars, median(n_chars) AS median_chars,
       quantile_cont(n_chars, 0.95) AS p95_chars, max(n_chars) AS max_chars
FROM documents GROUP BY lang""", floats=("mean_chars", "median_chars", "p95_chars"))
def doc_length_summary(spark, sf):
    """Mean / median / p95 / max length per language."""
    d = read_table(spark, sf, "documents", "lang", "n_chars")
    q = exact_quantiles(d, ["n_chars"], [0.5, 0.95], ["lang"]).select(
        "lang", F.col("q")[0].alias("median_chars"), F.col("q")[1].alias("p95_chars"))
    s = d.groupBy("lang").agg(F.avg("n_chars").alias("mean_chars"), F.max("n_chars").alias("max_chars"))
    return s.join(q, "lang", "left").select("lang", "mean_chars", "median_chars", "p95_chars", "max_chars")


@query("lineitem_describe", " UNION ALL ".join(f"""
SELECT '{c}' AS column, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
       quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75,
       max({c}) AS max FROM lineitem""" for c in NUM),
       floats=("mean", "std", "min", "p25", "p50", "p75", "max"))
def lineitem_describe(spark, sf):
    """describe() for every numeric lineitem measure, one aggregate."""
    return pr.describe(read_table(spark, sf, "lineitem", *NUM), NUM)


@query("lineitem_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem"
    for i, a in enumerate(NUM) for b in NUM[i + 1:]), floats=("r",))
def lineitem_correlations(spark, sf):
    """Pearson correlation of every pair, long layout, one aggregate."""
    return pr.correlation_pairs(read_table(spark, sf, "lineitem", *NUM), NUM)


@query("high_correlation_pairs", """
WITH p AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem"
    for i, a in enumerate(NUM + ['l_net']) for b in (NUM + ['l_net'])[i + 1:]).replace(
        "FROM lineitem", "FROM (SELECT *, l_extendedprice * (1 - l_discount) AS l_net FROM lineitem)") + """)
SELECT a, b, r FROM p WHERE abs(r) > 0.9""", floats=("r",))
def high_correlation_pairs(spark, sf):
    """Pairs with |r| > 0.9 (net price is derived so one pair qualifies)."""
    li = read_table(spark, sf, "lineitem", *NUM).withColumn(
        "l_net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return pr.correlation_pairs(li, NUM + ["l_net"]).filter(F.abs("r") > 0.9)


@query("lineitem_skewness", " UNION ALL ".join(f"""
SELECT '{c}' AS column, count({c}) AS n,
       skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1.0)) AS skew_population,
       skewness({c}) AS skew_sample FROM lineitem""" for c in NUM), floats=("skew_population", "skew_sample"))
def lineitem_skewness(spark, sf):
    """Population (Spark/scipy) and bias-corrected (pandas) skewness."""
    return pr.skewness(read_table(spark, sf, "lineitem", *NUM), NUM)


@query("brand_mode_by_type", """
WITH k AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL)
SELECT p_type, first(p_brand ORDER BY n DESC, p_brand) AS p_brand FROM k GROUP BY p_type""")
def brand_mode_by_type(spark, sf):
    """Group mode, smallest value on ties."""
    return pr.group_mode(read_table(spark, sf, "part", "p_type", "p_brand"), ["p_type"], "p_brand")


@query("price_quantity_fit", """
SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope,
       regr_intercept(l_extendedprice, l_quantity) AS intercept, corr(l_quantity, l_extendedprice) AS r
FROM lineitem GROUP BY l_returnflag""", floats=("slope", "intercept", "r"))
def price_quantity_fit(spark, sf):
    """Least-squares line of price on quantity per return flag."""
    li = read_table(spark, sf, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    return pr.least_squares(li, ["l_returnflag"], "l_quantity", "l_extendedprice")


@query("orders_cardinality", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM orders"
    for c in ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]))
def orders_cardinality(spark, sf):
    """Distinct counts of selected columns in one aggregate."""
    cols = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]
    o = read_table(spark, sf, "orders", *cols)
    agg = o.agg(*[F.count_distinct(c).alias(c) for c in cols])
    return agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct"))
                                         for c in cols])))


@query("price_histogram", """
WITH m AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(least(19, floor((l_extendedprice - lo) / ((hi - lo) / 20))) AS INTEGER) AS bin
      FROM lineitem, m),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
s AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20))
SELECT s.bin, coalesce(c.n, 0) AS n, lo + s.bin * ((hi - lo) / 20) AS bin_lo,
       lo + (s.bin + 1) * ((hi - lo) / 20) AS bin_hi
FROM s LEFT JOIN c USING (bin), m""", floats=("bin_lo", "bin_hi"))
def price_histogram(spark, sf):
    """20 equal-width bins of l_extendedprice, empty bins included."""
    return pr.histogram(read_table(spark, sf, "lineitem", "l_extendedprice"), "l_extendedprice", 20)


@query("discount_box_stats", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem GROUP BY l_returnflag),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT f.l_returnflag, q1, median, q3, lower, upper,
       min(CASE WHEN l_extendedprice BETWEEN lower AND upper THEN l_extendedprice END) AS whisker_lo,
       max(CASE WHEN l_extendedprice BETWEEN lower AND upper THEN l_extendedprice END) AS whisker_hi,
       CAST(sum(CASE WHEN l_extendedprice BETWEEN lower AND upper THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM lineitem l JOIN f USING (l_returnflag) GROUP BY ALL""",
       floats=("q1", "median", "q3", "lower", "upper", "whisker_lo", "whisker_hi"))
def discount_box_stats(spark, sf):
    """Box-plot statistics of price per return flag."""
    li = read_table(spark, sf, "lineitem", "l_returnflag", "l_extendedprice")
    return pr.box_stats(li, ["l_returnflag"], "l_extendedprice")


@query("lineitem_kpis", """
SELECT * FROM (VALUES
 ('revenue', (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l_discount AS DECIMAL(15, 2)))) AS DOUBLE) FROM lineitem)),
 ('lines', (SELECT CAST(count(*) AS DOUBLE) FROM lineitem)),
 ('orders', (SELECT CAST(count(DISTINCT l_orderkey) AS DOUBLE) FROM lineitem)),
 ('avg_discount', (SELECT avg(l_discount) FROM lineitem)),
 ('return_rate', (SELECT avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) FROM lineitem))
) AS t(metric, value)""", floats=("value",))
def lineitem_kpis(spark, sf):
    """KPI (metric, value) table from one aggregate."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount", "l_returnflag")
    return pr.kpi_table(li, [
        # exact decimal money sum: independent of summation order
        ("revenue", F.sum(F.col("l_extendedprice").cast("decimal(15,2)")
                          * (1 - F.col("l_discount").cast("decimal(15,2)")))),
        ("lines", F.count(F.lit(1))), ("orders", F.count_distinct("l_orderkey")),
        ("avg_discount", F.avg("l_discount")),
        ("return_rate", F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)))])


_ORDER = _PRI + ["6-UNKNOWN"]


@query("priority_breakdown", """
WITH od(o_orderpriority, dim_order) AS (VALUES """ + ", ".join(f"('{v}', {i})" for i, v in enumerate(_ORDER)) + """),
g AS (SELECT o_orderpriority, count(*) AS n,
             CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
             avg(o_totalprice) AS mean_score FROM orders GROUP BY o_orderpriority)
SELECT od.o_orderpriority, dim_order, coalesce(n, 0) AS n, coalesce(flagged, 0) AS flagged, mean_score,
       CAST(flagged AS DOUBLE) / n AS flagged_share
FROM od LEFT JOIN g USING (o_orderpriority)""", floats=("mean_score", "flagged_share"))
def priority_breakdown(spark, sf):
    """E19 + G3: breakdown in a fixed category order, absent categories kept."""
    o = read_table(spark, sf, "orders", "o_orderpriority", "o_totalprice")
    return pr.breakdown(o, "o_orderpriority", _ORDER, F.col("o_totalprice") > 200000, F.col("o_totalprice"))


@query("lang_imbalance", """
WITH g AS (SELECT lang, count(*) AS n, count(DISTINCT source) AS n_groups FROM documents GROUP BY lang)
SELECT lang, n, n_groups, (SELECT max(n) * 1.0 / min(n) FROM g) AS ratio_rows,
       (SELECT max(n_groups) * 1.0 / min(n_groups) FROM g) AS ratio_groups, n * 1.0 / n_groups AS rows_per_group
FROM g""", floats=("ratio_rows", "ratio_groups", "rows_per_group"))
def lang_imbalance(spark, sf):
    """E20 + M6: rows and distinct groups per class, imbalance ratios."""
    return pr.imbalance(read_table(spark, sf, "documents", "lang", "source"), "lang", "source")


_FEATS = ["n_chars", "n_lines", "n_digits"]


@query("lang_feature_profile", """
WITH d AS (SELECT lang, n_chars, len(string_split(text, chr(10))) AS n_lines,
                  length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits FROM documents),
m AS (SELECT lang, avg(n_chars) AS n_chars, avg(n_lines) AS n_lines, avg(n_digits) AS n_digits FROM d GROUP BY lang),
l AS (SELECT lang, 'n_chars' AS feature, n_chars AS mean FROM m UNION ALL
      SELECT lang, 'n_lines', n_lines FROM m UNION ALL SELECT lang, 'n_digits', n_digits FROM m)
SELECT lang, feature, mean,
       (mean - min(mean) OVER (PARTITION BY feature)) / nullif(max(mean) OVER (PARTITION BY feature) - min(mean) OVER (PARTITION BY feature), 0) AS scaled
FROM l""", floats=("mean", "scaled"))
def lang_feature_profile(spark, sf):
    """Feature means per class, min-max normalised across classes."""
    d = read_table(spark, sf, "documents", "lang", "n_chars", "text")
    d = d.select("lang", "n_chars", F.size(F.split("text", "\n")).alias("n_lines"),
                 F.length(F.regexp_replace("text", "[^0-9]", "")).alias("n_digits"))
    return pr.class_means_minmax(d, "lang", _FEATS)


@query("embedding_position_means", """
SELECT label, CAST(pos - 1 AS INTEGER) AS position, avg(v) AS mean, count(*) AS n
FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
GROUP BY ALL""", floats=("mean",))
def embedding_position_means(spark, sf):
    """Per class and vector position, mean value (array column histogram base)."""
    return pr.array_position_means(read_table(spark, sf, "embeddings", "label", "embedding"), "label", "embedding")


@query("lang_source_frequency", """
SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars,
       sum(n_chars) * 1.0 / (SELECT sum(n_chars) FROM documents) AS share
FROM documents GROUP BY lang, source""", floats=("share",))
def lang_source_frequency(spark, sf):
    """E26 + E22: pair frequency with share of total characters."""
    d = read_table(spark, sf, "documents", "lang", "source", "n_chars")
    return pr.share_of_total(d, ["lang", "source"], "n_chars")
