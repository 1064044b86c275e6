"""Scalar-rule and feature queries."""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import rules as ru
from ..functions.binning import cut, equal_width_code, percent_rank_average
from ..functions.dates import age_years, cyclic, haversine_km, log1p_clipped, expm1_clipped
from ..operators import cleaning as cl
from ..sources.tables import read_table
from ..operators.quantiles import exact_median, exact_mode, quantile_values
from .registry import query


@query("cyclic_time_features", f"""
SELECT event_id, sin(hour(ts) * {2 * math.pi / 24!r}) AS hour_sin, cos(hour(ts) * {2 * math.pi / 24!r}) AS hour_cos,
       sin(dayofyear(ts) * {2 * math.pi / 365!r}) AS doy_sin, cos(dayofyear(ts) * {2 * math.pi / 365!r}) AS doy_cos,
       sin(radians(value % 360)) AS dir_sin, cos(radians(value % 360)) AS dir_cos FROM events""",
       floats=("hour_sin", "hour_cos", "doy_sin", "doy_cos", "dir_sin", "dir_cos"))
def cyclic_time_features(spark, sf):
    """C4: sin/cos encodings of hour/24, day-of-year/365 and a degree angle."""
    e = read_table(spark, sf, "events", "event_id", "ts", "value")
    hs, hc = cyclic(F.hour("ts"), 24)
    ds, dc = cyclic(F.dayofyear("ts"), 365)
    r = F.radians(F.col("value") % 360)
    return e.select("event_id", hs.alias("hour_sin"), hc.alias("hour_cos"), ds.alias("doy_sin"), dc.alias("doy_cos"),
                    F.sin(r).alias("dir_sin"), F.cos(r).alias("dir_cos"))


@query("order_age_years", """
WITH m AS (SELECT max(o_orderdate) AS snap FROM orders)
SELECT CAST(floor(floor(date_diff('microsecond', o_orderdate, snap) / 86400000000.0) / 365) AS BIGINT) AS age_years,
       count(*) AS n FROM orders, m GROUP BY 1""")
def order_age_years(spark, sf):
    """Age in whole years = whole days // 365 (orders at the latest order date)."""
    o = read_table(spark, sf, "orders", "o_orderdate")
    snap = o.select(F.max("o_orderdate")).scalar()
    return o.groupBy(age_years(snap, F.col("o_orderdate")).alias("age_years")).agg(F.count(F.lit(1)).alias("n"))


@query("log_transforms", """
SELECT l_returnflag, avg(ln(1 + greatest(l_extendedprice - 50000, 0))) AS mean_log1p,
       sum(greatest(exp(ln(1 + greatest(l_extendedprice - 50000, 0))) - 1, 0)) AS back_sum,
       sum(greatest(l_extendedprice - 50000, 0)) AS clipped_sum FROM lineitem GROUP BY 1""",
       floats=("mean_log1p", "back_sum", "clipped_sum"))
def log_transforms(spark, sf):
    """log1p of a value clipped at 0, expm1 back-transform clipped at 0."""
    li = read_table(spark, sf, "lineitem", "l_returnflag", "l_extendedprice")
    x = F.col("l_extendedprice") - 50000
    lg = log1p_clipped(x)
    return li.groupBy("l_returnflag").agg(F.avg(lg).alias("mean_log1p"), F.sum(expm1_clipped(lg)).alias("back_sum"),
                                          F.sum(F.greatest(x, F.lit(0.0))).alias("clipped_sum"))


@query("nation_haversine", """
WITH g AS (SELECT n_nationkey, (n_nationkey * 37) % 170 - 85.0 AS lat, (n_nationkey * 71) % 350 - 175.0 AS lon FROM nation),
j AS (SELECT c.c_nationkey AS cn, s.s_nationkey AS sn FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
d AS (SELECT cn, 2 * 6371.0 * asin(sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
          + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2))) AS km
      FROM j JOIN g a ON a.n_nationkey = j.cn JOIN g b ON b.n_nationkey = j.sn)
SELECT cn AS c_nationkey, count(*) AS lines, avg(km) AS mean_km FROM d GROUP BY cn""", floats=("mean_km",))
def nation_haversine(spark, sf):
    """Great-circle km (R = 6371) between customer and supplier nations (coordinates
    derived from the nation key), mean per customer nation."""
    n = read_table(spark, sf, "nation", "n_nationkey")
    g = n.select("n_nationkey", ((F.col("n_nationkey") * 37) % 170 - 85.0).alias("lat"),
                 ((F.col("n_nationkey") * 71) % 350 - 175.0).alias("lon"))
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_suppkey")
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey")
    c = read_table(spark, sf, "customer", "c_custkey", "c_nationkey")
    s = read_table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
           .join(s, F.col("l_suppkey") == F.col("s_suppkey")))
    a = F.broadcast(g.select(F.col("n_nationkey").alias("c_nationkey"), F.col("lat").alias("la"), F.col("lon").alias("lo")))
    b = F.broadcast(g.select(F.col("n_nationkey").alias("s_nationkey"), F.col("lat").alias("lb"), F.col("lon").alias("lob")))
    d = j.join(a, "c_nationkey").join(b, "s_nationkey").withColumn("km", haversine_km("la", "lo", "lb", "lob"))
    return d.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("lines"), F.avg("km").alias("mean_km"))


QBINS = [0, 10, 25, 40, 50]
QLABELS = ["small", "medium", "large", "bulk"]


@query("quantity_bins", """
SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'small' WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'medium'
            WHEN l_quantity > 25 AND l_quantity <= 40 THEN 'large' WHEN l_quantity > 40 AND l_quantity <= 50 THEN 'bulk' END AS bin,
       count(*) AS n FROM lineitem GROUP BY 1""")
def quantity_bins(spark, sf):
    """Fixed-edge right-closed bins (0,10] (10,25] (25,40] (40,50]."""
    li = read_table(spark, sf, "lineitem", "l_quantity")
    return li.groupBy(cut("l_quantity", QBINS, QLABELS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("equal_width_target_means", """
WITH m AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE CAST(greatest(0, least(14, ceil((l_extendedprice - lo) / ((hi - lo) / 15)) - 1)) AS INTEGER) END AS bin,
             l_discount, lo, hi FROM lineitem, m)
SELECT bin, lo + (bin + 0.5) * ((hi - lo) / 15) AS mid, avg(l_discount) AS mean_target, count(*) AS n FROM b GROUP BY ALL""",
       floats=("mid", "mean_target"))
def equal_width_target_means(spark, sf):
    """C11: 15 equal-width right-closed bins (minimum in bin 0), mean target per bin and
    the bin mid-point label."""
    li = read_table(spark, sf, "lineitem", "l_extendedprice", "l_discount")
    mm = li.agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))
    lo, hi = mm.select("lo").scalar(), mm.select("hi").scalar()
    b = li.withColumn("bin", equal_width_code("l_extendedprice", lo, hi, 15))
    return b.groupBy("bin").agg(F.avg("l_discount").alias("mean_target"), F.count(F.lit(1)).alias("n")) \
            .withColumn("mid", lo + (F.col("bin") + 0.5) * ((hi - lo) / 15))


@query("acctbal_percent_rank", """
SELECT c_custkey, (rank() OVER (ORDER BY c_acctbal) - 1 + (count(*) OVER (PARTITION BY c_acctbal) + 1) / 2.0)
                  / count(*) OVER () AS pct_rank FROM customer""", floats=("pct_rank",))
def acctbal_percent_rank(spark, sf):
    """C14: average-method percent rank (ties share the mean rank)."""
    c = read_table(spark, sf, "customer", "c_custkey", "c_acctbal")
    return percent_rank_average(c, "c_acctbal", "pct_rank").select("c_custkey", "pct_rank")


CUST_SQL = """cs AS (SELECT c.c_custkey, c.c_acctbal, c.c_mktsegment, count(o.o_orderkey) AS n_orders,
                     coalesce(sum(o.o_totalprice), 0) AS spend FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
              GROUP BY ALL)"""


def cust_stats(spark, sf):
    c = read_table(spark, sf, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    agg = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spend"))
    return (c.join(agg, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
             .fillna({"n_orders": 0, "spend": 0.0}))


@query("package_catalogue", f"""
WITH {CUST_SQL},
q AS (SELECT quantile_cont(spend, 0.75) AS s75, quantile_cont(spend, 0.5) AS s50, quantile_cont(n_orders, 0.75) AS o75,
             quantile_cont(c_acctbal, 0.25) AS b25 FROM cs)
SELECT CASE WHEN spend >= s75 AND n_orders >= o75 THEN 'Premium Unlimited' WHEN spend >= s75 THEN 'High Spend'
            WHEN n_orders >= o75 THEN 'Frequent Buyer' WHEN spend >= s50 THEN 'Standard Plus'
            WHEN c_acctbal < b25 THEN 'Budget Saver' ELSE 'Basic' END AS package, count(*) AS customers
FROM cs, q GROUP BY 1""")
def package_catalogue(spark, sf):
    """Six ordered rules with data-driven quantile thresholds (exact quantiles
    -> literal thresholds -> CASE chain)."""
    cs = cust_stats(spark, sf)
    q = quantile_values(cs, ["spend", "n_orders", "c_acctbal"], [0.25, 0.5, 0.75])
    s75, s50, o75, b25 = (F.lit(x) for x in (q["spend"][2], q["spend"][1], q["n_orders"][2], q["c_acctbal"][0]))
    pkg = (F.when((F.col("spend") >= s75) & (F.col("n_orders") >= o75), "Premium Unlimited")
            .when(F.col("spend") >= s75, "High Spend").when(F.col("n_orders") >= o75, "Frequent Buyer")
            .when(F.col("spend") >= s50, "Standard Plus").when(F.col("c_acctbal") < b25, "Budget Saver")
            .otherwise("Basic"))
    return cs.groupBy(pkg.alias("package")).agg(F.count(F.lit(1)).alias("customers"))


W = {"spend": 0.55, "n_orders": 0.20, "c_acctbal": 0.20, "c_custkey": 0.05}


@query("composite_scores", f"""
WITH {CUST_SQL},
m AS (SELECT min(spend) AS a0, max(spend) AS a1, min(n_orders) AS b0, max(n_orders) AS b1, min(c_acctbal) AS c0,
             max(c_acctbal) AS c1, min(c_custkey) AS d0, max(c_custkey) AS d1 FROM cs)
SELECT c_custkey, round((coalesce((spend - a0) / nullif(a1 - a0, 0), 0) * 0.55 + coalesce((n_orders - b0) / nullif(b1 - b0, 0), 0) * 0.2
        + coalesce((c_acctbal - c0) / nullif(c1 - c0, 0), 0) * 0.2 + coalesce((c_custkey - d0) / nullif(d1 - d0, 0), 0) * 0.05) * 100, 2)
        AS score,
       CASE WHEN n_orders < 5 THEN 0 WHEN n_orders < 10 THEN 1 WHEN n_orders < 15 THEN 2 ELSE 3 END
        + 2 * CAST(c_acctbal < 0 AS INTEGER) + 2 * CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS points,
       coalesce(spend / nullif(n_orders, 0), 0) AS avg_order_value,
       CAST(spend > 1000000 AS INTEGER) AS big_spender
FROM cs, m""", floats=("score", "avg_order_value"))
def composite_scores(spark, sf):
    """C20 + C21 + C23 + C24: weighted min-max composite (x100, 2 dp), points ladder plus
    2 x flags, safe ratio, threshold flag."""
    cs = cust_stats(spark, sf)
    mm = cs.agg(*[F.min(c).alias(f"lo_{c}") for c in W], *[F.max(c).alias(f"hi_{c}") for c in W])
    stats = {c: (mm.select(f"lo_{c}").scalar(), mm.select(f"hi_{c}").scalar()) for c in W}
    pts = ru.points_ladder("n_orders", [(5, 0), (10, 1), (15, 2), (float("inf"), 3)]) \
        + 2 * (F.col("c_acctbal") < 0).cast("int") + 2 * (F.col("c_mktsegment") == "BUILDING").cast("int")
    return cs.select("c_custkey", ru.weighted_minmax_score(W, stats).alias("score"), pts.alias("points"),
                     ru.safe_ratio("spend", "n_orders").alias("avg_order_value"),
                     (F.col("spend") > 1000000).cast("int").alias("big_spender"))


@query("row_means_and_ordinals", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS a,
                  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice / 2 END AS b, o_orderpriority FROM orders)
SELECT o_orderkey, (coalesce(a, 0) + coalesce(b, 0)) / nullif(CAST(a IS NOT NULL AS INTEGER) + CAST(b IS NOT NULL AS INTEGER), 0) AS row_mean,
       coalesce(a, 0) + coalesce(b, 0) AS row_sum,
       coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 END, 0) AS priority_rank
FROM o""", floats=("row_mean", "row_sum"))
def row_means_and_ordinals(spark, sf):
    """C22 + C25: null-skipping row mean, row sums and ordinal map encoding (unknown -> 0)."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    a = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    b = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") / 2)
    omap = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2}
    return o.select("o_orderkey", ru.row_mean(a, b).alias("row_mean"),
                    (F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))).alias("row_sum"),
                    ru.ordinal_map("o_orderpriority", omap).alias("priority_rank"))


SKEW_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_sq"]


@query("skew_driven_log", """
WITH l AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * l_extendedprice / 1e6 AS l_sq FROM lineitem),
s AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1.0)) AS skew, "
    f"avg(ln(1 + greatest({c}, 0))) AS mean_log, avg({c}) AS mean_raw FROM l" for c in SKEW_COLS) + """)
SELECT "column", abs(skew) > 0.75 AS transformed, CASE WHEN abs(skew) > 0.75 THEN mean_log ELSE mean_raw END AS mean_after FROM s""",
       floats=("mean_after",))
def skew_driven_log(spark, sf):
    """Columns with |population skewness| > 0.75 get log1p(clip 0); the transformed
    list is kept (here with the mean of each column after the step)."""
    li = read_table(spark, sf, "lineitem", *SKEW_COLS[:-1]).withColumn(
        "l_sq", F.col("l_extendedprice") * F.col("l_extendedprice") / 1e6)
    sk = li.agg(*[F.skewness(c).alias(c) for c in SKEW_COLS]).first()
    chosen = [c for c in SKEW_COLS if sk[c] is not None and abs(sk[c]) > 0.75]
    t = li.withColumns({c: log1p_clipped(c) for c in chosen})
    means = t.agg(*[F.avg(c).alias(c) for c in SKEW_COLS])
    return means.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(c in chosen).alias("transformed"),
                                                    F.col(c).alias("mean_after")) for c in SKEW_COLS])))


@query("rating_sentiment", """
SELECT CASE WHEN r <= 2 THEN 'negative' WHEN r = 3 THEN 'neutral' WHEN r >= 4 THEN 'positive' END AS sentiment,
       CASE WHEN r <= 2 THEN 0 WHEN r >= 4 THEN 1 END AS sentiment_bin, count(*) AS n
FROM (SELECT CAST(round(l_quantity / 10.0) AS INTEGER) AS r FROM lineitem) GROUP BY ALL""")
def rating_sentiment(spark, sf):
    """Rating (quantity / 10 rounded) -> 3-class sentiment; binary label null for neutral."""
    li = read_table(spark, sf, "lineitem", "l_quantity")
    r = F.round(F.col("l_quantity") / 10.0).cast("int")
    s = ru.rating_to_sentiment(F.col("l_quantity") / 10.0)
    return li.groupBy(s.alias("sentiment"), F.when(r <= 2, 0).when(r >= 4, 1).alias("sentiment_bin")) \
             .agg(F.count(F.lit(1)).alias("n"))


BASE_COST = {"Minor": 150.0, "Moderate": 600.0, "Severe": 2000.0}
TYPE_MULT = {"LARGE": 1.5, "MEDIUM": 1.2, "SMALL": 0.9}


@query("repair_cost_lookup", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'Minor' WHEN p_size <= 30 THEN 'Moderate' ELSE 'Severe' END AS sev, p_type FROM part),
b(sev, base) AS (VALUES ('Minor', 150.0::DOUBLE), ('Moderate', 600.0::DOUBLE), ('Severe', 2000.0::DOUBLE)),
m(p_type, mult) AS (VALUES ('LARGE', 1.5::DOUBLE), ('MEDIUM', 1.2::DOUBLE), ('SMALL', 0.9::DOUBLE))
SELECT sev, p_type, count(*) AS n, sum(base * coalesce(mult, 1.1::DOUBLE)) AS cost FROM p JOIN b USING (sev) LEFT JOIN m USING (p_type) GROUP BY ALL""",
       floats=("cost",))
def repair_cost_lookup(spark, sf):
    """Base cost by severity x multiplier by type (default 1.1), two lookup joins."""
    from ..operators.joins import lookup
    p = read_table(spark, sf, "part", "p_partkey", "p_size", "p_type")
    p = p.withColumn("sev", F.when(F.col("p_size") <= 10, "Minor").when(F.col("p_size") <= 30, "Moderate")
                     .otherwise("Severe"))
    j = lookup(lookup(p, "sev", BASE_COST, "base", value_type="double"), "p_type", TYPE_MULT, "mult", 1.1, "double")
    return j.groupBy("sev", "p_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base") * F.col("mult")).alias("cost"))


ACTIONS = {"en": "Route to English desk", "fr": "Route to French desk", "de": "Route to German desk"}


@query("action_recommendations", f"""
SELECT doc_id, CASE WHEN least(n_chars / 4000.0, 1.0) < 0.6 THEN 'Low confidence - verify: ' ELSE '' END ||
       coalesce(CASE lang WHEN 'en' THEN 'Route to English desk' WHEN 'fr' THEN 'Route to French desk'
                          WHEN 'de' THEN 'Route to German desk' END, 'Manual review') AS action,
       substring(regexp_replace(text, '[\\r\\n]', ' ', 'g'), 1, 160) AS preview,
       split_part(source, 'c', 1) AS group_key FROM documents""")
def action_recommendations(spark, sf):
    """C30 + C31 + C32: action lookup with default and low-confidence prefix, 160-char
    preview, group key from a name (text before the first separator)."""
    d = read_table(spark, sf, "documents", "doc_id", "lang", "text", "n_chars", "source")
    conf = F.least(F.col("n_chars") / 4000.0, F.lit(1.0))
    return d.select("doc_id", ru.action_lookup("lang", conf, ACTIONS, "Manual review").alias("action"),
                    ru.truncate_text(F.regexp_replace("text", r"[\r\n]", " "), 160).alias("preview"),
                    ru.group_key_from_name("source", "c").alias("group_key"))


@query("representative_row", """
SELECT (SELECT median(c_acctbal) FROM customer) AS c_acctbal, (SELECT median(c_nationkey) FROM customer) AS c_nationkey,
       (SELECT first(c_mktsegment ORDER BY n DESC, c_mktsegment) FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)) AS c_mktsegment""",
       floats=("c_acctbal", "c_nationkey"))
def representative_row(spark, sf):
    """Default row = median of every numeric column, mode of every categorical one."""
    c = read_table(spark, sf, "customer", "c_acctbal", "c_nationkey", "c_mktsegment")
    med = quantile_values(c, ["c_acctbal", "c_nationkey"], [0.5])
    return exact_mode(c, "c_mktsegment").select(
        *[F.lit(med[x][0]).cast("double").alias(x) for x in ("c_acctbal", "c_nationkey")], "c_mktsegment")


@query("group_median_ratio", """
WITH g AS (SELECT c_mktsegment, median(c_acctbal) AS med FROM customer GROUP BY 1)
SELECT c_custkey, c_acctbal - med AS diff_from_median, round(c_acctbal / med, 3) AS ratio_to_median
FROM customer JOIN g USING (c_mktsegment)""", floats=("diff_from_median", "ratio_to_median"))
def group_median_ratio(spark, sf):
    """F7 + C34: difference from and ratio (3 dp) to the group median."""
    c = read_table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_acctbal")
    g = exact_median(c, "c_acctbal", ["c_mktsegment"], "med")
    j = c.join(g, "c_mktsegment")
    return j.select("c_custkey", (F.col("c_acctbal") - F.col("med")).alias("diff_from_median"),
                    F.round(F.col("c_acctbal") / F.col("med"), 3).alias("ratio_to_median"))


@query("target_encoding", """
WITH p AS (SELECT p_partkey, p_brand, p_retailprice, CASE WHEN p_partkey % 4 = 0 THEN 'test' ELSE 'train' END AS split FROM part),
g AS (SELECT p_brand, median(p_retailprice) AS enc FROM p WHERE split = 'train' GROUP BY 1),
d AS (SELECT median(enc) AS dflt FROM g)
SELECT p_partkey, split, coalesce(enc, (SELECT dflt FROM d)) AS brand_encoded FROM p LEFT JOIN g USING (p_brand)""",
       floats=("brand_encoded",))
def target_encoding(spark, sf):
    """Group-median target encoding fitted on train rows only; unseen groups get the
    median of the group medians."""
    p = read_table(spark, sf, "part", "p_partkey", "p_brand", "p_retailprice")
    p = p.withColumn("split", F.when(F.col("p_partkey") % 4 == 0, "test").otherwise("train"))
    g = exact_median(p.filter(F.col("split") == "train"), "p_retailprice", ["p_brand"], "enc")
    dflt = F.lit(quantile_values(g, ["enc"], [0.5])["enc"][0])
    return p.join(g, "p_brand", "left").select("p_partkey", "split", F.coalesce("enc", dflt).alias("brand_encoded"))


@query("numeric_code_categories", """
SELECT CAST(p_size AS VARCHAR) AS size_code, count(*) AS n FROM part WHERE p_type <> 'ECONOMY' GROUP BY 1""")
def numeric_code_categories(spark, sf):
    """B25 + B18 + B16: numeric code cast to a string category, a singleton-like category
    removed by filter, unused columns dropped."""
    p = read_table(spark, sf, "part", "p_size", "p_type", "p_name")
    p = cl.drop_if_present(p.filter(F.col("p_type") != "ECONOMY"), ["p_name", "not_there"])
    return p.groupBy(F.col("p_size").cast("string").alias("size_code")).agg(F.count(F.lit(1)).alias("n"))
