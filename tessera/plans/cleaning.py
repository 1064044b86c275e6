"""Cleaning queries.  The driver tables are clean, so dirt is *derived* inside each
query (the same expressions on the Spark and the SQL side): blank descriptions,
letter-only stock codes, zero quantities and prices, cancelled invoices, null keys."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..operators.ordering import keep_first
from ..sources.tables import read_table
from .registry import query

NON_PRODUCT_SQL = ", ".join(f"'{c}'" for c in cl.NON_PRODUCT_CODES)


def raw_lines(spark, sf):
    """Retail-shaped raw lines derived from lineitem/orders/part/customer/nation."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity",
                    "l_extendedprice", "l_discount", "l_returnflag")
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    p = read_table(spark, sf, "part", "p_partkey", "p_name", "p_size")
    c = read_table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    n = read_table(spark, sf, "nation", "n_nationkey", "n_name")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(p, F.col("l_partkey") == F.col("p_partkey"))
           .join(c, F.col("o_custkey") == F.col("c_custkey"))
           .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("C"), F.col("l_orderkey").cast("string")))
         .otherwise(F.col("l_orderkey").cast("string")).alias("invoice"),
        F.when(F.col("p_size") == 1, F.lit(" post ")).when(F.col("p_size") == 2, F.lit("Brand"))
         .otherwise(F.col("l_partkey").cast("string")).alias("stock_code"),
        F.when(F.col("p_size") == 3, F.lit("  ")).otherwise(F.col("p_name")).alias("description"),
        (F.col("l_quantity") - 1).alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(F.col("l_discount") == 0, F.lit(0.0))
         .otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("n_name").alias("country"))


RAW_LINES_SQL = """
raw AS (
  SELECT CASE WHEN l.l_returnflag = 'R' THEN 'C' || CAST(l.l_orderkey AS VARCHAR)
              ELSE CAST(l.l_orderkey AS VARCHAR) END AS invoice,
         CASE WHEN p.p_size = 1 THEN ' post ' WHEN p.p_size = 2 THEN 'Brand'
              ELSE CAST(l.l_partkey AS VARCHAR) END AS stock_code,
         CASE WHEN p.p_size = 3 THEN '  ' ELSE p.p_name END AS description,
         l.l_quantity - 1 AS quantity, o.o_orderdate AS invoice_date,
         CASE WHEN l.l_discount = 0 THEN 0.0 ELSE l.l_extendedprice / l.l_quantity END AS price,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE o.o_custkey END AS customer_id,
         n.n_name AS country
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
norm AS (
  SELECT trim(invoice) AS invoice, trim(stock_code) AS stock_code, trim(description) AS description,
         quantity, invoice_date, price, customer_id, country FROM raw)"""

RULE_CASE_SQL = f"""
  CASE WHEN customer_id IS NULL THEN 'dropped_missing_customer'
       WHEN description IS NULL OR length(trim(description)) = 0 THEN 'dropped_missing_description'
       WHEN coalesce(upper(trim(stock_code)) IN ({NON_PRODUCT_SQL})
                     OR regexp_matches(upper(trim(stock_code)), '^[A-Za-z]+$'), true) THEN 'dropped_non_product'
       WHEN quantity <= 0 OR coalesce(starts_with(invoice, 'C'), false) THEN 'return_rows'
       WHEN price <= 0 THEN 'dropped_nonpositive_price' END"""


def _rules():
    return [
        ("dropped_missing_customer", F.col("customer_id").isNull()),
        ("dropped_missing_description", cl.is_blank("description")),
        ("dropped_non_product", cl.is_non_product("stock_code")),
        ("return_rows", (F.col("quantity") <= 0) | cl.is_cancellation("invoice")),
        ("dropped_nonpositive_price", F.col("price") <= 0),
    ]


def normalized_lines(spark, sf):
    return cl.normalize_text(raw_lines(spark, sf), ["invoice", "stock_code", "description"])


@query("clean_funnel", f"""
WITH {RAW_LINES_SQL},
d AS (SELECT *, count(*) AS m FROM norm GROUP BY ALL),
r AS (SELECT m, coalesce(starts_with(invoice, 'C'), false) AS canc, {RULE_CASE_SQL} AS rule FROM d)
SELECT * FROM (VALUES
  ('raw_rows', (SELECT CAST(sum(m) AS BIGINT) FROM r), 0),
  ('cancellation_rows', (SELECT CAST(sum(CASE WHEN canc THEN m ELSE 0 END) AS BIGINT) FROM r), 1),
  ('dropped_duplicates', (SELECT CAST(sum(m) - count(*) AS BIGINT) FROM r), 2),
  ('dropped_missing_customer', (SELECT CAST(count(*) FILTER (WHERE rule = 'dropped_missing_customer') AS BIGINT) FROM r), 3),
  ('dropped_missing_description', (SELECT CAST(count(*) FILTER (WHERE rule = 'dropped_missing_description') AS BIGINT) FROM r), 4),
  ('dropped_non_product', (SELECT CAST(count(*) FILTER (WHERE rule = 'dropped_non_product') AS BIGINT) FROM r), 5),
  ('return_rows', (SELECT CAST(count(*) FILTER (WHERE rule = 'return_rows') AS BIGINT) FROM r), 6),
  ('dropped_nonpositive_price', (SELECT CAST(count(*) FILTER (WHERE rule = 'dropped_nonpositive_price') AS BIGINT) FROM r), 7),
  ('clean_rows', (SELECT CAST(count(*) FILTER (WHERE rule IS NULL) AS BIGINT) FROM r), 8)
) AS t(step, rows, step_order)""")
def clean_funnel(spark, sf):
    """B1 + B2 + B4 + B5 + B6 + B7 + B8: rows removed by each ordered cleaning rule."""
    return cl.rule_funnel(normalized_lines(spark, sf), _rules(),
                          flags=[("cancellation_rows", cl.is_cancellation("invoice"))])


@query("clean_totals", f"""
WITH {RAW_LINES_SQL},
d AS (SELECT DISTINCT * FROM norm),
c AS (SELECT * FROM d WHERE {RULE_CASE_SQL} IS NULL)
SELECT count(*) AS clean_rows, count(DISTINCT customer_id) AS clean_customers,
       count(DISTINCT stock_code) AS clean_products,
       sum(quantity * price) AS clean_revenue,
       strftime(min(invoice_date), '%Y-%m-%d %H:%M:%S') AS date_min,
       strftime(max(invoice_date), '%Y-%m-%d %H:%M:%S') AS date_max
FROM c""", floats=("clean_revenue",))
def clean_totals(spark, sf):
    """B7 + B8 totals: clean rows, customers, products, revenue (qty*price), date range.

    Revenue is left unrounded: per-line rounding of binary doubles differs between
    engines (pandas/DuckDB round the binary value, Spark the shortest decimal)."""
    kept, _ = cl.rule_split(normalized_lines(spark, sf).dropDuplicates(), _rules())
    return kept.agg(F.count(F.lit(1)).alias("clean_rows"),
                    F.count_distinct("customer_id").alias("clean_customers"),
                    F.count_distinct("stock_code").alias("clean_products"),
                    F.sum(F.col("quantity") * F.col("price")).alias("clean_revenue"),
                    F.date_format(F.min("invoice_date"), "yyyy-MM-dd HH:mm:ss").alias("date_min"),
                    F.date_format(F.max("invoice_date"), "yyyy-MM-dd HH:mm:ss").alias("date_max"))


@query("keyed_dedup_first", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                        l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1""")
def keyed_dedup_first(spark, sf):
    """Keep the first row per (l_orderkey, l_linenumber) in an explicit total order."""
    li = read_table(spark, sf, "lineitem")
    return keep_first(li, ["l_orderkey", "l_linenumber"],
                      ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                       "l_discount", "l_tax", "l_returnflag", "l_linestatus"])


CATEGORY_MAP = {"STANDARD": "Core", "MEDIUM": "Core", "PROMO": "Promotional",
                "LARGE": "Bulk", "SMALL": None}


@query("category_consolidation", """
WITH m(p_type, category) AS (VALUES ('STANDARD', 'Core'), ('MEDIUM', 'Core'),
                                    ('PROMO', 'Promotional'), ('LARGE', 'Bulk'))
SELECT category, count(*) AS parts, avg(p_retailprice) AS avg_price
FROM part JOIN m USING (p_type) GROUP BY category""", floats=("avg_price",))
def category_consolidation(spark, sf):
    """Dictionary consolidation of p_type; unmapped / None-mapped rows dropped."""
    p = read_table(spark, sf, "part", "p_type", "p_retailprice")
    return (cl.map_categories(p, "p_type", CATEGORY_MAP, "category")
              .groupBy("category").agg(F.count(F.lit(1)).alias("parts"),
                                       F.avg("p_retailprice").alias("avg_price")))


@query("group_median_fill", """
WITH c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS acctbal
           FROM customer),
g AS (SELECT c_mktsegment, median(acctbal) AS gm FROM c GROUP BY c_mktsegment)
SELECT c_custkey, coalesce(acctbal, gm, (SELECT median(acctbal) FROM c)) AS acctbal
FROM c LEFT JOIN g USING (c_mktsegment)""", floats=("acctbal",))
def group_median_fill(spark, sf):
    """Derived nulls in c_acctbal filled by the market-segment median."""
    c = read_table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_acctbal")
    c = c.withColumn("acctbal", cl.impossible_to_null("c_acctbal")).drop("c_acctbal")
    return cl.group_median_fill(c, "acctbal", ["c_mktsegment"]).select("c_custkey", "acctbal")


@query("mode_fill", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size <= 5 THEN NULL ELSE p_brand END AS p_brand FROM part),
k AS (SELECT p_brand, count(*) AS n FROM p WHERE p_brand IS NOT NULL GROUP BY p_brand),
m AS (SELECT first(p_brand ORDER BY n DESC, p_brand) AS mb FROM k)
SELECT p_partkey, coalesce(p_brand, (SELECT mb FROM m)) AS p_brand FROM p""")
def mode_fill(spark, sf):
    """Derived nulls in p_brand filled with the mode (smallest on ties)."""
    p = read_table(spark, sf, "part", "p_partkey", "p_brand", "p_size")
    p = p.withColumn("p_brand", F.when(F.col("p_size") > 5, F.col("p_brand"))).drop("p_size")
    return cl.mode_fill(p, ["p_brand"])


@query("winsorized_prices", """
WITH e AS (SELECT quantile_cont(l_extendedprice, 0.005) AS lo, quantile_cont(l_extendedprice, 0.995) AS hi
           FROM lineitem),
w AS (SELECT l_returnflag, least(greatest(l_extendedprice, (SELECT lo FROM e)), (SELECT hi FROM e)) AS v
      FROM lineitem)
SELECT l_returnflag, count(*) AS n, sum(v) AS total, min(v) AS lo, max(v) AS hi
FROM w GROUP BY l_returnflag""", floats=("total", "lo", "hi"))
def winsorized_prices(spark, sf):
    """l_extendedprice clipped to its 0.5 / 99.5 percentiles, summarised per flag."""
    li = read_table(spark, sf, "lineitem", "l_returnflag", "l_extendedprice")
    w = cl.winsorize(li, ["l_extendedprice"])
    return w.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum("l_extendedprice").alias("total"),
                                         F.min("l_extendedprice").alias("lo"),
                                         F.max("l_extendedprice").alias("hi"))


_IQR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("iqr_outliers", " UNION ALL ".join(f"""
SELECT '{c}' AS column, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
       (SELECT count(*) FROM lineitem WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       (SELECT count(*) FROM lineitem WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0
         / (SELECT count(*) FROM lineitem) AS pct
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)""" for c in _IQR_COLS),
       floats=("q1", "q3", "lower", "upper", "pct"))
def iqr_outliers(spark, sf):
    """IQR fences and strict outlier counts for every numeric lineitem measure."""
    return cl.iqr_outliers(read_table(spark, sf, "lineitem", *_IQR_COLS), _IQR_COLS)


@query("missing_values", """
WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS acctbal,
                  nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
SELECT * FROM (
  SELECT 'c_custkey' AS column, CAST(count(*) - count(c_custkey) AS BIGINT) AS missing,
         (count(*) - count(c_custkey)) * 100.0 / count(*) AS missing_pct FROM c
  UNION ALL SELECT 'c_name', CAST(count(*) - count(c_name) AS BIGINT), (count(*) - count(c_name)) * 100.0 / count(*) FROM c
  UNION ALL SELECT 'acctbal', CAST(count(*) - count(acctbal) AS BIGINT), (count(*) - count(acctbal)) * 100.0 / count(*) FROM c
  UNION ALL SELECT 'segment', CAST(count(*) - count(segment) AS BIGINT), (count(*) - count(segment)) * 100.0 / count(*) FROM c)
WHERE missing > 0""", floats=("missing_pct",))
def missing_values(spark, sf):
    """Null count and percent per column (derived nulls), only columns with nulls."""
    c = read_table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    c = c.select("c_custkey", "c_name", cl.impossible_to_null("c_acctbal").alias("acctbal"),
                 F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return cl.missing_table(c)


@query("constant_columns", """
WITH o AS (SELECT o_orderstatus, o_orderpriority, 'tpch' AS source_tag,
                  CAST(NULL AS DOUBLE) AS empty_col,
                  CASE WHEN o_totalprice > 0 THEN 1 END AS positive_flag FROM orders)
SELECT * FROM (
  SELECT 'o_orderstatus' AS column, CAST(count(DISTINCT o_orderstatus) + max(CAST(o_orderstatus IS NULL AS INTEGER)) AS BIGINT) AS n_distinct FROM o
  UNION ALL SELECT 'o_orderpriority', CAST(count(DISTINCT o_orderpriority) + max(CAST(o_orderpriority IS NULL AS INTEGER)) AS BIGINT) FROM o
  UNION ALL SELECT 'source_tag', CAST(count(DISTINCT source_tag) + max(CAST(source_tag IS NULL AS INTEGER)) AS BIGINT) FROM o
  UNION ALL SELECT 'empty_col', CAST(count(DISTINCT empty_col) + max(CAST(empty_col IS NULL AS INTEGER)) AS BIGINT) FROM o
  UNION ALL SELECT 'positive_flag', CAST(count(DISTINCT positive_flag) + max(CAST(positive_flag IS NULL AS INTEGER)) AS BIGINT) FROM o)
  AS t, LATERAL (SELECT n_distinct <= 1 AS is_constant)""")
def constant_columns(spark, sf):
    """Distinct values per column incl. null; <= 1 marks a constant column."""
    o = read_table(spark, sf, "orders", "o_orderstatus", "o_orderpriority", "o_totalprice")
    o = o.select("o_orderstatus", "o_orderpriority", F.lit("tpch").alias("source_tag"),
                 F.lit(None).cast("double").alias("empty_col"),
                 F.when(F.col("o_totalprice") > 0, 1).alias("positive_flag"))
    return cl.column_cardinality(o)


@query("events_quality", """
SELECT * FROM (VALUES
 ('rows', (SELECT CAST(count(*) AS VARCHAR) FROM events)),
 ('ts_min', (SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') FROM events)),
 ('ts_max', (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events)),
 ('duplicate_ts', (SELECT CAST(count(*) - count(DISTINCT ts) AS VARCHAR) FROM events)),
 ('null_cells', (SELECT CAST(sum(CAST(event_id IS NULL AS BIGINT) + CAST(ts IS NULL AS BIGINT)
                    + CAST(user_id IS NULL AS BIGINT) + CAST(event_type IS NULL AS BIGINT)
                    + CAST(v IS NULL AS BIGINT)) AS VARCHAR)
                 FROM (SELECT *, CASE WHEN value < 2 THEN NULL ELSE value END AS v FROM events))),
 ('impossible_shifted', (SELECT CAST(sum(CAST(value - 5 < 0 AS BIGINT)) AS VARCHAR) FROM events)),
 ('columns', '6')) AS t(metric, value)""")
def events_quality(spark, sf):
    """Data-quality report (rows, range, null cells, duplicate stamps, impossible readings)."""
    e = read_table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    e = e.select("event_id", "ts", "user_id", "event_type",
                 F.when(F.col("value") >= 2, F.col("value")).alias("v"),
                 (F.col("value") - 5).alias("shifted"))
    return cl.quality_report(e, "ts", ["shifted"])


@query("dropped_constant_columns", """
SELECT unnest(['o_orderkey', 'o_orderstatus', 'o_totalprice']) AS column,
       unnest([count(o_orderkey), count(o_orderstatus), count(o_totalprice)]) AS non_null FROM orders""")
def dropped_constant_columns(spark, sf):
    """The drop itself: a constant column, an empty one and a configured one go; the columns
    left, with their values counted."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    o = o.withColumn("source_tag", F.lit("tpch")).withColumn("empty_col", F.lit(None).cast("double"))
    left = cl.drop_constant_columns(o, configured=["o_orderpriority"], exclude=["o_orderkey"])
    counts = left.agg(*[F.count(c).alias(c) for c in left.columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null")) for c in left.columns])))


@query("identical_event_columns", """
WITH e AS (SELECT value AS rv1, value AS rv2, value * 1.0000001 AS almost, user_id, CAST(user_id AS DOUBLE) AS user_again,
                  CASE WHEN value > 50 THEN event_type END AS kind, CASE WHEN value > 50 THEN event_type END AS kind_again,
                  CASE WHEN value > 50 THEN event_type ELSE '' END AS kind_filled FROM events),
p(a, b) AS (SELECT unnest(['rv1', 'user_id', 'kind']), unnest(['rv2', 'user_again', 'kind_again']))
SELECT b AS column, a AS same_as FROM p WHERE
  CASE b WHEN 'rv2' THEN (SELECT count(*) = 0 FROM e WHERE rv1 IS DISTINCT FROM rv2)
         WHEN 'user_again' THEN (SELECT count(*) = 0 FROM e WHERE user_id IS DISTINCT FROM user_again)
         ELSE (SELECT count(*) = 0 FROM e WHERE kind IS DISTINCT FROM kind_again) END
UNION ALL SELECT 'almost', 'rv1' WHERE (SELECT count(*) = 0 FROM e WHERE rv1 IS DISTINCT FROM almost)
UNION ALL SELECT 'kind_filled', 'kind' WHERE (SELECT count(*) = 0 FROM e WHERE kind IS DISTINCT FROM kind_filled)""")
def identical_event_columns(spark, sf):
    """Columns that repeat another column, among copies, near copies and columns with nulls."""
    e = read_table(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    kind = F.when(F.col("value") > 50, F.col("event_type"))
    e = e.select("event_id", F.col("value").alias("rv1"), F.col("value").alias("rv2"), (F.col("value") * 1.0000001).alias("almost"), "user_id",
                 F.col("user_id").cast("double").alias("user_again"), kind.alias("kind"), kind.alias("kind_again"),
                 F.coalesce(kind, F.lit("")).alias("kind_filled"))
    return cl.identical_columns(e, ["event_id"])


@query("absence_fill", """
WITH c AS (SELECT nullif(c_mktsegment, 'BUILDING') AS segment,
                  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS acctbal FROM customer)
SELECT coalesce(segment, 'None') AS segment, count(*) AS customers, sum(coalesce(acctbal, 0)) AS acctbal
FROM c GROUP BY 1""", floats=("acctbal",))
def absence_fill(spark, sf):
    """Categoricals -> "None", numerics -> 0, then a grouped summary."""
    c = read_table(spark, sf, "customer", "c_mktsegment", "c_acctbal")
    c = c.select(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
                 cl.impossible_to_null("c_acctbal").alias("acctbal"))
    f = cl.fill_absent(c, categorical=["segment"], numeric=["acctbal"])
    return f.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"), F.sum("acctbal").alias("acctbal"))


@query("lenient_parse", """
WITH e AS (SELECT event_type,
                  TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k,
                  CASE WHEN value > 100 THEN ' Yes ' ELSE 'no' END AS big)
SELECT 1""" if False else """
WITH e AS (SELECT event_type,
                  TRY_CAST(nullif(regexp_extract(props, '"k": *([0-9]+)', 1), '') AS DOUBLE) AS k,
                  CASE WHEN value > 100 THEN ' Yes ' ELSE 'no' END AS big, value FROM events)
SELECT event_type, sum(k) AS k_total, CAST(sum(CASE WHEN lower(trim(big)) IN ('yes', 'true', '1') THEN 1
                                              WHEN lower(trim(big)) IN ('no', 'false', '0') THEN 0 END) AS BIGINT) AS big_events,
       count(*) FILTER (WHERE value - 5 >= 0) AS plausible
FROM e GROUP BY event_type""", floats=("k_total",))
def lenient_parse(spark, sf):
    """B11 + B12 + B14: yes/no flags, lenient numeric parse of a JSON-ish field, impossible -> null."""
    e = read_table(spark, sf, "events", "event_type", "props", "value")
    k = F.nullif(F.regexp_extract("props", r'"k": *([0-9]+)', 1), F.lit(""))
    e = e.select("event_type", k.try_cast("double").alias("k"),
                 F.from_json(F.lit(None).cast("string"), "a int").alias("_x") if False else
                 F.when(F.col("value") > 100, F.lit(" Yes ")).otherwise(F.lit("no")).alias("big"),
                 cl.impossible_to_null(F.col("value") - 5).alias("shifted"))
    from ..functions.rules import yes_no_to_int
    return e.groupBy("event_type").agg(F.sum("k").alias("k_total"),
                                       F.sum(yes_no_to_int("big")).cast("long").alias("big_events"),
                                       F.count("shifted").alias("plausible"))
