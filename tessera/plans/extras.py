"""Remaining inventory items as small queries: export sets, range filters, train-fitted
imputation, scenario arithmetic, shared split tables, unions, disjointness checks."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binning import qcut
from ..operators import cleaning as cl
from ..operators import masks as mk
from ..operators import sampling as sp
from ..sources import files as fs
from ..sources.tables import read_table
from .commerce import HOURS_SQL, all_active_hours
from .common import SALES_SQL, sales
from ..operators.quantiles import exact_median
from ..session import materialize
from .registry import query
from .sampling import VEC_ORDER_SQL, vec_order


@query("star_export_counts", f"""
WITH {SALES_SQL}
SELECT 'fact_sales' AS table_name, count(*) AS rows FROM sales
UNION ALL SELECT 'dim_customer', count(DISTINCT customer_id) FROM sales
UNION ALL SELECT 'dim_product', count(DISTINCT product) FROM sales
UNION ALL SELECT 'dim_date', CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1 AS BIGINT) FROM sales""")
def star_export_counts(spark, sf):
    """A13 + A2: star-schema tables exported as one header CSV folder each, read back with
    an inferred schema, row counts per table."""
    s = sales(spark, sf)
    tables = {"fact_sales": s,
              "dim_customer": s.groupBy("customer_id").agg(F.first("country").alias("country")),
              "dim_product": s.groupBy("product").agg(F.sum("quantity").alias("units")),
              "dim_date": s.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
                           .select(F.explode(F.sequence("lo", "hi")).alias("date"))}
    paths = fs.export_csv_set(tables, fs.scratch_path(spark, "star"))
    parts = [fs.read_inferred_csv(spark, p).agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(n))
             for n, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("text_range_filter", r"""
SELECT lang, count(*) AS kept FROM documents
WHERE text IS NOT NULL AND length(trim(text)) > 0 AND length(text) BETWEEN 30 AND 3000 AND NOT contains(text, '�')
  AND lang IN ('en', 'fr') GROUP BY lang""")
def text_range_filter(spark, sf):
    """B4 + B13 + B29: non-blank texts with length in [30, 3000] and no replacement
    character, restricted to a chosen category list."""
    d = read_table(spark, sf, "documents", "lang", "text")
    keep = (~cl.is_blank("text") & F.length("text").between(30, 3000) & ~F.col("text").contains("�")
            & F.col("lang").isin("en", "fr"))
    return d.filter(keep).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))


@query("train_fitted_imputer", """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS acctbal,
                  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment,
                  CASE WHEN c_custkey % 3 = 0 THEN 'test' ELSE 'train' END AS split FROM customer
           WHERE NOT (c_acctbal > 9900 AND c_mktsegment = 'AUTOMOBILE')),
m AS (SELECT median(acctbal) AS med FROM c WHERE split = 'train'),
k AS (SELECT segment, count(*) AS n FROM c WHERE split = 'train' AND segment IS NOT NULL GROUP BY segment),
md AS (SELECT first(segment ORDER BY n DESC, segment) AS mode FROM k)
SELECT split, coalesce(segment, (SELECT mode FROM md)) AS segment, count(*) AS n,
       sum(coalesce(acctbal, (SELECT med FROM m))) AS acctbal FROM c GROUP BY ALL""", floats=("acctbal",))
def train_fitted_imputer(spark, sf):
    """B17 + B23 + B24: rule-based outlier rows removed, median / most-frequent imputer
    fitted on the train rows only and applied to every split."""
    c = read_table(spark, sf, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    c = c.filter(~((F.col("c_acctbal") > 9900) & (F.col("c_mktsegment") == "AUTOMOBILE")))
    c = c.select("c_custkey", cl.impossible_to_null("c_acctbal").alias("acctbal"),
                 F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("segment"),
                 F.when(F.col("c_custkey") % 3 == 0, "test").otherwise("train").alias("split"))
    imp = cl.Imputer(numeric=["acctbal"], categorical=["segment"]).fit(c.filter(F.col("split") == "train"))
    out = imp.transform(c).na.drop("any")
    return out.groupBy("split", "segment").agg(F.count(F.lit(1)).alias("n"), F.sum("acctbal").alias("acctbal"))


@query("retention_scenarios", """
WITH s(scenario, detection, retained, cost) AS (VALUES ('conservative', 0.5, 0.2, 400.0), ('base', 0.7, 0.3, 400.0),
                                                      ('optimistic', 0.85, 0.4, 400.0)),
l AS (SELECT count(*) AS leavers, avg(o_totalprice) AS value FROM orders WHERE o_orderstatus = 'F')
SELECT scenario, leavers * detection * retained AS saved_customers,
       leavers * detection * retained * value - leavers * detection * cost AS net_value FROM s, l""",
       floats=("saved_customers", "net_value"))
def retention_scenarios(spark, sf):
    """Scenario ROI arithmetic (leavers x detection x retained x value - cost) as a
    projection over a scenario table; leavers and value come from the orders table."""
    o = read_table(spark, sf, "orders", "o_orderstatus", "o_totalprice")
    base = o.filter(F.col("o_orderstatus") == "F").agg(F.count(F.lit(1)).alias("leavers"), F.avg("o_totalprice").alias("value"))
    sc = spark.createDataFrame([("conservative", 0.5, 0.2, 400.0), ("base", 0.7, 0.3, 400.0), ("optimistic", 0.85, 0.4, 400.0)],
                               "scenario string, detection double, retained double, cost double")
    lv, val = base.select("leavers").scalar(), base.select("value").scalar()
    return sc.select("scenario", (lv * F.col("detection") * F.col("retained")).alias("saved_customers"),
                     (lv * F.col("detection") * F.col("retained") * val - lv * F.col("detection") * F.col("cost")).alias("net_value"))


@query("shared_split_join", f"""
WITH s AS (SELECT vec_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {VEC_ORDER_SQL}, vec_id)
                                   <= round(count(*) OVER (PARTITION BY label) * 0.2) THEN 'test' ELSE 'train' END AS split
           FROM embeddings),
a AS (SELECT vec_id, embedding[1] AS f1 FROM embeddings), b AS (SELECT vec_id, embedding[2] AS f2 FROM embeddings)
SELECT split, count(*) AS n, sum(CAST(f1 AS DOUBLE)) AS f1_sum, sum(CAST(f2 AS DOUBLE)) AS f2_sum
FROM s JOIN a USING (vec_id) JOIN b USING (vec_id) GROUP BY split""", floats=("f1_sum", "f2_sum"))
def shared_split_join(spark, sf):
    """D7 + D8: one persisted (row id, split) table joined by id to two separately built
    feature tables, so every model sees the same rows in the same split."""
    e = read_table(spark, sf, "embeddings", "vec_id", "label", "embedding")
    split = sp.stratified_split(e.select("vec_id", "label"), "label", ["vec_id"], 0.2, order=vec_order())
    path = fs.write_parquet(split, fs.scratch_path(spark, "split-table"))
    s = spark.read.parquet(path)
    a = e.select("vec_id", F.element_at("embedding", 1).cast("double").alias("f1"))
    b = e.select("vec_id", F.element_at("embedding", 2).cast("double").alias("f2"))
    return s.join(a, "vec_id").join(b, "vec_id").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("f1").alias("f1_sum"), F.sum("f2").alias("f2_sum"))


@query("mask_area_by_class", f"""
WITH {HOURS_SQL},
a AS (SELECT event_type, user_id, count(*) AS area FROM hrs GROUP BY ALL),
e AS (SELECT quantile_cont(area, [0.0, 1/3, 2/3, 1.0]) AS q FROM a),
t AS (SELECT a.*, CAST(1 + CAST(area > (SELECT q FROM e)[2] AS INTEGER) + CAST(area > (SELECT q FROM e)[3] AS INTEGER) AS INTEGER) AS tertile FROM a)
SELECT event_type, tertile, count(*) AS masks, avg(area) AS mean_area, median(area) AS median_area,
       CAST(sum(area) AS BIGINT) AS total_area FROM t GROUP BY ALL""", floats=("mean_area", "median_area"))
def mask_area_by_class(spark, sf):
    """E21 (+ C12): per class (event type) mask areas (active hours per user) with mean,
    median, sum, count, split by global size tertile."""
    u = all_active_hours(spark, sf)  # every event type, one grouped pass
    a = u.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("area"))
    t = materialize(qcut(a, "area", 3, "tertile", labels=[1, 2, 3]).withColumn("tertile", F.col("tertile").cast("int")))
    med = exact_median(t, "area", ["event_type", "tertile"], "median_area")
    return t.groupBy("event_type", "tertile").agg(
        F.count(F.lit(1)).alias("masks"), F.avg("area").alias("mean_area"), F.sum("area").alias("total_area")
    ).join(med, ["event_type", "tertile"]).select("event_type", "tertile", "masks", "mean_area", "median_area", "total_area")


@query("union_sources", """
SELECT source, count(*) AS n, count(title) AS with_title FROM (
  SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS id, text, NULL AS title FROM documents
  UNION ALL SELECT 'benchmark', CAST(item_id AS VARCHAR), text, NULL FROM benchmark
  UNION ALL SELECT 'conversations', CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text, role FROM conversations)
GROUP BY source""")
def union_sources(spark, sf):
    """H1: union by column name of three text sources with different columns
    (missing columns null) plus a source column."""
    d = read_table(spark, sf, "documents", "doc_id", "text").select(F.col("doc_id").cast("string").alias("id"), "text") \
        .withColumn("source", F.lit("documents"))
    b = read_table(spark, sf, "benchmark", "item_id", "text").select(F.col("item_id").cast("string").alias("id"), "text") \
        .withColumn("source", F.lit("benchmark"))
    c = read_table(spark, sf, "conversations", "conv_id", "turn", "role", "text").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text",
        F.col("role").alias("title")).withColumn("source", F.lit("conversations"))
    u = d.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("title").alias("with_title"))


@query("split_disjointness", """
WITH g AS (SELECT lang, source, count(*) AS size, (CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) * 7919) % 1000003 AS o
           FROM documents GROUP BY lang, source),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY lang ORDER BY o, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(size) OVER (PARTITION BY lang) AS tot FROM g),
s AS (SELECT lang, source, CASE WHEN before < tot * 0.2 THEN 'test' ELSE 'train' END AS split FROM c)
SELECT (SELECT count(*) FROM (SELECT lang, source FROM s WHERE split = 'train'
                              INTERSECT SELECT lang, source FROM s WHERE split = 'test')) AS shared_groups,
       (SELECT count(*) FROM s WHERE split = 'test') AS test_groups""")
def split_disjointness(spark, sf):
    """H3: no (class, group) appears in two splits (intersect must be empty)."""
    d = read_table(spark, sf, "documents", "lang", "source")
    order = (F.regexp_extract("source", "([0-9]+)", 1).cast("long") * 7919) % 1000003
    s = sp.group_split(d, "lang", "source", 0.2, order=order).select("lang", "source", "split").distinct()
    tr = s.filter(F.col("split") == "train").select("lang", "source")
    te = s.filter(F.col("split") == "test").select("lang", "source")
    return spark.range(1).select(F.lit(tr.intersect(te).count()).cast("long").alias("shared_groups"),
                                 F.lit(te.count()).cast("long").alias("test_groups"))


@query("inferred_csv_scan", """
SELECT count(*) AS n, CAST(sum(p_size) AS BIGINT) AS total_size, count(DISTINCT p_type) AS types FROM part""")
def inferred_csv_scan(spark, sf):
    """A2 + A3 + A4: parts exported with a leading unnamed index column, read back with
    an inferred schema (index dropped) and as an all-string, column-pruned scan."""
    p = read_table(spark, sf, "part", "p_partkey", "p_type", "p_size")
    path = fs.scratch_path(spark, "parts-csv")
    p.select(F.col("p_partkey").alias("_c0"), "p_type", "p_size").write.option("header", True).csv(path)
    inferred = fs.read_inferred_csv(spark, path, drop_index=True)
    strings = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in ["_c0", "p_type", "p_size"]])) \
                   .option("header", True).csv(path).select("p_type")
    n_types = strings.select(F.count_distinct("p_type")).scalar()
    return inferred.agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").cast("long").alias("total_size")) \
                   .withColumn("types", n_types)


@query("one_hot_alignment", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN o_orderpriority || '-X' ELSE o_orderpriority END AS cat,
                  CASE WHEN o_orderkey % 4 = 0 THEN 'test' ELSE 'train' END AS split FROM orders),
v AS (SELECT cat, CAST(row_number() OVER (ORDER BY cat) - 1 AS INTEGER) AS slot FROM (SELECT DISTINCT cat FROM o WHERE split = 'train')),
t AS (SELECT coalesce(v.slot, (SELECT count(*) FROM v)) AS slot FROM o LEFT JOIN v USING (cat) WHERE split = 'test')
SELECT CAST(slot AS INTEGER) AS slot, count(*) AS n FROM t GROUP BY slot""")
def one_hot_alignment(spark, sf):
    """H2 + J1: one-hot encoder fitted on the train rows only (alphabetical slots);
    test rows are aligned to the train columns, unseen categories fall into the extra
    "keep" slot; count of test rows per active slot."""
    from pyspark.ml.functions import vector_to_array
    from ..operators.ml import column_transformer
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    o = o.select("o_orderkey", "o_totalprice",
                 F.when(F.col("o_orderkey") % 8 == 0, F.concat("o_orderpriority", F.lit("-X")))
                  .otherwise(F.col("o_orderpriority")).alias("cat"),
                 F.when(F.col("o_orderkey") % 4 == 0, "test").otherwise("train").alias("split"))
    model = column_transformer(["cat"], ["o_totalprice"], scale=None).fit(o.filter(F.col("split") == "train"))
    t = model.transform(o.filter(F.col("split") == "test"))
    e = t.select(F.posexplode(vector_to_array("cat__ohe")).alias("slot", "v")).filter(F.col("v") == 1.0)
    return e.groupBy(F.col("slot").cast("int").alias("slot")).agg(F.count(F.lit(1)).alias("n"))


@query("tab_line_parse", r"""
SELECT role AS label, count(*) AS n, CAST(sum(length(regexp_replace(text, '[\r\n\t]', ' ', 'g'))) AS BIGINT) AS chars
FROM conversations GROUP BY role""")
def tab_line_parse(spark, sf):
    """Conversation turns written as "label<TAB>text" lines together with tab-less
    lines (benchmark passages, which must be skipped), read back and parsed."""
    c = read_table(spark, sf, "conversations", "role", "text")
    b = read_table(spark, sf, "benchmark", "text")
    clean = lambda col: F.regexp_replace(col, r"[\r\n\t]", " ")
    lines = c.select(F.concat("role", F.lit("\t"), clean(F.col("text"))).alias("value")) \
             .unionByName(b.select(clean(F.col("text")).alias("value")))
    path = fs.scratch_path(spark, "tab-lines")
    lines.write.text(path)
    p = fs.parse_tab_lines(spark.read.text(path))
    return p.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).cast("long").alias("chars"))
