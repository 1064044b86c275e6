"""Joins, recommenders, baskets, duplicate checks and run-length masks over the
driver tables (D, J11-J17, M, L13)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import decision_from_severity, severity_from_area
from ..operators import joins as jn
from ..operators import masks as mk
from ..operators import recommend as rc
from ..sources.tables import read_table
from .registry import query

FLAGS = ["A", "N", "R"]


def inventory(spark, sf):
    o = read_table(spark, sf, "orders", "o_orderkey")
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_returnflag").withColumnRenamed("l_orderkey", "o_orderkey")
    return jn.class_inventory(o, li, "o_orderkey", "l_returnflag", FLAGS)


INV_SQL = """inv AS (
  SELECT o.o_orderkey, coalesce(list_sort(list(DISTINCT l.l_returnflag) FILTER (WHERE l.l_returnflag IS NOT NULL)), []) AS classes
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey),
inv2 AS (SELECT o_orderkey, array_to_string(classes, ',') AS classes,
  CAST(list_contains(classes, 'A') AS INTEGER) AS c_A, CAST(list_contains(classes, 'N') AS INTEGER) AS c_N,
  CAST(list_contains(classes, 'R') AS INTEGER) AS c_R, coalesce(classes[1], '0') AS label FROM inv)"""


@query("order_flag_inventory", f"WITH {INV_SQL} SELECT * FROM inv2")
def order_flag_inventory(spark, sf):
    """Every order with its sorted return-flag classes, one-hot columns and first class."""
    return inventory(spark, sf).withColumn("classes", F.array_join("classes", ","))


@query("flag_cooccurrence", f"""
WITH {INV_SQL}
SELECT a, b, CAST(n AS BIGINT) AS n FROM (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, sum(c_{a} * c_{b}) AS n FROM inv2" for a in FLAGS for b in FLAGS) + ")")
def flag_cooccurrence(spark, sf):
    """Class x class co-occurrence from one-hot sums (no pair rows)."""
    return jn.cooccurrence(inventory(spark, sf), FLAGS)


@query("top_brand_lines", """
WITH j AS (SELECT p.p_brand, l.l_orderkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
top AS (SELECT p_brand FROM j GROUP BY p_brand ORDER BY count(DISTINCT l_orderkey) DESC, p_brand LIMIT 5)
SELECT p_brand, count(*) AS lines FROM j WHERE p_brand IN (SELECT p_brand FROM top) GROUP BY p_brand""")
def top_brand_lines(spark, sf):
    """D5 + G1: semi join of lines to the 5 brands with most distinct orders."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    p = read_table(spark, sf, "part", "p_partkey", "p_brand")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "l_orderkey")
    top = (j.groupBy("p_brand").agg(F.count_distinct("l_orderkey").alias("_n"))
            .orderBy(F.desc("_n"), "p_brand").limit(5))
    return jn.semi(j, top, ["p_brand"]).groupBy("p_brand").agg(F.count(F.lit(1)).alias("lines"))


@query("parts_never_returned", """
SELECT p_partkey, p_type FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)""")
def parts_never_returned(spark, sf):
    """Anti join of the part catalogue with large returned lines (quantity > 45)."""
    p = read_table(spark, sf, "part", "p_partkey", "p_type")
    r = read_table(spark, sf, "lineitem", "l_partkey", "l_returnflag", "l_quantity") \
        .filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)) \
        .select(F.col("l_partkey").alias("p_partkey"))
    return jn.anti(p, r, ["p_partkey"])


PRIORITY_WEIGHT = {"1-URGENT": 3.0, "2-HIGH": 2.0, "3-MEDIUM": 1.0}


@query("priority_weighted_value", """
WITH m(o_orderpriority, weight) AS (VALUES ('1-URGENT', 3.0), ('2-HIGH', 2.0), ('3-MEDIUM', 1.0))
SELECT o_orderstatus, sum(o_totalprice * coalesce(weight, 0.5)) AS weighted_value, count(*) AS n
FROM orders LEFT JOIN m USING (o_orderpriority) GROUP BY o_orderstatus""", floats=("weighted_value",))
def priority_weighted_value(spark, sf):
    """Dictionary lookup with a default (0.5) for unmapped keys."""
    o = read_table(spark, sf, "orders", "o_orderstatus", "o_orderpriority", "o_totalprice")
    j = jn.lookup(o, "o_orderpriority", PRIORITY_WEIGHT, "weight", 0.5, "double")
    return j.groupBy("o_orderstatus").agg(F.sum(F.col("o_totalprice") * F.col("weight")).alias("weighted_value"),
                                          F.count(F.lit(1)).alias("n"))


AHASH_SQL = """ah AS (
  SELECT vec_id, CAST(CASE WHEN hh >= 9223372036854775808 THEN hh - 18446744073709551616 ELSE hh END AS BIGINT) AS h
  FROM (SELECT vec_id, (""" + " + ".join(
    f"CAST(CAST(embedding[{i + 1}] AS DOUBLE) > m AS HUGEINT) * CAST({1 << (63 - i)} AS HUGEINT)" for i in range(64)) + """) AS hh
        FROM (SELECT vec_id, embedding, (""" + " + ".join(f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(64)) + """) / 64 AS m
              FROM embeddings)))"""


@query("near_duplicate_vectors", f"""
WITH {AHASH_SQL},
d AS (SELECT h, count(*) AS n FROM ah GROUP BY h)
SELECT a.h AS hash_a, b.h AS hash_b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance, a.n AS n_a, b.n AS n_b
FROM d a JOIN d b ON a.h < b.h AND bit_count(xor(a.h, b.h)) <= 5
UNION ALL SELECT h, h, 0, n, n FROM d WHERE n > 1""")
def near_duplicate_vectors(spark, sf):
    """M5 + D10: 64-bit average hashes of the embeddings and all hash pairs within
    Hamming distance 5 (pigeonhole banding, exact), plus exact copies."""
    e = read_table(spark, sf, "embeddings", "vec_id", "embedding")
    h = e.select("vec_id", jn.average_hash("embedding").alias("h"))
    return jn.hamming_pairs(h, "vec_id", "h", 5)


UI_SQL = """ui AS (SELECT DISTINCT o.o_custkey AS "user", l.l_partkey AS item
                   FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def ui_table(spark, sf):
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey")
    return rc.user_items(li.join(o, F.col("l_orderkey") == F.col("o_orderkey")), "o_custkey", "l_partkey")


def _reco_sql(ui: str, owned: str, k: int, n: int) -> str:
    return f"""
sz AS (SELECT "user", count(*) AS size FROM {ui} GROUP BY "user"),
ov AS (SELECT a."user" AS u, b."user" AS v, count(*) AS inter FROM {ui} a JOIN {ui} b ON a.item = b.item AND a."user" <> b."user"
       GROUP BY ALL),
sim AS (SELECT u, v, inter / sqrt(sa.size * sb.size) AS sim FROM ov JOIN sz sa ON sa."user" = u JOIN sz sb ON sb."user" = v),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS nrank FROM sim) WHERE nrank <= {k}),
cand AS (SELECT nb.u AS "user", i.item, round(sum(nb.sim), 9) AS score FROM nb JOIN {ui} i ON i."user" = nb.v GROUP BY ALL),
c2 AS (SELECT * FROM cand WHERE score > 0 AND NOT EXISTS (SELECT 1 FROM {owned} o WHERE o."user" = cand."user" AND o.item = cand.item)),
rec AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS INTEGER) AS rank FROM c2) WHERE rank <= {n})"""


@query("user_knn_recommendations", f"""
WITH {UI_SQL}, {_reco_sql('ui', 'ui', 10, 5)}
SELECT "user", item, score, rank FROM rec""", floats=("score",))
def user_knn_recommendations(spark, sf):
    """J11 + J12 + J14: user-based cosine kNN (k=10) recommendations, top 5 per customer."""
    return rc.recommend(ui_table(spark, sf), k=10, n=5).select("user", "item", "score", "rank")


@query("item_also_bought", f"""
WITH {UI_SQL},
isz AS (SELECT item, count(*) AS size FROM ui GROUP BY item),
pop AS (SELECT item FROM isz ORDER BY size DESC, item LIMIT 10),
co AS (SELECT q.item AS q, o.item, count(*) AS inter FROM ui q JOIN ui o ON q."user" = o."user" AND o.item <> q.item
       WHERE q.item IN (SELECT item FROM pop) GROUP BY ALL),
s AS (SELECT q, co.item, inter / sqrt(a.size * b.size) AS sim FROM co JOIN isz a ON a.item = q JOIN isz b ON b.item = co.item)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY sim DESC, item) AS INTEGER) AS rank FROM s) WHERE rank <= 5""",
       floats=("sim",))
def item_also_bought(spark, sf):
    """Cosine item-item neighbours (top 5) of the 10 most popular parts."""
    ui = ui_table(spark, sf)
    pop = ui.groupBy("item").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "item").limit(10)
    return rc.item_neighbours(ui, pop, 5)


HOLD_ORDER = "((\"user\" * 7919 + item * 104729) % 1000003)"


@query("recommender_holdout_metrics", f"""
WITH {UI_SQL},
h AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY {HOLD_ORDER}, item) AS p, count(*) OVER (PARTITION BY "user") AS n FROM ui),
sp AS (SELECT "user", item, n >= 5 AS eligible, n >= 5 AND p <= greatest(1, floor(n * 0.2)) AS hidden FROM h),
vis AS (SELECT "user", item FROM sp WHERE NOT hidden),
hid AS (SELECT "user", item FROM sp WHERE hidden),
nh AS (SELECT "user", count(*) AS n_hidden FROM hid GROUP BY "user"),
{_reco_sql('vis', 'vis', 10, 10)},
r AS (SELECT rec."user", rec.rank, CASE WHEN hid.item IS NULL THEN 0 ELSE 1 END AS hit
      FROM rec JOIN nh USING ("user") LEFT JOIN hid ON hid."user" = rec."user" AND hid.item = rec.item),
r2 AS (SELECT *, sum(hit) OVER (PARTITION BY "user" ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum FROM r),
per AS (SELECT "user", sum(hit) AS hits, sum(CASE WHEN hit = 1 THEN cum / rank ELSE 0.0 END) AS ap FROM r2 GROUP BY "user"),
pu AS (SELECT nh."user", n_hidden, coalesce(hits, 0) AS hits, coalesce(ap, 0.0) AS ap FROM nh LEFT JOIN per USING ("user"))
SELECT count(*) AS users, avg(hits / 10) AS precision_at_n, avg(hits / n_hidden) AS recall_at_n,
       avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END) AS hit_rate, avg(ap / least(n_hidden, 10)) AS map_at_n FROM pu""",
       floats=("precision_at_n", "recall_at_n", "hit_rate", "map_at_n"))
def recommender_holdout_metrics(spark, sf):
    """Leave-20 %-out evaluation over every customer with >= 5 parts:
    precision@10, recall@10, hit rate, MAP@10 (k=10 cosine)."""
    ui = ui_table(spark, sf)
    order = (F.col("user") * 7919 + F.col("item") * 104729) % 1000003
    sp = rc.holdout_split(ui, 5, 0.2, order=order)
    return rc.evaluate_recommendations(sp, 10, 10)


def _grid_sql(metrics, ks, n: int) -> str:
    """Neighbours of visible sets among all whole sets, every k and metric, by brute force."""
    sim = {"cosine": "inter / sqrt(na * nb)", "euclidean": "1 / (1 + sqrt(na + nb - 2 * inter))", "manhattan": "1 / (1.0 + (na + nb - 2 * inter))"}
    def one(m: str) -> str:
        partners = "inter > 0" if m == "cosine" else "true"
        return f"""SELECT '{m}' AS metric, u, v, {sim[m]} AS sim, row_number() OVER (PARTITION BY u ORDER BY {sim[m]} DESC, v) AS nrank
  FROM pairs WHERE {partners}"""
    return f"""
h AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY {HOLD_ORDER}, item) AS p, count(*) OVER (PARTITION BY "user") AS n FROM ui),
sp AS (SELECT "user", item, n >= 5 AS eligible, n >= 5 AND p <= greatest(1, floor(n * 0.2)) AS hidden FROM h),
ask AS (SELECT "user", item FROM sp WHERE eligible AND NOT hidden),
hid AS (SELECT "user", item FROM sp WHERE hidden),
nh AS (SELECT "user", count(*) AS n_hidden FROM hid GROUP BY "user"),
sa AS (SELECT "user" AS u, count(*) AS na FROM ask GROUP BY 1), sb AS (SELECT "user" AS v, count(*) AS nb FROM ui GROUP BY 1),
ov AS (SELECT a."user" AS u, b."user" AS v, count(*) AS inter FROM ask a JOIN ui b ON a.item = b.item AND a."user" <> b."user" GROUP BY ALL),
pairs AS (SELECT u, v, na, nb, coalesce(inter, 0) AS inter FROM sa JOIN sb ON u <> v LEFT JOIN ov USING (u, v)),
nb AS (SELECT * FROM ({" UNION ALL ".join(map(one, metrics))}) WHERE nrank <= {max(ks)}),
ks AS (SELECT unnest({list(ks)})::INTEGER AS k),
cand AS (SELECT metric, k, u AS "user", i.item, round(sum(sim), 9) AS score FROM nb JOIN ks ON nrank <= k JOIN ui i ON i."user" = v GROUP BY ALL),
c2 AS (SELECT * FROM cand ANTI JOIN ask USING ("user", item) WHERE score > 0),
rec AS (SELECT *, row_number() OVER (PARTITION BY metric, k, "user" ORDER BY score DESC, item) AS rank FROM c2 QUALIFY rank <= {n}),
hit AS (SELECT metric, k, "user", rank, row_number() OVER (PARTITION BY metric, k, "user" ORDER BY rank) AS nth FROM rec SEMI JOIN hid USING ("user", item)),
per AS (SELECT metric, k, "user", count(*) AS hits, sum(nth / rank) AS ap FROM hit GROUP BY ALL),
every AS (SELECT metric, k, nh."user", n_hidden, coalesce(hits, 0) AS hits, coalesce(ap, 0.0) AS ap
          FROM (SELECT unnest({list(metrics)}) AS metric) CROSS JOIN ks CROSS JOIN nh LEFT JOIN per USING (metric, k, "user"))
SELECT metric, k, count(*) AS users, avg(hits / {n}) AS precision_at_n, avg(hits / n_hidden) AS recall_at_n,
       avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END) AS hit_rate, avg(ap / least(n_hidden, {n})) AS map_at_n FROM every GROUP BY ALL"""


GRID_METRICS, GRID_KS = ("cosine", "euclidean", "manhattan"), (3, 5, 7, 9, 11, 15)


@query("recommender_tuning_grid", f"""
WITH {UI_SQL}, {_grid_sql(GRID_METRICS, GRID_KS, 10)}""", floats=("precision_at_n", "recall_at_n", "hit_rate", "map_at_n"))
def recommender_tuning_grid(spark, sf):
    """Three metrics x six numbers of neighbours, evaluated on hidden parts of every customer
    with five or more; visible parts search the whole sets of all other customers."""
    ui = ui_table(spark, sf)
    order = (F.col("user") * 7919 + F.col("item") * 104729) % 1000003
    return rc.evaluate_grid(rc.holdout_split(ui, 5, 0.2, order=order), GRID_METRICS, GRID_KS, 10)


@query("described_recommendations", f"""
WITH {UI_SQL}, {_reco_sql('ui', 'ui', 11, 10)}
SELECT "user", rank, item, coalesce(p_name, '') AS description FROM rec LEFT JOIN part ON p_partkey = item""")
def described_recommendations(spark, sf):
    """Ten recommendations for every customer: rank, part and its description."""
    rec = rc.recommend(ui_table(spark, sf), k=11, n=10)
    parts = read_table(spark, sf, "part", "p_partkey", "p_name")
    return rc.describe(rec, parts, "p_partkey", "p_name").select("user", "rank", "item", "description")


def _baskets_sql(item: str, top: int | None, market: str = "") -> str:
    limit = f"AND item IN (SELECT item FROM q GROUP BY item ORDER BY count(*) DESC, item LIMIT {top})" if top else ""
    return f"""
q AS (SELECT l.l_orderkey, {item} AS item, sum(l.l_quantity) AS qt FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
      {market} GROUP BY ALL HAVING sum(l.l_quantity) > 0),
bk AS (SELECT l_orderkey, list_sort(list(item)) AS items FROM q WHERE true {limit}
       GROUP BY l_orderkey HAVING count(*) >= 2)"""


BASKET_SQL = _baskets_sql("p.p_brand", 300)


def baskets_df(spark, sf, item: str, top_items: int | None, orders=None):
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    p = read_table(spark, sf, "part", "p_partkey", item)
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    if orders is not None:
        j = j.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return rc.baskets(j, "l_orderkey", item, "l_quantity", top_items=top_items)


def brand_baskets_df(spark, sf):
    return baskets_df(spark, sf, "p_brand", 300)


@query("brand_baskets", f"""
WITH {BASKET_SQL}
SELECT l_orderkey, array_to_string(items, ',') AS items, CAST(len(items) AS INTEGER) AS n_items FROM bk""")
def brand_baskets(spark, sf):
    """Brand baskets per order (top-300 items, positive quantity, >= 2 brands)."""
    b = brand_baskets_df(spark, sf)
    return b.select("l_orderkey", F.array_join("items", ",").alias("items"), F.size("items").alias("n_items"))


MARKET_SQL = _baskets_sql("CAST(p.p_partkey AS VARCHAR)", 300, """JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey AND r.r_name = 'EUROPE'""")


@query("market_product_baskets", f"""
WITH {MARKET_SQL}
SELECT l_orderkey, array_to_string(items, ',') AS items, CAST(len(items) AS INTEGER) AS n_items FROM bk""")
def market_product_baskets(spark, sf):
    """Product baskets of one market (region EUROPE), its 300 most frequent products."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_custkey")
    c = read_table(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    r = read_table(spark, sf, "region", "r_regionkey", "r_name").where("r_name = 'EUROPE'")
    nations = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey")  # 25 nations
    orders = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
              .join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("o_orderkey"))
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    p = read_table(spark, sf, "part", "p_partkey")
    j = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
         .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
         .withColumn("item", F.col("l_partkey").cast("string")))
    b = rc.baskets(j, "l_orderkey", "item", "l_quantity", top_items=300)
    return b.select("l_orderkey", F.array_join("items", ",").alias("items"), F.size("items").alias("n_items"))


# Every non-empty subset of every basket, by bit mask (a basket has a few lines): the definition
# of support, without a bound on the itemset's size.  Sizes of parts are banded into five items
# so that itemsets of all sizes are frequent.
SIZE_BASKETS = _baskets_sql("'size ' || CAST(p.p_size // 10 AS VARCHAR)", None)
ITEMSETS_SQL = SIZE_BASKETS + """,
nb AS (SELECT count(*) AS n FROM bk),
masks AS (SELECT items, unnest(range(1, (1 << len(items)))) AS m FROM bk),
subs AS (SELECT [items[i] for i in range(1, len(items) + 1) if (m >> (i - 1)) & 1 = 1] AS s FROM masks),
fi AS (SELECT s, count(*) AS f FROM subs GROUP BY s HAVING count(*) >= 0.02 * (SELECT n FROM nb))"""


def size_baskets_df(spark, sf):
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    p = read_table(spark, sf, "part", "p_partkey", "p_size")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "item", F.concat(F.lit("size "), F.floor(F.col("p_size") / 10).cast("string")))
    return rc.baskets(j, "l_orderkey", "item", "l_quantity")


@query("frequent_itemsets", f"""
WITH {ITEMSETS_SQL}
SELECT array_to_string(s, ', ') AS itemset, CAST(len(s) AS INTEGER) AS size, f / (SELECT n FROM nb) AS support FROM fi""",
       floats=("support",))
def frequent_itemsets(spark, sf):
    """Frequent itemsets (FP-growth, support >= 0.02) of any size."""
    return rc.frequent_itemsets(size_baskets_df(spark, sf), 0.02)


@query("association_rules", f"""
WITH {ITEMSETS_SQL},
sp AS (SELECT s, f, unnest(range(1, (1 << len(s)) - 1)) AS m FROM fi WHERE len(s) >= 2),
r AS (SELECT f, [s[i] for i in range(1, len(s) + 1) if (m >> (i - 1)) & 1 = 1] AS ante,
             [s[i] for i in range(1, len(s) + 1) if (m >> (i - 1)) & 1 = 0] AS cons FROM sp)
SELECT array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents,
       r.f / (SELECT n FROM nb) AS support, r.f / a.f AS confidence, (r.f / a.f) / (c.f / (SELECT n FROM nb)) AS lift
FROM r JOIN fi a ON a.s = r.ante JOIN fi c ON c.s = r.cons""", floats=("support", "confidence", "lift"))
def association_rules(spark, sf):
    """All association rules (antecedents and consequents of any size), any lift."""
    return rc.association_rules(size_baskets_df(spark, sf), 0.02, 0.0)


@query("duplicate_documents", """
WITH h AS (SELECT doc_id, sha256(text) AS hash FROM documents),
k AS (SELECT hash, min(doc_id) AS kept FROM h GROUP BY hash)
SELECT doc_id, kept FROM h JOIN k USING (hash) WHERE doc_id <> kept""")
def duplicate_documents(spark, sf):
    """M1: exact copies by content hash, each with the kept (first) document."""
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return mk.exact_duplicates(d, "doc_id", "text").select("doc_id", "kept")


SPLIT_SQL = "CASE WHEN doc_id % 5 IN (0, 1, 2) THEN 'train' WHEN doc_id % 5 = 3 THEN 'val' ELSE 'test' END"


def doc_splits(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text", "n_chars")
    m = F.col("doc_id") % 5
    return d.select("doc_id", "text", "n_chars", F.md5("text").alias("hash"),
                    F.when(m.isin(0, 1, 2), "train").when(m == 3, "val").otherwise("test").alias("split"))


@query("doc_leakage_flags", f"""
WITH d AS (SELECT doc_id, md5(text) AS hash, {SPLIT_SQL} AS split FROM documents),
g AS (SELECT hash, max(CAST(split = 'train' AS INTEGER)) AS tr, max(CAST(split = 'val' AS INTEGER)) AS va,
             min(doc_id) AS first FROM d GROUP BY hash),
f AS (SELECT doc_id, split, CASE WHEN tr = 1 AND va = 1 AND split = 'val' THEN 'leakage'
                                 WHEN NOT (tr = 1 AND va = 1) AND doc_id <> first THEN 'duplicate' END AS flag
      FROM d JOIN g USING (hash))
SELECT * FROM f WHERE flag IS NOT NULL""")
def doc_leakage_flags(spark, sf):
    """M2: cross-split leakage (val copies of train content) and in-split duplicates."""
    f = mk.leakage_flags(doc_splits(spark, sf), "doc_id", "split", "hash")
    return f.filter(F.col("flag").isNotNull()).select("doc_id", "split", "flag")


@query("doc_quarantine", f"""
WITH d AS (SELECT doc_id, text, n_chars, md5(text) AS hash, {SPLIT_SQL} AS split FROM documents),
g AS (SELECT hash, max(CAST(split = 'train' AS INTEGER)) AS tr, max(CAST(split = 'val' AS INTEGER)) AS va,
             min(doc_id) AS first FROM d GROUP BY hash),
f AS (SELECT d.*, CASE WHEN tr = 1 AND va = 1 AND split = 'val' THEN 'leakage'
                       WHEN NOT (tr = 1 AND va = 1) AND doc_id <> first THEN 'duplicate' END AS flag FROM d JOIN g USING (hash)),
q AS (SELECT coalesce(CASE WHEN text IS NULL OR length(text) = 0 OR contains(text, '�') THEN 'corrupt' END, flag,
                      CASE WHEN n_chars < 200 THEN 'low_quality' END) AS reason FROM f)
SELECT reason, count(*) AS n FROM q WHERE reason IS NOT NULL GROUP BY reason""")
def doc_quarantine(spark, sf):
    """M3 + M4: quarantine decision table, reason priority corrupt > leakage/duplicate > low quality."""
    f = mk.leakage_flags(doc_splits(spark, sf), "doc_id", "split", "hash")
    reason = mk.quarantine(f, mk.integrity("text").isNotNull(), F.col("flag"), F.col("n_chars") < 200)
    return f.select(reason.alias("reason")).filter(F.col("reason").isNotNull()).groupBy("reason") \
            .agg(F.count(F.lit(1)).alias("n"))


@query("page_integrity", """
SELECT coalesce(CASE WHEN html IS NULL THEN 'missing' WHEN length(html) = 0 THEN 'empty'
                     WHEN contains(html, '�') THEN 'undecodable' END,
                CASE WHEN NOT starts_with(lower(html), '<!doctype html') THEN 'not_html' END, 'ok') AS status,
       count(*) AS n FROM pages GROUP BY 1""")
def page_integrity(spark, sf):
    """M4: integrity issue table for raw pages (missing / empty / undecodable / not HTML)."""
    p = read_table(spark, sf, "pages", "html")
    st = F.coalesce(mk.integrity("html"), F.when(~F.lower("html").startswith("<!doctype html"), "not_html"), F.lit("ok"))
    return p.groupBy(st.alias("status")).agg(F.count(F.lit(1)).alias("n"))


HOURS_SQL = """hrs AS (SELECT DISTINCT user_id, event_type,
     CAST(floor(date_diff('microsecond', (SELECT date_trunc('month', min(ts)) FROM events), ts) / 3600000000.0) AS BIGINT) + 1 AS pos
   FROM events)"""


def active_hours(spark, sf, event_type):
    hours = all_active_hours(spark, sf)
    return hours.filter(F.col("event_type") == event_type).select("user_id", "pos")


def all_active_hours(spark, sf):
    e = read_table(spark, sf, "events", "user_id", "event_type", "ts")
    base = e.select(F.date_trunc("month", F.min("ts"))).scalar()
    pos = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(base)) / 3600000000).cast("long") + 1
    return e.select("event_type", "user_id", pos.alias("pos")).distinct()


RUNS_SQL = HOURS_SQL + """,
isl AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS g FROM hrs WHERE event_type = 'click'),
runs AS (SELECT user_id, min(pos) AS start, count(*) AS length FROM isl GROUP BY user_id, g),
rle AS (SELECT user_id, string_agg(CAST(start AS VARCHAR) || ' ' || CAST(length AS VARCHAR), ' ' ORDER BY start) AS rle
        FROM runs GROUP BY user_id)"""


def click_rle(spark, sf):
    return mk.rle_string(mk.runs_from_positions(active_hours(spark, sf, "click"), "user_id", "pos"), "user_id")


@query("rle_runs", f"WITH {RUNS_SQL} SELECT user_id, rle FROM rle")
def rle_runs(spark, sf):
    """M8 encode: active click hours per user as a run-length string (1-based, start order)."""
    return click_rle(spark, sf)


@query("rle_severity", f"""
WITH {RUNS_SQL},
a AS (SELECT user_id, CAST(list_sum([CAST(x AS BIGINT) for x in list_filter(string_split(rle, ' '), lambda x, i: i % 2 = 0)]) AS BIGINT) AS area FROM rle),
p AS (SELECT user_id, area, round(least(area * 100.0 / 720, 100.0), 4) AS pct FROM a)
SELECT user_id, area, pct, CASE WHEN area = 0 THEN 'None' WHEN pct < 2 THEN 'Minor' WHEN pct < 5 THEN 'Moderate' ELSE 'Severe' END AS severity,
  CASE WHEN area = 0 THEN 'Accept' WHEN pct < 2 THEN 'Accept' WHEN pct < 5 THEN 'Rework' ELSE 'Reject' END AS decision FROM p""",
       floats=("pct",))
def rle_severity(spark, sf):
    """M7 + C17: mask area from the RLE string, % of the 720-hour month (capped, 4 dp),
    severity and decision per user."""
    r = click_rle(spark, sf).withColumn("area", mk.rle_area("rle"))
    r = r.withColumn("pct", F.round(F.least(F.col("area") * 100.0 / 720, F.lit(100.0)), 4))
    sev = severity_from_area("pct", F.col("area") > 0)
    return r.select("user_id", "area", "pct", sev.alias("severity"), decision_from_severity(sev).alias("decision"))


@query("rle_decode_check", f"""
WITH {RUNS_SQL},
d AS (SELECT user_id, unnest(generate_series(start, start + length - 1)) AS pos FROM runs)
SELECT user_id, count(*) AS n_positions, min(pos) AS first_pos, max(pos) AS last_pos FROM d GROUP BY user_id""")
def rle_decode_check(spark, sf):
    """M8 decode: positions recovered from the RLE strings (round trip)."""
    d = mk.decode_runs(click_rle(spark, sf), "user_id", "rle")
    return d.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_positions"), F.min("pos").alias("first_pos"),
                                    F.max("pos").alias("last_pos"))


@query("click_view_overlap", f"""
WITH {HOURS_SQL},
a AS (SELECT user_id, pos FROM hrs WHERE event_type = 'click'),
b AS (SELECT user_id, pos FROM hrs WHERE event_type = 'view'),
na AS (SELECT user_id, count(*) AS n_a FROM a GROUP BY 1), nb AS (SELECT user_id, count(*) AS n_b FROM b GROUP BY 1),
i AS (SELECT user_id, count(*) AS inter FROM a JOIN b USING (user_id, pos) GROUP BY 1),
j AS (SELECT coalesce(na.user_id, nb.user_id) AS user_id, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b
      FROM na FULL JOIN nb USING (user_id)),
k AS (SELECT j.*, coalesce(inter, 0) AS inter FROM j LEFT JOIN i USING (user_id))
SELECT user_id, n_a, n_b, inter, CASE WHEN n_a + n_b = 0 THEN 1.0 ELSE 2 * inter / (n_a + n_b) END AS dice,
       CASE WHEN n_a + n_b - inter = 0 THEN 1.0 ELSE inter / (n_a + n_b - inter) END AS iou FROM k""",
       floats=("dice", "iou"))
def click_view_overlap(spark, sf):
    """Dice and IoU between each user's click-hour and view-hour masks (decoded
    from run-length strings)."""
    a = mk.decode_runs(click_rle(spark, sf), "user_id", "rle")
    vr = mk.rle_string(mk.runs_from_positions(active_hours(spark, sf, "view"), "user_id", "pos"), "user_id")
    b = mk.decode_runs(vr, "user_id", "rle")
    return mk.overlap_scores(a, b, "user_id")
