"""Evaluation queries (L1-L14).  Scores are deterministic expressions of the driver
tables: quality labels scored by document length, languages predicted by stop-word
rules, classes scored by a softmax over embedding coordinates."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..sources.tables import read_table
from .registry import query

SCORED_SQL = """s AS (SELECT l.doc_id, l.quality AS label, least(d.n_chars, 8000) / 8000.0 AS score,
                  CAST(least(d.n_chars, 8000) / 8000.0 >= 0.25 AS INTEGER) AS pred
           FROM labels l JOIN documents d USING (doc_id))"""


def scored(spark, sf):
    lab = read_table(spark, sf, "labels", "doc_id", "quality")
    d = read_table(spark, sf, "documents", "doc_id", "n_chars")
    sc = F.least(F.col("n_chars"), F.lit(8000)) / 8000.0
    return lab.join(d, "doc_id").select("doc_id", F.col("quality").alias("label"), sc.alias("score"),
                                        (sc >= 0.25).cast("int").alias("pred"))


CURVE_SQL = SCORED_SQL + """,
g AS (SELECT score AS threshold, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg
      FROM s GROUP BY score),
t AS (SELECT threshold, pos, neg, row_number() OVER (ORDER BY threshold DESC) AS rank,
             CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
             CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g),
pr AS (SELECT *, tp / (tp + fp) AS precision, tp / P AS recall FROM t)"""


@query("binary_kpis", f"""
WITH {SCORED_SQL},
m AS (SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND pred = 1) AS fp,
             count(*) FILTER (WHERE label <> 1 AND pred <> 1) AS tn, count(*) FILTER (WHERE label = 1 AND pred <> 1) AS fn FROM s)
SELECT tp, fp, tn, fn, coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0) AS accuracy,
       coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity,
       coalesce(fn / nullif(fn + tp, 0), 0) AS fnr FROM m""",
       floats=("accuracy", "precision", "recall", "f1", "specificity", "fnr"))
def binary_kpis(spark, sf):
    """L1: confusion matrix and binary KPIs, zero division -> 0."""
    return ev.binary_metrics(scored(spark, sf), "label", "pred")


LANG_PRED_SQL = """p AS (SELECT doc_id, lang AS label,
         CASE WHEN contains(text, ' the ') THEN 'en' WHEN contains(text, ' le ') THEN 'fr'
              WHEN contains(text, ' und ') THEN 'de' ELSE 'es' END AS pred, n_chars FROM documents)"""


def lang_pred(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "lang", "text", "n_chars")
    t = F.col("text")
    pred = (F.when(t.contains(" the "), "en").when(t.contains(" le "), "fr")
             .when(t.contains(" und "), "de").otherwise("es"))
    return d.select("doc_id", F.col("lang").alias("label"), pred.alias("pred"), "n_chars")


@query("lang_classification_report", f"""
WITH {LANG_PRED_SQL},
pairs AS (SELECT label, pred, count(*) AS n FROM p GROUP BY ALL),
sup AS (SELECT label AS class, sum(n) AS support FROM pairs GROUP BY 1),
prd AS (SELECT pred AS class, sum(n) AS predicted FROM pairs GROUP BY 1),
tp AS (SELECT label AS class, n AS tp FROM pairs WHERE label = pred),
per AS (SELECT class, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted
        FROM sup FULL JOIN prd USING (class) LEFT JOIN tp USING (class)),
m AS (SELECT class, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
             CAST(support AS BIGINT) AS support FROM per),
m2 AS (SELECT class, precision, recall,
              coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1, support FROM m)
SELECT * FROM m2
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m2""",
       floats=("precision", "recall", "f1"))
def lang_classification_report(spark, sf):
    """L2: per-class P/R/F1/support with macro and weighted averages."""
    return ev.classification_report(lang_pred(spark, sf), "label", "pred")


@query("lang_confusion", f"""
WITH {LANG_PRED_SQL},
pairs AS (SELECT label, pred, count(*) AS n FROM p GROUP BY ALL)
SELECT label, pred, n, n / sum(n) OVER (PARTITION BY label) AS share FROM pairs""", floats=("share",))
def lang_confusion(spark, sf):
    """L2: row-normalised confusion matrix, long layout."""
    return ev.confusion_normalized(lang_pred(spark, sf), "label", "pred")


@query("roc_points", f"""
WITH {CURVE_SQL}
SELECT threshold, rank, fp / N AS fpr, tp / P AS tpr FROM t""", floats=("threshold", "fpr", "tpr"))
def roc_points(spark, sf):
    """L3: exact ROC points, one per distinct score."""
    return ev.roc_curve(scored(spark, sf), "label", "score")


@query("roc_auc_exact", f"""
WITH {CURVE_SQL}
SELECT sum(pos * ((N - fp) + 0.5 * neg)) / (max(P) * max(N)) AS auc FROM t""", floats=("auc",))
def roc_auc_exact(spark, sf):
    """L3: exact AUC with tie half-credit."""
    return ev.auc(scored(spark, sf), "label", "score")


@query("average_precision", f"""
WITH {CURVE_SQL}
SELECT sum(pos / P * precision) AS average_precision FROM pr""", floats=("average_precision",))
def average_precision(spark, sf):
    """L4: step-sum average precision."""
    return ev.average_precision(scored(spark, sf), "label", "score")


@query("pr_points", f"""
WITH {CURVE_SQL}
SELECT threshold, rank, tp, fp, precision, recall FROM pr""", floats=("threshold", "precision", "recall"))
def pr_points(spark, sf):
    """L4: precision / recall per distinct threshold."""
    return ev.pr_curve(scored(spark, sf), "label", "score").select(
        "threshold", "rank", "tp", "fp", "precision", "recall")


@query("best_f1_threshold", f"""
WITH {CURVE_SQL},
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM pr)
SELECT threshold, precision, recall, f1 FROM f ORDER BY f1 DESC, threshold DESC LIMIT 1""",
       floats=("threshold", "precision", "recall", "f1"))
def best_f1_threshold(spark, sf):
    """F1-maximising threshold."""
    return ev.best_f1_threshold(scored(spark, sf), "label", "score")


@query("recall_operating_points", f"""
WITH {CURVE_SQL},
tg(target) AS (VALUES (0.7), (0.8), (0.9), (0.999)),
b AS (SELECT tg.target, (SELECT struct_pack(threshold := threshold, precision := precision, recall := recall, tp := tp, fp := fp)
                      FROM pr WHERE recall >= tg.target ORDER BY precision DESC, threshold DESC LIMIT 1) AS x FROM tg)
SELECT CAST(target AS DOUBLE) AS target, coalesce(x.threshold, 0.5) AS threshold, x.precision AS precision,
       x.recall AS recall, x.tp AS tp, x.fp AS fp, x.threshold IS NOT NULL AS reachable,
       CAST(x.tp + x.fp AS DOUBLE) / nullif(x.tp, 0) AS alarms_per_catch FROM b""",
       floats=("threshold", "precision", "recall", "alarms_per_catch"))
def recall_operating_points(spark, sf):
    """Highest-precision threshold per target recall, 0.5 when unreachable."""
    return ev.threshold_for_recall(scored(spark, sf), "label", "score", [0.7, 0.8, 0.9, 0.999])


@query("recall_grid", f"""
WITH {SCORED_SQL},
gr AS (SELECT CAST(round(0.05 * i, 2) AS DOUBLE) AS threshold FROM range(1, 20) t(i)),
c AS (SELECT threshold, CAST(count(*) FILTER (WHERE label = 1 AND score >= threshold) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE label <> 1 AND score >= threshold) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS P
      FROM gr, s GROUP BY threshold)
SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(P, 0), 0) AS recall,
       coalesce(tp / nullif(tp + fp, 0), 0) >= 0.9 AS eligible FROM c""", floats=("precision", "recall"))
def recall_grid(spark, sf):
    """Recall / precision on the .05-.95 grid, precision floor 0.9 (one aggregate)."""
    return ev.recall_grid_threshold(scored(spark, sf), "label", "score", 0.9)


@query("price_regression_metrics", """
WITH j AS (SELECT l.l_returnflag, l.l_extendedprice AS y, l.l_quantity * p.p_retailprice * 0.98 AS pred
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT l_returnflag, avg(abs(y - pred)) AS mae, sqrt(avg((y - pred) * (y - pred))) AS rmse, count(*) AS n,
       avg(CASE WHEN abs(y) >= 1 THEN abs((y - pred) / y) END) * 100 AS mape,
       1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) AS r2
FROM j GROUP BY l_returnflag""", floats=("mae", "rmse", "mape", "r2"))
def price_regression_metrics(spark, sf):
    """MAE, RMSE, R^2, MAPE of a price model per return flag."""
    li = read_table(spark, sf, "lineitem", "l_partkey", "l_returnflag", "l_extendedprice", "l_quantity")
    p = read_table(spark, sf, "part", "p_partkey", "p_retailprice")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_returnflag", F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice") * 0.98).alias("pred"))
    return ev.regression_metrics(j, "y", "pred", group_cols=["l_returnflag"])


SOFTMAX_SQL = """sm AS (SELECT vec_id, label, """ + ", ".join(
    f"exp(CAST(embedding[{i + 1}] AS DOUBLE)) AS e{i}" for i in range(10)) + """ FROM embeddings),
pr10 AS (SELECT vec_id, label, """ + ", ".join(
    f"e{i} / (" + " + ".join(f"e{j}" for j in range(10)) + f") AS p{i}" for i in range(10)) + """ FROM sm),
lng AS (""" + " UNION ALL ".join(
    f"SELECT {i} AS k, vec_id, CAST(label = {i} AS INTEGER) AS y, p{i} AS score FROM pr10" for i in range(10)) + ")"


def softmax_long(spark, sf):
    e = read_table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    ex = [F.exp(F.element_at("embedding", i + 1).cast("double")) for i in range(10)]
    z = ex[0]
    for x in ex[1:]:
        z = z + x
    probs = F.array(*[x / z for x in ex])
    d = e.select("vec_id", "label", probs.alias("p"))
    return d.select("vec_id", F.posexplode("p").alias("k", "score"), "label").select(
        "k", "vec_id", (F.col("label") == F.col("k")).cast("int").alias("y"), "score")


def _auc_sql(src: str, group: str | None) -> str:
    gcols = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""(SELECT {gcols}sum(pos * ((N - fp) + 0.5 * neg)) / (max(P) * max(N)) AS auc FROM (
      SELECT {gcols}pos, neg, sum(neg) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER ({part.strip()}) AS P, sum(neg) OVER ({part.strip()}) AS N
      FROM (SELECT {gcols}score, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg
            FROM {src} GROUP BY {gcols}score)) {"GROUP BY " + group if group else ""})"""


@query("embedding_ovr_auc", f"""
WITH {SOFTMAX_SQL},
per AS {_auc_sql('lng', 'k')}
SELECT CAST(k AS VARCHAR) AS class, auc FROM per
UNION ALL SELECT 'macro', avg(auc) FROM per
UNION ALL SELECT 'micro', auc FROM {_auc_sql('lng', None)}""", floats=("auc",))
def embedding_ovr_auc(spark, sf):
    """One-vs-rest AUC per class, macro mean and micro (pooled) AUC."""
    lng = softmax_long(spark, sf)
    per = ev.auc(lng, "y", "score", ["k"])
    macro = per.agg(F.avg("auc").alias("auc")).select(F.lit("macro").alias("class"), "auc")
    micro = ev.auc(lng, "y", "score").select(F.lit("micro").alias("class"), "auc")
    return per.select(F.col("k").cast("string").alias("class"), "auc").unionByName(macro).unionByName(micro)


ML_SQL = """ml AS (""" + " UNION ALL ".join(
    f"SELECT vec_id, {i} AS k, CAST(embedding[{i + 1}] > 0 AS INTEGER) AS y, "
    f"1 / (1 + exp(-CAST(embedding[{i + 4}] AS DOUBLE))) AS score FROM embeddings" for i in range(3)) + ")"


@query("multilabel_metrics", f"""
WITH {ML_SQL},
f AS (SELECT k, count(*) FILTER (WHERE y = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND score >= 0.5) AS fp,
             count(*) FILTER (WHERE y = 1 AND score < 0.5) AS fn FROM ml GROUP BY k),
a AS {_auc_sql('(SELECT k, y, score FROM ml)', 'k')},
per AS (SELECT k, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, auc FROM f JOIN a USING (k))
SELECT CAST(k AS VARCHAR) AS label, f1, auc FROM per
UNION ALL SELECT 'macro', avg(f1), avg(auc) FROM per""", floats=("f1", "auc"))
def multilabel_metrics(spark, sf):
    """Per-label F1 (threshold 0.5) and AUC from aligned label / score arrays, macro row."""
    e = read_table(spark, sf, "embeddings", "vec_id", "embedding")
    el = lambda i: F.element_at("embedding", i + 1).cast("double")
    d = e.select("vec_id", F.array(*[(el(i) > 0).cast("int") for i in range(3)]).alias("labels"),
                 F.array(*[1 / (1 + F.exp(-el(i + 3))) for i in range(3)]).alias("scores"))
    lng = ev.multilabel_long(d, "vec_id", "labels", "scores").withColumn(
        "pred", (F.col("score") >= 0.5).cast("int"))
    f1 = ev.binary_metrics(lng, "label", "pred", ["k"]).select("k", "f1")
    auc = ev.auc(lng, "label", "score", ["k"])
    per = f1.join(auc, "k")
    macro = per.agg(F.avg("f1").alias("f1"), F.avg("auc").alias("auc")).select(F.lit("macro").alias("label"), "f1", "auc")
    return per.select(F.col("k").cast("string").alias("label"), "f1", "auc").unionByName(macro)


@query("lang_error_pairs", f"""
WITH {LANG_PRED_SQL}
SELECT label, pred, count(*) AS n FROM p WHERE label <> pred GROUP BY ALL ORDER BY n DESC, label, pred LIMIT 5""")
def lang_error_pairs(spark, sf):
    """The 5 most frequent confused (label, pred) pairs."""
    return ev.confused_pairs(lang_pred(spark, sf), "label", "pred", 5)


@query("lang_error_lengths", f"""
WITH {LANG_PRED_SQL}
SELECT label = pred AS correct, count(*) AS n, avg(n_chars) AS mean_chars FROM p GROUP BY 1""",
       floats=("mean_chars",))
def lang_error_lengths(spark, sf):
    """Error versus correct rows, mean length."""
    p = lang_pred(spark, sf)
    return p.groupBy((F.col("label") == F.col("pred")).alias("correct")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean_chars"))


@query("quality_leaderboard", f"""
WITH {SCORED_SQL},
s2 AS (SELECT doc_id, label, score AS s_len, 0.5 AS s_const, 1.0 / (1 + doc_id % 7) AS s_noise FROM s),
la AS {_auc_sql("(SELECT label AS y, s_len AS score FROM s2)", None)},
lc AS {_auc_sql("(SELECT label AS y, s_const AS score FROM s2)", None)},
ln AS {_auc_sql("(SELECT label AS y, s_noise AS score FROM s2)", None)},
u AS (SELECT 'length' AS model, auc FROM la UNION ALL SELECT 'constant', auc FROM lc
      UNION ALL SELECT 'noise', auc FROM ln)
SELECT model, auc, (auc - (SELECT auc FROM lc)) / abs((SELECT auc FROM lc)) * 100 AS improvement_pct FROM u""",
       floats=("auc", "improvement_pct"))
def quality_leaderboard(spark, sf):
    """L12 + K15: AUC of three scorers, improvement over the constant baseline."""
    s = scored(spark, sf)
    rows = [ev.auc(s.withColumn("sc", sc), "label", "sc").select(F.lit(name).alias("model"), "auc")
            for name, sc in [("length", F.col("score")), ("constant", F.lit(0.5)),
                             ("noise", 1.0 / (1 + F.col("doc_id") % 7))]]
    return ev.leaderboard(rows, "auc", "constant")


@query("lang_binary_collapse", f"""
WITH {LANG_PRED_SQL},
b AS (SELECT CAST(label <> 'en' AS INTEGER) AS y, CAST(pred <> 'en' AS INTEGER) AS p FROM p),
m AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND p = 1) AS fp,
             count(*) FILTER (WHERE y <> 1 AND p <> 1) AS tn, count(*) FILTER (WHERE y = 1 AND p <> 1) AS fn FROM b)
SELECT tp, fp, tn, fn, coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0) AS accuracy,
       coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity,
       coalesce(fn / nullif(fn + tp, 0), 0) AS fnr FROM m""",
       floats=("accuracy", "precision", "recall", "f1", "specificity", "fnr"))
def lang_binary_collapse(spark, sf):
    """Multi-class collapsed to "not English" and rescored."""
    p = lang_pred(spark, sf).select((F.col("label") != "en").cast("int").alias("y"),
                                    (F.col("pred") != "en").cast("int").alias("p"))
    return ev.binary_metrics(p, "y", "p")


@query("misclassified_documents", f"""
WITH {SCORED_SQL},
w AS (SELECT doc_id, score, CASE WHEN label = 0 THEN 'FP' ELSE 'FN' END AS error FROM s WHERE label <> pred),
r AS (SELECT (SELECT count(*) FROM w WHERE error = 'FP') / (SELECT greatest(count(*), 1) FROM s WHERE label = 0) AS fpr,
             (SELECT count(*) FROM w WHERE error = 'FN') / (SELECT greatest(count(*), 1) FROM s WHERE label = 1) AS fnr)
SELECT w.doc_id, error, CASE error WHEN 'FP' THEN fpr ELSE fnr END AS error_rate,
       row_number() OVER (PARTITION BY error ORDER BY abs(score - 0.25) DESC, w.doc_id) AS rank,
       left(text, 120) AS snippet FROM w JOIN documents d USING (doc_id), r""", floats=("error_rate",))
def misclassified_documents(spark, sf):
    """Every misclassified document by type, the most confident mistakes first, with the rate of
    its type and the beginning of its text."""
    s = scored(spark, sf).withColumn("distance", F.abs(F.col("score") - 0.25))
    wrong = ev.misclassified(s, "label", "pred", [F.desc("distance"), F.asc("doc_id")])
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return wrong.join(d, "doc_id").select("doc_id", "error", "error_rate", "rank", F.left("text", F.lit(120)).alias("snippet"))
