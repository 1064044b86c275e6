"""Model-fitting queries.

An iterative estimator's numbers have no SQL oracle, so the queries with one return what does:
exact row counts of every split and fold, one prediction per row, and flags that SQL spells as
true.  Those flags are weak: ``learned`` is about training rows and ``near_or_below_mean`` holds for
a constant prediction, since the driver tables have no signal to learn (on sf0.001 every regressor's
test R^2 is below 0, every classifier near chance).  What the operators compute - predictions,
metrics, inertia, importances, scores - is returned by queries without oracle beside them
(``ml_embedding_predictions``, ``ml_price_metrics``, ``ml_kmeans_search``, ``ml_oof_predictions``,
``ml_importance_values``, ``ml_batch_scores``) and tested on tables with signal, against floors that a
constant prediction misses.
"""
from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (CountVectorizer, IDF, MinMaxScaler, Normalizer, RobustScaler, StandardScaler,
                                VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import log1p_clipped
from ..functions.rules import risk_level, risk_score
from ..functions.text import word_tokens
from ..operators import evaluation as ev
from ..operators import ml
from ..operators import sampling as sp
from ..operators.ordering import sequence_index
from ..operators.text import remove_stop_words
from ..session import materialize
from ..sources.files import scratch_path
from ..sources.tables import read_table
from .features import CUST_SQL, cust_stats
from .features import cust_stats
from .registry import query


def _emb(spark, sf):
    e = read_table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    e = e.select("vec_id", F.col("label").cast("double").alias("label"),
                 array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    return materialize(sp.stratified_split(e, "label", ["vec_id"], 0.2))


EMB_SPLIT_SQL = """
c AS (SELECT label, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS t FROM embeddings GROUP BY label),
e AS (SELECT CAST(sum(n) - sum(t) AS BIGINT) AS n_train, CAST(sum(t) AS BIGINT) AS n_test FROM c)"""
#: Deterministic 1-in-5 split of the price table, the same in SQL.
SPLIT_EXPR = "(l_partkey * 7919 + CAST(l_quantity AS BIGINT) * 104729 + CAST(round(l_discount * 100) AS BIGINT) * 1299709) % 5 = 0"
PRICE_SPLIT_SQL = f"""
s AS (SELECT {SPLIT_EXPR} AS test, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey),
e AS (SELECT count(*) FILTER (NOT test) AS n_train, count(*) FILTER (test) AS n_test FROM s)"""


PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


def _names_sql(names) -> str:
    return ", ".join(f"('{n}')" for n in names)


def _counts(d) -> dict:
    return {r["split"]: r["count"] for r in d.groupBy("split").count().collect()}  # two rows


def embedding_models(spark, sf):
    """Training and test rows of the embeddings, rows per split, and three fitted classifiers."""
    d = _emb(spark, sf)
    n = _counts(d)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    classes = int(train.select(F.max("label")).first()[0]) + 1
    models = {
        "logreg": LogisticRegression(maxIter=50, regParam=0.01, family="multinomial"),
        "random_forest": RandomForestClassifier(numTrees=30, maxDepth=6, seed=42),
        "mlp": MultilayerPerceptronClassifier(layers=[64, 256, 128, 64, classes], maxIter=40, seed=42),
    }
    return train, test, n, {name: est.fit(train) for name, est in models.items()}


@query("ml_embedding_predictions", None)
def ml_embedding_predictions(spark, sf):
    """The rows behind ``ml_embedding_classifiers``: every model's prediction for every test row."""
    _, test, _, models = embedding_models(spark, sf)
    parts = [m.transform(test).select(F.lit(name).alias("model"), "vec_id", "label", "prediction") for name, m in models.items()]
    return reduce(DataFrame.unionByName, parts)


@query("ml_embedding_classifiers", f"""
WITH {EMB_SPLIT_SQL}
SELECT model, n_train, n_test, n_test AS n_predicted, true AS learned
FROM e, (VALUES ('logreg'), ('random_forest'), ('mlp')) AS m(model)""")
def ml_embedding_classifiers(spark, sf):
    """K1 (multinomial LR, L2) + K3 (random forest) + K6 (MLP 256-128-64) + K15 + L2: fitted on
    the training rows of a stratified 20 % split; ``learned``: training accuracy above the
    share of the largest class, for every model."""
    train, test, n, models = embedding_models(spark, sf)
    majority = train.groupBy("label").count().select(F.max("count")).first()[0] / n["train"]
    rows = []
    for name, model in models.items():
        acc = model.transform(train).select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
        predicted = model.transform(test).where("prediction is not null").count()
        rows.append((name, n["train"], n["test"], predicted, acc > majority))
    return spark.createDataFrame(rows, "model string, n_train long, n_test long, n_predicted long, learned boolean")


def _price_table(spark, sf):
    """Line features with a unique ``rid``: positions in the total order of all columns (rows
    that tie in all of them are interchangeable)."""
    li = read_table(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                    "l_returnflag")
    p = read_table(spark, sf, "part", "p_partkey", "p_retailprice", "p_size")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size", (F.col("l_returnflag") == "R").cast("int").alias("is_return"),
        F.log1p("l_extendedprice").alias("y_log"), F.when(F.expr(SPLIT_EXPR), "test").otherwise("train").alias("split"))
    j = sequence_index(j, j.columns, name="rid")
    return VectorAssembler(inputCols=PRICE_FEATURES, outputCol="features").transform(j)


_REGRESSORS = ("linear", "ridge", "lasso", "elastic_net", "random_forest", "gbt")


def price_metrics(spark, sf):
    """Rows per split, and per regressor the metrics of its test rows: prices, that is after the expm1
    back-transform of labels and predictions.  ``mean_rmse`` beside them is the error of the training rows'
    mean (of the log, as the models are fitted) as a prediction."""
    d = materialize(_price_table(spark, sf).select("rid", "split", "y_log", "features"))
    n = _counts(d)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    staged = train.withColumn("is_val", F.col("rid") % 5 == 0)
    models = {"linear": LinearRegression(labelCol="y_log"),
              "ridge": LinearRegression(labelCol="y_log", regParam=0.1, elasticNetParam=0.0),
              "lasso": LinearRegression(labelCol="y_log", regParam=0.01, elasticNetParam=1.0),
              "elastic_net": LinearRegression(labelCol="y_log", regParam=0.01, elasticNetParam=0.5),
              "random_forest": RandomForestRegressor(labelCol="y_log", numTrees=20, maxDepth=8, seed=42),
              "gbt": GBTRegressor(labelCol="y_log", maxIter=20, maxDepth=5, seed=42, validationTol=0.001,
                                  validationIndicatorCol="is_val")}
    # All models score a test row in one pass, and one aggregation measures them.
    scored = ml.predicted(test, {f"p_{name}": est.fit(staged) for name, est in models.items()})
    scored = scored.withColumn("p_mean", F.lit(train.agg(F.avg("y_log")).first()[0]).cast("double"))
    each = F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"p_{name}").alias("prediction")) for name in (*models, "mean")])
    prices = ev.back_transformed(scored.select("y_log", F.inline(each)), "y_log", "prediction")
    rows = ev.regression_metrics(prices, "y_log", "prediction", group_cols=["model"]).collect()
    found = {r.model: r.asDict() for r in rows}  # one row per model
    return n, {name: found[name] | {"mean_rmse": found["mean"]["rmse"]} for name in models if name in found}


@query("ml_price_metrics", None)
def ml_price_metrics(spark, sf):
    """The numbers behind ``ml_price_regressors``: error and R^2 of every model on the prices of the test rows."""
    _, found = price_metrics(spark, sf)
    return spark.createDataFrame([(name, m["n"], m["mae"], m["rmse"], m["mape"], m["r2"]) for name, m in found.items()],
                                 "model string, n long, mae double, rmse double, mape double, r2 double")


@query("ml_price_regressors", f"""
WITH {PRICE_SPLIT_SQL}
SELECT model, n_train, n_test, true AS near_or_below_mean FROM e, (VALUES {_names_sql(_REGRESSORS)}) AS m(model)""")
def ml_price_regressors(spark, sf):
    """K2 (linear / ridge / lasso / elastic net) + K3 + K4 (boosting stopped early on a validation
    share of the training rows) on log1p(price), L5 metrics after the expm1 back-transform;
    ``near_or_below_mean``: test RMSE of prices at most 5 % above that of the training rows' mean,
    back-transformed as well (prices of unseen lines are hardly predictable from these columns)."""
    n, found = price_metrics(spark, sf)
    rows = [(name, n["train"], n["test"], m["rmse"] <= 1.05 * m["mean_rmse"]) for name, m in found.items()]
    return spark.createDataFrame(rows, "model string, n_train long, n_test long, near_or_below_mean boolean")


@query("ml_quality_text_lr", """
WITH j AS (SELECT doc_id, quality FROM labels JOIN documents USING (doc_id)),
c AS (SELECT quality, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS t FROM j GROUP BY quality)
SELECT CAST(sum(n) - sum(t) AS BIGINT) AS n_train, CAST(sum(t) AS BIGINT) AS n_test, CAST(4 AS BIGINT) AS grid_points,
       CAST(3 AS BIGINT) AS random_points, true AS test_auc_above_half FROM c""")
def ml_quality_text_lr(spark, sf):
    """T12 (TF-IDF vectors, whole vocabulary) + T14 (text + numeric union) + K1 (weighted binary
    LR) + K8 (grid with stratified folds) + K9 (random search) + K10 + L3: vocabulary, idf,
    weights and model come from the training rows only; the exact AUC is that of the test rows."""
    lab = read_table(spark, sf, "labels", "doc_id", "quality")
    d = read_table(spark, sf, "documents", "doc_id", "text", "n_chars")
    j = lab.join(d, "doc_id").select("doc_id", F.col("quality").cast("double").alias("label"),
                                     word_tokens("text").alias("raw"), F.log1p("n_chars").alias("len_log"))
    j = sp.stratified_split(remove_stop_words(j, "raw", "tok"), "label", ["doc_id"], 0.2)
    train, test = materialize(j.where("split = 'train'")), materialize(j.where("split = 'test'"))
    pos = train.select(F.avg("label")).scalar()
    weight = F.when(F.col("label") == 1, 0.5 / pos).otherwise(0.5 / (1 - pos))
    train = materialize(ml.fold_column(train.withColumn("weight", weight), "label", "doc_id", 3))
    feats = Pipeline(stages=[CountVectorizer(inputCol="tok", outputCol="tf", minDF=2.0, vocabSize=1 << 24),
                             IDF(inputCol="tf", outputCol="tfidf"), Normalizer(inputCol="tfidf", outputCol="tfidf_n"),
                             VectorAssembler(inputCols=["tfidf_n", "len_log"], outputCol="features")]).fit(train)
    x = materialize(ml.without_attributes(feats.transform(train).select("doc_id", "label", "weight", "fold", "features"), "features"))
    lr = LogisticRegression(weightCol="weight", maxIter=30)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    cv = lambda g: CrossValidator(estimator=lr, estimatorParamMaps=g, evaluator=BinaryClassificationEvaluator(),
                                  foldCol="fold", seed=42, parallelism=len(g))
    full = cv(grid).fit(x)
    some = ml.sample_param_grid(grid, 3)
    drawn = cv(some).fit(x)
    best = full if max(full.avgMetrics) >= max(drawn.avgMetrics) else drawn
    scored = best.transform(feats.transform(test)).select(
        F.col("label").cast("int").alias("y"), F.element_at(vector_to_array("probability"), 2).alias("score"))
    auc = ev.auc(scored, "y", "score").first().auc
    return spark.createDataFrame(
        [(train.count(), test.count(), len(full.avgMetrics), len(drawn.avgMetrics), auc > 0.5)],
        "n_train long, n_test long, grid_points long, random_points long, test_auc_above_half boolean")


def segment_search(spark, sf):
    """Scaled customer statistics, and inertia and silhouette of k from 2 to 10."""
    cs = cust_stats(spark, sf).select("c_custkey", "n_orders", "spend", "c_acctbal")
    x = cs.select("c_custkey", "n_orders", "spend", "c_acctbal", log1p_clipped("n_orders").alias("f"),
                  log1p_clipped("spend").alias("m"), log1p_clipped("c_acctbal").alias("b"))
    x = VectorAssembler(inputCols=["f", "m", "b"], outputCol="raw").transform(x)
    scalers = Pipeline(stages=[StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                               MinMaxScaler(inputCol="raw", outputCol="unit"),
                               RobustScaler(inputCol="raw", outputCol="robust", withCentering=True)])
    x = materialize(scalers.fit(x).transform(x))
    return x, ml.kmeans_search(x, "features", range(2, 11))


@query("ml_kmeans_search", None)
def ml_kmeans_search(spark, sf):
    """The numbers behind ``ml_kmeans_segments``: inertia and silhouette per k."""
    _, search = segment_search(spark, sf)
    return spark.createDataFrame([(r["k"], r["inertia"], r["silhouette"]) for r in search], "k long, inertia double, silhouette double")


@query("ml_kmeans_segments", """
SELECT k, (SELECT count(*) FROM customer) AS customers, true AS inertia_falls, k AS clusters, k AS names FROM range(2, 11) AS t(k)""")
def ml_kmeans_segments(spark, sf):
    """J2 (log1p + standard, min-max and robust scaling) + J7 (k from 2 to 10: inertia, silhouette)
    + J8 (naming by rank score) + J9 (unique names) + E22 on customer statistics: per k, the
    customers assigned, whether inertia is below that of one cluster, and the clusters and
    distinct names."""
    x, search = segment_search(spark, sf)
    spread = x.select(F.sum(F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, v: a + v * v))).first()[0]
    zcols = {"mean_orders": ("Frequent", "Infrequent"), "mean_spend": ("Big spenders", "Small spenders"),
             "mean_balance": ("Cash rich", "Indebted")}
    rows = []
    for found in search:
        k = found["k"]
        lab = KMeans(k=k, seed=42).fit(x).transform(x).withColumnRenamed("prediction", "cluster")
        prof = lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("customers"), F.avg("n_orders").alias("mean_orders"),
                                          F.avg("spend").alias("mean_spend"), F.avg("c_acctbal").alias("mean_balance"))
        named = ml.name_clusters_by_rank(prof.withColumn("_r", -F.col("mean_balance")), "cluster", "_r", "mean_orders",
                                         "mean_spend", [f"Segment {i + 1}" for i in range(k)])
        st = prof.agg(*[F.avg(c).alias(f"m_{c}") for c in zcols], *[F.stddev_pop(c).alias(f"s_{c}") for c in zcols]).first()
        z = [{"cluster": r["cluster"], **{c: (r[c] - st[f"m_{c}"]) / (st[f"s_{c}"] or 1.0) for c in zcols}}
             for r in prof.select("cluster", *zcols).collect()]  # k rows
        greedy = ml.greedy_unique_names(z, zcols, "Typical")
        total = named.agg(F.sum("customers").alias("customers"), F.count_distinct(named.columns[-2 if named.columns[-1] == "_r" else -1])
                          .alias("names"), F.count(F.lit(1)).alias("clusters")).first()
        assert len(greedy) == k
        rows.append((k, total["customers"], found["inertia"] < spread, total["clusters"], total["names"]))
    return spark.createDataFrame(rows, "k long, customers long, inertia_falls boolean, clusters long, names long")


@query("ml_pca_variance", """
SELECT CAST(label AS INTEGER) AS label, count(*) AS n, true AS variance_ordered FROM embeddings GROUP BY label""")
def ml_pca_variance(spark, sf):
    """2-D PCA of the centred embeddings: rows per label with coordinates, and whether the
    explained shares are in order, positive and at most one in sum."""
    e = _emb(spark, sf)
    proj, var = ml.pca_variance(e, "features", 2)
    ordered = bool(var[0] >= var[1] > 0 and var[0] + var[1] <= 1 + 1e-9)
    p = proj.select("label", vector_to_array("pca").alias("xy")).where("xy[0] is not null and xy[1] is not null")
    return (p.groupBy(F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("variance_ordered", F.lit(ordered)))


_STACK = ("lin", "ridge", "rf")


def oof_table(spark, sf, k: int = 3):
    """(rid, fold, y_log, p_<model> ...) for the training rows, and per model the mean of its
    fold models' predictions for the test rows."""
    d = _price_table(spark, sf).select("rid", "split", "y_log", "features")
    train = materialize(ml.fold_column(d.filter(F.col("split") == "train"), None, "rid", k))
    test = materialize(d.filter(F.col("split") == "test"))
    base = {"lin": LinearRegression(labelCol="y_log"),
            "ridge": LinearRegression(labelCol="y_log", regParam=0.1, elasticNetParam=0.0),
            "rf": RandomForestRegressor(labelCol="y_log", numTrees=15, maxDepth=6, seed=1)}
    oof, held = ml.out_of_fold_with_test(train, test, {f"p_{name}": est for name, est in base.items()}, "fold", k,
                                         ["rid", "fold", "y_log"], ["rid", "y_log"])
    return materialize(oof), materialize(held)


def stacked(spark, sf):
    """Out-of-fold rows and test rows with the meta-model's ``prediction``."""
    oof, held = oof_table(spark, sf)
    va = VectorAssembler(inputCols=[f"p_{n}" for n in _STACK], outputCol="features")
    meta = LinearRegression(labelCol="y_log", regParam=0.01, elasticNetParam=0.0).fit(va.transform(oof))
    return meta.transform(va.transform(oof)), meta.transform(va.transform(held))


@query("ml_oof_predictions", None)
def ml_oof_predictions(spark, sf):
    """The rows behind ``ml_oof_stacking``: per row its fold (null for test rows), base and stacked
    predictions."""
    cols = ["rid", "y_log", *[f"p_{n}" for n in _STACK], "prediction"]
    oof, held = stacked(spark, sf)
    return oof.select("fold", *cols).unionByName(held.select(F.lit(None).cast("int").alias("fold"), *cols))


@query("ml_oof_stacking", f"""
WITH {PRICE_SPLIT_SQL},
f AS (SELECT fold, (n_train // 3) + CASE WHEN fold < n_train % 3 THEN 1 ELSE 0 END AS n_oof, n_train, n_test FROM e, range(3) AS r(fold))
SELECT CAST(fold AS INTEGER) AS fold, n_oof, n_oof AS distinct_rows, n_test, true AS near_or_below_mean FROM f""")
def ml_oof_stacking(spark, sf):
    """K11 (one out-of-fold prediction per training row) + K12 (ridge meta-model on three base
    models' OOF predictions, test rows scored with the mean of the fold models) + K10: per
    fold, its rows, distinct rows, the test rows scored, and whether the stacked RMSE is
    at most 5 % above that of the mean, in the fold and on the test rows."""
    oof, held = stacked(spark, sf)
    err = F.sqrt(F.avg((F.col("y_log") - F.col("prediction")) ** 2)) <= 1.05 * F.stddev_pop("y_log")
    on_test = held.agg(err.alias("ok"), F.count_distinct("rid").alias("n")).first()
    return (oof.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_oof"), F.count_distinct("rid").alias("distinct_rows"), err.alias("in_fold"))
        .select("fold", "n_oof", "distinct_rows", F.lit(on_test["n"]).cast("long").alias("n_test"),
                (F.col("in_fold") & F.lit(bool(on_test["ok"]))).alias("near_or_below_mean")))


def importances(spark, sf):
    """Rows per split, training means, ranked importances, contributions per test row and feature,
    the rows whose contributions miss the prediction, and the loss of AUC per permuted feature."""
    d = materialize(_price_table(spark, sf))
    n = _counts(d)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    gbt = GBTClassifier(labelCol="is_return", maxIter=15, maxDepth=4, seed=42).fit(train)
    imp = ml.ranked_importances(gbt.featureImportances.toArray(), PRICE_FEATURES, spark)
    lin = LinearRegression(labelCol="y_log").fit(train)
    means = train.agg(*[F.avg(c).alias(c) for c in PRICE_FEATURES]).first().asDict()
    contrib = ml.linear_contributions(test, "rid", PRICE_FEATURES, list(lin.coefficients), means)
    centre = lin.intercept + sum(float(c) * means[f] for c, f in zip(lin.coefficients, PRICE_FEATURES))
    total = contrib.groupBy("rid").agg(F.sum("contribution").alias("c"))
    off = lin.transform(test).join(total, "rid").where(F.abs(F.col("prediction") - centre - F.col("c")) > 1e-6).count()

    # One pairing of the test rows serves every feature, and one set of curves all of their scores.
    va = VectorAssembler(inputCols=PRICE_FEATURES, outputCol="features")
    shuffled = materialize(ml.permuted_columns(test.drop("features"), "rid", PRICE_FEATURES))

    def scores(df, feature):
        return gbt.transform(df).select(F.lit(feature).alias("feature"), F.col("is_return").alias("y"),
                                        F.element_at(vector_to_array("probability"), 2).alias("score"))

    every = scores(test, "")
    for c in PRICE_FEATURES:
        every = every.unionByName(scores(va.transform(shuffled.withColumn(c, F.col(f"other_{c}"))), c))
    aucs = {r.feature: r.auc for r in ev.auc(every, "y", "score", ["feature"]).collect()}  # one row per feature
    drops = [aucs[""] - aucs[c] for c in PRICE_FEATURES]
    return n, means, imp, contrib, off, dict(zip(PRICE_FEATURES, drops))


@query("ml_importance_values", None)
def ml_importance_values(spark, sf):
    """The numbers behind ``ml_feature_importance``: per feature its importance and rank in the
    boosted model, the loss of test AUC when permuted, and the mean size of its linear contribution."""
    _, _, imp, contrib, _, drops = importances(spark, sf)
    drop = spark.createDataFrame(list(drops.items()), "feature string, auc_drop double")
    size = contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
    return imp.join(drop, "feature").join(size, "feature")


@query("ml_feature_importance", f"""
WITH {PRICE_SPLIT_SQL}, m AS (SELECT {", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(PRICE_FEATURES))}
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE NOT ({SPLIT_EXPR}))
SELECT feature, n_train, n_test, mean_value, true AS importances_sum_to_one FROM e,
  (SELECT unnest([{", ".join(f"'{c}'" for c in PRICE_FEATURES)}]) AS feature, unnest([{", ".join(f"m{i}" for i in range(5))}]) AS mean_value FROM m)""",
       floats=("mean_value",))
def ml_feature_importance(spark, sf):
    """K4 (GBT classifier) + K16 (model importances) + K17 (exact linear contributions around the
    training means) + K18 (permutation importance on test rows): one row per feature, with
    the counts of both splits; contributions of a row add up to its prediction minus the mean one."""
    n, means, imp, _, off, drops = importances(spark, sf)
    whole = abs(imp.select(F.sum("importance")).first()[0] - 1) < 1e-6 and off == 0 and len(drops) == len(PRICE_FEATURES)
    rows = [(c, n["train"], n["test"], means[c], bool(whole)) for c in PRICE_FEATURES]
    return spark.createDataFrame(rows, "feature string, n_train long, n_test long, mean_value double, importances_sum_to_one boolean")


def scored_rows(spark, sf):
    """The training labels, and every row with its label, confidence, risk and top classes."""
    e = _emb(spark, sf).withColumnRenamed("features", "raw")
    pipe = Pipeline(stages=[StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                            LogisticRegression(maxIter=40, regParam=0.05, family="multinomial")])
    train = e.where("split = 'train'")
    model = ml.save_and_load(pipe.fit(train), scratch_path(spark, "pipeline-model"))
    s = model.transform(e)
    p = vector_to_array("probability")
    top = F.array_max(p)
    labels = [str(int(r.label)) for r in train.select("label").distinct().orderBy("label").collect()]  # one per class
    every = [str(i) for i in range(int(max(map(int, labels))) + 1)]
    return labels, s.select("vec_id", F.col("prediction").cast("int").cast("string").alias("predicted"), top.alias("confidence"),
                 risk_score(top).alias("risk_score"), risk_level(risk_score(top)).alias("risk_level"),
                 ml.top_classes("probability", every, 3).alias("top3"))


@query("ml_batch_scores", None)
def ml_batch_scores(spark, sf):
    """The rows behind ``ml_batch_scoring``."""
    return scored_rows(spark, sf)[1]


@query("ml_batch_scoring", """
SELECT vec_id, true AS valid_label, true AS risk_follows_confidence, 3 AS n_top FROM embeddings""")
def ml_batch_scoring(spark, sf):
    """J6 + A17 + K13 + K14: one fitted pipeline (scaling + multinomial LR), fitted on the training
    split, saved, loaded and used to score every row: label, probability, risk score and level,
    top-3 classes; checked per row (a known label, the most probable one first, the risk
    score and level that its probability implies)."""
    labels, s = scored_rows(spark, sf)
    level = F.when(F.col("risk_score") >= 80, "Critical").when(F.col("risk_score") >= 50, "High").when(
        F.col("risk_score") >= 20, "Medium").otherwise("Low")
    return s.select(
        "vec_id", (F.col("predicted").isin(labels) & F.startswith("top3", F.concat("predicted", F.lit(" (")))).alias("valid_label"),
        ((F.col("risk_level") == level) & (F.abs(F.col("risk_score") - 100 * F.col("confidence")) <= 0.0501)).alias("risk_follows_confidence"),
        F.size(F.split("top3", ", ")).alias("n_top"))


@query("ml_group_profile_clusters", """
SELECT c_custkey, c_nationkey, true AS has_cluster FROM customer""")
def ml_group_profile_clusters(spark, sf):
    """Per-group statistics (customers by nation) -> scaling -> KMeans(5) -> cluster id
    used as a feature for every customer; unseen groups get -1."""
    c = read_table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    g = c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("m"), F.stddev_samp("c_acctbal").alias("s"),
                                     F.count(F.lit(1)).alias("n"))
    x = VectorAssembler(inputCols=["m", "s", "n"], outputCol="raw", handleInvalid="keep").transform(g.fillna(0.0, ["s"]))
    x = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(x).transform(x)
    cl = KMeans(k=5, seed=42).fit(x).transform(x).select("c_nationkey", F.col("prediction").alias("nation_cluster"))
    # One row per group: left to the runtime size check, a group table may be large.
    return c.join(cl, "c_nationkey", "left").fillna(-1, ["nation_cluster"]) \
            .select("c_custkey", "c_nationkey", F.col("nation_cluster").between(0, 4).alias("has_cluster"))


_SCALED = ("n_orders", "spend", "c_acctbal")


def _scaled_sql(c: str) -> str:
    return f"""({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS standard_{c},
  ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS minmax_{c},
  ({c} - quantile_cont({c}::DOUBLE, 0.5) OVER ()) / (quantile_cont({c}::DOUBLE, 0.75) OVER () - quantile_cont({c}::DOUBLE, 0.25) OVER ()) AS robust_{c}"""


@query("scaled_customer_features", f"""
WITH {CUST_SQL}
SELECT c_custkey, {", ".join(map(_scaled_sql, _SCALED))} FROM cs""",
       floats=tuple(f"{k}_{c}" for k in ("standard", "minmax", "robust") for c in _SCALED))
def scaled_customer_features(spark, sf):
    """Standard, min-max and robust scaling of the customer statistics, every value."""
    cs = materialize(cust_stats(spark, sf).select("c_custkey", *_SCALED))
    out = ml.scale(cs, ml.fit_scalers(cs, _SCALED))
    return out.select("c_custkey", *[f"{k}_{c}" for c in _SCALED for k in ("standard", "minmax", "robust")])
