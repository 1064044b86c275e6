"""Feature transformers, clustering and supervised models on Spark ML.

Estimators are Spark ML (distributed, JVM); the helpers here only wire pipelines,
folds and tables.  Metrics reuse ``operators.evaluation`` (exact curves) rather than
binned evaluator shortcuts.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (MinMaxScaler, OneHotEncoder, PCA, RobustScaler, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import sequence_index, stable_hash
from .quantiles import quantile_values


def column_transformer(categorical: Sequence[str], numeric: Sequence[str], out: str = "features",
                       scale: str | None = "standard") -> Pipeline:
    """One-hot categoricals (unseen -> extra all-zero slot via handleInvalid
    "keep") + scaled numerics, fitted on train only; test rows are aligned to the train
    categories by construction."""
    stages = []
    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep", dropLast=False))
    stages.append(VectorAssembler(inputCols=list(numeric), outputCol="__num", handleInvalid="keep"))
    if scale:
        sc = {"standard": StandardScaler(inputCol="__num", outputCol="__nums", withMean=True, withStd=True),
              "minmax": MinMaxScaler(inputCol="__num", outputCol="__nums"),
              "robust": RobustScaler(inputCol="__num", outputCol="__nums")}[scale]
        stages.append(sc)
        num_col = "__nums"
    else:
        num_col = "__num"
    stages.append(VectorAssembler(inputCols=[*ohe, num_col], outputCol=out))
    return Pipeline(stages=stages)


def pca_variance(df: DataFrame, features: str, k: int = 2) -> tuple[DataFrame, list[float]]:
    """Centre (sklearn centres, Spark PCA does not), then PCA(k); returns the
    projected rows and the explained-variance ratios."""
    centred = StandardScaler(inputCol=features, outputCol="__c", withMean=True, withStd=False).fit(df).transform(df)
    model = PCA(k=k, inputCol="__c", outputCol="pca").fit(centred)
    return model.transform(centred).drop("__c"), [float(x) for x in model.explainedVariance]


def kmeans_search(df: DataFrame, features: str, ks: Sequence[int], seed: int = 42) -> list[dict]:
    """Inertia (training cost) and silhouette for each k (Spark's silhouette uses
    squared euclidean distance; compare orderings, not values, with sklearn)."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol="prediction")
    out = []
    for k in ks:
        m = KMeans(k=k, seed=seed, featuresCol=features).fit(df)
        out.append({"k": k, "inertia": float(m.summary.trainingCost), "silhouette": float(ev.evaluate(m.transform(df)))})
    return out


def name_clusters_by_rank(profile: DataFrame, cluster: str, r: str, f: str, m: str, names: Sequence[str]) -> DataFrame:
    """score = rank(M) + rank(F) - rank(R) (average ranks over the k cluster rows),
    clusters named by descending score.  The window spans k rows only."""
    def avg_rank(c):
        w = Window.orderBy(c)
        wt = Window.partitionBy(c)
        return F.rank().over(w) + (F.count(F.lit(1)).over(wt) - 1) / 2.0
    p = profile.withColumn("_score", avg_rank(m) + avg_rank(f) - avg_rank(r))
    p = p.withColumn("_pos", F.row_number().over(Window.orderBy(F.desc("_score"), cluster)))
    arr = F.array(*[F.lit(n) for n in names])
    return p.withColumn("segment", F.coalesce(F.element_at(arr, F.col("_pos").cast("int")), F.lit("Other"))) \
            .drop("_score", "_pos")


def greedy_unique_names(profile_rows: list[dict], dims: dict[str, tuple[str, str]], default: str) -> dict:
    """On the k profile rows (driver side, k small): repeatedly give the most extreme
    remaining (cluster, dimension) its dimension's name; leftovers get ``default``."""
    remaining = {r["cluster"]: r for r in profile_rows}
    names, used = {}, set()
    while remaining and len(used) < len(dims):
        best = None
        for cid, row in remaining.items():
            for d, (hi_name, _) in dims.items():
                if d in used:
                    continue
                z = abs(row[d])
                if best is None or z > best[0]:
                    best = (z, cid, d, hi_name if row[d] >= 0 else dims[d][1])
        _, cid, d, nm = best
        names[cid] = nm
        used.add(d)
        remaining.pop(cid)
    for cid in remaining:
        names[cid] = default
    return names


def fit_scalers(train: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, tuple[float, float]]]:
    """(offset, width) per kind and column from the training rows: ``standard`` (mean, population
    deviation), ``minmax`` (least, range) and ``robust`` (median, interquartile range, both
    exact); a width of 0 counts as 1.  One row per column comes to the driver."""
    agg = train.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (
        ("mean", F.avg), ("sd", F.stddev_pop), ("lo", F.min), ("hi", F.max))]).first()
    q = quantile_values(train, cols, [0.25, 0.5, 0.75])
    pair = lambda a, w: (float(a or 0.0), float(w or 0.0) or 1.0)
    return {"standard": {c: pair(agg[f"mean_{c}"], agg[f"sd_{c}"]) for c in cols},
            "minmax": {c: pair(agg[f"lo_{c}"], (agg[f"hi_{c}"] or 0) - (agg[f"lo_{c}"] or 0)) for c in cols},
            "robust": {c: pair(q[c][1], (q[c][2] or 0) - (q[c][0] or 0)) for c in cols}}


def scale(df: DataFrame, scalers: dict[str, dict[str, tuple[float, float]]]) -> DataFrame:
    """``<kind>_<column>`` for every fitted scaler."""
    return df.withColumns({f"{kind}_{c}": (F.col(c) - F.lit(a)) / F.lit(w) for kind, cols in scalers.items() for c, (a, w) in cols.items()})


def without_attributes(df: DataFrame, features: str) -> DataFrame:
    """``features`` without the names of its attributes, one per term after ``CountVectorizer`` and
    ``VectorAssembler``: the schema that carries them travels with every task of every pass of a fit."""
    return df.withColumn(features, F.col(features).alias(features, metadata={}))


def sample_param_grid(grid: list, n: int, seed: int = 42) -> list:
    """K9: a seeded random subset of a ``ParamGridBuilder`` grid (random search); the
    grid is a small driver-side list of parameter maps."""
    import random
    idx = sorted(random.Random(seed).sample(range(len(grid)), min(n, len(grid))))
    return [grid[i] for i in idx]


def fold_column(df: DataFrame, label: str | None, key: str, k: int, seed: int = 42) -> DataFrame:
    """Stratified fold ids from a seeded hash order (I2) for ``CrossValidator(foldCol)``."""
    d = df.withColumn("_h", stable_hash(seed, key))
    idx = sequence_index(d, ["_h", key], [label] if label else [], "_p")
    return idx.withColumn("fold", ((F.col("_p") - 1) % k).cast("int")).drop("_h", "_p")


def out_of_fold(df: DataFrame, estimator, fold_col: str, k: int, keep: Sequence[str]) -> DataFrame:
    """Held-out predictions for every row (fit on the other folds)."""
    parts = []
    for i in range(k):
        model = estimator.fit(df.filter(F.col(fold_col) != i))
        parts.append(model.transform(df.filter(F.col(fold_col) == i)).select(*keep, "prediction"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def predicted(df: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """``df`` with every model's prediction in the column of its name, in one pass over the rows."""
    for name, model in models.items():
        df = model.transform(df, {model.predictionCol: name})
    return df


def out_of_fold_with_test(df: DataFrame, test: DataFrame, estimator, fold_col: str, k: int, keep: Sequence[str],
                          keep_test: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Held-out predictions for every row of ``df``, and for every row of ``test`` the mean
    prediction of the k fold models (``keep_test`` must identify a test row).

    ``estimator`` is one estimator (column ``prediction``) or a mapping of column names to estimators.  All
    models of a fold score a row where it is, and so do those of all folds for a test row: nothing is
    joined or grouped."""
    named = estimator if isinstance(estimator, Mapping) else {"prediction": estimator}
    folds = [{name: est.fit(df.filter(F.col(fold_col) != i)) for name, est in named.items()} for i in range(k)]
    parts = [predicted(df.filter(F.col(fold_col) == i), models).select(*keep, *named) for i, models in enumerate(folds)]
    held = predicted(test, {f"_{name}_{i}": m for i, models in enumerate(folds) for name, m in models.items()})
    mean = [(reduce(Column.__add__, [F.col(f"_{name}_{i}") for i in range(k)]) / k).alias(name) for name in named]
    return reduce(DataFrame.unionByName, parts), held.select(*keep_test, *mean)


def top_classes(prob_col: str, labels: Sequence[str], k: int = 3):
    """K14: "label (p), ..." for the k most probable classes of a probability vector."""
    arr = vector_to_array(F.col(prob_col))
    pairs = F.transform(F.sequence(F.lit(1), F.size(arr)),
                        lambda i: F.struct(F.element_at(arr, i).alias("p"),
                                           F.element_at(F.array(*[F.lit(x) for x in labels]), i).alias("label")))
    top = F.slice(F.reverse(F.array_sort(pairs)), 1, k)
    return F.array_join(F.transform(top, lambda s: F.concat(s["label"], F.lit(" ("),
                                                            F.format_number(s["p"], 3), F.lit(")"))), ", ")


def ranked_importances(values: Sequence[float], names: Sequence[str], spark) -> DataFrame:
    """Importances (or |coefficients|) as a ranked table."""
    rows = sorted(zip(names, [float(v) for v in values]), key=lambda t: (-abs(t[1]), t[0]))
    return spark.createDataFrame([(n, v, i + 1) for i, (n, v) in enumerate(rows)], "feature string, importance double, rank int")


def linear_contributions(df: DataFrame, id_col: str, features: Sequence[str], coefs: Sequence[float],
                         centre: dict | None = None) -> DataFrame:
    """Exact per-row contribution coefficient x (value - centre) for a linear model,
    long layout (id, feature, contribution); the coefficient list is bounded by the
    number of features."""
    centre = centre or {}
    arr = F.array(*[F.struct(F.lit(f).alias("feature"),
                             ((F.col(f) - F.lit(centre.get(f, 0.0))) * F.lit(float(c))).alias("contribution"))
                    for f, c in zip(features, coefs)])
    return df.select(id_col, F.inline(arr))


def permuted_columns(df: DataFrame, key: str, cols: Sequence[str], seed: int = 7) -> DataFrame:
    """K18 helper: add ``other_<col>``, the values of another row: rows ordered by two independent
    hash orders are paired by position (two range-partitioned indexes and an equi-join on the
    position), a permutation that is exact, reproducible and the same for every column."""
    a = sequence_index(df.withColumn("_h1", stable_hash(seed, key)), ["_h1", key], [], "_p").drop("_h1")
    b = sequence_index(df.select(key, *cols).withColumn("_h2", stable_hash(seed + 1, key)), ["_h2", key], [], "_p") \
        .select("_p", *[F.col(c).alias(f"other_{c}") for c in cols])
    return a.join(b, "_p").drop("_p")


def permuted_column(df: DataFrame, key: str, col: str, seed: int = 7) -> DataFrame:
    """K18 helper: replace ``col`` by the value of another row (``permuted_columns``)."""
    d = permuted_columns(df, key, [col], seed)
    return d.drop(col).withColumnRenamed(f"other_{col}", col)


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    """Fitted pipeline save / load."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
