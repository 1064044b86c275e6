"""Least-squares queries with oracles that compute the models: future value of customers (K2, K7,
K11, K12, K17) and direct forecasts of hourly series (F13, F14, F23)."""
from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..operators import linear as ln
from ..operators import ml
from ..operators import timeseries as ts
from ..operators.linear import Penalty
from ..session import materialize
from ..sources.tables import read_table
from .registry import query
from .timeseries import INTERP_SQL, hourly_filled

FEATURES = ["frequency", "monetary", "avg_value", "recency", "tenure"]

#: Customers with orders before the cutoff (12 months before the last order): features up to it,
#: log of the value of the 6 months after it; a quarter held out, the rest in five folds.
CLV_SQL = """
c AS (SELECT max(o_orderdate) - INTERVAL 12 MONTH AS cutoff FROM orders),
cal AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS frequency, sum(o_totalprice) AS monetary, avg(o_totalprice) AS avg_value,
               CAST(date_diff('day', max(o_orderdate), any_value(cutoff)) AS DOUBLE) AS recency,
               CAST(date_diff('day', min(o_orderdate), any_value(cutoff)) AS DOUBLE) AS tenure
        FROM orders, c WHERE o_orderdate < cutoff GROUP BY o_custkey),
hold AS (SELECT o_custkey, sum(o_totalprice) AS target FROM orders, c
         WHERE o_orderdate >= cutoff AND o_orderdate < cutoff + INTERVAL 6 MONTH GROUP BY o_custkey),
d AS (SELECT cal.*, coalesce(target, 0) AS target, ln(1 + coalesce(target, 0)) AS y, o_custkey % 4 = 0 AS is_test, o_custkey // 4 % 5 AS fold
      FROM cal LEFT JOIN hold USING (o_custkey))"""


def _list(items) -> str:
    return "[" + ", ".join(items) + "]"


def _moments_sql(source: str, keys: str, xs: list[str], y: str) -> str:
    """Correlations, scaled covariances with the target, deviations and means, per key."""
    corr = _list(_list("1.0" if a == b else f"corr({a}, {b})" for b in xs) for a in xs)
    return f"""SELECT {keys}, count(*) AS n, {corr} AS r, {_list(f'covar_pop({a}, {y}) / stddev_pop({a})' for a in xs)} AS ry,
  {_list(f'stddev_pop({a})' for a in xs)} AS s, {_list(f'avg({a})' for a in xs)} AS m, avg({y}) AS my FROM {source} GROUP BY ALL"""


def _solve_sql(name: str, source: str, keys: str, p: int) -> str:
    """``name``: standardised coefficients g by elimination, of rows with r, ry, alpha."""
    return f"""{name}_steps AS (
  WITH RECURSIVE e AS (
    SELECT {keys}, 1 AS k, list_transform(r, lambda row, i: list_append(list_transform(row, lambda v, j: CASE WHEN i = j THEN v + alpha ELSE v END), ry[i])) AS a
    FROM {source}
    UNION ALL
    SELECT {keys}, k + 1, list_transform(a, lambda row, i: CASE WHEN i = k THEN list_transform(row, lambda v: v / row[k])
      ELSE list_transform(row, lambda v, j: v - row[k] * a[k][j] / a[k][k]) END) FROM e WHERE k <= {p})
  SELECT {keys}, a FROM e WHERE k = {p + 1}),
{name} AS (SELECT {keys}, list_transform(a, lambda row: row[{p + 1}]) AS g FROM {name}_steps)"""


def _descent_sql(name: str, source: str, keys: str, p: int, sweeps: int = 200) -> str:
    """``name``: standardised coefficients g by coordinate descent, of rows with r, ry, alpha, l1."""
    part = "(ry[i] - list_dot_product(r[i], g) + r[i][i] * g[i])"
    return f"""{name} AS (
  WITH RECURSIVE e AS (
    SELECT {keys}, 0 AS k, {_list(['0.0::DOUBLE'] * p)} AS g, r, ry, alpha, l1 FROM {source}
    UNION ALL
    SELECT {keys}, k + 1, list_transform(g, lambda v, i: CASE WHEN i = k % {p} + 1
      THEN sign({part}) * greatest(abs({part}) - alpha * l1, 0.0) / (r[i][i] + alpha * (1 - l1)) ELSE v END), r, ry, alpha, l1
    FROM e WHERE k < {sweeps * p})
  SELECT {keys}, g FROM e WHERE k = {sweeps * p})"""


MODELS = {"linear": Penalty(), "ridge": Penalty(0.1), "lasso": Penalty(0.02, 1.0), "elastic_net": Penalty(0.02, 0.5)}
_MODELS_SQL = "models AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', {p.alpha}::DOUBLE, {p.l1}::DOUBLE)" for n, p in MODELS.items()) + ") AS t(model, alpha, l1))"

#: Coefficients per model, fitted on all training rows.
_WHOLE_SQL = f"""{CLV_SQL}, {_MODELS_SQL},
mom AS ({_moments_sql("(SELECT * FROM d WHERE NOT is_test)", "1 AS one", FEATURES, "y")}),
task AS (SELECT * FROM mom, models),
{_solve_sql("exact", "(SELECT * FROM task WHERE l1 = 0)", "model", 5)},
{_descent_sql("sparse", "(SELECT * FROM task WHERE l1 > 0)", "model", 5)},
coef AS (SELECT model, g, list_transform(g, lambda v, i: v / s[i]) AS b, n, m, my
         FROM (SELECT * FROM exact UNION ALL SELECT * FROM sparse), mom)"""


def clv_table(spark, sf):
    """The supervised set: a row per customer of the calibration window."""
    o = read_table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    cutoff = o.select(F.add_months(F.max("o_orderdate"), -12).cast("timestamp_ntz")).scalar()
    cal = o.filter(F.col("o_orderdate") < cutoff).groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("frequency"), F.sum("o_totalprice").alias("monetary"), F.avg("o_totalprice").alias("avg_value"),
        F.max("o_orderdate").alias("last"), F.min("o_orderdate").alias("first"))
    hold = o.filter((F.col("o_orderdate") >= cutoff) & (F.col("o_orderdate") < F.add_months(cutoff, 6).cast("timestamp_ntz"))).groupBy(
        "o_custkey").agg(F.sum("o_totalprice").alias("target"))
    d = cal.join(hold, "o_custkey", "left").fillna(0.0, ["target"])
    return materialize(d.select(
        "o_custkey", "frequency", "monetary", "avg_value", F.datediff(cutoff, "last").cast("double").alias("recency"),
        F.datediff(cutoff, "first").cast("double").alias("tenure"), "target", F.log1p("target").alias("y"),
        (F.col("o_custkey") % 4 == 0).alias("is_test"), F.floor(F.col("o_custkey") / 4 % 5).cast("long").alias("fold")))


@query("linear_models", f"""
WITH {_WHOLE_SQL},
p AS (SELECT model, y, my - list_dot_product(b, m) + list_dot_product(b, {_list(FEATURES)}) AS yhat FROM d, coef WHERE is_test),
e AS (SELECT model, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae FROM p GROUP BY model)
SELECT model, n AS n_train, {", ".join(f"round(b[{i + 1}] * s[{i + 1}], 6) AS std_{f}" for i, f in enumerate(FEATURES))},
       round(my - list_dot_product(b, m), 6) AS intercept, round(rmse, 6) AS rmse, round(mae, 6) AS mae
FROM coef JOIN e USING (model), (SELECT s FROM mom)""")
def linear_models(spark, sf):
    """K2: least squares, ridge, lasso and elastic net on the customers' future value, from one
    aggregate of sums: standardised coefficients, intercept, and errors on the held-out quarter."""
    d = clv_table(spark, sf)
    train, test = d.where("not is_test"), d.where("is_test")
    m = ln.moments(train, FEATURES, "y")
    sd = train.agg(*[F.stddev_pop(c).alias(c) for c in FEATURES]).first()
    out = None
    for name, penalty in MODELS.items():
        model = ln.fit(m, penalty)
        err = ln.predict(test, model, FEATURES).select((F.col("y") - F.col("prediction")).alias("e")).agg(
            F.round(F.sqrt(F.avg(F.col("e") * F.col("e"))), 6).alias("rmse"), F.round(F.avg(F.abs("e")), 6).alias("mae")).first()
        row = model.select(F.lit(name).alias("model"), F.col("n").alias("n_train"), *[
            F.round(F.col("coef")[i] * sd[f], 6).alias(f"std_{f}") for i, f in enumerate(FEATURES)],
            F.round("intercept", 6).alias("intercept"), F.lit(err["rmse"]).alias("rmse"), F.lit(err["mae"]).alias("mae"))
        out = row if out is None else out.unionByName(row)
    return out


@query("linear_row_contributions", f"""
WITH {_WHOLE_SQL}
SELECT o_custkey, unnest({_list(f"'{f}'" for f in FEATURES)}) AS feature,
       unnest({_list(f"round(b[{i + 1}] * ({f} - m[{i + 1}]), 6)" for i, f in enumerate(FEATURES))}) AS contribution
FROM d, coef WHERE is_test AND model = 'ridge'""")
def linear_row_contributions(spark, sf):
    """Contribution of every feature to every held-out customer's prediction (coefficient x
    distance from the training mean); a row's contributions add up to its prediction minus the mean one."""
    d = clv_table(spark, sf)
    train = d.where("not is_test")
    model = ln.fit(ln.moments(train, FEATURES, "y"), MODELS["ridge"]).first()
    means = train.agg(*[F.avg(c).alias(c) for c in FEATURES]).first().asDict()
    return ml.linear_contributions(d.where("is_test"), "o_custkey", FEATURES, model["coef"], means).withColumn(
        "contribution", F.round("contribution", 6))


#: Base models of the stack: features and penalty.
BASES = {"linear": (FEATURES, Penalty()), "ridge": (FEATURES, Penalty(0.1)), "strong_ridge": (FEATURES, Penalty(1.0)),
         "lasso": (FEATURES, Penalty(0.02, 1.0)), "elastic_net": (FEATURES, Penalty(0.02, 0.5)),
         "activity": (["frequency", "recency"], Penalty()), "money": (["monetary", "avg_value"], Penalty())}
META = Penalty(0.1)


def _bases_sql() -> str:
    rows = ", ".join(f"('{n}', {p.alpha}::DOUBLE, {p.l1}::DOUBLE, {_list('1.0' if f in fs else '0.0' for f in FEATURES)})"
                     for n, (fs, p) in BASES.items())
    return f"bases AS (SELECT * FROM (VALUES {rows}) AS t(model, alpha, l1, used))"


_STACK_SQL = f"""{CLV_SQL}, {_bases_sql()},
mom AS ({_moments_sql("(SELECT f, d.* FROM d, range(5) AS r(f) WHERE NOT is_test AND fold <> f)", "f", FEATURES, "y")}),
task AS (SELECT f, model, alpha, l1, s, m, my,
  list_transform(r, lambda row, i: list_transform(row, lambda v, j: CASE WHEN i = j THEN v ELSE v * used[i] * used[j] END)) AS r,
  list_transform(ry, lambda v, i: v * used[i]) AS ry FROM mom, bases),
{_solve_sql("exact", "(SELECT * FROM task WHERE l1 = 0)", "f, model", 5)},
{_descent_sql("sparse", "(SELECT * FROM task WHERE l1 > 0)", "f, model", 5)},
coef AS (SELECT f, model, list_transform(g, lambda v, i: v / s[i]) AS b, m, my
         FROM (SELECT * FROM exact UNION ALL SELECT * FROM sparse) JOIN mom USING (f)),
each AS (SELECT o_custkey, y, is_test, fold, f, model, my - list_dot_product(b, m) + list_dot_product(b, {_list(FEATURES)}) AS p
         FROM d JOIN coef ON is_test OR f = fold),
mean AS (SELECT o_custkey, y, is_test, fold, model, avg(p) AS p FROM each GROUP BY ALL),
wide AS (SELECT o_custkey, y, is_test, fold, {", ".join(f"max(p) FILTER (model = '{b}') AS p_{b}" for b in BASES)} FROM mean GROUP BY ALL),
top AS (SELECT *, {META.alpha}::DOUBLE AS alpha FROM ({_moments_sql("(SELECT * FROM wide WHERE NOT is_test)", "1 AS one", [f"p_{b}" for b in BASES], "y")})),
{_solve_sql("final", "top", "one", len(BASES))},
w AS (SELECT list_transform(g, lambda v, i: v / s[i]) AS b, m, my FROM final, top),
stacked AS (SELECT wide.*, my - list_dot_product(b, m) + list_dot_product(b, {_list(f"p_{b}" for b in BASES)}) AS prediction FROM wide, w)"""


def stacked_clv(spark, sf):
    d = clv_table(spark, sf)
    return ln.stack(d.where("not is_test"), d.where("is_test"), "fold", "y", BASES, META)


@query("linear_stack_predictions", f"""
WITH {_STACK_SQL}
SELECT o_custkey, is_test, CASE WHEN NOT is_test THEN fold END AS fold, {", ".join(f"round(p_{b}, 6) AS p_{b}" for b in BASES)}, round(prediction, 6) AS prediction
FROM stacked""")
def linear_stack_predictions(spark, sf):
    """K11 + K12: seven base models' out-of-fold predictions of every training customer, their fold
    models' mean for the held-out ones, and the ridge model stacked on them."""
    train, held, _ = stacked_clv(spark, sf)
    cols = [F.round(f"p_{b}", 6).alias(f"p_{b}") for b in BASES] + [F.round("prediction", 6).alias("prediction")]
    return train.select("o_custkey", "is_test", "fold", *cols).unionByName(
        held.select("o_custkey", "is_test", F.lit(None).cast("long").alias("fold"), *cols))


@query("linear_stack_scores", f"""
WITH {_STACK_SQL},
long AS (SELECT is_test, y, unnest({_list([f"'{b}'" for b in BASES] + ["'stack'"])}) AS model,
                unnest({_list([f"p_{b}" for b in BASES] + ["prediction"])}) AS p FROM stacked)
SELECT model, is_test, count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae FROM long GROUP BY ALL""")
def linear_stack_scores(spark, sf):
    """K10 + K12 + L12: errors of every base model and of the stack, out of fold and held out."""
    train, held, _ = stacked_clv(spark, sf)
    both = train.unionByName(held)
    long = both.select("is_test", "y", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(c).alias("p")) for n, c in [*((b, f"p_{b}") for b in BASES), ("stack", "prediction")]])))
    e = F.col("y") - F.col("p")
    return long.groupBy("model", "is_test").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"), F.round(F.avg(F.abs(e)), 6).alias("mae"))


def compare_clv_models(d, seed: int = 42):
    """K7: (model, rmse, mae, r2, chosen) on the original scale for three regressors of log(1 + value):
    random forest, boosted trees and ridge.  K15: chosen is the least RMSE, then the
    least MAE, then the first name.  ``d`` has FEATURES, target, y and is_test."""
    v = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(d)
    train, test = v.where("not is_test"), v.where("is_test")
    predicted = {
        "random_forest": RandomForestRegressor(labelCol="y", numTrees=60, maxDepth=8, seed=seed).fit(train).transform(test),
        "boosted_trees": GBTRegressor(labelCol="y", maxIter=40, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, seed=seed).fit(train).transform(test),
        "ridge": ln.predict(test, ln.fit(ln.moments(train, FEATURES, "y"), MODELS["ridge"]), FEATURES)}
    rows = []
    for name, p in predicted.items():
        p = p.withColumn("value", F.greatest(F.expm1("prediction"), F.lit(0.0)))
        s = ev.regression_metrics(p, "target", "value").first()
        rows.append((name, s["rmse"], s["mae"], s["r2"]))
    best = min(rows, key=lambda r: (r[1], r[2], r[0]))
    return d.sparkSession.createDataFrame([(*r, r is best) for r in rows], "model string, rmse double, mae double, r2 double, chosen boolean")


@query("clv_model_comparison", None)
def clv_model_comparison(spark, sf):
    """K7 + K15: three models of the customers' value in the next six months, and the one chosen."""
    return compare_clv_models(clv_table(spark, sf))


HORIZONS = (24, 48, 168)
LAGS = ["last", "before_last", "day_ago", "mean_day", "hour_sin", "hour_cos"]

FORECAST_SQL = INTERP_SQL + f""",
o AS (SELECT event_type, pos, bucket, count(*) OVER (PARTITION BY event_type) AS n,
        list(value) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS history FROM x),
f AS (SELECT event_type, pos, n, history[24] AS last, history[23] AS before_last, history[1] AS day_ago, list_avg(history) AS mean_day,
             sin({2 * math.pi!r} * hour(bucket) / 24) AS hour_sin, cos({2 * math.pi!r} * hour(bucket) / 24) AS hour_cos
      FROM o WHERE len(history) = 24),
w AS (SELECT f.*, h AS horizon, CASE WHEN pos + h - 1 <= n * 7 // 10 THEN 'train' WHEN pos > n * 7 // 10 THEN 'test' END AS split
      FROM f, (VALUES {", ".join(f"({h})" for h in HORIZONS)}) AS t(h) WHERE pos + h - 1 <= n),
t AS (SELECT w.*, x.pos - w.pos + 1 AS step, x.value AS y FROM w JOIN x ON x.event_type = w.event_type AND x.pos BETWEEN w.pos AND w.pos + w.horizon - 1
      WHERE split IS NOT NULL),
task AS (SELECT *, 0.0::DOUBLE AS alpha FROM ({_moments_sql("(SELECT * FROM t WHERE split = 'train')", "event_type, horizon, step", LAGS, "y")})),
{_solve_sql("exact", "task", "event_type, horizon, step", len(LAGS))},
coef AS (SELECT event_type, horizon, step, list_transform(g, lambda v, i: v / s[i]) AS b, m, my FROM exact JOIN task USING (event_type, horizon, step))"""


def forecasts(spark, sf):
    """Models and test errors for every horizon."""
    base = hourly_filled(spark, sf)
    base = materialize(base.join(base.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "event_type"))
    angle = 2 * math.pi * F.hour("bucket") / 24
    models = scores = None
    for h in HORIZONS:
        w = ts.history_windows(base, "event_type", "pos", "value", 24, h)
        cut = F.expr("n * 7 div 10")
        w = w.select("event_type", F.element_at("history", 24).alias("last"), F.element_at("history", 23).alias("before_last"),
                     F.element_at("history", 1).alias("day_ago"), (ln.dot(F.col("history"), F.array_repeat(F.lit(1.0), 24)) / 24).alias("mean_day"),
                     F.sin(angle).alias("hour_sin"), F.cos(angle).alias("hour_cos"), "future",
                     F.when(F.col("pos") + h - 1 <= cut, "train").when(F.col("pos") > cut, "test").alias("split"))
        model, score = ln.direct_forecast(materialize(w), ["event_type"], LAGS, "future", h, "split")
        model, score = (x.withColumn("horizon", F.lit(h)) for x in (model, score))
        models = model if models is None else models.unionByName(model)
        scores = score if scores is None else scores.unionByName(score)
    return models, scores


@query("direct_forecast_models", f"""
WITH {FORECAST_SQL}
SELECT event_type, CAST(horizon AS INTEGER) AS horizon, CAST(step AS INTEGER) AS step,
       {", ".join(f"round(b[{i + 1}], 6) AS b_{f}" for i, f in enumerate(LAGS))}, round(my - list_dot_product(b, m), 6) AS intercept FROM coef""")
def direct_forecast_models(spark, sf):
    """a linear model for each of the next 24, 48 and 168 hours of each series, from one shared
    matrix of products per series with a right-hand side per hour."""
    models, _ = forecasts(spark, sf)
    return models.select("event_type", "horizon", F.col("step").cast("int").alias("step"),
                         *[F.round(F.col("coef")[i], 6).alias(f"b_{f}") for i, f in enumerate(LAGS)], F.round("intercept", 6).alias("intercept"))


@query("direct_forecast_errors", f"""
WITH {FORECAST_SQL},
e AS (SELECT event_type, horizon, step, y - (my - list_dot_product(b, m) + list_dot_product(b, {_list(LAGS)})) AS e
      FROM t JOIN coef USING (event_type, horizon, step) WHERE split = 'test')
SELECT event_type, CAST(horizon AS INTEGER) AS horizon, CAST(step AS INTEGER) AS step, count(*) AS n_test,
       round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae FROM e GROUP BY ALL""")
def direct_forecast_errors(spark, sf):
    """F14 + F23: error of the direct forecasts per lead time, on origins after the training part."""
    _, scores = forecasts(spark, sf)
    return scores.select("event_type", "horizon", F.col("step").cast("int").alias("step"), "n_test",
                         F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))
