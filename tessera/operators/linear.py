"""Least squares from sufficient statistics.

A linear model needs only sums: rows, features, products of features, products with the
target.  ``moments`` takes them in one distributed aggregate per group, shifted by the overall means so
that nothing cancels; sums of groups are sums of sums, so the statistics of every
cross-validation training set are the totals minus one fold, without another pass.  Systems of p
equations are solved per group inside Spark (Gauss-Jordan, or coordinate descent for the
L1 penalty), so there may be as many groups - series, folds, steps - as the data has.

All fits standardise the features (population deviation) and minimise, over standardised
coefficients g with R the features' correlations and r their covariances with the target,

    g'Rg / 2 - r'g + alpha * (l1 * |g|_1 + (1 - l1) / 2 * |g|_2^2).
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

TOLERANCE = 1e-10


@dataclass(frozen=True)
class Penalty:
    """``alpha`` 0: plain least squares; ``l1`` 0: ridge, 1: lasso, else elastic net."""
    alpha: float = 0.0
    l1: float = 0.0


@dataclass(frozen=True)
class Moments:
    """Sums per group (``rows``: the group's columns, n, and one column per sum), and the means by
    which features and target were shifted."""
    rows: DataFrame
    by: tuple[str, ...]
    features: tuple[str, ...]
    shift: tuple[float, ...]
    target_shift: float

    @property
    def sums(self) -> list[str]:
        return [c for c in self.rows.columns if c not in self.by]


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def moments(df: DataFrame, features: Sequence[str], target: str, by: Sequence[str] = ()) -> Moments:
    """Statistics of the rows without null or NaN in a feature or the target, per group."""
    cols = [*features, target]
    whole = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    for c in cols:
        whole = whole.where(F.col(c).isNotNull() & ~F.isnan(c))
    m = whole.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = [float(x or 0.0) for x in m]
    x = [F.col(c) - F.lit(s) for c, s in zip(cols, shift)]
    y, p = x[-1], len(features)
    sums = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("y"), F.sum(y * y).alias("yy")]
    sums += [F.sum(x[i]).alias(f"x{i}") for i in range(p)] + [F.sum(x[i] * y).alias(f"x{i}y") for i in range(p)]
    sums += [F.sum(x[i] * x[j]).alias(f"x{i}x{j}") for i, j in _pairs(p)]
    return Moments(whole.groupBy(*by).agg(*sums), tuple(by), tuple(features), tuple(shift[:-1]), shift[-1])


def total(m: Moments, by: Sequence[str] = ()) -> Moments:
    """Statistics of larger groups: sums over the columns of ``by`` alone."""
    rows = m.rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in m.sums])
    return Moments(rows, tuple(by), m.features, m.shift, m.target_shift)


def without_each(m: Moments, fold: str) -> Moments:
    """For every fold the statistics of all other folds of its group: totals minus its own."""
    rest = [c for c in m.by if c != fold]
    whole = m.rows.groupBy(*rest).agg(*[F.sum(c).alias(f"all_{c}") for c in m.sums])
    if rest:
        joined = m.rows.join(whole, rest)
    else:  # one row of sums
        sums = whole.first()
        joined = m.rows.select("*", *[F.lit(sums[f"all_{c}"]).alias(f"all_{c}") for c in m.sums])
    rows = joined.select(*m.by, *[(F.col(f"all_{c}") - F.col(c)).alias(c) for c in m.sums])
    return Moments(rows, m.by, m.features, m.shift, m.target_shift)


def gauss_jordan(matrix: Column, p: int) -> Column:
    """Reduced rows of an augmented p x (p + 1) matrix with a unit diagonal to begin with.  A pivot
    that is all but 0 (a column that the ones before it explain) leaves its row 0."""
    def step(acc: Column, k: Column) -> Column:
        row = F.element_at(acc, k)
        pivot = F.element_at(row, k)
        scaled = F.transform(row, lambda v: F.when(F.abs(pivot) > TOLERANCE, v / pivot).otherwise(0.0))
        return F.transform(acc, lambda r, i: F.when(i + 1 == k, scaled).otherwise(
            F.zip_with(r, scaled, lambda u, v: u - F.element_at(r, k) * v)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(p)), matrix, step)


def coordinate_descent(r: Column, ry: Column, p: int, penalty: Penalty, sweeps: int) -> Column:
    """Standardised coefficients after ``sweeps`` rounds over all coordinates."""
    quadratic, linear = penalty.alpha * (1 - penalty.l1), penalty.alpha * penalty.l1

    def update(g: Column, s: Column) -> Column:
        j = F.pmod(s, F.lit(p)) + 1
        row = F.element_at(r, j)
        fit = F.aggregate(F.zip_with(row, g, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        part = F.element_at(ry, j) - fit + F.element_at(row, j) * F.element_at(g, j)
        size = F.element_at(row, j) + quadratic
        moved = F.when(size > TOLERANCE, F.signum(part) * F.greatest(F.abs(part) - linear, F.lit(0.0)) / size).otherwise(0.0)
        return F.transform(g, lambda v, i: F.when(i + 1 == j, moved).otherwise(v))

    return F.aggregate(F.sequence(F.lit(0), F.lit(sweeps * p - 1)), F.array_repeat(F.lit(0.0), p), update)


def fit(m: Moments, penalty: Penalty = Penalty(), sweeps: int = 200) -> DataFrame:
    """(group, n, intercept, coef): coefficients in the order of the features, per group.

    A feature that is constant in its group, or explained by those before it, gets 0; a
    group without rows gets null coefficients."""
    p, n = len(m.features), F.col("n")
    c = {}
    for i, j in _pairs(p):
        c[i, j] = c[j, i] = F.col(f"x{i}x{j}") / n - F.col(f"x{i}") / n * F.col(f"x{j}") / n
    sd = [F.sqrt(F.greatest(c[i, i], F.lit(0.0))) for i in range(p)]
    # A feature whose variance is rounding error alone counts as constant.
    flat = [sd[i] <= 1e-9 * F.sqrt(F.col(f"x{i}x{i}") / n + abs(s) ** 2) for i, s in enumerate(m.shift)]
    unit = m.rows.where(n > 0).select(*m.by, "n", F.array(*[F.when(f, 0.0).otherwise(s) for f, s in zip(flat, sd)]).alias("sd"), F.array(
        *[F.array(*[c[i, j] for j in range(p)]) for i in range(p)]).alias("c"),
        F.array(*[F.col(f"x{i}y") / n - F.col(f"x{i}") / n * F.col("y") / n for i in range(p)]).alias("cy"),
        F.array(*[F.lit(s) + F.col(f"x{i}") / n for i, s in enumerate(m.shift)]).alias("mean"),
        (F.lit(m.target_shift) + F.col("y") / n).alias("mean_y"))
    share = lambda v, d: F.when(d > 0, v / d).otherwise(0.0)
    unit = unit.withColumn("r", F.transform("c", lambda row, i: F.zip_with(row, "sd", lambda v, s: share(share(v, s), F.col("sd")[i]))))
    unit = unit.withColumn("ry", F.zip_with("cy", "sd", share))
    if penalty.l1 > 0 and penalty.alpha > 0:
        g = coordinate_descent(F.col("r"), F.col("ry"), p, penalty, sweeps)
    else:
        # Scaled to a unit diagonal again, so that the tolerance means the same with a penalty.
        d = 1.0 + penalty.alpha
        rows = F.transform("r", lambda row, i: F.concat(F.transform(row, lambda v, j: F.when(
            i == j, F.when(v > 0, F.lit(1.0)).otherwise(0.0)).otherwise(v / d)), F.array(F.col("ry")[i] / d)))
        g = F.transform(gauss_jordan(rows, p), lambda row: F.element_at(row, -1))
    out = unit.withColumn("coef", F.zip_with(g, "sd", share))
    return out.select(*m.by, "n", (F.col("mean_y") - dot(F.col("coef"), F.col("mean"))).alias("intercept"), "coef")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def predict(df: DataFrame, model: DataFrame, features: Sequence[str], by: Sequence[str] = (), out: str = "prediction") -> DataFrame:
    """``df`` with the prediction of its group's model (null where there is none).  Without
    groups the model is one row, read once."""
    value = array_of(features)
    if by:
        joined = df.join(model.select(*by, F.col("intercept").alias("_b"), F.col("coef").alias("_w")), list(by), "left")
        return joined.withColumn(out, F.col("_b") + dot(F.col("_w"), value)).drop("_b", "_w")
    row = model.select("intercept", "coef").first()
    if row is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    weights = F.array(*[F.lit(float(w)) for w in row["coef"]])
    return df.withColumn(out, F.lit(float(row["intercept"])) + dot(weights, value))


def array_of(features: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def only(m: Moments, features: Sequence[str]) -> Moments:
    """The statistics of some of the features: the same sums, without another pass."""
    at = [m.features.index(f) for f in features]
    pair = lambda i, j: f"x{min(i, j)}x{max(i, j)}"
    cols = [*m.by, "n", "y", "yy", *[F.col(f"x{i}").alias(f"x{k}") for k, i in enumerate(at)],
            *[F.col(f"x{i}y").alias(f"x{k}y") for k, i in enumerate(at)],
            *[F.col(pair(at[i], at[j])).alias(f"x{i}x{j}") for i, j in _pairs(len(at))]]
    return Moments(m.rows.select(*cols), m.by, tuple(features), tuple(m.shift[i] for i in at), m.target_shift)


def stack(train: DataFrame, test: DataFrame, fold: str, target: str, bases: dict[str, tuple[Sequence[str], Penalty]],
          meta: Penalty) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Out-of-fold predictions of every base model, and a model stacked on them.

    One pass over the training rows gives the statistics of every fold; each base (its features and
    penalty) is solved per fold from all other folds' sums.  A training row is predicted by
    the model that has not seen it, a test row by the mean of the folds' models.  The stacked
    model is fitted on the out-of-fold predictions.
    Returns (training rows, test rows, the stacked model); rows carry ``p_<base>`` and ``prediction``.
    """
    features = list(dict.fromkeys(f for fs, _ in bases.values() for f in fs))
    m = moments(train, features, target, [fold])
    others = without_each(replace(m, rows=materialize(m.rows)), fold)
    names = [f"p_{b}" for b in bases]
    models = None
    for name, (fs, penalty) in zip(names, bases.values()):
        one = fit(only(others, fs), penalty).select(F.col(fold).alias("_fold"), F.struct("intercept", "coef").alias(name))
        models = one if models is None else models.join(one, "_fold")
    models = materialize(models)  # a row per fold
    value = {name: array_of(fs) for name, (fs, _) in zip(names, bases.values())}
    train = train.join(models, F.col(fold) == F.col("_fold"), "left").drop("_fold").withColumns(
        {p: F.col(f"{p}.intercept") + dot(F.col(f"{p}.coef"), v) for p, v in value.items()})
    # The mean of linear models is the linear model of the mean coefficients.
    means = models.agg(*[F.avg(f"{p}.intercept").alias(f"b_{p}") for p in names], *[
        F.array(*[F.avg(F.col(f"{p}.coef")[i]) for i in range(len(fs))]).alias(f"w_{p}") for p, (fs, _) in zip(names, bases.values())]).first()
    for p, v in value.items():
        test = test.withColumn(p, F.lit(means[f"b_{p}"]) + dot(F.array(*[F.lit(w) for w in means[f"w_{p}"]]), v))
    train = materialize(train)
    final = materialize(fit(moments(train, names, target), meta))
    return predict(train, final, names), predict(test, final, names), final


def direct_forecast(windows: DataFrame, series: Sequence[str], features: Sequence[str], future: str, horizon: int,
                    split: str, penalty: Penalty = Penalty()) -> tuple[DataFrame, DataFrame]:
    """one linear model per series and step ahead, all steps from one pass over the windows.

    ``windows`` has a row per origin: features, the array ``future`` of ``horizon`` values, and
    ``split`` (train or test).  All steps of a series share the products of features, which are
    summed once; only the products with the target are summed per step.
    Returns (models per series and step, from 1; errors on the test rows per series and step).
    """
    windows = windows.dropna(subset=[*features, future])
    train = windows.where(F.col(split) == "train")
    shape = moments(train.withColumn("_y", F.lit(0.0)), features, "_y", series)
    p = len(features)
    x = [F.col(c).cast("double") - F.lit(s) for c, s in zip(features, shape.shift)]
    each = train.select(*series, *[v.alias(f"x{i}") for i, v in enumerate(x)], F.posexplode(future).alias("step", "y"))
    right = each.groupBy(*series, (F.col("step") + 1).alias("step")).agg(
        F.sum("y").alias("y"), F.sum(F.col("y") * F.col("y")).alias("yy"), *[F.sum(F.col(f"x{i}") * F.col("y")).alias(f"x{i}y") for i in range(p)])
    shared = shape.rows.drop("y", "yy", *[f"x{i}y" for i in range(p)])
    model = materialize(fit(Moments(right.join(shared, list(series)), (*series, "step"), shape.features, shape.shift, 0.0), penalty))
    # All steps of a series in one array, in order: the windows are not multiplied by their steps twice.
    lists = model.groupBy(*series).agg(F.sort_array(F.collect_list(F.struct("step", "intercept", "coef"))).alias("steps"))
    test = windows.where(F.col(split) == "test").join(lists, list(series))
    value = array_of(features)
    errors = test.select(*series, F.posexplode(F.zip_with(future, "steps", lambda y, s: y - (s["intercept"] + dot(s["coef"], value)))).alias("i", "e"))
    scores = errors.groupBy(*series, (F.col("i") + 1).alias("step")).agg(
        F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"), F.avg(F.abs("e")).alias("mae"))
    return model, scores
