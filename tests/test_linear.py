"""Least squares from sums, stacking and direct forecasts against numpy."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import linear as ln
from tessera.operators.linear import Penalty
from tessera.plans.linear import FEATURES, compare_clv_models

XS = ["a", "b", "c"]


def plain_fit(x, y, penalty, sweeps=200):
    """Standardised coordinate descent or normal equations; returns (intercept, coefficients)."""
    mean, sd = x.mean(0), x.std(0)
    z = (x - mean) / np.where(sd > 0, sd, 1)
    r, ry = z.T @ z / len(y), z.T @ (y - y.mean()) / len(y)
    if penalty.l1 == 0:
        g = np.linalg.solve(r + penalty.alpha * np.eye(len(r)), ry)
    else:
        g = np.zeros(len(r))
        for _ in range(sweeps):
            for j in range(len(g)):
                part = ry[j] - r[j] @ g + r[j, j] * g[j]
                g[j] = np.sign(part) * max(abs(part) - penalty.alpha * penalty.l1, 0) / (r[j, j] + penalty.alpha * (1 - penalty.l1))
    coef = g / np.where(sd > 0, sd, 1)
    return y.mean() - coef @ mean, coef


def rows(n=120, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 50, 0.01] + [1e6, -3, 0]
    y = 2 * x[:, 0] - 0.1 * x[:, 1] + 30 * x[:, 2] + rng.normal(size=n)
    return x, y


def frame(spark, x, y, **more):
    cols = [*map(list, x.T), list(map(float, y)), *more.values()]
    return spark.createDataFrame([tuple(v.item() if hasattr(v, "item") else v for v in r) for r in zip(*cols)], [*XS, "y", *more])


@pytest.mark.parametrize("penalty", [Penalty(), Penalty(0.3), Penalty(0.05, 1.0), Penalty(0.1, 0.4)])
def test_fits_by_definition(spark, penalty):
    x, y = rows()
    group = [i % 2 for i in range(len(y))]
    df = frame(spark, x, y, g=group)
    extra = spark.createDataFrame([(None, 1.0, 1.0, 1.0, 0), (float("nan"), 1.0, 1.0, 1.0, 1), (1.0, 1.0, 1.0, None, 1)], df.schema)
    for r in ln.fit(ln.moments(df.unionByName(extra), XS, "y", ["g"]), penalty).collect():
        at = np.array(group) == r.g
        b, w = plain_fit(x[at], y[at], penalty)
        assert r.n == at.sum() and np.allclose(r.coef, w, rtol=1e-6) and np.isclose(r.intercept, b, rtol=1e-6)


def test_constant_and_explained_features_get_nothing(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=60)
    x = np.stack([a, np.full(60, 7.0), 2 * a - 1], 1)
    model = ln.fit(ln.moments(frame(spark, x, 3 * a + 5), XS, "y")).first()
    assert np.allclose(model.coef, [3, 0, 0], atol=1e-6) and np.isclose(model.intercept, 5)
    assert ln.fit(ln.moments(frame(spark, x, a, g=[0] * 60).where("a > 1e9"), XS, "y", ["g"])).count() == 0


def test_other_folds_from_totals(spark):
    x, y = rows(90, 4)
    fold = [i % 3 for i in range(90)]
    m = ln.moments(frame(spark, x, y, fold=fold), XS, "y", ["fold"])
    for r in ln.fit(ln.without_each(m, "fold")).collect():
        at = np.array(fold) != r.fold
        b, w = plain_fit(x[at], y[at], Penalty())
        assert r.n == at.sum() and np.allclose(r.coef, w, rtol=1e-6) and np.isclose(r.intercept, b, rtol=1e-6)
    whole = ln.fit(ln.total(m)).first()
    assert np.allclose(whole.coef, plain_fit(x, y, Penalty())[1], rtol=1e-6)
    some = ln.fit(ln.only(ln.total(m), ["c", "a"])).first()
    assert np.allclose(some.coef, plain_fit(x[:, [2, 0]], y, Penalty())[1], rtol=1e-6)


def test_stack_sees_no_row_it_predicts(spark):
    x, y = rows(100, 5)
    fold = np.arange(100) % 4
    tx, ty = rows(20, 6)
    bases = {"all": (XS, Penalty()), "ridge": (XS, Penalty(0.2)), "one": (["b"], Penalty())}
    train, test, final = ln.stack(frame(spark, x, y, fold=list(fold), id=list(range(100))), frame(spark, tx, ty, id=list(range(20))),
                                  "fold", "y", bases, Penalty(0.1))
    oof, held = {}, {}
    for name, (fs, p) in bases.items():
        at = [XS.index(f) for f in fs]
        fits = [plain_fit(x[fold != f][:, at], y[fold != f], p) for f in range(4)]
        oof[name] = np.array([fits[f][0] + x[i, at] @ fits[f][1] for i, f in enumerate(fold)])
        held[name] = np.mean([b + tx[:, at] @ w for b, w in fits], 0)
    b, w = plain_fit(np.stack(list(oof.values()), 1), y, Penalty(0.1))
    got = {r.id: r for r in train.collect()}
    assert all(np.isclose(got[i][f"p_{n}"], oof[n][i], rtol=1e-9) for i in got for n in bases)
    assert np.allclose([got[i].prediction for i in range(100)], b + np.stack(list(oof.values()), 1) @ w, rtol=1e-6)
    out = {r.id: r for r in test.collect()}
    assert np.allclose([out[i].prediction for i in range(20)], b + np.stack(list(held.values()), 1) @ w, rtol=1e-6)


def test_direct_forecasts_by_step(spark):
    rng = np.random.default_rng(8)
    out = []
    for s in ("u", "v"):
        for t in range(60):
            f = rng.normal(size=3)
            out.append((s, *map(float, f), [float(f @ [1, 2, k] + k + rng.normal() * .1) for k in range(5)], "train" if t < 40 else "test"))
    df = spark.createDataFrame(out + [("u", None, 1.0, 1.0, [0.0] * 5, "train")], "s string, a double, b double, c double, future array<double>, split string")
    model, errors = ln.direct_forecast(df, ["s"], XS, "future", 5, "split")
    got = {(r.s, r.step): r for r in model.collect()}
    err = {(r.s, r.step): r for r in errors.collect()}
    assert set(got) == set(err) == {(s, k) for s in "uv" for k in range(1, 6)}
    for (s, k), r in got.items():
        tr = [o for o in out if o[0] == s and o[5] == "train"]
        te = [o for o in out if o[0] == s and o[5] == "test"]
        b, w = plain_fit(np.array([o[1:4] for o in tr]), np.array([o[4][k - 1] for o in tr]), Penalty())
        assert np.allclose(r.coef, w) and np.isclose(r.intercept, b)
        e = np.array([o[4][k - 1] - b - np.array(o[1:4]) @ w for o in te])
        assert err[s, k].n_test == 20 and np.isclose(err[s, k].rmse, np.sqrt((e ** 2).mean())) and np.isclose(err[s, k].mae, np.abs(e).mean())


def test_value_models_find_signal(spark):
    rng = np.random.default_rng(9)
    rows_ = []
    for i in range(400):
        f = rng.uniform(0, 1, 5)
        y = 2 + 3 * f[0] + 2 * f[3]
        rows_.append((*map(float, f), float(np.expm1(y)), float(y), i % 4 == 0))
    got = {r.model: r for r in compare_clv_models(spark.createDataFrame(rows_, [*FEATURES, "target", "y", "is_test"])).collect()}
    assert set(got) == {"random_forest", "boosted_trees", "ridge"} and all(r.r2 > 0.6 for r in got.values())
    best = min(got.values(), key=lambda r: (r.rmse, r.mae, r.model))
    assert [r.model for r in got.values() if r.chosen] == [best.model]
