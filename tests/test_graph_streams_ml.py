"""Components, clusters, rules of any size, streams over folders, caches, phases, folds."""
from __future__ import annotations

import math
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import knn, ml
from tessera.operators import recommend as rc
from tessera.operators.graph import connected_components
from tessera.plans import io as io_plans
from tessera.plans import ml as ml_plans
from tessera.sources import files as fs

SF = "/root/testdata/sf0.001"


def test_components_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(500 + i, 501 + i) for i in range(64)] + [(900, 900)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty).count() == 0


def test_dbscan_long_chain_is_one_cluster(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(200)], "id long, v array<double>")
    got = {r.cluster for r in knn.dbscan(df, "id", "v", 1.0, 2).collect()}
    assert got == {0}


def test_rules_of_any_size(spark):
    bk = spark.createDataFrame([(i, ["a", "b", "c", "d"]) for i in range(5)], "k long, items array<string>")
    assert rc.association_rules(bk, 0.5, 0.0).count() == 50
    assert rc.frequent_itemsets(bk, 0.5).where("size = 4").count() == 1


def test_smote_makes_as_many_as_needed(spark):
    rows = [(i, [float(i % 7), float(i % 3)], "a") for i in range(50)] + [(100 + i, [float(i), 1.0], "b") for i in range(8)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y string")
    out = knn.smote(df, "id", "v", "y", "b", k=3)
    per = {r["_s"]: r["count"] for r in out.groupBy(F.split("id", "-")[1].alias("_s")).count().collect()}
    assert out.count() == 42 and set(per.values()) == {5, 6} and out.select("id").distinct().count() == 42


def _rows(df):
    """Sorted rows; sums of doubles depend on their order in the last bits."""
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


def _folder(spark, tmp_path, parts):
    """``events`` as a folder of files, with some rows in a late order."""
    e = spark.read.parquet(f"{SF}/events.parquet")
    root = str(tmp_path / f"sf-{parts}")
    e.orderBy(F.xxhash64("event_id")).repartition(parts).write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("name", ["stream_event_rules", "stream_hourly_alerts", "stream_residual_anomalies"])
def test_streams_read_files_and_folders(spark, tmp_path, name):
    query = getattr(io_plans, name)
    one = _rows(query(spark, SF))
    if name == "stream_hourly_alerts":  # late rows beyond the watermark may be dropped, so feed time in order
        e = spark.read.parquet(f"{SF}/events.parquet")
        root = str(tmp_path / "ordered")
        for i, (lo, hi) in enumerate(((0, .25), (.25, .5), (.5, .75), (.75, 1.01))):
            bounds = e.selectExpr(f"percentile_approx(ts, {lo})", f"percentile_approx(ts, {min(hi, 1.0)})").first()
            part = e.where((F.col("ts") >= bounds[0]) & ((F.col("ts") < bounds[1]) if hi < 1 else F.lit(True)))
            part.coalesce(1).write.mode("append").parquet(f"{root}/events.parquet")
    else:
        root = _folder(spark, tmp_path, 4)
    assert _rows(query(spark, root)) == one


def test_catalogue_counts_folders(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(9).repartition(3).write.parquet(str(tmp_path / "b.parquet"))
    got = {r["table"]: r["files"] for r in io_plans.table_file_catalogue(spark, str(tmp_path)).collect()}
    assert set(got) == {"a", "b"} and got["b"] == 3


def test_cache_hit_and_other_errors(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    for _ in range(2):
        assert fs.cached_parquet(spark, str(tmp_path), {"k": 1}, build).count() == 3
    assert len(built) == 1
    path = next(p for p in tmp_path.iterdir())
    for f in path.glob("*.parquet"):
        f.write_bytes(b"no parquet")
    with pytest.raises(Exception) as e:
        fs.cached_parquet(spark, str(tmp_path), {"k": 1}, build)
    assert len(built) == 1 and not (isinstance(e.value, AnalysisException) and e.value.getCondition() == "PATH_NOT_FOUND")


def test_phase_slices(spark, tmp_path):
    ran = []

    def phase(name, f):
        def run(prev):
            ran.append(name)
            return f(prev)
        return name, run

    phases = [phase("a", lambda _: spark.range(4)), phase("b", lambda p: p.where("id > 1")), phase("c", lambda p: p.selectExpr("id * 10 AS id"))]
    assert fs.run_phases(spark, phases, str(tmp_path)).count() == 2 and ran == ["a", "b", "c"]
    ran.clear()
    assert sorted(r.id for r in fs.run_phases(spark, phases, str(tmp_path), start="b").collect()) == [20, 30] and ran == ["b", "c"]
    ran.clear()
    assert fs.run_phases(spark, phases, str(tmp_path), stop="b").count() == 2 and ran == ["a", "b"]
    ran.clear()
    assert fs.run_phases(spark, phases, str(tmp_path), only="c").count() == 2 and ran == ["c"]


def test_one_prediction_per_row(spark):
    oof, held = ml_plans.oof_table(spark, SF)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert oof.count() + held.count() == lines
    assert oof.select("rid").distinct().count() == oof.count() and held.select("rid").distinct().count() == held.count()
    assert not {r.rid for r in oof.select("rid").collect()} & {r.rid for r in held.select("rid").collect()}


def test_folds_are_scored_by_models_that_never_saw_them(spark):
    df = spark.createDataFrame([(i, float(i % 5), float(i % 5 == 0) * 100, i % 3) for i in range(60)], "rid long, x double, y double, fold int")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    est = LinearRegression(labelCol="y")
    oof, held = ml.out_of_fold_with_test(df, df.limit(4), est, "fold", 3, ["rid", "fold"], ["rid"])
    for i in range(3):
        own = {r.rid: r.prediction for r in est.fit(df.where(f"fold <> {i}")).transform(df.where(f"fold = {i}")).collect()}
        assert {r.rid: pytest.approx(r.prediction) for r in oof.where(f"fold = {i}").collect()} == own
    assert held.count() == 4


def test_checkpoint_folder_is_required_off_local(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Fake())


@pytest.fixture(scope="module")
def signal(spark, tmp_path_factory):
    """Tables whose price, return flag and labels follow from the features."""
    rng, root = random.Random(8), tmp_path_factory.mktemp("signal")
    parts = [(i, 100.0 + 9 * i, i % 50 + 1) for i in range(100)]
    lines = []
    for _ in range(1500):
        part, q = rng.choice(parts), float(rng.randint(1, 50))
        lines.append((part[0], q, rng.randint(0, 10) / 100, rng.randint(0, 8) / 100, q * part[1], "R" if q > 25 else "N"))
    vectors = [(i, [rng.gauss(2.0 if d % 4 == i % 4 else 0.0, 1.0) for d in range(64)], i % 4) for i in range(400)]
    for name, rows, ddl in (("part", parts, "p_partkey long, p_retailprice double, p_size int"),
                            ("lineitem", lines, "l_partkey long, l_quantity double, l_discount double, l_tax double, "
                                                "l_extendedprice double, l_returnflag string"),
                            ("embeddings", vectors, "vec_id long, embedding array<float>, label int")):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_classifiers_predict_unseen_rows(spark, signal):
    p = ml_plans.ml_embedding_predictions(spark, signal)
    right = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    got = {r.model: r for r in p.groupBy("model").agg(right.alias("right"), F.count_distinct("vec_id").alias("n")).collect()}
    assert set(got) == {"logreg", "random_forest", "mlp"}
    assert all(r.right > 0.7 and r.n == 80 for r in got.values()), got  # a constant is right for 0.25
    s = ml_plans.ml_batch_scores(spark, signal).join(spark.read.parquet(f"{signal}/embeddings.parquet"), "vec_id").collect()
    assert len(s) == 400 and sum(int(r.predicted) == r.label for r in s) > 300
    assert all(r.top3.startswith(r.predicted + " (") and 0.25 <= r.confidence <= 1 for r in s)


def test_regressors_beat_the_mean_on_unseen_rows(spark, signal):
    got = {r.model: r for r in ml_plans.ml_price_metrics(spark, signal).collect()}
    assert set(got) == set(ml_plans._REGRESSORS)
    assert all(r.r2 > 0.5 and r.rmse > 0 and r.n > 200 for r in got.values()), got  # a constant has R^2 of 0 at most
    rows = ml_plans.ml_oof_predictions(spark, signal)
    assert rows.count() == 1500 == rows.select("rid").distinct().count()
    for r in rows.groupBy("fold").agg(F.sum((F.col("y_log") - F.col("prediction")) ** 2).alias("sse"),
                                      (F.var_pop("y_log") * F.count("rid")).alias("mean_sse")).collect():
        assert r.sse < 0.5 * r.mean_sse, r


def test_importances_name_the_feature_that_decides(spark, signal):
    got = {r.feature: r for r in ml_plans.ml_importance_values(spark, signal).collect()}
    assert set(got) == set(ml_plans.PRICE_FEATURES) and sum(r.importance for r in got.values()) == pytest.approx(1)
    first = got["l_quantity"]
    assert first["rank"] == 1 and first.auc_drop > 0.3 and first.mean_abs_contribution > 0.1
    assert all(abs(r.auc_drop) < 0.1 for f, r in got.items() if f != "l_quantity")


def test_search_returns_inertia_and_silhouette(spark):
    got = ml_plans.ml_kmeans_search(spark, SF).orderBy("k").collect()
    assert [r.k for r in got] == list(range(2, 11))
    assert got[-1].inertia < got[0].inertia and all(-1 <= r.silhouette <= 1 and r.inertia > 0 for r in got)
    assert len({r.silhouette for r in got}) == 9


def test_searches_read_stored_vectors_without_attribute_names(spark, monkeypatch):
    """with a name per term in the schema, each of the many short tasks of a fit took longer to unpack than to run."""
    seen, fit = [], ml_plans.CrossValidator.fit

    def watched(self, df):
        seen.append((df.schema["features"].metadata, df._jdf.queryExecution().analyzed().toString()))
        return fit(self, df)

    monkeypatch.setattr(ml_plans.CrossValidator, "fit", watched)
    row = ml_plans.ml_quality_text_lr(spark, SF).first()
    assert (row.grid_points, row.random_points) == (4, 3) and len(seen) == 2
    assert all(not names and "UDF" not in plan for names, plan in seen)


def test_fold_models_score_rows_without_joins(spark):
    """Several models at once, and neither shuffle of the rows nor a join on their ids."""
    df = spark.createDataFrame([(i, float(i % 7), float(i % 7) * 2 + i % 3, i % 3) for i in range(90)], "rid long, x double, y double, fold int")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    test = df.where("rid < 20").drop("fold")
    both = {"plain": LinearRegression(labelCol="y"), "ridge": LinearRegression(labelCol="y", regParam=0.5)}
    oof, held = ml.out_of_fold_with_test(df, test, both, "fold", 3, ["rid"], ["rid"])
    for x in (oof, held):
        assert "Exchange" not in x._jdf.queryExecution().executedPlan().toString()
    for name, est in both.items():
        models = [est.fit(df.where(f"fold <> {i}")) for i in range(3)]
        own = {r.rid: r.prediction for i, m in enumerate(models) for r in m.transform(df.where(f"fold = {i}")).collect()}
        assert {r.rid: pytest.approx(r[name]) for r in oof.collect()} == own
        each = [{r.rid: r.prediction for r in m.transform(test).collect()} for m in models]
        assert {r.rid: pytest.approx(r[name]) for r in held.collect()} == {i: sum(e[i] for e in each) / 3 for i in each[0]}


def test_test_rows_are_scored_once_for_all_regressors(spark, signal, monkeypatch):
    """one aggregation over the test rows measures every model."""
    calls, measure = [], ml_plans.ev.regression_metrics
    monkeypatch.setattr(ml_plans.ev, "regression_metrics", lambda *a, **b: calls.append(a[0]) or measure(*a, **b))
    n, found = ml_plans.price_metrics(spark, signal)
    assert len(calls) == 1 and list(found) == list(ml_plans._REGRESSORS)
    assert all(m["n"] == n["test"] for m in found.values())


def test_price_models_are_measured_on_prices(spark, signal):
    """errors were those of the logs; a price misses by hundreds, its log by less than one."""
    _, found = ml_plans.price_metrics(spark, signal)
    d = ml_plans._price_table(spark, signal)
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    plain = LinearRegression(labelCol="y_log").fit(train.withColumn("is_val", F.col("rid") % 5 == 0)).transform(test)
    rows = [(math.expm1(r.y_log), max(math.expm1(r.prediction), 0.0)) for r in plain.select("y_log", "prediction").collect()]
    assert found["linear"]["rmse"] == pytest.approx(math.sqrt(sum((y - p) ** 2 for y, p in rows) / len(rows)), rel=1e-6)
    assert found["linear"]["mape"] == pytest.approx(100 * sum(abs(y - p) / y for y, p in rows) / len(rows), rel=1e-6)
    mean = math.expm1(train.agg(F.avg("y_log")).first()[0])
    assert found["gbt"]["mean_rmse"] == pytest.approx(math.sqrt(sum((y - mean) ** 2 for y, _ in rows) / len(rows)), rel=1e-6)


def test_streamed_texts_are_dealt_over_all_cores(spark, monkeypatch):
    """a micro-batch is one file; its rows were scored by the task that read them."""
    seen, run = [], io_plans.st.run_append
    monkeypatch.setattr(io_plans.st, "run_append", lambda df, name: seen.append(df) or run(df, name))
    out = io_plans.stream_document_scores(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.count() == docs.count() and out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert "RepartitionByExpression" in seen[0]._jdf.queryExecution().analyzed().toString()
