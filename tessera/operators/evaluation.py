"""Evaluation operators (L1-L14) over a (label, score[, pred]) table.

Curves are built from the table of *distinct scores* (one row per threshold, ties
collapsed as sklearn does) with per-score positive / negative counts; cumulative
counts come from the chunked running sum, never from one global window.  AUC uses the
exact tie-aware formula  sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import running_sum, sequence_index
from .topk import top_k_per_group


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _div(a, b) -> Column:
    """Zero division -> 0 (sklearn ``zero_division=0``)."""
    return F.coalesce(F.try_divide(_c(a).cast("double"), _c(b)), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """L1: confusion counts and accuracy, precision, recall, F1, specificity, FNR."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    m = df.groupBy(*group_cols).agg(cnt(y & p).alias("tp"), cnt(~y & p).alias("fp"),
                                    cnt(~y & ~p).alias("tn"), cnt(y & ~p).alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return (m.withColumn("accuracy", _div(tp + tn, tp + fp + tn + fn))
             .withColumn("precision", _div(tp, tp + fp))
             .withColumn("recall", _div(tp, tp + fn))
             .withColumn("f1", _div(2 * tp, 2 * tp + fp + fn))
             .withColumn("specificity", _div(tn, tn + fp))
             .withColumn("fnr", _div(fn, fn + tp)))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """L2: per-class precision / recall / F1 / support plus macro and weighted rows."""
    pairs = df.groupBy(F.col(label).alias("_y"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    tp = pairs.filter(F.col("_y") == F.col("_p")).select(F.col("_y").alias("class"), F.col("_n").alias("tp"))
    sup = pairs.groupBy(F.col("_y").alias("class")).agg(F.sum("_n").alias("support"))
    prd = pairs.groupBy(F.col("_p").alias("class")).agg(F.sum("_n").alias("predicted"))
    per = (sup.join(prd, "class", "full").join(tp, "class", "left")
              .fillna(0, ["tp", "support", "predicted"])
              .withColumn("precision", _div("tp", "predicted"))
              .withColumn("recall", _div("tp", "support"))
              .withColumn("f1", _div(2 * F.col("precision") * F.col("recall"),
                                     F.col("precision") + F.col("recall"))))
    per = per.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1",
                     F.col("support").cast("long").alias("support"))
    tot = per.select(F.sum("support")).scalar()
    avg = per.agg(F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
                  F.sum("support").alias("s"))
    rows = avg.select(F.inline(F.array(
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("s").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                 F.col("wf").alias("f1"), F.col("s").cast("long").alias("support")))))
    del tot
    return per.unionByName(rows)


def confusion_normalized(df: DataFrame, label: str, pred: str) -> DataFrame:
    """L2: row-normalised confusion matrix in long form (label, pred, n, share)."""
    pairs = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    rows = pairs.groupBy("label").agg(F.sum("n").alias("_r"))
    return pairs.join(rows, "label").withColumn("share", F.col("n") / F.col("_r")).drop("_r")


def score_counts(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per (group, distinct score): positives and negatives (partial aggregate)."""
    y = F.col(label) == 1
    return df.groupBy(*group_cols, F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.when(y, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(y, 0).otherwise(1)).cast("long").alias("neg"))


def threshold_table(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Cumulative tp / fp at every distinct threshold (score >= threshold), descending."""
    g = list(group_cols)
    sc = score_counts(df, label, score, g)
    idx = sequence_index(sc, [F.desc("threshold")], g, "rank")
    cum = running_sum(idx, "rank", ["pos", "neg"], g)
    tot = sc.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    cum = cum.withColumnsRenamed({"pos_cum": "tp", "neg_cum": "fp"})
    if g:
        return cum.join(tot, g)
    return cum.withColumn("P", tot.select("P").scalar()).withColumn("N", tot.select("N").scalar())


def roc_curve(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """L3: (threshold, fpr, tpr) per distinct score, exact (no binning)."""
    t = threshold_table(df, label, score, group_cols)
    return t.select(*group_cols, "threshold", "rank", (F.col("fp") / F.col("N")).alias("fpr"),
                    (F.col("tp") / F.col("P")).alias("tpr"))


def auc(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """L3: exact ROC AUC with ties as half credit (= trapezoid over the exact curve)."""
    g = list(group_cols)
    t = threshold_table(df, label, score, g)
    # negatives strictly below a threshold = N - fp(threshold)
    return t.groupBy(*g).agg(
        (F.sum(F.col("pos") * ((F.col("N") - F.col("fp")) + 0.5 * F.col("neg")))
         / (F.first("P") * F.first("N"))).alias("auc"))


def pr_curve(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """L4: precision / recall at every distinct threshold."""
    t = threshold_table(df, label, score, group_cols)
    return t.select(*group_cols, "threshold", "rank", "tp", "fp", "P", "pos", "neg",
                    (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    (F.col("tp") / F.col("P")).alias("recall"))


def average_precision(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """L4: AP = sum_n (R_n - R_{n-1}) P_n (step sum, not trapezoid)."""
    c = pr_curve(df, label, score, group_cols)
    return c.groupBy(*group_cols).agg(F.sum(F.col("pos") / F.col("P") * F.col("precision")).alias("average_precision"))


def best_f1_threshold(df: DataFrame, label: str, score: str, eps: float = 1e-12) -> DataFrame:
    """Threshold maximising F1 = 2PR / (P + R + eps); ties -> higher threshold."""
    c = pr_curve(df, label, score).withColumn(
        "f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + eps))
    return c.agg(F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                          F.struct("f1", "threshold")).alias("b")).select("b.*")


def threshold_for_recall(df: DataFrame, label: str, score: str, targets: Sequence[float],
                         fallback: float = 0.5) -> DataFrame:
    """For each target recall the highest-precision threshold reaching it (ties ->
    higher threshold); ``fallback`` when unreachable.  Operating point: caught (tp),
    false alarms (fp), alarms per catch.  One aggregate over the curve for all targets."""
    c = pr_curve(df, label, score)
    pt = F.struct("threshold", "precision", "recall", "tp", "fp")
    agg = c.agg(*[F.max_by(pt, F.when(F.col("recall") >= t, F.struct("precision", "threshold"))).alias(f"t{i}")
                  for i, t in enumerate(targets)])
    out = agg.select(F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("target"), F.col(f"t{i}.threshold").alias("threshold"),
                 F.col(f"t{i}.precision").alias("precision"), F.col(f"t{i}.recall").alias("recall"),
                 F.col(f"t{i}.tp").alias("tp"), F.col(f"t{i}.fp").alias("fp"))
        for i, t in enumerate(targets)])))
    return (out.withColumn("reachable", F.col("threshold").isNotNull())
               .withColumn("threshold", F.coalesce("threshold", F.lit(fallback)))
               .withColumn("alarms_per_catch", F.try_divide((F.col("tp") + F.col("fp")).cast("double"), F.col("tp"))))


def recall_grid_threshold(df: DataFrame, label: str, score: str, precision_floor: float,
                          grid: Sequence[float] | None = None) -> DataFrame:
    """Recall at every grid threshold (score >= t) from one aggregate; keep those
    with precision >= floor; best = highest recall, first (lowest) threshold on ties."""
    grid = list(grid or [round(0.05 * i, 2) for i in range(1, 20)])
    y = F.col(label) == 1
    s = F.col(score)
    aggs = []
    for i, t in enumerate(grid):
        aggs += [F.sum(F.when(y & (s >= t), 1).otherwise(0)).alias(f"tp{i}"),
                 F.sum(F.when(~y & (s >= t), 1).otherwise(0)).alias(f"fp{i}")]
    a = df.agg(F.sum(F.when(y, 1).otherwise(0)).alias("P"), *aggs)
    long = a.select(F.inline(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").cast("long").alias("tp"),
                                                F.col(f"fp{i}").cast("long").alias("fp"), F.col("P").cast("long").alias("P"))
                                       for i, t in enumerate(grid)])))
    long = (long.withColumn("precision", _div("tp", F.col("tp") + F.col("fp")))
                .withColumn("recall", _div("tp", "P")))
    return long.withColumn("eligible", F.col("precision") >= precision_floor)


def recall_grid_choice(df: DataFrame, label: str, score: str, precision_floor: float,
                       grid: Sequence[float] | None = None) -> DataFrame:
    """The grid's eligible threshold with the highest recall, the lowest on ties (one row;
    none if no threshold reaches the precision)."""
    g = recall_grid_threshold(df, label, score, precision_floor, grid).where(F.col("eligible") & (F.col("tp") + F.col("fp") > 0))
    return g.orderBy(F.desc("recall"), "threshold").limit(1).select("threshold", "recall", "precision")


def regression_metrics(df: DataFrame, y: str, pred: str, mape_min_abs: float = 1.0,
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R^2 and MAPE (rows with |y| < ``mape_min_abs`` left out of MAPE only)."""
    e = F.col(y) - F.col(pred)
    m = df.groupBy(*group_cols).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("_sse"), F.var_pop(y).alias("_var"), F.count(F.lit(1)).alias("n"),
        (F.avg(F.when(F.abs(F.col(y)) >= mape_min_abs, F.abs(e / F.col(y)))) * 100).alias("mape"))
    return m.withColumn("r2", 1 - F.col("_sse") / (F.col("_var") * F.col("n"))).drop("_sse", "_var")


def back_transformed(df: DataFrame, y_log: str, pred_log: str) -> DataFrame:
    """expm1 back-transform of log targets, predictions clipped at 0."""
    return df.withColumn(y_log, F.expm1(y_log)).withColumn(pred_log, F.greatest(F.expm1(pred_log), F.lit(0.0)))


def multilabel_long(df: DataFrame, id_col: str, labels: str, scores: str) -> DataFrame:
    """Explode aligned label and score arrays into (id, k, label, score)."""
    z = df.select(id_col, F.posexplode(F.arrays_zip(F.col(labels).alias("y"), F.col(scores).alias("s"))))
    return z.select(id_col, F.col("pos").alias("k"), F.col("col.y").alias("label"), F.col("col.s").alias("score"))


def confused_pairs(df: DataFrame, label: str, pred: str, k: int) -> DataFrame:
    """Most frequent (label, pred) error pairs; ties by label, pred."""
    return (df.filter(F.col(label) != F.col(pred))
              .groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "label", "pred").limit(k))


def misclassified(df: DataFrame, label: str, pred: str, order_cols, k: int | None = None) -> DataFrame:
    """The false positives and false negatives of a 0/1 prediction, worst first by ``order_cols``
    (a total order within a type): all columns, ``error`` (FP or FN), ``error_rate`` (share of that
    type among the rows that could be of it) and ``rank`` within the type; at most ``k`` of each (None: all)."""
    n = df.agg(*[F.sum((F.col(label) == v).cast("long")).alias(f"n{v}") for v in (0, 1)],
               F.sum(((F.col(label) == 0) & (F.col(pred) == 1)).cast("long")).alias("fp"),
               F.sum(((F.col(label) == 1) & (F.col(pred) == 0)).cast("long")).alias("fn")).first()
    wrong = df.where(F.col(label) != F.col(pred)).withColumn("error", F.when(F.col(label) == 0, "FP").otherwise("FN"))
    rate = F.when(F.col("error") == "FP", (n["fp"] or 0) / max(n["n0"] or 0, 1)).otherwise((n["fn"] or 0) / max(n["n1"] or 0, 1))
    wrong = wrong.withColumn("error_rate", rate)
    if k is not None:
        return top_k_per_group(wrong, ["error"], order_cols, k, "rank")
    return sequence_index(wrong, order_cols, ["error"], "rank")  # two groups: positions across tasks


def leaderboard(metric_rows: Sequence[DataFrame], metric: str, baseline: str, higher_is_better: bool = True) -> DataFrame:
    """Union of per-model metric rows with improvement over a baseline model (%)."""
    out = metric_rows[0]
    for r in metric_rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    base = out.filter(F.col("model") == baseline).select(metric).scalar()
    sign = 1 if higher_is_better else -1
    return out.withColumn("improvement_pct", sign * (F.col(metric) - base) / F.abs(base) * 100)
