"""Resumable streams, polarity in context, column audits, error lists and scalers on fixtures."""
from __future__ import annotations

import datetime as dt
import math
import re
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import cleaning, evaluation, ml
from tessera.operators import text as tx
from tessera.plans import io as plans
from tessera.streaming import stream as st

T0 = dt.datetime(2024, 1, 1)


def event_files(spark, folder, batches):
    """A Parquet file per batch, in order of their names and times."""
    import os
    schema = "id long, ts timestamp, kind string, value double"
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/b{k}")
        for f in os.listdir(f"{folder}/b{k}"):
            if f.endswith(".parquet"):
                os.makedirs(f"{folder}/in", exist_ok=True)
                os.rename(f"{folder}/b{k}/{f}", f"{folder}/in/{k:03d}.parquet")
                os.utime(f"{folder}/in/{k:03d}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.createDataFrame([], schema).schema


def test_a_stopped_stream_goes_on_without_losing_or_repeating_rows(spark, tmp_path):
    rng = random.Random(4)
    batches, n = [], 0
    for k in range(6):
        rows = []
        for _ in range(20):
            back = 5 if rng.random() < 0.15 else 0  # some rows come hours late
            rows.append((n, T0 + dt.timedelta(hours=k - back, minutes=rng.randrange(60)), "ab"[n % 2], float(rng.randrange(200))))
            n += 1
        batches.append(rows)
    batches[3].append((n, None, "a", 1.0))
    schema = event_files(spark, str(tmp_path / "src"), batches)

    def run(fail_after=None):
        store = st.Resumable(spark, str(tmp_path / "store"))
        s = st.file_stream(spark, str(tmp_path / "src" / "in"), schema, max_files=1)
        st.windows_with_late_rows(s, store, "ts", ["kind"], F.col("value") > 100, "1 hour", "2 hours", fail_after)
        return store

    for fail_after in (2, 1, 1):  # stops after writing a batch, before it is committed
        with pytest.raises(Exception, match="stopped on purpose"):
            run(fail_after)
    store = run()
    late, windows, latest = set(), {}, None
    for rows in batches:
        for i, ts, kind, value in rows:
            if ts is None:
                continue
            if latest is not None and ts < latest - dt.timedelta(hours=2):
                late.add(i)
                continue
            w = windows.setdefault((ts.replace(minute=0), kind), [0, 0])
            w[0] += 1
            w[1] += value > 100
        latest = max([t for _, t, _, _ in rows if t] + ([latest] if latest else []))
    assert late and {r.id for r in store.get("late", schema).collect()} == late
    assert store.get("late", schema).count() == len(late)
    got = {(r.window_start, r.kind): (r.n, r.share, r.alert) for r in st.window_table(store, [("kind", "string")]).collect()}
    assert got == {k: (a, b / a, b / a > 0.2) for k, (a, b) in windows.items()}
    assert sum(a for a, _ in windows.values()) + len(late) == n


def test_a_pipeline_scores_a_stream_as_in_batch(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    model = plans.message_model(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.repartition(4).write.parquet(str(tmp_path / "docs"))
    s = st.file_stream(spark, str(tmp_path / "docs"), docs.schema, max_files=1)
    stream = st.run_append(plans.message_scores(s, model, ["doc_id"]), "test-scores")
    batch = plans.message_scores(docs, model, ["doc_id"])
    key = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)
    assert key(stream) == key(batch) and stream.count() == docs.count()
    assert {r.label5 for r in batch.collect()} <= {"Normal", "Fraud", "Phishing", "Promotion", "Spam"}


def test_polarity_looks_back(spark):
    lex = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    texts = ["good", "not good", "very good", "not a very good", "it was not all that bad", "barely good", "good not", "very", "", None,
             "not one two three good", "very one good", "good good", "never very very bad"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.compound for r in tx.polarity(df, "id", "text", lex, negators=["not", "never"], boosters={"very": 0.3, "barely": -0.3}).collect()}
    raw = [2, -1.48, 2.3, -0.74 * 2.3, 1.48, 1.7, 2, 0, 0, 0, 2, 2 + .3 * .95, 4, 0.74 * (2 + .3 + .3 * .95)]
    # words of one letter are no words: "a" does not count as one that lies between
    assert {i: round(x, 9) for i, x in got.items()} == {i: round(x / math.sqrt(x * x + 15), 9) for i, x in enumerate(raw)}
    plain = {r.id: r.compound for r in tx.polarity(df, "id", "text", lex).collect()}
    assert plain[1] == plain[0] and plain[7] == 0


def test_identical_columns(spark):
    rows = [(1, 1, 1.0, "x", None, None, 1), (2, None, None, "y", "b", "b", 2), (3, 3, 3.0, "x", "c", "c", 3), (4, 5, 5.0, "z", "d", "e", 4)]
    df = spark.createDataFrame(rows, "k long, a int, a2 double, s string, n string, almost string, k2 int").withColumn("a3", F.col("a"))
    got = {r.column: r.same_as for r in cleaning.identical_columns(df, ["k"]).collect()}
    assert got == {"a2": "a", "a3": "a"}
    swapped = df.withColumn("s2", F.when(F.col("k") == 1, "y").when(F.col("k") == 2, "x").otherwise(F.col("s")))
    assert cleaning.identical_columns(swapped, ["k"], ["s", "s2"]).count() == 0  # the same values on other rows
    assert cleaning.identical_columns(df.limit(0), ["k"], ["a", "a3"]).count() == 1  # nothing tells empty columns apart


def test_misclassified_rows(spark):
    rows = [(1, 0, 1, .9), (2, 0, 1, .6), (3, 0, 0, .1), (4, 1, 0, .2), (5, 1, 1, .8), (6, 0, 1, .9)]
    df = spark.createDataFrame(rows, "id long, y int, p int, s double")
    got = [tuple(r) for r in evaluation.misclassified(df, "y", "p", [F.desc("s"), F.asc("id")]).select("id", "error", "error_rate", "rank").orderBy("error", "rank").collect()]
    assert got == [(4, "FN", 0.5, 1), (1, "FP", 0.75, 1), (6, "FP", 0.75, 2), (2, "FP", 0.75, 3)]
    top = evaluation.misclassified(df, "y", "p", [F.desc("s"), F.asc("id")], 1)
    assert {r.id for r in top.collect()} == {1, 4}
    assert evaluation.misclassified(df.limit(0), "y", "p", ["id"]).count() == 0


def test_scalers(spark):
    df = spark.createDataFrame([(float(i), 3.0, None if i == 0 else float(i)) for i in range(5)], "a double, flat double, gaps double")
    s = ml.fit_scalers(df, ["a", "flat", "gaps"])
    assert s["standard"]["a"] == (2.0, math.sqrt(2)) and s["minmax"]["a"] == (0.0, 4.0) and s["robust"]["a"] == (2.0, 2.0)
    assert s["standard"]["flat"] == (3.0, 1.0) and s["minmax"]["flat"] == (3.0, 1.0)
    assert s["robust"]["gaps"] == (2.5, 1.5)
    out = ml.scale(df, s).orderBy("a").collect()
    assert [r.robust_a for r in out] == [-1.0, -0.5, 0.0, 0.5, 1.0] and out[0].standard_gaps is None


def test_terms_are_counted_where_texts_are_dealt(spark, tmp_path):
    """A table of many files: documents with equal and null ids count as one, and only texts are shuffled."""
    rows = [(i // 2 if i < 8 else None, "de", f"alpha beta alpha gamma{i % 3}") for i in range(10)] + [(50, "en", None), (51, None, "")]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(6).write.parquet(f"{tmp_path}/d")
    terms = tx.doc_terms(spark.read.parquet(f"{tmp_path}/d"), "doc_id", "text", (1, 2), keep=["lang"])
    want = {}
    for i, lang, text in rows:
        w = (text or "").split()
        for n, t in [(1, x) for x in w] + [(2, " ".join(p)) for p in zip(w, w[1:])]:
            want[(i, lang, n, t)] = want.get((i, lang, n, t), 0) + 1
    assert {(r.doc_id, r.lang, r.n, r.term): r.tf for r in terms.collect()} == want
    plan = terms._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan


def test_permuted_columns_pair_rows_once(spark):
    d = spark.createDataFrame([(i, float(i), -float(i)) for i in range(50)], "k long, a double, b double")
    got = {r.k: (r.other_a, r.other_b) for r in ml.permuted_columns(d, "k", ["a", "b"]).collect()}
    assert sorted(a for a, _ in got.values()) == [float(i) for i in range(50)] and all(a == -b for a, b in got.values())
    for c, at in (("a", 0), ("b", 1)):
        assert {r.k: r[c] for r in ml.permuted_column(d, "k", c).collect()} == {k: v[at] for k, v in got.items()}


def test_tokens_meet_the_dictionary_where_they_are(spark, tmp_path):
    """whole token lists are shuffled, the rows of single tokens are not."""
    from tessera.plans import text as text_plans

    rows = [(1, "cats and dogs chase cat toys"), (2, "dog toy dogs"), (3, ""), (4, None), (5, "houses house glass")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = text_plans.lemmatized_tokens(spark, str(tmp_path))
    assert {r.doc_id: r.lemma_text for r in out.collect()} == {
        1: "cat dog chase cat toy", 2: "dog toy dog", 3: "", 4: "", 5: "house house glass"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#\w+, \d+\), (\w+)", plan)
    assert "BroadcastHashJoin" in plan and set(dealt) == {("doc_id", "REPARTITION_BY_NUM")}


def test_words_without_a_valence_are_not_shuffled(spark):
    """F16: a small lexicon is sent to the texts, whatever its size is taken for."""
    df = spark.createDataFrame([(1, "not very good"), (2, "plain words"), (3, None)], "id long, text string")
    lex = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    out = tx.polarity(df, "id", "text", lex, negators=["not"], boosters={"very": 0.5})
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [token" in plan and {r.id: r.compound == 0 for r in out.collect()} == {1: False, 2: True, 3: True}


def test_a_repeated_word_is_cut_up_once(spark, tmp_path):
    """F8: grams come from a document's distinct words, counted as often as the words are."""
    from tessera.plans import text as text_plans
    spark.createDataFrame([(1, "ab Ab a"), (2, "a ab\tcab"), (3, None), (4, " ")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = text_plans.char_ngrams(spark, str(tmp_path))
    want = {" ab": (3, 2, 2), "ab ": (4, 2, 2), " ab ": (3, 2, 2), " a ": (4, 2, 2), " ca": (1, 1, 1), "cab": (1, 1, 1), " cab": (1, 1, 1), "cab ": (1, 1, 1)}
    assert {r.term: (r["count"], r.doc_freq, r.max_tf) for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [doc_id") < plan.rindex("Aggregate [doc_id")  # words are counted before they are cut up


def test_shuffle_files_go_with_their_job(spark):
    import __spark_entry__ as E
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    E._prepare(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
