"""Split / fold / sampling queries.  Pseudo-random orders are arithmetic on ids so the
DuckDB oracle can reproduce them exactly (the library default is a seeded xxhash64)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as sp
from ..operators import topk as tk
from ..sources.tables import read_table
from .registry import query

VEC_ORDER_SQL = "(vec_id * 7919) % 1000003"
DOC_ORDER_SQL = "(doc_id * 104729) % 1000003"


def vec_order():
    return (F.col("vec_id") * 7919) % 1000003


def doc_order():
    return (F.col("doc_id") * 104729) % 1000003


@query("stratified_split", f"""
SELECT vec_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {VEC_ORDER_SQL}, vec_id)
                                <= round(count(*) OVER (PARTITION BY label) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM embeddings""")
def stratified_split(spark, sf):
    """Stratified 80/20 split of the embeddings by label."""
    e = read_table(spark, sf, "embeddings", "vec_id", "label")
    return sp.stratified_split(e, "label", ["vec_id"], 0.2, order=vec_order())


@query("stratified_folds", f"""
SELECT label, CAST((row_number() OVER (PARTITION BY label ORDER BY {VEC_ORDER_SQL}, vec_id) - 1) % 5 AS INTEGER) AS fold,
       vec_id FROM embeddings""")
def stratified_folds(spark, sf):
    """Stratified 5-fold ids."""
    e = read_table(spark, sf, "embeddings", "vec_id", "label")
    return sp.stratified_folds(e, "label", ["vec_id"], 5, order=vec_order()).select("label", "fold", "vec_id")


@query("timeseries_folds", """
WITH p AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS pos, count(*) OVER () AS n FROM events),
t AS (SELECT *, floor(n / 4) AS ts_size FROM p),
f AS (SELECT i AS fold, CASE WHEN pos <= n - (3 - i) * ts_size THEN 'train'
                              WHEN pos <= n - (3 - i) * ts_size + ts_size THEN 'test' END AS role, ts
      FROM t, range(0, 3) r(i))
SELECT CAST(fold AS INTEGER) AS fold, role, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ts_min,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts_max FROM f WHERE role IS NOT NULL GROUP BY ALL""")
def timeseries_folds(spark, sf):
    """Expanding-window time-series folds (3 splits) over the event stream."""
    e = read_table(spark, sf, "events", "event_id", "ts")
    f = sp.timeseries_folds(e, "ts", ["event_id"], 3)
    return f.groupBy(F.col("fold").cast("int").alias("fold"), "role").agg(
        F.count(F.lit(1)).alias("n"), F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("ts_min"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("ts_max"))


@query("group_split", """
WITH g AS (SELECT lang, source, count(*) AS size, (hash_src * 7919) % 1000003 AS o
           FROM (SELECT lang, source, CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) AS hash_src FROM documents)
           GROUP BY lang, source, hash_src),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY lang ORDER BY o, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(size) OVER (PARTITION BY lang) AS tot FROM g)
SELECT lang, source, CAST(size AS BIGINT) AS docs, CASE WHEN before < tot * 0.2 THEN 'test' ELSE 'train' END AS split FROM c""")
def group_split(spark, sf):
    """I4 + H3: group-aware stratified split (source groups never cross splits)."""
    d = read_table(spark, sf, "documents", "lang", "source")
    order = (F.regexp_extract("source", "([0-9]+)", 1).cast("long") * 7919) % 1000003
    s = sp.group_split(d, "lang", "source", 0.2, order=order)
    return s.groupBy("lang", "source", "split").agg(F.count(F.lit(1)).alias("docs")) \
            .select("lang", "source", "docs", "split")


@query("class_weights", """
WITH c AS (SELECT label, count(*) AS n_c FROM embeddings GROUP BY label)
SELECT label, n_c, (SELECT sum(n_c) FROM c) / ((SELECT count(*) FROM c) * n_c) AS weight FROM c""",
       floats=("weight",))
def class_weights(spark, sf):
    """Balanced class weights n / (k * n_c)."""
    return sp.class_weights(read_table(spark, sf, "embeddings", "label"), "label")


DOC_SPLIT_SQL = "CASE WHEN doc_id % 5 IN (0, 1, 2) THEN 'train' WHEN doc_id % 5 = 3 THEN 'val' ELSE 'test' END"


def doc_split_df(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "lang")
    m = F.col("doc_id") % 5
    return d.withColumn("split", F.when(m.isin(0, 1, 2), "train").when(m == 3, "val").otherwise("test"))


@query("split_subsample", f"""
WITH d AS (SELECT doc_id, lang, {DOC_SPLIT_SQL} AS split FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY split, lang ORDER BY {DOC_ORDER_SQL}, doc_id) AS p,
             count(*) OVER (PARTITION BY split, lang) AS n FROM d)
SELECT doc_id, split, lang FROM r WHERE p <= round(n * 0.5)""")
def split_subsample(spark, sf):
    """50 % subsample per split x class; rows keep their split."""
    return sp.fractional_subsample(doc_split_df(spark, sf), ["split", "lang"], ["doc_id"], 0.5,
                                   order=doc_order()).select("doc_id", "split", "lang")


@query("resplit_pooled", f"""
WITH d AS (SELECT doc_id, lang, {DOC_SPLIT_SQL} AS split FROM documents),
p AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {DOC_ORDER_SQL}, doc_id) AS r,
             count(*) OVER (PARTITION BY lang) AS n FROM d WHERE split IN ('train', 'val'))
SELECT doc_id, lang, CASE WHEN r <= round(n * 0.15) THEN 'val' ELSE 'train' END AS split FROM p
UNION ALL SELECT doc_id, lang, split FROM d WHERE split NOT IN ('train', 'val')""")
def resplit_pooled(spark, sf):
    """I8: pool train+val, re-split 85/15 stratified by language, test untouched."""
    return sp.resplit_pooled(doc_split_df(spark, sf), "split", "lang", ["doc_id"], order=doc_order()) \
             .select("doc_id", "lang", "split")


@query("seeded_doc_sample", f"""
SELECT doc_id, lang FROM documents ORDER BY {DOC_ORDER_SQL}, doc_id LIMIT 50""")
def seeded_doc_sample(spark, sf):
    """Reproducible sample of 50 documents (hash order, a sampling operator)."""
    d = read_table(spark, sf, "documents", "doc_id", "lang")
    return tk.seeded_sample(d, 50, 42, ["doc_id"], order=doc_order())


@query("balanced_label_sample", f"""
SELECT doc_id, quality FROM (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {DOC_ORDER_SQL}, doc_id) AS r FROM labels)
WHERE r <= 50""")
def balanced_label_sample(spark, sf):
    """Class-balanced sample, 100 // 2 labelled documents per quality class."""
    lab = read_table(spark, sf, "labels", "doc_id", "quality")
    return tk.balanced_sample(lab, "quality", 100, 42, ["doc_id"], order=doc_order()).select("doc_id", "quality")
