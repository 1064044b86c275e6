"""Run-length masks and file-catalogue quality checks (M1-M8, L13) as table jobs.

A mask is a set of 1-based positions per key.  Long form ``(key, start, length)``
runs are the scalable representation; the ``"start length start length ..."`` string
is produced per key for export (its size is bounded by the key's domain, e.g. the
pixels of one image).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import sequence_index


def runs_from_positions(df: DataFrame, key: str, pos: str) -> DataFrame:
    """M8 encode: gaps-and-islands.  Island id = position - rank of the position in the
    key (rank from a range-partitioned index, so one huge mask spans many tasks)."""
    d = df.select(key, pos).distinct()
    idx = sequence_index(d, [pos], [key], "_r")
    return (idx.groupBy(key, (F.col(pos) - F.col("_r")).alias("_island"))
               .agg(F.min(pos).alias("start"), F.count(F.lit(1)).alias("length"))
               .drop("_island"))


def rle_string(runs: DataFrame, key: str) -> DataFrame:
    """Runs -> "start length ..." string per key, runs in start order."""
    g = runs.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_r"))
    return g.select(key, F.array_join(F.flatten(F.transform("_r", lambda r: F.array(r["start"].cast("string"),
                                                                                      r["length"].cast("string")))),
                                      " ").alias("rle"))


def parse_rle(rle) -> Column:
    """"s1 l1 s2 l2 ..." -> array<struct<start, length>>."""
    r = F.col(rle) if isinstance(rle, str) else rle
    nums = F.transform(F.filter(F.split(F.trim(r), r"\s+"), lambda x: x != ""), lambda x: x.cast("long"))
    pairs = F.transform(F.sequence(F.lit(0), (F.size(nums) / 2).cast("int") - 1),
                        lambda i: F.struct(F.element_at(nums, i * 2 + 1).alias("start"),
                                           F.element_at(nums, i * 2 + 2).alias("length")))
    return F.when(F.size(nums) >= 2, pairs).otherwise(F.array().cast("array<struct<start:bigint,length:bigint>>"))


def rle_area(rle) -> Column:
    """M7: mask area = sum of every second number."""
    r = F.col(rle) if isinstance(rle, str) else rle
    nums = F.filter(F.split(F.trim(r), r"\s+"), lambda x: x != "")
    lens = F.filter(nums, lambda x, i: i % 2 == 1)
    return F.aggregate(lens, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def decode_runs(df: DataFrame, key: str, rle: str) -> DataFrame:
    """M8 decode: (key, pos) for every covered position."""
    r = df.select(key, F.explode(parse_rle(rle)).alias("_r"))
    return r.select(key, F.explode(F.sequence(F.col("_r.start"), F.col("_r.start") + F.col("_r.length") - 1)).alias("pos"))


def overlap_scores(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Dice and IoU of two position sets per key (equi-join on (key, pos));
    both empty -> 1."""
    na = a.groupBy(key).agg(F.count(F.lit(1)).alias("n_a"))
    nb = b.groupBy(key).agg(F.count(F.lit(1)).alias("n_b"))
    inter = a.join(b, [key, "pos"]).groupBy(key).agg(F.count(F.lit(1)).alias("inter"))
    j = na.join(nb, key, "full").join(inter, key, "left").fillna(0, ["n_a", "n_b", "inter"])
    return (j.withColumn("dice", F.when(F.col("n_a") + F.col("n_b") == 0, 1.0)
                                  .otherwise(2 * F.col("inter") / (F.col("n_a") + F.col("n_b"))))
             .withColumn("iou", F.when(F.col("n_a") + F.col("n_b") - F.col("inter") == 0, 1.0)
                                 .otherwise(F.col("inter") / (F.col("n_a") + F.col("n_b") - F.col("inter")))))


# ------------------------------------------------------------------ M1-M4 catalogue checks
def exact_duplicates(df: DataFrame, path: str, content: str) -> DataFrame:
    """M1: rows whose content hash equals an earlier (smaller) path's; each gets the kept
    path.  The kept path per hash is an aggregate (partial per task), not a window, so
    a group of copies holding a third of the table is reduced before the shuffle."""
    h = df.select(path, F.sha2(F.col(content).cast("binary"), 256).alias("hash"))
    keep = h.groupBy("hash").agg(F.min(path).alias("kept"))
    return h.join(keep, "hash").filter(F.col(path) != F.col("kept"))


def leakage_flags(df: DataFrame, path: str, split: str, hash_col: str,
                  train: str = "train", val: str = "val") -> DataFrame:
    """M2: a hash present in train and val flags its val copies; otherwise every copy
    but the first path (sorted) is flagged as a duplicate."""
    g = df.groupBy(hash_col).agg(F.max((F.col(split) == train).cast("int")).alias("_tr"),
                                 F.max((F.col(split) == val).cast("int")).alias("_va"),
                                 F.min(path).alias("_first"))
    j = df.join(g, hash_col)
    leak = (F.col("_tr") == 1) & (F.col("_va") == 1)
    reason = (F.when(leak & (F.col(split) == val), "leakage")
               .when(~leak & (F.col(path) != F.col("_first")), "duplicate"))
    return j.withColumn("flag", reason).drop("_tr", "_va", "_first")


def quarantine(df: DataFrame, corrupt: Column, leak_or_dup: Column, weak: Column) -> Column:
    """M3: first reason by priority corrupt > leakage/duplicate > weak-signal."""
    return F.coalesce(F.when(corrupt, F.lit("corrupt")), leak_or_dup, F.when(weak, F.lit("low_quality")))


def integrity(content) -> Column:
    """M4: 'missing' (null), 'empty' (zero length), 'undecodable' (replacement char), else null."""
    c = F.col(content) if isinstance(content, str) else content
    return (F.when(c.isNull(), "missing").when(F.length(c) == 0, "empty")
             .when(F.contains(c, F.lit("�")), "undecodable"))
