"""Join and lookup operators.

Broadcast hints are only placed on tables whose size is bounded by construction
(parameter-sized lookup tables, a fixed list of classes); everything derived from the
data is left to AQE, which broadcasts at run time only below
``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions of big joins.
"""
from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_fill(df: DataFrame, other: DataFrame, keys: Sequence[str], fill: dict) -> DataFrame:
    """Left equi-join with defaults for misses."""
    return df.join(other, list(keys), "left").fillna(fill)


def lookup(df: DataFrame, col: str, mapping: dict, out: str, default=None, value_type: str = "string") -> DataFrame:
    """Dictionary lookup with a default; the dictionary is parameter-sized, so the
    broadcast is bounded."""
    spark = df.sparkSession
    key_type = df.schema[col].dataType.simpleString()
    m = spark.createDataFrame(list(mapping.items()), f"{col} {key_type}, {out} {value_type}")
    j = df.join(F.broadcast(m), col, "left")
    return j.fillna({out: default}) if default is not None else j


def class_inventory(items: DataFrame, labels: DataFrame, key: str, cls: str, classes: Sequence) -> DataFrame:
    """Every item gets the sorted list of its classes, one-hot columns for the
    fixed class list and the first class as label ("0" when none)."""
    per = labels.groupBy(key).agg(F.sort_array(F.collect_set(cls)).alias("classes"))
    j = items.join(per, key, "left").withColumn("classes", F.coalesce("classes", F.array().cast(per.schema["classes"].dataType)))
    for c in classes:
        j = j.withColumn(f"c_{c}", F.array_contains("classes", F.lit(c)).cast("int"))
    return j.withColumn("label", F.coalesce(F.try_element_at("classes", F.lit(1)).cast("string"), F.lit("0")))


def cooccurrence(flags: DataFrame, classes: Sequence) -> DataFrame:
    """Class x class co-occurrence counts from per-item one-hot columns ``c_<class>``
    as a single aggregate of K*K conditional sums: no pair rows are emitted."""
    aggs = [F.sum(F.col(f"c_{a}") * F.col(f"c_{b}")).cast("long").alias(f"{a}__{b}") for a in classes for b in classes]
    row = flags.agg(*aggs)
    return row.select(F.inline(F.array(*[F.struct(F.lit(str(a)).alias("a"), F.lit(str(b)).alias("b"),
                                                  F.col(f"{a}__{b}").alias("n")) for a in classes for b in classes])))


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep rows whose key is in ``keys``."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_anti")


# ------------------------------------------------------------------ D10 near duplicates
def _bands(bits: int, n_bands: int) -> list[tuple[int, int]]:
    base, extra = divmod(bits, n_bands)
    out, start = [], 0
    for i in range(n_bands):
        width = base + (1 if i < extra else 0)
        out.append((start, width))
        start += width
    return out


def hamming_pairs(df: DataFrame, key: str, hash_col: str, max_dist: int = 5) -> DataFrame:
    """All pairs of distinct hash values within Hamming distance ``max_dist``.

    A covering index: the 64 bits are cut into ``max_dist + 3`` bands, so two hashes that differ in
    at most ``max_dist`` bits agree on three bands at least.  Candidates come from an equi-join on
    every triple of bands (56 triples of 24 bits for distance 5) over the *distinct* hash values:
    copies of one hash are one row, never n^2 pairs, and unrelated hashes meet with probability
    56 / 2^24 instead of 6 / 2^11 with single bands.  A pair comes from the first three bands it
    agrees on alone.  Null hashes match nothing.
    Result: (hash_a, hash_b, distance, n_a, n_b) with hash_a < hash_b, plus exact copies
    as distance-0 rows (hash_a = hash_b) carrying their multiplicity.
    """
    bands = _bands(64, max(max_dist + 3, 4))
    wide = max(w for _, w in bands)
    triples = F.expr("array(" + ", ".join(f"named_struct('i', {i}, 'j', {j}, 'k', {k})" for i, j, k in itertools.combinations(range(len(bands)), 3)) + ")")
    h = df.where(F.col(hash_col).isNotNull()).groupBy(F.col(hash_col).alias("h")).agg(F.count(F.lit(1)).alias("n"))

    def cut(c: Column) -> Column:
        return F.array(*[F.shiftrightunsigned(c, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in bands])

    def code(i: Column, j: Column, k: Column) -> Column:
        return i * 4096 + j * 64 + k

    b = F.col("b")
    rows = F.transform(triples, lambda t: F.struct(
        code(t["i"], t["j"], t["k"]).alias("t"),
        F.shiftleft(b[t["i"]], 2 * wide).bitwiseOR(F.shiftleft(b[t["j"]], wide)).bitwiseOR(b[t["k"]]).alias("v")))
    ex = h.withColumn("b", cut(F.col("h"))).select("h", "n", F.inline(rows))
    a, b = ex.alias("a"), ex.alias("b")
    x = F.col("a.h").bitwiseXOR(F.col("b.h"))
    close = (a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.v") == F.col("b.v")) & (F.col("a.h") < F.col("b.h")))
             .where(F.bit_count(x) <= max_dist))
    agreed = F.filter(F.transform(cut(x), lambda v, i: F.when(v == 0, i)), lambda i: i.isNotNull())
    pairs = close.where(F.col("a.t") == code(agreed[0], agreed[1], agreed[2])).select(
        F.col("a.h").alias("hash_a"), F.col("b.h").alias("hash_b"), F.bit_count(x).cast("int").alias("distance"),
        F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))
    copies = h.filter(F.col("n") > 1).select(F.col("h").alias("hash_a"), F.col("h").alias("hash_b"),
                                             F.lit(0).alias("distance"), F.col("n").alias("n_a"), F.col("n").alias("n_b"))
    return pairs.unionByName(copies)


def average_hash(arr) -> Column:
    """M5: 64-bit average hash of a numeric array: bit i (MSB first) = value_i > mean."""
    a = F.col(arr) if isinstance(arr, str) else arr
    mean = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double")) / F.size(a)
    bits = F.transform(a, lambda x: F.when(x.cast("double") > mean, 1).otherwise(0))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b.cast("long")))

