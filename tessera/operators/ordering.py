"""Order-dependent building blocks that stay distributed.

pandas semantics often depend on row position ("keep first", ``rank(method="first")``,
``iloc[::6]``, cumulative sums).  Spark has no implicit order, so every helper here
takes explicit ``order_cols`` that must form a *total* order (add a unique key as the
last column).  None of them uses an un-partitioned window over the data: a hot key or
a single long series is range-partitioned over many tasks and stitched back with a
tiny per-task offset table.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

_LOCAL_BITS = 33  # monotonically_increasing_id = partition_id << 33 | record index


def _cols(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def _names(cols) -> list[str]:
    return [c for c in _cols(cols) if isinstance(c, str)]


def sequence_index(df: DataFrame, order_cols, partition_cols=(), name: str = "pos",
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order_cols`` within ``partition_cols``.

    Plan: range-partition on (partition_cols, order_cols) -> sort inside each task ->
    ``monotonically_increasing_id`` gives (task id, local index) without another
    shuffle -> per-(group, task) counts (partial aggregate, at most one row per task and
    group) -> prefix sums over that small table -> equi-join back.  A group holding a
    third of all rows is spread over a third of the tasks.

    The numbered rows are written once to the checkpoint folder before they are read
    twice (counts and join): range bounds come from sampling, and an input whose row
    order is not fixed (any shuffle output) could otherwise be partitioned differently
    by the two reads, or after an executor loss.
    """
    part = _cols(partition_cols)
    order = _cols(order_cols)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*part, *order]
    local = (df.repartitionByRange(n, *keys)
               .sortWithinPartitions(*keys)
               .withColumn("_mid", F.monotonically_increasing_id()))
    local = (written(local)
               .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
               .withColumn("_lrn", (F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1))))
    pn = _names(part)
    counts = local.groupBy(*pn, "_pid").agg(F.count(F.lit(1)).alias("_cnt"),
                                           F.min("_lrn").alias("_first"))
    w = Window.partitionBy(*pn).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*pn, "_pid", "_first",
                            F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    if not pn:
        # one row per task: size bounded by the partition count
        offsets = F.broadcast(offsets)
    out = (local.join(offsets, [*pn, "_pid"])
                .withColumn(name, (F.col("_off") + F.col("_lrn") - F.col("_first") + 1).cast("long"))
                .drop("_mid", "_pid", "_lrn", "_off", "_first"))
    return out


def halo_chunks(df: DataFrame, pos_col: str, preceding: int, following: int,
                chunk_rows: int = 1 << 16) -> DataFrame:
    """Split an ordered series into chunks of ``chunk_rows`` positions and copy the
    ``preceding`` rows before / ``following`` rows after every chunk boundary into the
    neighbouring chunk as *halo* rows.

    A bounded-frame window (lag, lead, rolling) partitioned by (series, ``_chunk``)
    then sees every row it needs; keep only ``_core`` rows afterwards.  Work per task
    is bounded by ``chunk_rows + preceding + following`` whatever the series length.
    """
    if preceding >= chunk_rows or following >= chunk_rows:
        raise ValueError("chunk_rows must exceed the window frame")
    p = F.col(pos_col) - 1
    chunk = F.floor(p / chunk_rows).cast("long")
    off = p - chunk * chunk_rows
    entries = F.array(
        F.struct(chunk.alias("c"), F.lit(True).alias("core")),
        F.when(off >= chunk_rows - preceding, F.struct((chunk + 1).alias("c"), F.lit(False).alias("core"))),
        F.when((off < following) & (chunk > 0), F.struct((chunk - 1).alias("c"), F.lit(False).alias("core"))),
    )
    return (df.withColumn("_e", F.explode(F.filter(entries, lambda e: e.isNotNull())))
              .withColumn("_chunk", F.col("_e.c")).withColumn("_core", F.col("_e.core"))
              .drop("_e"))


def keep_first(df: DataFrame, key_cols, order_cols) -> DataFrame:
    """Keyed de-duplication that keeps the first row of each key in ``order_cols``
    (pandas ``drop_duplicates(subset, keep="first")``).

    Written as ``min_by`` over a struct, i.e. an aggregate with map-side partial
    aggregation: a key holding a third of the table is reduced inside each task before
    the shuffle, unlike ``row_number()`` over a window partitioned by the key.
    """
    keys = _names(key_cols)
    order = _cols(order_cols)
    rest = [c for c in df.columns if c not in keys]
    ordkey = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    agg = (df.groupBy(*keys)
             .agg(F.min_by(F.struct(*rest), ordkey).alias("_row")))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def stable_hash(seed: int, *cols) -> Column:
    """Deterministic pseudo-random 64-bit key from (seed, cols): reproducible whatever
    the partitioning, unlike ``rand()`` / ``randomSplit``."""
    return F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in cols])


def sequence_index_sized(df: DataFrame, order_cols, partition_cols=(), name: str = "pos",
                         size_name: str = "n") -> DataFrame:
    """``sequence_index`` plus the group size ``size_name`` (rows per partition key)."""
    part = _names(partition_cols)
    idx = sequence_index(df, order_cols, partition_cols, name)
    sizes = idx.groupBy(*part).agg(F.max(name).alias(size_name))
    if not part:
        return idx.withColumn(size_name, sizes.scalar())
    return idx.join(sizes, part)


def running_sum(df: DataFrame, pos_col: str, value_cols: Sequence[str], partition_cols=(),
                chunk_rows: int = 1 << 16, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``value_cols`` along an existing dense position.

    Rows are cut into fixed-size chunks of positions (balanced groups even for one
    huge series); sums inside each chunk come from a window over that chunk, and the
    carry from earlier chunks from prefix sums over the (small) chunk-total table.
    """
    part = _names(partition_cols)
    ch = F.floor((F.col(pos_col) - 1) / chunk_rows).cast("long")
    d = df.withColumn("_chunk", ch)
    w = Window.partitionBy(*part, "_chunk").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, 0)
    for v in value_cols:
        d = d.withColumn(f"_in_{v}", F.sum(v).over(w))
    tot = d.groupBy(*part, "_chunk").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    wc = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(*part, "_chunk", *[F.coalesce(F.sum(f"_t_{v}").over(wc), F.lit(0)).alias(f"_c_{v}")
                                          for v in value_cols])
    out = d.join(carry, [*part, "_chunk"])
    for v in value_cols:
        out = out.withColumn(f"{v}{suffix}", F.col(f"_c_{v}") + F.col(f"_in_{v}"))
    return out.drop("_chunk", *[f"_in_{v}" for v in value_cols], *[f"_c_{v}" for v in value_cols])
