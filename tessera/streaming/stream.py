"""Structured Streaming operators.

The same column expressions as the batch operators are applied to a ``readStream``
source.  Queries run with ``trigger(availableNow=True)`` into Parquet sinks under the
shared checkpoint folder, with their own checkpoint locations, so a restarted or
retried query resumes exactly once.

``Resumable`` sinks keep one folder per micro-batch and overwrite it: a batch that was written but
not yet committed when a run stopped is written again under its number by the next run, so
no row counts twice.  Rows that come too late for their window go to a table of their own.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet file stream over the table at ``path``: a folder of files or one file.

    The last character is put in a character class, so the path is a glob that matches
    itself; the source then lists a folder's files as well as a single file.
    ``max_files`` bounds the files of a micro-batch.
    """
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    return r.parquet(f"{path[:-1]}[{path[-1]}]")


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream to completion (availableNow) into Parquet; return the sink."""
    spark = stream.sparkSession
    out, ck = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
               .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def row_rules(stream: DataFrame, features: dict[str, Column]) -> DataFrame:
    """Row-local features and rules on a stream (no state)."""
    return stream.withColumns(features)


def windowed_share(stream: DataFrame, ts: str, keys: list[str], flag: Column, window: str = "1 hour",
                   watermark: str = "2 hours", alert_share: float = 0.2) -> DataFrame:
    """Tumbling-window row count and flagged share per key with an alert flag; the
    watermark bounds state and drops data later than ``watermark``."""
    agg = (stream.withWatermark(ts, watermark)
                 .groupBy(F.window(ts, window).alias("w"), *keys)
                 .agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(flag, 1.0).otherwise(0.0)).alias("share")))
    return agg.withColumn("alert", F.col("share") > alert_share)


def run_update_upsert(agg: DataFrame, key_cols: list[str], name: str) -> DataFrame:
    """Run an aggregating stream in update mode to completion; every micro-batch's
    updated rows are appended with their batch id and the final table keeps the latest
    version of each key (exact even for windows the watermark has not closed yet)."""
    spark = agg.sparkSession
    out, ck = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(out)

    q = (agg.writeStream.outputMode("update").option("checkpointLocation", ck)
            .foreachBatch(sink).trigger(availableNow=True).start())
    q.awaitTermination()
    allv = spark.read.parquet(out)
    rest = [c for c in allv.columns if c not in key_cols and c != "_batch"]
    latest = allv.groupBy(*key_cols).agg(F.max_by(F.struct(*rest), "_batch").alias("_v"))
    return latest.select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in rest])


def residual_flags(stream: DataFrame, static: DataFrame, keys: list[str], value: str, k: float = 3.0) -> DataFrame:
    """Stream-static join with per-key (mean, std) from a batch table; flag rows whose
    absolute residual exceeds k standard deviations."""
    j = stream.join(static, keys)
    return j.withColumn("residual", F.col(value) - F.col("mean")) \
            .withColumn("anomaly", F.abs(F.col("residual")) > k * F.col("std"))



def scored(stream: DataFrame, model: PipelineModel, features: dict[str, Column], keep: list[str]) -> DataFrame:
    """N1 + K13: row-local features (T1, T9, ...) and a fitted pipeline applied to every row of a
    stream, as in batch: all stages are row-local transformers, so there is no state."""
    return model.transform(stream.withColumns(features)).select(*keep)


class Resumable:
    """A folder with a sub-folder per micro-batch and table, for a stream that may stop anywhere.

    ``folder`` also holds the stream's checkpoint: a new run with the same folder goes on where the last
    one stopped.  ``fail_after`` (tests) makes a run stop after it has written that many batches,
    before the last of them is committed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def put(self, table: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path(table)}/batch={batch_id}")

    def get(self, table: str, schema: T.StructType | str) -> DataFrame:
        """Everything written to ``table`` so far; with column ``batch``."""
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        try:
            return self.spark.read.schema(with_batch).parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], with_batch)  # no batch yet

    def run(self, stream: DataFrame, sink: Callable[[DataFrame, int], None], fail_after: int | None = None) -> None:
        """Process what the source has; each batch goes to ``sink``."""
        done = 0

        def each(batch: DataFrame, batch_id: int) -> None:
            nonlocal done
            sink(batch, batch_id)
            done += 1
            if fail_after is not None and done >= fail_after:
                raise RuntimeError("stopped on purpose")

        q = (stream.writeStream.option("checkpointLocation", self.path("checkpoint"))
             .foreachBatch(each).trigger(availableNow=True).start())
        q.awaitTermination()


def windows_with_late_rows(stream: DataFrame, store: Resumable, ts: str, keys: list[str], flag: Column, window: str = "1 hour",
                           delay: str = "2 hours", fail_after: int | None = None) -> None:
    """Number of rows and of flagged rows per tumbling window and key, and late rows by themselves.

    A row is late if its time is more than ``delay`` before the latest time of all earlier
    batches.  Each batch leaves its partial counts in ``parts``, its late rows in ``late`` and its latest time in
    ``clock``, all under its number; ``window_table`` adds the parts up."""
    spark, schema = stream.sparkSession, stream.schema
    clock = "latest timestamp"

    def sink(batch: DataFrame, batch_id: int) -> None:
        before = store.get("clock", clock).where(F.col("batch") < batch_id).select(F.max("latest").alias("latest"))
        due = before.select(F.col("latest") - F.expr(f"INTERVAL {delay}")).first()[0]  # one row per batch so far
        late = F.lit(False) if due is None else F.coalesce(F.col(ts) < F.lit(due), F.lit(False))
        store.put("late", batch.where(late), batch_id)
        flagged = F.sum(F.when(flag, 1).otherwise(0)).cast("long")
        parts = batch.where(~late & F.col(ts).isNotNull()).groupBy(F.window(ts, window).alias("w"), *keys).agg(
            F.count(F.lit(1)).alias("n"), flagged.alias("flagged"))
        store.put("parts", parts.select(F.col("w.start").alias("window_start"), *keys, "n", "flagged"), batch_id)
        store.put("clock", batch.agg(F.max(ts).cast("timestamp").alias("latest")), batch_id)

    store.run(stream, sink, fail_after)


def window_table(store: Resumable, keys: list[tuple[str, str]], alert_share: float = 0.2) -> DataFrame:
    """(window_start, keys..., n, share, alert) of all batches so far; ``keys`` are (name, type)."""
    names = [k for k, _ in keys]
    parts = store.get("parts", ", ".join(["window_start timestamp", *[f"{k} {t}" for k, t in keys], "n long", "flagged long"]))
    total = parts.groupBy("window_start", *names).agg(F.sum("n").alias("n"), (F.sum("flagged") / F.sum("n")).alias("share"))
    return total.withColumn("alert", F.col("share") > alert_share)
