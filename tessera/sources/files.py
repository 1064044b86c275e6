"""File sources and sinks.

Scratch output goes under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temporary folder.
"""
from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from ..operators.topk import top_k_per_group


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-io/{name}-{uuid.uuid4().hex[:12]}"


# ------------------------------------------------------------------ A1-A7 CSV and parsing
def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, renames: dict | None = None,
                   timestamp_cols: dict | None = None, header: bool = True) -> DataFrame:
    """A1/A4/A5: CSV with a declared schema (no inference pass); string timestamp
    columns parsed with an explicit format; column renames."""
    df = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)
    for c, fmt in (timestamp_cols or {}).items():
        df = df.withColumn(c, F.to_timestamp(c, fmt))
    return df.withColumnsRenamed(renames or {})


def read_inferred_csv(spark: SparkSession, path: str, drop_index: bool = False) -> DataFrame:
    """A2/A3: header + inferred schema (one extra pass; prefer declared schemas at
    scale); optionally drop an unnamed leading index column."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    first = df.columns[0]
    if drop_index and (first.startswith("_c") or first in ("", "Unnamed: 0")):
        df = df.drop(first)
    return df


def lenient_timestamp(col: str, fmt: str | None = None):
    """Unparseable -> null (ANSI-safe)."""
    return F.try_to_timestamp(F.col(col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(col))


def epoch_millis_to_ts(col: str):
    """A7."""
    return F.timestamp_millis(F.col(col))


def parse_label_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``__label__{1|2} title: body`` lines -> (label 0/1, title, body, text).
    Malformed lines are skipped; the split is at the *first* ": " (else the title is
    empty); text = title + ". " + body stripped of leading/trailing '.' and ' '."""
    m = F.regexp_extract(value, r"^__label__([12]) (.*)$", 1)
    rest = F.regexp_extract(value, r"^__label__[12] (.*)$", 1)
    d = lines.filter(m != "").select((m.cast("int") - 1).alias("label"), rest.alias("_rest"))
    pos = F.instr("_rest", ": ")
    title = F.when(pos > 0, F.substring("_rest", F.lit(1), pos - 1)).otherwise(F.lit(""))
    body = F.when(pos > 0, F.expr("substring(_rest, instr(_rest, ': ') + 2)")).otherwise(F.col("_rest"))
    d = d.select("label", title.alias("title"), body.alias("body"))
    return d.withColumn("text", F.btrim(F.concat("title", F.lit(". "), "body"), F.lit(". ")))


def parse_tab_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``label<TAB>text`` lines; lines without a tab are skipped."""
    parts = F.split(value, "\t", 2)
    return lines.filter(F.size(parts) == 2).select(parts[0].alias("label"), parts[1].alias("text"))


def read_json_capped(spark: SparkSession, path: str, schema: T.StructType, category: str, order_cols: Sequence[str],
                     cap: int, keep: Sequence[str] | None = None) -> DataFrame:
    """A10: JSON lines with a declared schema, selected fields, at most ``cap`` rows per
    category (partition column or file) in an explicit order (salted top-k per group)."""
    df = spark.read.schema(schema).json(path)
    if keep:
        df = df.select(*keep, category)
    return top_k_per_group(df, [category], list(order_cols), cap, "_r").drop("_r")


# ------------------------------------------------------------------ A11-A14, A16, A18
def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def cached_parquet(spark: SparkSession, root: str, key: dict, build: Callable[[], DataFrame]) -> DataFrame:
    """Parameter-keyed cache: reuse the Parquet built for the same key."""
    h = hashlib.sha1(json.dumps(key, sort_keys=True).encode()).hexdigest()[:16]
    path = f"{root.rstrip('/')}/{h}"
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    write_parquet(build(), path)
    return spark.read.parquet(path)


def run_phases(spark: SparkSession, phases: Sequence[tuple[str, Callable[[DataFrame | None], DataFrame]]],
               root: str, start: str | None = None, stop: str | None = None, only: str | None = None) -> DataFrame:
    """Ordered DataFrame -> DataFrame phases with Parquet between them; ``start`` /
    ``stop`` / ``only`` select a slice, earlier outputs are read back from Parquet."""
    names = [n for n, _ in phases]
    lo = names.index(only or start) if (only or start) else 0
    hi = names.index(only or stop) if (only or stop) else len(names) - 1
    prev = spark.read.parquet(f"{root}/{names[lo - 1]}") if lo > 0 else None
    for name, fn in phases[lo:hi + 1]:
        out = fn(prev)
        write_parquet(out, f"{root}/{name}")
        prev = spark.read.parquet(f"{root}/{name}")
    return prev


def export_csv_set(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One header CSV folder per table (BI export)."""
    out = {}
    for name, df in tables.items():
        p = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("header", True).csv(p)
        out[name] = p
    return out


def write_json_metrics(df: DataFrame, path: str) -> str:
    """A (small) metrics DataFrame written as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_manifest(df: DataFrame, path: str, split: str = "split") -> str:
    """Manifest partitioned by split."""
    return write_parquet(df, path, [split])


def file_catalogue(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True,
                   with_content_hash: bool = False) -> DataFrame:
    """Directory as a table: one row per file at any depth (path, name, parent folder
    as class, bytes from the file's metadata).  ``with_content_hash`` also reads the bytes
    in the executors (files up to 2 GB)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", recursive).load(root))
    parts = F.split("path", "/")
    out = df.select("path", F.element_at(parts, -1).alias("name"), F.element_at(parts, -2).alias("folder"),
                    F.col("length").alias("bytes"),
                    *([F.md5("content").alias("md5")] if with_content_hash else []))
    return out
