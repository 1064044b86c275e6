"""Session helpers.

Nothing here hard-codes cluster paths: the checkpoint directory is read from the
session (``spark.checkpoint.dir``) and only filled in when unset, as in tests.
"""
from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "tessera", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    ``master`` is only set when given; on a cluster it comes from spark-submit.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``; it must be
    set there.  Only a local master gets a fresh scratch folder when it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate that several later passes read (e.g. a customer-grain
    table scored by three range-partitioned rankings) once, to the shared checkpoint
    folder, so each pass starts from stored data instead of re-running the lineage.
    Survives executor loss: the files are in the shared folder, not on executors."""
    return cut_lineage(df)


def written(df: DataFrame) -> DataFrame:
    """``materialize`` for rounds of a loop: Parquet files in the shared folder, read back.

    A checkpoint hands the constraints of the plan that it replaces on to the next one.  Joins
    with renamed columns multiply them, so that after some rounds planning takes longer than the
    work; a table that is read from files has none."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``written`` for tables that nothing reads after the block: their files are deleted at its end."""
    paths = []

    def keep(df: DataFrame) -> DataFrame:
        paths.append(f"{ensure_checkpoint_dir(spark).rstrip('/')}/passing-{uuid.uuid4().hex}")
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for p in map(hadoop, paths):
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def in_rounds(spark: SparkSession, key: str, rounds: int, one: Callable[[Column, Callable[[DataFrame], DataFrame]], DataFrame]) -> DataFrame:
    """All rows of ``one(part, keep)`` for ``rounds`` parts of the values of ``key``.  Each round is written before
    the next begins, and what it shuffled or kept is dropped: a round's share of it is all that lies on disk."""
    found = []
    for r in range(rounds):
        with passing(spark) as keep:
            part = F.pmod(F.xxhash64(F.lit(7), key), F.lit(rounds)) == r
            found.append(written(one(part, keep)))
    return reduce(DataFrame.unionByName, found)


def spread_out(df: DataFrame, *cols: str) -> DataFrame:
    """Deal small rows that cost much work each over all shuffle partitions.

    Run-time coalescing goes by bytes: a few MB of candidate pairs would end up in one task,
    however long their distances take.  A repartitioning with a number is left as it is."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)
