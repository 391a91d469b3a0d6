"""Session helpers: building a session, cutting lineage, reading tables."""

from __future__ import annotations

import gc
import os
import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "kinweave", cpus: str | int | None = None) -> SparkSession:
    """A local session for tests, bench and the command line; a cluster's own session is used where there is one."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("KINWEAVE_DRIVER_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder named in spark.checkpoint.dir. Only a local session may lack it and gets a folder of its own; on a cluster its lack is an error, before any work."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="kinweave-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the reliable checkpoint folder, so that a lost executor costs no recomputation of its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Frees the disk of finished steps: Spark removes the shuffle files and checkpoints of what the driver no longer refers to, but only once it has collected its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_and_release(df: DataFrame) -> DataFrame:
    """cut(df), after which the shuffles that made it leave the disk."""
    spark, out = df.sparkSession, cut(df)
    del df
    release(spark)
    return out


def in_slices(rows: DataFrame, by: list[str], most: int, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work(rows), where work does the same to each row on its own: done by slices of about most rows, drawn by a hash of by, so that the shuffles of one slice only are on disk at once."""
    k = max(1, -(-rows.count() // most))
    part = F.pmod(F.xxhash64(*by), F.lit(k))
    return union_all([cut_and_release(work(rows.where(part == i) if k > 1 else rows)) for i in range(k)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of df. It knows scans and checkpoints, not how many rows explode or Python functions make of one."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit_rows: int = 200_000) -> DataFrame:
    """Hints a broadcast if df, an aggregate that is cheap to count, has at most limit_rows rows; else the join shuffles."""
    return F.broadcast(df) if df.limit(limit_rows + 1).count() <= limit_rows else df.hint("merge")
