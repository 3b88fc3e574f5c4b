"""Session helpers: a tuned local builder, reliable checkpoints, bounded broadcasts."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after its rows were counted and found below this.
BROADCAST_ROWS = 100_000
# Fits that run at once.
FITS = 4


def local_session(name: str = "sparktab", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the caller brings its own session; nothing here is needed.
    """
    shuffle = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites recorded for every column cost more than small plans themselves
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; make one only on one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparktab-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cached(df: DataFrame) -> DataFrame:
    """Keep a table that several jobs read; blocks that do not fit go to disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def side_by_side(f: Callable[[object], object], grid: Sequence, at_once: int = FITS) -> list:
    """Results in the order of the grid; a few fits share the cluster, so that one's last tasks do not leave it idle."""
    with ThreadPoolExecutor(min(at_once, max(1, len(grid)))) as pool:
        return list(pool.map(f, grid))


def swept_out(spark: SparkSession) -> None:
    """Let the driver collect its garbage: Spark drops broadcasts and shuffles of jobs that are over only then."""
    spark.sparkContext._jvm.System.gc()


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast if it has few rows, else leave the join to Spark."""
    count = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if count <= BROADCAST_ROWS else df
