"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings of a session that this package builds; a session that already runs keeps its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Frame tables are narrow in bytes but sort-heavy; keep AQE from
    # coalescing them into one or two tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Removes the shuffle files of a statement when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[str] = []


def _is_local(master: str) -> bool:
    """Driver and tasks in one process (``local``, ``local[n]``, ``local[*]``)."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def get_session(master: str | None = None, partitions: int = 8, app: str = "episodeframe") -> SparkSession:
    """Return the active session or build one.

    ``DEFAULTS`` apply to a built session only; the number of shuffle
    partitions and the driver's memory are set for local masters (tests,
    bench) and left to the cluster's configuration otherwise."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if _is_local(master or ""):
        b = b.config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", "16g")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder (``spark.checkpoint.dir``).

    Where none is configured a scratch folder is made for a local master; on a
    cluster that is an error, because executors could not see each other's
    files."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getCheckpointDir()
    if not d:
        if not _is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="episodeframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every statement run inside are removed as it ends.

    Otherwise they stay until the driver's garbage collection finds them, and a
    job of many steps holds the shuffles of all of them at once.  For writes: a
    frame that is collected again would have to be shuffled again."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, was)


def cut_lineage(df: DataFrame, how: str = "table") -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable, survives
    executor loss) and return a DataFrame reading it back.

    ``how="table"`` writes a Parquet table (columnar, cheap to write and
    re-read, column-pruned by later readers); ``how="checkpoint"`` uses
    ``DataFrame.checkpoint``.  ``release_tables`` deletes the written tables."""
    d = ensure_checkpoint_dir(df.sparkSession)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    path = f"{d.rstrip('/')}/tables/{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    _written.append(path)
    return df.sparkSession.read.parquet(path)


def tables_written() -> int:
    """How many tables of ``cut_lineage`` there are, for ``release_tables``."""
    return len(_written)


def delete_folder(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release_tables(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables that ``cut_lineage`` wrote in this process, those after
    the first ``since`` (``tables_written``) but the last ``keep``; frames that
    read them must not be used any more.  Returns how many."""
    paths = _written[since:len(_written) - keep]
    del _written[since:len(_written) - keep]
    for path in paths:
        delete_folder(spark, path)
    return len(paths)
