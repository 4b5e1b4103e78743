"""Landing with a late side table (T8) and recording sessions.

One streaming query carries message rows and control rows (start, stop).  Each
micro-batch, numbered by Spark, writes folders of its own below ``root``:

    on_time/batch_id=N   rows at or after their recording's clock less the delay
    late/batch_id=N      rows behind it, and rows without stamp or recording
    clocks/batch_id=N    every recording's clock (largest stamp) after the batch
    pending/batch_id=N   recordings that were stopped and wait for their rows
    manifest/batch_id=N  recordings published by the batch, and where

A batch reads the state of the batch before and overwrites its own folders, so
running it again (after a failure, or a restart from the checkpoint) gives the
same rows once more in the same place; the manifest is written last and commits
the batch.  A data set is written to a folder of its own per attempt, and only
the manifest makes it count: no recording is published twice.  Nothing of a
recording is gathered in one task: clocks are one aggregation with map-side
combine, and the split is a join that adaptive execution can divide.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodeframe.session import cut_lineage
from episodeframe.streaming.live import MESSAGE_SCHEMA

CONTROL_SCHEMA = T.StructType([T.StructField("recording_id", T.LongType()), T.StructField("action", T.StringType()),
                               T.StructField("ts_ns", T.LongType())])
START, STOP = "start", "stop"

_CLOCKS = "recording_id long, clock_ns long, n_rows long"
_PENDING = "recording_id long, stop_ns long, n_rows long"
_MANIFEST = "recording_id long, stop_ns long, data_set string"


def with_control(messages: DataFrame, control: DataFrame) -> DataFrame:
    """Message and control rows as one stream; ``action`` is null on messages."""
    return messages.withColumn("action", F.lit(None).cast("string")).unionByName(control, allowMissingColumns=True)


@dataclass
class Store:
    """The folders of one landing query; batch folders that are committed."""

    spark: SparkSession
    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    def path(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch_id={batch}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def committed(self) -> list[int]:
        """Numbers of the batches whose manifest is complete."""
        fs, p = self._fs(f"{self.root}/manifest")
        if not fs.exists(p):
            return []
        found = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("batch_id=")]
        return sorted(int(q.getName().split("=")[1]) for q in found if fs.exists(q.suffix("/_SUCCESS")))

    def read(self, table: str, batches: list[int], schema: T.StructType | str) -> DataFrame:
        """Rows of committed batches, with their ``batch_id``."""
        if not batches:
            kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            return self.spark.createDataFrame([], kind).withColumn("batch_id", F.lit(None).cast("long"))
        read = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return read.parquet(*[self.path(table, b) for b in batches]).withColumn("batch_id", F.col("batch_id").cast("long"))

    def state(self, table: str, batch: int, schema: str) -> DataFrame:
        """A state table as the last committed batch before ``batch`` left it."""
        before = [b for b in self.committed() if b < batch]
        return self.read(table, before[-1:], schema).drop("batch_id")

    def write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(self.path(table, batch))

    def landed(self, extra: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
        """All landed rows, late ones included."""
        done = self.committed()
        return self.read("on_time", done, extra).unionByName(self.read("late", done, extra))

    def manifest(self) -> DataFrame:
        return self.read("manifest", self.committed(), _MANIFEST)


def split_late(rows: DataFrame, clocks: DataFrame, delay_ns: int) -> DataFrame:
    """Rows with ``is_late``: more than ``delay_ns`` behind their recording's
    clock (before these rows), or without a stamp or recording.

    The clock is that of the recording, so streams of recordings whose clocks lie
    hours apart do not make each other late."""
    known = clocks.select("recording_id", F.col("clock_ns").alias("_clock"))
    late = F.col("ts_ns").isNull() | F.col("recording_id").isNull() | (F.col("ts_ns") < F.col("_clock") - F.lit(delay_ns))
    return rows.join(known, "recording_id", "left").withColumn("is_late", F.coalesce(late, F.lit(False))).drop("_clock")


def advance_clocks(clocks: DataFrame, rows: DataFrame) -> DataFrame:
    new = rows.where("recording_id is not null").groupBy("recording_id").agg(
        F.max("ts_ns").alias("clock_ns"), F.count(F.lit(1)).alias("n_rows"))
    return clocks.unionByName(new).groupBy("recording_id").agg(F.max("clock_ns").alias("clock_ns"), F.sum("n_rows").alias("n_rows"))


Publisher = Callable[[DataFrame, DataFrame, str], None]


def run_batch(store: Store, batch: DataFrame, number: int, publish: Publisher | None, delay_ns: int,
              closing: bool = False) -> None:
    """One micro-batch: land its rows, then publish the stopped recordings whose
    rows are all there.

    A recording is ready once its clock has reached its stop, or if a batch brought
    it no row since the batch that brought the stop (``closing``: now).
    ``publish(messages, recordings, path)`` gets the landed messages of the ready
    recordings up to their stops, late ones included."""
    if number in store.committed():
        return
    is_control = F.col("action").isNotNull()
    rows = batch.where(~is_control).drop("action")
    clocks = store.state("clocks", number, _CLOCKS)
    split = cut_lineage(split_late(rows, clocks, delay_ns))
    store.write(split.where("not is_late").drop("is_late"), "on_time", number)
    store.write(split.where("is_late").drop("is_late"), "late", number)
    store.write(advance_clocks(clocks, split), "clocks", number)
    clocks = store.spark.read.schema(_CLOCKS).parquet(store.path("clocks", number))

    published = store.manifest().select("recording_id")
    stops = batch.where(is_control & (F.col("action") == STOP) & F.col("recording_id").isNotNull()).groupBy("recording_id").agg(
        F.max("ts_ns").alias("stop_ns"), F.lit(-1).cast("long").alias("n_rows"))
    waiting = (store.state("pending", number, _PENDING).unionByName(stops).groupBy("recording_id")
               .agg(F.min("stop_ns").alias("stop_ns"), F.max("n_rows").alias("n_rows"))
               .join(published, "recording_id", "left_anti"))
    now = clocks.select("recording_id", "clock_ns", F.col("n_rows").alias("_now"))
    # n_rows: rows of the recording at the batch before, -1 at the batch of the stop
    ready = (F.lit(closing) | (F.col("clock_ns") >= F.col("stop_ns")) | (F.col("n_rows") == F.col("_now")))
    waiting = cut_lineage(waiting.join(now, "recording_id", "left").withColumn("_now", F.coalesce("_now", F.lit(0).cast("long")))
                          .withColumn("_ready", F.coalesce(ready, F.lit(False))))
    store.write(waiting.where("not _ready").select("recording_id", "stop_ns", F.col("_now").alias("n_rows")), "pending", number)
    done = waiting.where("_ready").select("recording_id", "stop_ns")
    target = f"{store.root}/data_sets/batch-{number}-{uuid.uuid4().hex}"
    if publish is not None and not done.isEmpty():
        committed = [*store.committed(), number]
        landed = store.read("on_time", committed, rows.schema).unionByName(store.read("late", committed, rows.schema))
        mine = landed.join(done, "recording_id").where(F.col("stop_ns").isNull() | (F.col("ts_ns") <= F.col("stop_ns")))
        publish(mine.drop("stop_ns", "batch_id"), done, target)
    store.write(done.withColumn("data_set", F.lit(target)), "manifest", number)


def record(source: DataFrame, root: str, checkpoint: str, publish: Publisher | None = None, delay_ns: int = 1_000_000_000,
           available_now: bool = True):
    """T6 + T8: start the query over ``with_control`` rows.

    Rows without an event time column are kept as they are; ``delay_ns`` says how
    far behind its recording's clock a row may be and still be on time."""
    spark = source.sparkSession

    def batch(df: DataFrame, number: int) -> None:
        run_batch(Store(spark, root), df, number, publish, delay_ns)

    w = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def close_pending(store: Store, schema: T.StructType, publish: Publisher) -> None:
    """After the last batch of a finished source: publish what still waits, as
    one more batch without rows."""
    done = store.committed()
    empty = store.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("action", T.StringType())]))
    run_batch(store, empty, (done[-1] + 1) if done else 0, publish, 0, closing=True)


def after_publication(store: Store, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Landed rows that no data set holds although their recording is published:
    those beyond its stop, and those that came after it."""
    m = store.manifest().select("recording_id", "stop_ns", F.col("batch_id").alias("_at"))
    r = store.landed(schema).join(m, "recording_id")
    missed = (F.col("ts_ns") > F.col("stop_ns")) | F.col("ts_ns").isNull() | (F.col("batch_id") > F.col("_at"))
    return r.where(missed).drop("_at")

