"""Structured Streaming operators.

Live sensor streams land as message rows ``(recording_id, stream, ts_ns,
seq, payload)``.  Event time is ``ts`` (TIMESTAMP derived from ``ts_ns``);
state lives in Spark's state store under the query's checkpoint location.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MESSAGE_SCHEMA = T.StructType([
    T.StructField("recording_id", T.LongType()),
    T.StructField("stream", T.StringType()),
    T.StructField("ts_ns", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("payload", T.StringType()),
])

# Liveness limits of the collector (seconds).
SILENCE_TIMEOUT_S = 5.0
NEVER_SEEN_TIMEOUT_S = 5.0


def with_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.timestamp_micros(F.call_function("div", F.col("ts_ns"), F.lit(1000))))


def ingest(spark: SparkSession, paths: dict[str, str], schema: T.StructType = MESSAGE_SCHEMA,
           fmt: str = "json", max_files_per_trigger: int | None = None) -> DataFrame:
    """One streaming source per stream name, unioned into one message
    table with a ``stream`` column."""
    out = None
    for name, path in paths.items():
        r = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.load(path).withColumn("stream", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return with_event_time(out)


def running_counts(messages: DataFrame) -> DataFrame:
    """Running row count per (recording, stream); update output mode."""
    return messages.groupBy("recording_id", "stream").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_snapshot(messages: DataFrame, payload: list[str] | None = None) -> DataFrame:
    """T4: latest record per (recording, stream) by (ts_ns, seq); update or
    complete output mode.  Absent streams are simply absent (null when
    joined to the expected list)."""
    payload = payload or ["value"]
    return messages.groupBy("recording_id", "stream").agg(
        F.max_by(F.struct("ts_ns", "seq", *payload), F.struct("ts_ns", "seq")).alias("latest"))


def accumulate_window(transforms: DataFrame, seconds: int = 3, watermark: str = "10 seconds") -> DataFrame:
    """T5: tumbling window of ``seconds``; keep the last transform per child
    frame in each window (append output mode after the watermark)."""
    others = [c for c in transforms.columns if c not in ("child", "ts")]
    return (transforms.withWatermark("ts", watermark)
            .groupBy(F.window("ts", f"{seconds} seconds"), "child")
            .agg(F.max_by(F.struct(*others), F.struct("ts", *(["seq"] if "seq" in others else []))).alias("last")))


def decimate(messages: DataFrame, period_ms: int = 10, watermark: str = "10 seconds") -> DataFrame:
    """T7 (re-aimed rate cap): first arrival per (recording, stream,
    ``floor(ts / period)``) bucket; duplicates inside the watermark are
    dropped, nothing else is."""
    b = F.call_function("div", F.col("ts_ns"), F.lit(period_ms * 1_000_000))
    return (messages.withColumn("bucket", b).withWatermark("ts", watermark)
            .dropDuplicatesWithinWatermark(["recording_id", "stream", "bucket"]))


def land_all(messages: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Land every row (late, out-of-order and equal stamps included)
    as Parquet partitioned by recording and stream; ordering happens at
    close by ``(ts_ns, seq)``."""
    w = (messages.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("recording_id", "stream"))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


# ---------------------------------------------------------------- T3 liveness

ALARM_SCHEMA = T.StructType([
    T.StructField("recording_id", T.LongType()), T.StructField("stream", T.StringType()),
    T.StructField("alarm", T.StringType()), T.StructField("last_ts", T.TimestampType()),
    T.StructField("at", T.TimestampType()),
])


def _limit(seen: bool) -> int:
    return int((SILENCE_TIMEOUT_S if seen else NEVER_SEEN_TIMEOUT_S) * 1_000_000)


def _runs(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stamps of an Arrow batch as runs without a silence, per recording and
    stream, so that a recording's task gets few rows; and one clock row."""
    for pdf in pdfs:
        if not len(pdf):
            continue
        out = [(None, None, "clock", int(pdf["us"].max()), int(pdf["us"].max()))]
        for (rec, stream, kind), us in pdf.groupby(["rec", "stream", "kind"], dropna=False, sort=False)["us"]:
            u = np.unique(us.to_numpy())
            cut = np.flatnonzero(np.diff(u) > _limit(True))
            rec, stream = (None if pd.isna(x) else x for x in (rec, stream))
            out += [(rec, stream, kind, int(low), int(high)) for low, high in zip(u[np.r_[0, cut + 1]], u[np.r_[cut, len(u) - 1]])]
        yield pd.DataFrame(out, columns=["rec", "stream", "kind", "low", "high"])


def _liveness(key, pdfs: Iterator[pd.DataFrame], state: GroupState, delay: int) -> Iterator[pd.DataFrame]:
    """State of a recording: its clock (largest stamp, microseconds), the
    watermark at which its wait began, and [stream, last, seen, alarmed]."""
    rec, is_clock = key
    if is_clock:
        for _ in pdfs:
            pass
        return
    clock, since, rows = json.loads(state.get[0]) if state.exists else (None, None, [])
    streams, alarms = {r[0]: r[1:] for r in rows}, []
    mark = state.getCurrentWatermarkMs()

    def silent(now: int) -> int | None:
        """Alarms of all streams due; the wait to the next one."""
        waits = []
        for name, (last, seen, alarmed) in streams.items():
            wait = last + _limit(seen) - (now - delay)
            if not alarmed and wait <= 0:
                alarms.append((rec, name, "silent" if seen else "never seen", last, last + _limit(seen)))
                streams[name][2] = True
            elif not alarmed:
                waits.append(wait)
        return min(waits, default=None)

    if state.hasTimedOut:
        # the first timeout after a recording's rows only notes the watermark, which
        # holds their trigger now; from there its clock goes on with the watermark
        since = mark if since is None else since
        wait = silent(clock + (mark - since) * 1000)
        timer = None if wait is None else mark + wait // 1000 + 1
    else:
        # all runs of the trigger first: the result must not depend on how the
        # rows were cut into Arrow batches
        new = pd.concat(list(pdfs), ignore_index=True).sort_values(["low", "high"])
        for name, part in new.groupby("stream", dropna=False, sort=False):
            name = None if pd.isna(name) else name
            last, seen, alarmed = streams.get(name, (None, False, False))
            starts, data = part[part["kind"] == "expected"], part[part["kind"] == "data"]
            if last is None and len(starts):
                last = int(starts["high"].max())
            for low, high in zip(data["low"].tolist(), data["high"].tolist()):
                if last is not None and low - last > _limit(seen) and not alarmed:  # else reported by the clock
                    alarms.append((rec, name, "silent" if seen else "never seen", last, last + _limit(seen)))
                if last is None or high > last or not seen:
                    last, seen, alarmed = high if last is None else max(last, high), True, False
            streams[name] = [last, seen, alarmed]
        clock, since = max([*new["high"].tolist(), *([] if clock is None else [clock])]), None
        silent(clock)
        timer = mark + 1
    state.update((json.dumps([clock, since, [[name, *v] for name, v in streams.items()]]),))
    if timer is not None:
        state.setTimeoutTimestamp(timer)
    if alarms:
        yield pd.DataFrame(alarms, columns=["rec", "stream", "alarm", "last_us", "at_us"])


def liveness_alarms(messages: DataFrame, expected: DataFrame, watermark: str = "1 second") -> DataFrame:
    """Alarm when a stream is silent for more than 5 s, or was never seen
    5 s after the recording started.

    ``expected`` rows ``(recording_id, stream, ts)`` seed every expected
    stream at the recording's start, so a stream that never sends data
    still has state and is reported as "never seen".  Each recording has its own
    clock, its largest stamp: an alarm is due as that passes ``last + 5 s`` by
    ``watermark``, however far the clocks of recordings lie apart, and no row is
    dropped for being behind another recording.  A recording that sends
    nothing any more is timed by how far the watermark over all recordings
    moves on meanwhile.  An alarm stands when a stamp from before it comes
    later; rows without a stamp say nothing."""
    delay = int(pd.Timedelta(watermark) / pd.Timedelta(microseconds=1))

    def run(key, pdfs, state):
        return _liveness(key, pdfs, state, delay)

    def rows(df: DataFrame, kind: str) -> DataFrame:
        return df.where("ts is not null").select(F.col("recording_id").cast("string").alias("rec"), "stream",
                                                 F.lit(kind).alias("kind"), F.unix_micros("ts").alias("us"))

    runs = rows(messages, "data").unionByName(rows(expected, "expected")).mapInPandas(
        _runs, "rec string, stream string, kind string, low long, high long")
    # only clock rows carry the watermark's time: Spark drops rows behind the
    # watermark, and rows whose time is null never are
    runs = (runs.withColumn("is_clock", F.col("kind") == "clock")
            .withColumn("ts", F.when(F.col("is_clock"), F.timestamp_micros("high"))).withWatermark("ts", watermark))
    out = runs.groupBy("rec", "is_clock").applyInPandasWithState(
        run, "rec string, stream string, alarm string, last_us long, at_us long", "state string", "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("rec").cast("long").alias("recording_id"), "stream", "alarm",
                      F.timestamp_micros("last_us").alias("last_ts"), F.timestamp_micros("at_us").alias("at"))


# ---------------------------------------------------------------- T6 session

def recording_sessions(control: DataFrame, on_closed: Callable[[DataFrame, int], None],
                       checkpoint: str, trigger_once: bool = True):
    """Control rows ``(recording_id, action in {start, stop}, ts)``;
    each micro-batch hands the recordings whose ``stop`` arrived to
    ``on_closed(closed_recordings_df, epoch_id)``, which runs the batch
    plan (validate -> align -> publish) on the landed messages of just those
    recordings."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        closed = df.where(F.col("action") == "stop").select("recording_id").distinct()
        on_closed(closed, epoch_id)

    w = control.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
