"""Batch twins of the streaming operators (T2, T4, T5, T7) and the
point-cloud explode (F25), over the landed tables."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodeframe.functions.timeunits import epoch_ns
from episodeframe.operators.pointcloud import explode_points
from episodeframe.plans.catalog import r6, register
from episodeframe.session import ensure_checkpoint_dir
from episodeframe.sources.tables import events_as_messages, table
from episodeframe.streaming import live as L


@register("live_counts", """
SELECT user_id AS recording_id, event_type AS stream, count(*) AS n_rows FROM events GROUP BY 1, 2""")
def live_counts(spark, sf_dir):
    """T2 batch twin: running counts per (recording, stream)."""
    return L.running_counts(events_as_messages(spark, sf_dir))


@register("latest_snapshot", """
SELECT user_id AS recording_id, event_type AS stream, arg_max(epoch_us(ts) * 1000, (epoch_us(ts), event_id)) AS ts_ns,
       arg_max(event_id, (epoch_us(ts), event_id)) AS seq, arg_max(value, (epoch_us(ts), event_id)) AS value
FROM events GROUP BY 1, 2""")
def latest_snapshot(spark, sf_dir):
    """T4 batch twin (= J1 at the end of the recording)."""
    s = L.latest_snapshot(events_as_messages(spark, sf_dir))
    return s.select("recording_id", "stream", "latest.ts_ns", "latest.seq", "latest.value")


@register("decimated_events", """
WITH e AS (SELECT user_id AS recording_id, event_type AS stream, epoch_us(ts) * 1000 AS ts_ns, event_id AS seq, value
           FROM events)
SELECT recording_id, stream, ts_ns // 3600000000000 AS bucket, arg_min(seq, (ts_ns, seq)) AS seq,
       arg_min(value, (ts_ns, seq)) AS value FROM e GROUP BY 1, 2, 3""")
def decimated_events(spark, sf_dir):
    """T7 batch twin: first message per (recording, stream, hour bucket)."""
    m = events_as_messages(spark, sf_dir)
    b = F.call_function("div", F.col("ts_ns"), F.lit(3_600_000_000_000))
    first = F.min_by(F.struct("seq", "value"), F.struct("ts_ns", "seq"))
    return (m.withColumn("bucket", b).groupBy("recording_id", "stream", "bucket")
            .agg(first.alias("f")).select("recording_id", "stream", "bucket", "f.seq", "f.value"))


@register("decimated_stream", """
SELECT DISTINCT user_id AS recording_id, event_type AS stream, epoch_us(ts) * 1000 // 3600000000000 AS bucket FROM events""")
def decimated_stream(spark, sf_dir):
    """T7 as a stream: the landed events run through ``live.decimate`` once;
    which message of a bucket arrives first is the source's business."""
    events = table(spark, sf_dir, "events")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/decimated/{uuid.uuid4().hex}"
    events.write.parquet(f"{root}/in")
    src = spark.readStream.schema(events.schema).parquet(f"{root}/in")
    m = src.select(F.col("user_id").alias("recording_id"), F.col("event_type").alias("stream"), epoch_ns("ts").alias("ts_ns"))
    kept = L.decimate(L.with_event_time(m), period_ms=3_600_000).select("recording_id", "stream", "bucket")
    q = (kept.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{root}/out")


@register("accumulated_transforms", """
WITH t AS (SELECT 'customer_' || CAST(o_custkey AS VARCHAR) AS child, o_orderkey AS seq, o_totalprice AS tx,
                  o_orderdate AS ts FROM orders),
w AS (SELECT *, time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') AS window_start FROM t)
SELECT window_start, child, arg_max(seq, (ts, seq)) AS seq, round(arg_max(tx, (ts, seq)), 6) AS tx
FROM w GROUP BY 1, 2""")
def accumulated_transforms(spark, sf_dir):
    """T5 batch twin: tumbling 30-day windows, last transform per child."""
    o = table(spark, sf_dir, "orders")
    t = o.select(F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("child"),
                 F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("tx"),
                 F.col("o_orderdate").alias("ts"))
    a = L.accumulate_window(t, seconds=30 * 86400)
    return a.select(F.col("window.start").alias("window_start"), "child",
                    F.col("last.seq").alias("seq"), r6(F.col("last.tx")).alias("tx"))


@F.pandas_udf(T.BinaryType())
def _pack_points(v: pd.Series) -> pd.Series:
    """A vector of 4 n floats as n little-endian float32 points (x, y, z, w)."""
    return v.map(lambda a: np.asarray(a, dtype="<f4").tobytes())


@register("point_cloud_explode", """
SELECT vec_id AS cloud_id, CAST(p AS BIGINT) AS point_index,
       round(CAST(embedding[4 * p + 1] AS DOUBLE), 6) AS x, round(CAST(embedding[4 * p + 2] AS DOUBLE), 6) AS y,
       round(CAST(embedding[4 * p + 3] AS DOUBLE), 6) AS z, round(CAST(embedding[4 * p + 4] AS DOUBLE), 6) AS w
FROM embeddings, range(0, 16) r(p)""")
def point_cloud_explode(spark, sf_dir):
    """each embedding packed as a binary cloud of 16 points (all 64
    elements), exploded back to rows by the vectorised decoder."""
    fields = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(4 * i).alias("offset"),
                                F.lit(7).alias("datatype"), F.lit(1).alias("count")) for i, n in enumerate("xyzw")])
    clouds = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("cloud_id"), F.call_function("div", F.size("embedding"), F.lit(4)).cast("int").alias("width"),
        F.lit(1).alias("height"), F.lit(16).alias("point_step"), F.lit(False).alias("is_bigendian"), fields.alias("fields"),
        _pack_points("embedding").alias("data"))
    p = explode_points(clouds, tuple("xyzw"))
    return p.select("cloud_id", "point_index", *[r6(F.col(c)).alias(c) for c in "xyzw"])
