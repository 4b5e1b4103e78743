"""Readers for the landed tables and their mapping onto the data model.

``events`` plays the landed message table: recording = ``user_id``, stream
= ``event_type``, ``ts_ns = unix_micros(ts) * 1000``, ``seq = event_id``,
payload = ``value`` (JSON payload = ``props``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodeframe.functions.timeunits import epoch_ns

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_messages(spark: SparkSession, sf_dir: str,
                       streams: list[str] | None = None) -> DataFrame:
    """S1 over ``events``: ``recording_id, stream, msgtype, ts_ns, seq,
    value, payload``.  A stream filter is pushed to the Parquet scan (P1)."""
    ev = table(spark, sf_dir, "events")
    if streams is not None:
        ev = ev.where(F.col("event_type").isin(list(streams)))
    return ev.select(
        F.col("user_id").alias("recording_id"),
        F.col("event_type").alias("stream"),
        F.concat(F.lit("events/"), F.col("event_type")).alias("msgtype"),
        epoch_ns("ts").alias("ts_ns"),
        F.col("event_id").alias("seq"),
        F.col("value"),
        F.col("props").alias("payload"))


def embeddings_as_poses(spark: SparkSession, sf_dir: str, step_ns: int = 1_000_000) -> DataFrame:
    """``embeddings`` as a pose stream: recording = ``label``, arrival order
    = ``vec_id``, ``ts_ns = vec_id * step_ns``; position = elements 5-7,
    orientation = normalised elements 1-4 (x, y, z, w)."""
    e = table(spark, sf_dir, "embeddings")
    v = [F.col("embedding")[i].cast("double") for i in range(7)]
    n = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2] + v[3] * v[3])
    return e.select(
        F.col("label").cast("long").alias("recording_id"),
        F.lit("arm_end_pose").alias("stream"),
        (F.col("vec_id") * F.lit(step_ns)).alias("ts_ns"),
        F.col("vec_id").alias("seq"),
        F.struct(v[4].alias("x"), v[5].alias("y"), v[6].alias("z")).alias("position"),
        F.struct((v[0] / n).alias("x"), (v[1] / n).alias("y"),
                 (v[2] / n).alias("z"), (v[3] / n).alias("w")).alias("orientation"))
