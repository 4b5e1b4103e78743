"""Topic routing, preferred-topic selection and presence checks (P1-P4,
J7, J9, J10, A3, A4).

The topic dimension comes from the config (bounded by its size), so it is
broadcast; everything per recording is an aggregation, never a cross
product of recordings and config rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REC = "recording_id"


def filter_topics(messages: DataFrame, topics: list[str], topic: str = "topic") -> DataFrame:
    """Keep configured topics only; the literal list reaches the Parquet
    scan as a pushed ``In`` filter."""
    return messages.where(F.col(topic).isin(list(topics)))


def route_topics(messages: DataFrame, dim: DataFrame, topic: str = "topic") -> DataFrame:
    """Attach field/decoder/priority/required/kind from the topic dim."""
    return messages.join(F.broadcast(dim), messages[topic] == dim["topic"]).drop(dim["topic"])


def drop_empty_payloads(messages: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(kept rows, per-topic counts of dropped empty payloads)."""
    empty = F.col(payload).isNull() | (F.length(F.col(payload)) == 0)
    dropped = (messages.where(empty).groupBy(REC, "topic")
               .agg(F.count(F.lit(1)).alias("dropped_empty")))
    return messages.where(~empty), dropped


def tolerant_decode(messages: DataFrame, schema: T.DataType, payload: str = "payload",
                    out: str = "decoded") -> DataFrame:
    """JSON decode where unreadable payloads become null instead of
    failing the job; ``decode_error`` flags them."""
    parsed = F.from_json(F.col(payload), schema, {"mode": "PERMISSIVE"})
    ok = F.try_parse_json(F.col(payload)).isNotNull()
    return (messages.withColumn(out, F.when(ok, parsed))
            .withColumn("decode_error", ~ok | F.col(out).isNull()))


def reject_counts(decoded: DataFrame, reasons: dict[str, F.Column], topic: str = "topic") -> DataFrame:
    """A4: ``(topic, reason, count)`` for each named reject condition with
    at least one hit; one pass over the data (conditional counts, then
    unpivot)."""
    names = list(reasons)
    agg = decoded.groupBy(topic).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"_r{i}")
                                       for i, c in enumerate(reasons.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("reason"), F.col(f"_r{i}").alias("count"))
                      for i, n in enumerate(names)])
    return (agg.select(topic, F.inline(pairs)).where(F.col("count") > 0)
            .select(topic, "reason", "count"))


def topic_counts(routed: DataFrame, rec: str = REC) -> DataFrame:
    """A1: rows per (recording, field, topic) with the topic's priority."""
    return (routed.groupBy(rec, "field", "topic", "priority", "kind")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def preferred_topics(counts: DataFrame, rec: str = REC) -> DataFrame:
    """A3: per (recording, field) the candidate minimising (empty?,
    priority, -count, topic name)."""
    w = Window.partitionBy(rec, "field").orderBy(
        (F.col("n_rows") == 0).asc(), F.col("priority").asc(), F.col("n_rows").desc(), F.col("topic").asc())
    return (counts.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
            .withColumn("selected_topic", F.when(F.col("n_rows") > 0, F.col("topic"))))


def missing_required(present: DataFrame, required: list[str], rec: str = REC,
                     name: str = "field", all_recordings: DataFrame | None = None) -> DataFrame:
    """``(recording, missing)`` for every required name a
    recording lacks.  Per recording the present names are collected (a set
    bounded by the config), and the config list minus that set is exploded."""
    have = present.groupBy(rec).agg(F.collect_set(name).alias("_have"))
    if all_recordings is not None:
        have = all_recordings.select(rec).distinct().join(have, rec, "left")
    need = F.array(*[F.lit(r) for r in required]) if required else F.array().cast("array<string>")
    miss = F.array_except(need, F.coalesce(F.col("_have"), F.array().cast("array<string>")))
    return have.select(rec, F.explode(miss).alias("missing"))


def missing_data_keys(present: DataFrame, keys: list[tuple[str, str]], rec: str = REC,
                      all_recordings: DataFrame | None = None) -> DataFrame:
    """Enabled data keys ``(key, severity)`` that are empty or absent
    per recording (master-arm keys carry severity 'warn')."""
    sev = F.create_map(*[F.lit(x) for kv in keys for x in kv])
    m = missing_required(present, [k for k, _ in keys], rec, "field", all_recordings)
    return m.select(rec, F.col("missing").alias("data_key"), F.element_at(sev, F.col("missing")).alias("severity"))


def empty_after_alignment(frames: DataFrame, fields: list[str], rec: str = REC,
                          severity: dict[str, str] | None = None) -> DataFrame:
    """J10, after alignment: per recording, the aligned fields with no value
    in any frame (one aggregation over the frames), with severity
    (default 'error'; e.g. master-arm keys 'warn')."""
    severity = severity or {}
    agg = frames.groupBy(rec).agg(*[F.count(F.col(f"`{f}`")).alias(f"_n{i}") for i, f in enumerate(fields)])
    pairs = F.array(*[F.struct(F.lit(f).alias("data_key"), F.col(f"_n{i}").alias("_n"),
                               F.lit(severity.get(f, "error")).alias("severity"))
                      for i, f in enumerate(fields)])
    return (agg.select(rec, F.inline(pairs)).where(F.col("_n") == 0)
            .select(rec, "data_key", "severity"))
