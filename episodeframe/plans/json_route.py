"""JSON episodes to a training set (Entry C).

    frames (S2) -> format per episode (P18) -> one normalised form, sensors and
    commands as maps of VARIANTs -> state and action (F10, F13; W2, W3 where an
    episode has no actions) -> relative start, delta (W4, W5) -> common width (F14)

Three generations of episode files differ in where joint states and actions
stand; the form is chosen per episode, so a set may mix them.  Widths are
profiled over all frames and shorter vectors padded with zeros."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodeframe.functions import typed as Y
from episodeframe.functions import variants as V
from episodeframe.functions.typed import TypedField
from episodeframe.operators.actions import delta_action, future_chunk, relative_to_first
from episodeframe.operators.blocks import block_of, dense_index
from episodeframe.session import cut_lineage
from episodeframe.sources.files import FRAME_SCHEMA, episode_formats, is_v3_frame

KEYS = ["source_file", "episode_id"]


def read_episode_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2 for episodes landed as JSON lines, one frame each (K7): rows as
    ``read_episodes`` gives them; no episode is one record.  ``frame_pos`` is the
    frame's place by ``frame_id``."""
    schema = T.StructType([T.StructField("episode_id", T.LongType()), T.StructField("model", T.StringType()), T.StructField("task", T.StringType()),
                           T.StructField("collection_config", T.StringType()), *FRAME_SCHEMA.fields])
    rows = spark.read.schema(schema).json(path).withColumn("source_file", F.lit(path))
    rows = rows.withColumn("has_collection_config", F.col("collection_config").isNotNull()).drop("collection_config")
    return dense_index(cut_lineage(rows), KEYS, ["frame_id"], "frame_pos", block_col=block_of("frame_id", 1 << 16))


def _variants(m: Column) -> Column:
    return F.transform_values(m, lambda k, v: F.try_parse_json(v))


@dataclass
class Routed:
    frames: DataFrame
    state_width: int
    action_width: int


def normalised(frames: DataFrame) -> DataFrame:
    """Frames with ``form`` (``v3`` or ``joints``), ``has_action``, ``sensors`` and
    ``commands``.

    v3: observation and action are the maps.  Older files hold joint states in the
    frame, as [positions, velocities, efforts] or as an object with positions."""
    first_v3 = frames.where("frame_pos = 0").select(*KEYS, is_v3_frame(F.col("observation"), F.col("action")).alias("_v3"))
    known = episode_formats(frames).join(first_v3, KEYS, "left")
    joints = F.try_parse_json("joint_states")
    positions = F.when(V.kind(joints) == "ARRAY", F.try_variant_get(joints, "$[0]", "variant")).otherwise(V.member(joints, "positions"))
    own = F.create_map(F.lit("joint_states"), positions)
    empty = F.create_map().cast("map<string,variant>")
    f = frames.join(known, KEYS)
    return f.select(
        *KEYS, "model", F.coalesce("task", F.lit("unknown")).alias("task"), "frame_pos", "timestamp",
        F.when(F.coalesce("_v3", F.lit(False)), "v3").otherwise("joints").alias("form"), "has_action", "new_format",
        F.when(F.coalesce("_v3", F.lit(False)), F.coalesce(_variants(F.col("observation")), empty)).otherwise(own).alias("sensors"),
        F.coalesce(_variants(F.col("action")), empty).alias("commands"))


def route(frames: DataFrame, state: list[TypedField], action: list[TypedField], joints: list[int] | None = None, chunk: int = 32,
          relative_start: bool = False, delta: bool = False) -> Routed:
    """Training frames: keys, model, task, form, frame_pos, timestamp, state, action.

    ``joints`` picks joints of older files.  Without actions in an episode its
    action is the next ``chunk`` states and its last frame goes.  ``delta``
    subtracts the unshifted state, not from chunks."""
    n = normalised(frames)
    own = F.try_variant_get(F.element_at("sensors", F.lit("joint_states")), "$", "array<double>")
    picked = own if joints is None else F.filter(F.array(*[F.get(own, F.lit(j)) for j in joints]), lambda x: x.isNotNull())
    v3 = F.col("form") == "v3"
    n = n.select(*KEYS, "model", "task", "form", "has_action", "frame_pos", "timestamp",
                 F.when(v3, Y.vector(F.col("sensors"), state)).otherwise(picked).alias("state"),
                 F.when(F.col("has_action"), F.when(v3, Y.vector(F.col("commands"), action)).otherwise(Y.commands(F.col("commands")))).alias("given"))
    n = cut_lineage(n)
    without = future_chunk(n.where("not has_action").drop("given"), KEYS, "frame_pos", "state", k=chunk, out="action")
    both = n.where("has_action").withColumnRenamed("given", "action").unionByName(without.where("action is not null"))
    if delta:
        plain = both if not relative_start else cut_lineage(both)
        both = plain.withColumn("_plain", F.col("state"))
    if relative_start:
        both = relative_to_first(both, KEYS, "frame_pos", ["state", "action"])
    if delta:
        both = both.withColumn("action", F.when(F.col("has_action"), delta_action(F.col("action"), F.col("_plain"))).otherwise(F.col("action"))).drop("_plain")
    both = cut_lineage(both)
    widths = both.agg(F.max(F.size("state")), F.max(F.size("action"))).first()
    s, a = (max(w or 0, 0) for w in widths)
    none = F.array().cast("array<double>")
    out = both.select(*KEYS, "model", "task", "form", "frame_pos", "timestamp", Y.fit(F.coalesce("state", none), s).cast("array<float>").alias("state"),
                      Y.fit(F.coalesce("action", none), a).cast("array<float>").alias("action"))
    return Routed(out, s, a)
