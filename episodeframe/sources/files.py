"""File sources (S2-S6, S8-S11) with explicit schemas.

Every reader passes a schema (no inference pass over the data), selects
only the columns it needs (JSON/Parquet readers prune the rest), and
returns rejects as a DataFrame rather than raising on the first bad file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Episode JSON: observation/action/images values are nested JSON of varying
# shape, kept as raw JSON text per key and decoded per stream later.
FRAME_SCHEMA = T.StructType([
    T.StructField("frame_id", T.LongType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("observation", T.MapType(T.StringType(), T.StringType())),
    T.StructField("action", T.MapType(T.StringType(), T.StringType())),
    T.StructField("images", T.MapType(T.StringType(), T.StringType())),
    T.StructField("joint_states", T.StringType()),
])
EPISODE_SCHEMA = T.StructType([
    T.StructField("episode_id", T.LongType()),
    T.StructField("model", T.StringType()),
    T.StructField("task", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("num_frames", T.LongType()),
    T.StructField("joint_names", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("storage_format", T.StringType()),
    T.StructField("collection_config", T.StringType()),
    T.StructField("frames", T.ArrayType(FRAME_SCHEMA)),
])


def read_episodes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Episode JSON files -> (frame rows, rejected episodes).

    Frame rows: episode fields plus ``frame_pos`` (0-based position in the
    file) and the frame struct's fields.  Episodes without frames are
    rejected (the reference raises)."""
    ep = (spark.read.schema(EPISODE_SCHEMA).option("multiLine", True).json(path)
          .withColumn("source_file", F.col("_metadata.file_path")))
    bad = ep.where(F.col("frames").isNull() | (F.size("frames") == 0)).select(
        "source_file", "episode_id", F.lit("no frames").alias("reason"))
    good = ep.where(F.size("frames") > 0)
    fr = good.select("source_file", "episode_id", "model", "task",
                     F.col("collection_config").isNotNull().alias("has_collection_config"),
                     F.posexplode("frames").alias("frame_pos", "f")).select(
        "source_file", "episode_id", "model", "task", "has_collection_config", "frame_pos", "f.*")
    return fr, bad


# Keys that mark the episode JSON generations.
V3_OBS_KEY, V3_ACT_KEY = "right_arm_joint_states", "master_left_arm_end_pose_action"
X2_OBS_KEY, X2_ACT_KEY = "left_arm_end_pose", "left_arm_end_pose_action"


def is_v3_frame(observation: F.Column, action: F.Column) -> F.Column:
    """P18, per frame: either robot generation's observation/action key pair present."""
    return F.coalesce(
        (F.map_contains_key(observation, V3_OBS_KEY) & F.map_contains_key(action, V3_ACT_KEY))
        | (F.map_contains_key(observation, X2_OBS_KEY) & F.map_contains_key(action, X2_ACT_KEY)),
        F.lit(False))


def episode_formats(frames: DataFrame) -> DataFrame:
    """P18 per episode: ``new_format`` (first frame has the V3 observation
    key, or top-level joint states, or the episode has a collection
    config) and ``has_action`` (an action map in any of the first 5
    frames)."""
    first = F.col("frame_pos") == 0
    return frames.groupBy("source_file", "episode_id").agg(
        F.bool_or(first & (F.coalesce(F.map_contains_key("observation", V3_OBS_KEY), F.lit(False))
                           | F.col("joint_states").isNotNull())).alias("_first_new"),
        F.bool_or("has_collection_config").alias("_old"),
        F.bool_or((F.col("frame_pos") < 5) & F.col("action").isNotNull()).alias("has_action"),
    ).select("source_file", "episode_id", (F.col("_first_new") | F.col("_old")).alias("new_format"),
             "has_action")


def read_episode_metadata(spark: SparkSession, path: str) -> DataFrame:
    """S3: metadata only.  The frames array is read as ids only (the JSON
    parser skips the rest); task defaults to 'unknown', num_frames to the
    number of frames."""
    meta_schema = T.StructType([f for f in EPISODE_SCHEMA.fields if f.name != "frames"] + [
        T.StructField("frames", T.ArrayType(T.StructType([T.StructField("frame_id", T.LongType())])))])
    ep = spark.read.schema(meta_schema).option("multiLine", True).json(path)
    return ep.select("episode_id", "model", F.coalesce("task", F.lit("unknown")).alias("task"),
                     "timestamp", "duration",
                     F.coalesce("num_frames", F.size("frames").cast("long")).alias("num_frames"),
                     "joint_names", "storage_format")


def read_dataset_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Dataset metadata ``{"episodes": [...]}`` -> one row per episode."""
    s = T.StructType([T.StructField("episodes", T.ArrayType(T.StructType([
        T.StructField("episode_id", T.LongType()), T.StructField("task", T.StringType()),
        T.StructField("num_frames", T.LongType()), T.StructField("timestamp", T.StringType())])))])
    return spark.read.schema(s).option("multiLine", True).json(path).select(
        F.explode("episodes").alias("e")).select("e.*")


def read_sidecars(spark: SparkSession, path: str, recording_from_path: str = r"([^/]+)/[^/]+\.json$") -> DataFrame:
    """Optional JSON sidecars (task_meta.json, step_index.json) as one
    VARIANT per file, so key *presence* stays visible (P9).  Non-object
    documents are dropped.  ``recording_id`` comes from the parent folder."""
    df = (spark.read.option("multiLine", True).option("singleVariantColumn", "doc").json(path)
          .withColumn("source_file", F.col("_metadata.file_path")))
    return (df.where(F.schema_of_variant("doc").startswith("OBJECT"))
            .withColumn("recording_id", F.regexp_extract("source_file", recording_from_path, 1)))


def read_sidecar_files(spark: SparkSession, path: str, recording_from_path: str = r"([^/]+)/[^/]+\.json$") -> DataFrame:
    """Sidecar files as ``(recording_id, kind, part, text)``; the recording
    is the parent folder's name, the kind the file's stem.  Texts are parsed by
    ``sidecars.documents``, which tells broken files apart."""
    df = spark.read.text(path, wholetext=True).withColumn("_f", F.col("_metadata.file_path"))
    return df.select(F.regexp_extract("_f", recording_from_path, 1).alias("recording_id"),
                     F.regexp_extract("_f", r"([^/]+)\.json$", 1).alias("kind"), F.lit(0).alias("part"), F.col("value").alias("text"))


def read_sidecar_lines(spark: SparkSession, path: str) -> DataFrame:
    """S5 as a landed table: JSON lines ``{"recording_id", "kind", "part", "doc"}``,
    one file for many recordings; ``doc`` stays text."""
    return spark.read.schema("recording_id long, kind string, part int, doc string").json(path).withColumnRenamed("doc", "text")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest ``{"dataset": {...}, "tasks": [{task_id, task, files:
    [path | {path, ...}]}]}`` -> ``(task_index, task_id, task, file_index,
    file)``; both positions are kept."""
    df = spark.read.option("multiLine", True).option("singleVariantColumn", "doc").json(path)
    tasks = df.select(F.posexplode(F.variant_get("doc", "$.tasks", "array<variant>")).alias("task_index", "t"))
    files = tasks.select(
        "task_index",
        F.coalesce(F.try_variant_get("t", "$.task_id", "string"),
                   F.try_variant_get("t", "$.taskId", "string")).alias("task_id"),
        F.coalesce(F.try_variant_get("t", "$.task", "string"),
                   F.try_variant_get("t", "$.description", "string")).alias("task"),
        F.posexplode(F.variant_get("t", "$.files", "array<variant>")).alias("file_index", "f"))
    return files.select("task_index", "task_id", "task", "file_index",
                        F.coalesce(F.try_variant_get("f", "$.path", "string"),
                                   F.try_variant_get("f", "$", "string")).alias("file"))


def read_published_frames(spark: SparkSession, root: str) -> DataFrame:
    """The ``data/`` Parquet files of a published dataset, whether laid
    out as ``chunk-*/file-*.parquet`` or as Spark part files."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root.rstrip('/')}/data")


def read_stats_json(spark: SparkSession, path: str, prefix: str | None = None) -> DataFrame:
    """Stats.json as ``MAP<feature, STRUCT>``; keep features by prefix."""
    stat = T.StructType([T.StructField(n, T.ArrayType(T.DoubleType())) for n in
                         ("min", "max", "mean", "std", "count", "q01", "q10", "q50", "q90", "q99")])
    df = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), T.MapType(T.StringType(), stat))
    df = df.select(m.alias("stats"))
    if prefix:
        df = df.select(F.map_filter("stats", lambda k, v: k.startswith(prefix)).alias("stats"))
    return df.select(F.explode("stats").alias("feature", "s")).select("feature", "s.*")


def read_raw_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Raw-stream manifest; files with zero records are skipped."""
    s = T.StructType([
        T.StructField("episode_id", T.LongType()), T.StructField("created", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("files", T.MapType(T.StringType(), T.StructType([
            T.StructField("records", T.LongType()), T.StructField("record_format", T.StringType())])))])
    df = spark.read.schema(s).option("multiLine", True).json(path)
    return (df.select("episode_id", F.explode("files").alias("file", "info"))
            .select("episode_id", "file", "info.records", "info.record_format")
            .where(F.col("records") > 0))


ROBOT_JOINT_SCHEMA = ("_name string, _type string, parent struct<_link: string>, child struct<_link: string>, "
                      "limit struct<_lower: double, _upper: double, _effort: double, _velocity: double>")


def read_robot_joints(spark: SparkSession, path: str) -> DataFrame:
    """Joints of robot model files (name, type, parent, child, limits) via
    the XML source, in a fixed schema; a joint without an element has nulls.
    Folders named ``model=...`` give a ``model`` column."""
    df = spark.read.format("xml").schema(ROBOT_JOINT_SCHEMA).option("rowTag", "joint").option("attributePrefix", "_").load(path)
    model = ["model"] if "model" in df.columns else []
    return df.where(F.col("_name").isNotNull()).select(
        *model, F.col("_name").alias("name"), F.col("_type").alias("type"), F.col("parent._link").alias("parent"), F.col("child._link").alias("child"),
        *[F.col(f"limit._{a}").alias(a) for a in ("lower", "upper", "effort", "velocity")])


def read_raw_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """S10 as a landed table: one JSON line per recording with its files; files
    with zero records are skipped."""
    info = "struct<records: bigint, record_format: string, merged_format: string>"
    df = spark.read.schema(f"recording_id long, files map<string, {info}>").json(path)
    return (df.select("recording_id", F.explode("files").alias("stream", "info"))
            .select("recording_id", "stream", "info.records", "info.record_format", "info.merged_format").where(F.col("records") > 0))
