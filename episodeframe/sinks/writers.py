"""Sinks for the published dataset and the collection outputs.

Writers go through Spark's commit protocol (a job's files appear
atomically on success).  Frames are range-partitioned by the global index
so files hold contiguous index ranges; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodeframe.functions.text import chunk_file_path
from episodeframe.operators.stats import pack_stats


ROWS_PER_FILE = 1 << 20
CHUNK_FILES = 1000


def file_columns(index: str, rows_per_file: int = ROWS_PER_FILE) -> list:
    """``chunk_index`` and ``file_index`` of a global row number: a file folder
    holds ``rows_per_file`` consecutive rows, a chunk folder so many files."""
    file = F.call_function("div", F.col(index), F.lit(rows_per_file).cast("long"))
    return [F.call_function("div", file, F.lit(CHUNK_FILES).cast("long")).alias("chunk_index"), file.alias("file_index")]


def write_frames(frames: DataFrame, root: str, files: int | None = None, rows_per_file: int = ROWS_PER_FILE,
                 ranged: bool = False) -> None:
    """K1: ``data/chunk_index=C/file_index=F/`` as Parquet; fails if the output
    already exists.  Frames are range-partitioned and sorted by ``index``;
    ``ranged`` says that they lie in range partitions of it already
    (``renumber``)."""
    cols = ["timestamp", "frame_index", "episode_index", "index", "task_index",
            "observation.state", "action"] + [c for c in frames.columns if c.startswith("observation.images.")]
    df = frames.select(*[F.col(f"`{c}`") for c in cols if c in frames.columns], *file_columns("index", rows_per_file))
    if not ranged:
        df = df.repartitionByRange(files, "index") if files else df.repartitionByRange("index")
    (df.sortWithinPartitions("chunk_index", "file_index", "index").write.partitionBy("chunk_index", "file_index")
     .mode("errorifexists").parquet(f"{root.rstrip('/')}/data"))


def write_tasks(tasks: DataFrame, root: str) -> None:
    """K2: ``meta/tasks`` (task_index, task)."""
    tasks.select(F.col("task_index").cast("long"), "task").write.mode("errorifexists").parquet(
        f"{root.rstrip('/')}/meta/tasks")


def write_episodes(episodes: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """K3: ``meta/episodes``: tasks as a list, length, index range, the data
    folder of the first frame and any per-camera video columns present."""
    chunk, file = file_columns("dataset_from_index", rows_per_file)
    df = episodes.select(
        "episode_index", F.array(F.col("task")).alias("tasks"), "length", "dataset_from_index",
        "dataset_to_index", chunk.alias("data/chunk_index"), file.alias("data/file_index"),
        *[F.col(f"`{c}`") for c in episodes.columns if c.startswith("videos/")])
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/meta/episodes")


def stats_json(stats: DataFrame) -> DataFrame:
    """K4: one row holding ``{feature: {min: [...], max: [...], ...}}`` as
    JSON (stats rows are per feature and position, so this is small)."""
    packed = pack_stats(stats)
    names = [c for c in packed.columns if c != "feature"]
    return packed.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
        "feature", F.struct(*names))))).alias("json"))


def video_total(episodes: DataFrame, cameras: list[str]) -> DataFrame:
    """K5: one row with ``total_videos``, the distinct files of all cameras."""
    files = [F.count_distinct(F.col(f"`videos/{c}/file_index`")) for c in cameras]
    return episodes.agg(sum(files, F.lit(0)).cast("long").alias("total_videos"))


def info_json(totals: DataFrame, fps: int, features: dict[str, int], chunks_size: int = CHUNK_FILES, videos: DataFrame | None = None,
              cameras: list[str] | None = None, image_size: tuple[int, int] | None = None,
              rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """K5: totals, ``splits = {"train": "0:N"}``, feature shapes and path
    templates as one JSON row.  Chunks are those of the frames' files; a camera
    is a feature of kind ``video`` (with ``image_size`` = height, width)."""
    shape = F.array(F.lit(3), *map(F.lit, image_size)) if image_size else F.lit(None).cast("array<int>")
    none = F.lit(None).cast("struct<`video.fps`:double>")
    feats = F.create_map(*[x for name, width in features.items() for x in (
        F.lit(name), F.struct(F.lit("float32").alias("dtype"), F.array(F.lit(width)).alias("shape"), none.alias("info")))],
        *[x for c in cameras or [] for x in (F.lit(f"observation.images.{c}"), F.struct(
            F.lit("video").alias("dtype"), shape.alias("shape"), F.struct(F.lit(float(fps)).alias("video.fps")).alias("info")))])
    totals = totals.crossJoin(videos) if videos is not None else totals.withColumn("total_videos", F.lit(0).cast("long"))  # one row each
    files = F.ceil(F.col("total_frames") / rows_per_file)
    return totals.select(F.to_json(F.struct(
        F.col("total_episodes"), F.col("total_frames"), F.col("total_tasks"), F.col("total_videos"),
        F.ceil(files / chunks_size).alias("total_chunks"),
        F.lit(fps).alias("fps"), F.lit(chunks_size).alias("chunks_size"),
        F.create_map(F.lit("train"), F.concat(F.lit("0:"), F.col("total_episodes").cast("string"))).alias("splits"),
        F.lit("data/chunk_index={chunk_index}/file_index={file_index}").alias("data_path"),
        F.lit("videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4").alias("video_path"),
        feats.alias("features"))).alias("json"))


def write_small_json(df: DataFrame, path: str) -> None:
    """K4/K5/K6 helper: a one-row JSON document (single output file)."""
    df.coalesce(1).write.mode("errorifexists").text(path)


def write_source_manifest(manifest: DataFrame, path: str) -> None:
    """K6: source -> task lineage as JSON lines."""
    manifest.write.mode("errorifexists").json(path)


def write_episode_json(frames: DataFrame, path: str, episode: str = "episode_id") -> None:
    """K7 (re-aimed): episode frames as JSON lines partitioned by episode,
    one folder per episode, instead of one document holding every frame
    (which would pull a whole episode into one record)."""
    # Range partitioning splits a long episode over several tasks (a hash on
    # the episode alone would put a hot episode in one task).
    frames.repartitionByRange(episode, "frame_id").sortWithinPartitions(episode, "frame_id").write.partitionBy(
        episode).mode("errorifexists").json(path)


def write_raw_streams(messages: DataFrame, path: str) -> None:
    """K8: raw pre-alignment messages, partitioned by recording and stream."""
    messages.write.partitionBy("recording_id", "stream").mode("errorifexists").parquet(path)


def raw_manifest(messages: DataFrame, payload: str = "payload", expected: DataFrame | None = None) -> DataFrame:
    """A10: per (recording, stream): record count, the shape of the first record
    and ``merged_format``, the shape that holds all records.

    ``expected`` rows (recording_id, stream) without a message are listed with
    zero records."""
    first = F.min_by(F.col(payload), F.struct("ts_ns", "seq"))
    m = (messages.groupBy("recording_id", "stream")
         .agg(F.count(F.lit(1)).alias("records"), first.alias("_first"), F.schema_of_variant_agg(F.try_parse_json(payload)).alias("merged_format"))
         .withColumn("record_format", F.schema_of_variant(F.try_parse_json("_first"))).drop("_first"))
    if expected is None:
        return m
    return (expected.select("recording_id", "stream").distinct().join(m, ["recording_id", "stream"], "full")
            .withColumn("records", F.coalesce("records", F.lit(0).cast("long"))))


def write_raw_manifest(manifest: DataFrame, path: str) -> None:
    """K8: the manifest as JSON lines, one per recording; its ``files`` are as
    many as the recording has streams."""
    info = F.struct("records", "record_format", "merged_format")
    (manifest.groupBy("recording_id").agg(F.map_from_entries(F.collect_list(F.struct("stream", info))).alias("files"))
     .write.mode("errorifexists").json(path))


def append_episode_rows(rows: DataFrame, path: str) -> None:
    """Append episode metadata rows to the dataset metadata table."""
    rows.write.mode("append").parquet(path)


__all__ = ["write_frames", "write_tasks", "write_episodes", "stats_json", "info_json", "write_small_json",
           "write_source_manifest", "write_episode_json", "write_raw_streams", "raw_manifest",
           "append_episode_rows", "chunk_file_path"]
