"""Per-camera video ranges of episodes.

Frames of a camera lie end to end in its video files.  A file takes the episodes
whose first frame (counted over the camera) falls into its share of frames, so
no episode is split; time inside a file starts anew at each file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodeframe.operators.blocks import Scan, global_scan

CAMERA, EPISODE = "camera", "episode_index"
CHUNK_FILES = 1000
FIELDS = ["chunk_index", "file_index", "from_timestamp", "to_timestamp"]


def column(camera: str, field: str) -> str:
    return f"videos/{camera}/{field}"


def camera_rows(episodes: DataFrame, cameras: list[str], length: str = "length") -> DataFrame:
    """One row per episode and camera; ``n_frames`` is the episode's length."""
    return (episodes.withColumn(CAMERA, F.explode(F.array(*[F.lit(c) for c in cameras]).cast("array<string>")))
            .withColumn("n_frames", F.col(length).cast("long")))


def camera_ranges(rows: DataFrame, fps: float, frames_per_file: int, keys: list[str] | None = None,
                  chunk_files: int = CHUNK_FILES) -> DataFrame:
    """K3: ``(keys, camera, episode_index, n_frames)`` -> file and time range.

    The frames before an episode are a prefix sum over one global order, cut
    into ranges, less those before its (keys, camera); the first frame of each
    file gives the reset of its clock.  A camera of any length is scanned by many
    tasks."""
    by = [*(keys or []), CAMERA]
    scanned = global_scan(rows, [*by, EPISODE], [Scan("_before", "n_frames", "sum", inclusive=False)])
    base = scanned.groupBy(*by).agg(F.min("_before").alias("_base"))
    at = scanned.join(base, by).withColumn("_start", F.col("_before") - F.col("_base"))
    at = at.withColumn("file_index", F.call_function("div", F.col("_start"), F.lit(frames_per_file).cast("long")))
    first = at.groupBy(*by, "file_index").agg(F.min("_start").alias("_first"))
    out = at.join(first, [*by, "file_index"])
    begin = F.col("_start") - F.col("_first")
    return out.select(*by, EPISODE, "n_frames", F.call_function("div", F.col("file_index"), F.lit(chunk_files).cast("long")).alias("chunk_index"),
                      "file_index", (begin / F.lit(float(fps))).alias("from_timestamp"),
                      ((begin + F.col("n_frames")) / F.lit(float(fps))).alias("to_timestamp"))


def video_files(ranges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The files that the ranges name, with their frames."""
    return ranges.groupBy(*(keys or []), CAMERA, "chunk_index", "file_index").agg(F.sum("n_frames").alias("n_frames"))


def wide(ranges: DataFrame, cameras: list[str], keys: list[str] | None = None) -> DataFrame:
    """One row per episode with the columns ``videos/<camera>/<field>``."""
    return ranges.groupBy(*(keys or []), EPISODE).agg(*[
        F.max(F.when(F.col(CAMERA) == c, F.col(f))).alias(column(c, f)) for c in cameras for f in FIELDS])
