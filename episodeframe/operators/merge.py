"""Merging many converted sources into one renumbered dataset (W6, W7,
J11, J12, J14, U1, A14).

Global numbering never runs a window over all frames in one partition:
episode lengths are counted per episode (map-side combined), the small
episode table gets its running offsets from a blocked prefix sum, and
frames take ``index = dataset_from_index + frame_index`` through a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.operators.blocks import Scan, block_of, dense_index, global_scan, tasks_for
from episodeframe.session import cut_lineage, release_tables, tables_written


def union_sources(tables: list[DataFrame]) -> DataFrame:
    """Concatenate per-source tables by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def first_seen_order(df: DataFrame, name: str, pos: str | list[str], out: str = "ordinal") -> DataFrame:
    """Distinct names numbered by first appearance (``pos`` order)."""
    pos_cols = [pos] if isinstance(pos, str) else pos
    first = df.groupBy(name).agg(F.min(F.struct(*pos_cols)).alias("_first"))
    return _rank_small(first, "_first", out).drop("_first")


def _rank_small(df: DataFrame, order_col: str, out: str) -> DataFrame:
    """0-based rank over a dimension table (tasks, sources) of any size."""
    return global_scan(df, [order_col], [Scan(out, "_one", "sum", inclusive=False)])


def episode_offsets(episodes: DataFrame, order: list[str], length: str = "length") -> DataFrame:
    """W6 on the episode table: ``episode_index`` (0.. in ``order``) and
    ``dataset_from_index``/``dataset_to_index`` (running frame offsets).

    The episodes are cut into ranges of ``order``, so a source that holds most
    of them is scanned by many tasks."""
    r = global_scan(episodes, order, [Scan("episode_index", "_one", "sum", inclusive=False),
                                      Scan("dataset_from_index", length, "sum", inclusive=False)])
    return r.withColumn("dataset_to_index", F.col("dataset_from_index") + F.col(length))


def renumber(frames: DataFrame, episode_key: list[str], frame_order: list[str],
             episode_order: list[str], materialize: bool = True, ranged: bool = False) -> tuple[DataFrame, DataFrame]:
    """Returns ``(frames, episodes)``.

    frames gain ``frame_index`` (0.. per episode in ``frame_order``),
    ``episode_index`` and ``index`` (global running row number).  episodes
    carry ``length`` and the index range.  ``episode_order`` columns must be
    present on ``frames`` (constant per episode).

    The frames are read by three consumers (the dense frame index and its
    block summaries, the episode lengths, the final offset join), so they are
    that are a plain Parquet scan already.

    Where ``episode_order`` orders by columns of the key, an episode has one row
    and the frames are shuffled once for their number and their episode's;
    ``ranged`` then leaves them in range partitions of ``index``."""
    if ranged and set(episode_order) != set(episode_key):
        raise ValueError("frames are in ranges of their index only if the episodes are ordered by their key")
    if materialize:
        frames = cut_lineage(frames)
    eps = (frames.groupBy(*episode_key, *[c for c in episode_order if c not in episode_key])
           .agg(F.count(F.lit(1)).alias("length")))
    since = tables_written()
    eps = cut_lineage(episode_offsets(eps, episode_order))  # read by the frames and by the caller
    release_tables(frames.sparkSession, since, keep=1)
    first = eps.select(*episode_key, "episode_index", "dataset_from_index")
    block = block_of(frame_order[0], 1 << 16)
    if set(episode_order) <= set(episode_key):
        n = tasks_for(frames.sparkSession, eps.agg(F.sum("length")).first()[0])
        out = dense_index(frames, episode_key, frame_order, "frame_index", block, attach=first, partitions=n,
                          ranges=episode_order if ranged else None)
    else:
        out = dense_index(frames, episode_key, frame_order, "frame_index", block).join(first, episode_key)
    return out.withColumn("index", F.col("dataset_from_index") + F.col("frame_index")).drop("dataset_from_index"), eps


def video_file_index(files: DataFrame, source_order: list[str], local_index: str = "local_file_index",
                     out: str = "file_index") -> DataFrame:
    """Dense global video file index across sources.

    ``files`` holds one row per (source, local file index) for the first
    camera; sources are numbered in ``source_order`` and each source's
    files follow the previous sources' files in local index order."""
    return global_scan(files, [*source_order, local_index], [Scan(out, "_one", "sum", inclusive=False)])


def map_video_files(episodes: DataFrame, file_map: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Attach the global file index to each episode; the second result
    holds episodes whose local file has no mapping (an error upstream)."""
    mapped = episodes.join(file_map, keys, "left")
    return mapped, mapped.where(F.col("file_index").isNull())


def missing_camera_files(files: DataFrame, cameras: list[str], first_camera: str,
                         source: list[str], local_index: str = "local_file_index",
                         camera: str = "camera") -> DataFrame:
    """(source, file, camera) triples where the first camera has a file
    index that another camera lacks."""
    base = files.where(F.col(camera) == first_camera).select(*source, local_index).distinct()
    wanted = base.withColumn(camera, F.explode(F.array(*[F.lit(c) for c in cameras])))
    have = files.select(*source, local_index, camera).distinct()
    return wanted.join(have, source + [local_index, camera], "left_anti")


def attach_task_index(frames: DataFrame, tasks: DataFrame, key: str = "task") -> DataFrame:
    """Task text -> ``task_index`` on every frame.  The task table is a
    dimension (one row per task) and is broadcast when AQE sees it small."""
    return frames.join(tasks.select(key, "task_index"), key, "left")
