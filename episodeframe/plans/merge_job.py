"""Merging published data sets into one (Entry B).

    manifest (S6) -> frames and episodes of every source (S8, source order from
    the file's path) -> rejects per source (F22, J12) -> renumber (W6, J11)
    -> global video files (W7, J12) -> frames / tasks / episodes / stats / info /
    lineage (K1-K6)

A source is a folder below ``base``; the manifest names it and its position
gives the order.  One scan reads the frames of all sources: the folder is cut
from each row's file path and joined to the manifest.  With ``strict`` nothing
is written if any source is rejected; otherwise the rejected ones are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodeframe.operators import merge as M
from episodeframe.operators import stats as S
from episodeframe.operators import videos as V
from episodeframe.operators.blocks import Scan, global_scan
from episodeframe.session import cut_lineage, release_tables, shuffles_removed, tables_written
from episodeframe.sinks import writers as W
from episodeframe.sources.files import read_published_frames

SOURCE = ["task_index", "file_index"]           # position in the manifest
NOT_FOUND, NO_ROWS, EMPTY_EPISODE = "source not found", "no data rows", "episode without data rows"
OTHER_WIDTH, NO_VIDEO = "vector width differs", "video file missing"


@dataclass
class Layout:
    """Folders of a source's tables below the source."""

    data: str = "data"
    episodes: str = "meta/episodes"
    videos: str = "meta/video_files"


@dataclass
class Merged:
    frames: DataFrame
    episodes: DataFrame
    tasks: DataFrame
    lineage: DataFrame
    rejects: DataFrame
    cameras: list[str] = field(default_factory=list)


def _folder(path) -> F.Column:
    """Last part of a path."""
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def _read(spark: SparkSession, base: str, folder: str, schema: str) -> DataFrame:
    """Rows of one table of all sources below ``base``, with the source's folder."""
    root = base.rstrip("/")
    df = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/*/{folder}")
    # every row asks for its path: plain cuts, a pattern and a decoder cost more than the row itself
    at = F.substring_index(F.substring_index(F.col("_metadata.file_path"), f"/{folder}/", 1), "/", -1)
    return df.withColumn("_folder", F.when(at.contains("%") | at.contains("+"), F.url_decode(at)).otherwise(at))


def source_tables(spark: SparkSession, manifest: DataFrame, base: str, cameras: list[str], layout: Layout) -> tuple[DataFrame, ...]:
    """(sources, frames, episodes, video files), each with the manifest position."""
    sources = cut_lineage(manifest.select(*SOURCE, "task_id", "task", "file", _folder(F.col("file")).alias("_folder")))
    key = sources.select(*SOURCE, "_folder")
    video = ", ".join(f"`{V.column(c, f)}` {'double' if f.endswith('timestamp') else 'long'}" for c in cameras for f in V.FIELDS)
    frames = _read(spark, base, layout.data, "timestamp double, episode_index long, index long, `observation.state` array<float>, action array<float>")
    episodes = _read(spark, base, layout.episodes, "episode_index long, length long" + (", " + video if video else ""))
    files = _read(spark, base, layout.videos, "camera string, chunk_index long, file_index long") if cameras else None

    def placed(df: DataFrame) -> DataFrame:
        return df.join(key, "_folder").drop("_folder")

    return sources, placed(frames), placed(episodes), placed(files.withColumnRenamed("file_index", "local_file")) if cameras else None


def check_sources(sources: DataFrame, frames: DataFrame, episodes: DataFrame, files: DataFrame | None, cameras: list[str],
                  width: int) -> DataFrame:
    """Rejects: manifest position, file, reason, count of the rows at fault."""
    counted = cut_lineage(frames.groupBy(*SOURCE, "episode_index").agg(F.count(F.lit(1)).alias("rows"), F.count_if(
        F.coalesce((F.size("`observation.state`") != width) | (F.size("action") != width), F.lit(True))).alias("bad")))
    per = counted.groupBy(*SOURCE).agg(F.sum("bad").alias("bad"))
    listed = episodes.select(*SOURCE).distinct()
    state = sources.join(per, SOURCE, "left").join(listed.withColumn("_listed", F.lit(True)), SOURCE, "left")
    reason = F.when(F.col("bad").isNull() & F.col("_listed").isNull(), NOT_FOUND).when(F.col("bad").isNull(), NO_ROWS).when(F.col("bad") > 0, OTHER_WIDTH)
    out = state.where(reason.isNotNull()).select(*SOURCE, reason.alias("reason"), F.coalesce("bad", F.lit(0).cast("long")).alias("n"))
    empty = (episodes.select(*SOURCE, "episode_index").join(counted, [*SOURCE, "episode_index"], "left_anti")
             .join(per.select(*SOURCE), SOURCE, "left_semi").groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("n")))
    out = out.unionByName(empty.select(*SOURCE, F.lit(EMPTY_EPISODE).alias("reason"), "n"))
    if cameras:
        out = out.unionByName(_missing(episodes, files, cameras).groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("n")).select(*SOURCE, F.lit(NO_VIDEO).alias("reason"), "n"))
    return out.join(sources.select(*SOURCE, "file"), SOURCE).select(*SOURCE, "file", "reason", "n")


def _ranges(episodes: DataFrame, cameras: list[str]) -> DataFrame:
    """Camera files that episodes name; the source's own file number is ``local_file``."""
    rows = [F.struct(F.lit(c).alias(V.CAMERA), *[F.col(f"`{V.column(c, f)}`").alias("local_file" if f == "file_index" else f) for f in V.FIELDS])
            for c in cameras]
    return episodes.select(*SOURCE, "episode_index", F.inline(F.array(*rows)))


def _missing(episodes: DataFrame, files: DataFrame, cameras: list[str]) -> DataFrame:
    at = [*SOURCE, V.CAMERA, "local_file"]
    return _ranges(episodes, cameras).select(*at).distinct().join(files.select(*at).distinct(), at, "left_anti")


def merge_published(spark: SparkSession, manifest: DataFrame, base: str, width: int, cameras: list[str] | None = None,
                    strict: bool = True, layout: Layout | None = None) -> Merged:
    """The merged tables, not yet written; frames lie in ranges of their index."""
    cameras = cameras or []
    sources, frames, episodes, files = source_tables(spark, manifest, base, cameras, layout or Layout())
    since = tables_written()
    rejects = cut_lineage(check_sources(sources, frames, episodes, files, cameras, width))
    release_tables(spark, since, keep=1)
    if strict and not rejects.isEmpty():
        listed = rejects.orderBy(*SOURCE).limit(20).collect()
        raise ValueError("rejected sources: " + "; ".join(f"{r.file}: {r.reason} ({r.n})" for r in listed))
    bad = rejects.select(*SOURCE).distinct()
    frames, episodes, good = (t.join(bad, SOURCE, "left_anti") for t in (frames, episodes, sources))
    own = frames.withColumnsRenamed({"index": "_source_index", "episode_index": "source_episode", "observation.state": "_state"})
    # the frames are a Parquet scan; who needs the episodes alone reads no vectors
    frames, numbered = M.renumber(own, [*SOURCE, "source_episode"], ["_source_index"], [*SOURCE, "source_episode"], materialize=False, ranged=True)
    frames = frames.select("timestamp", "frame_index", "episode_index", "index", F.col("task_index").cast("long").alias("task_index"),
                           F.col("_state").alias("observation.state"), "action")
    at = F.coalesce("_source_index", F.lit(-1 << 63))  # the order of the frames, without numbering them again
    ends = own.groupBy(*SOURCE, "source_episode").agg(F.min_by("timestamp", at).alias("_from"), F.max_by("timestamp", at).alias("_to"))
    out = numbered.join(good.select(*SOURCE, "task"), SOURCE)
    if cameras:
        # Files of the first camera, numbered over all sources; every camera's file of that number follows
        first = files.join(bad, SOURCE, "left_anti").where(F.col(V.CAMERA) == cameras[0]).select(*SOURCE, "local_file").distinct()
        mapped = global_scan(first, [*SOURCE, "local_file"], [Scan("_file", "_one", "sum", inclusive=False)])
        named = _ranges(episodes, cameras).withColumnRenamed("episode_index", "source_episode").join(mapped, [*SOURCE, "local_file"])
        named = named.join(numbered.select(*SOURCE, "source_episode", "episode_index"), [*SOURCE, "source_episode"]).join(ends, [*SOURCE, "source_episode"])
        named = named.select("episode_index", V.CAMERA, F.call_function("div", F.col("_file"), F.lit(V.CHUNK_FILES).cast("long")).alias("chunk_index"),
                             F.col("_file").alias("file_index"), F.coalesce("from_timestamp", "_from").alias("from_timestamp"),
                             F.coalesce("to_timestamp", "_to").alias("to_timestamp"))
        out = out.join(V.wide(named, cameras), "episode_index", "left")
    lineage = numbered.groupBy(*SOURCE).agg(
        F.count(F.lit(1)).alias("n_episodes"), F.sum("length").alias("n_frames"), F.min("episode_index").alias("from_episode"),
        F.min("dataset_from_index").alias("dataset_from_index"), F.max("dataset_to_index").alias("dataset_to_index"))
    lineage = sources.drop("_folder").join(lineage, SOURCE, "left")
    tasks = manifest.select(F.col("task_index").cast("long").alias("task_index"), "task").distinct()
    return Merged(frames, out.drop("file_index"), tasks, lineage, rejects, cameras)


def write_merged(m: Merged, out_root: str, fps: int, width: int, image_size: tuple[int, int] | None = None) -> None:
    """K1-K6.  Statistics and totals are read from the written frames."""
    root, spark = out_root.rstrip("/"), m.frames.sparkSession
    with shuffles_removed(spark):
        _write_merged(spark, m, root, fps, width, image_size)


def _write_merged(spark: SparkSession, m: Merged, root: str, fps: int, width: int, image_size: tuple[int, int] | None) -> None:
    W.write_tasks(m.tasks, root)
    W.write_episodes(m.episodes, root)  # its joins shuffle most: before the frames take their place
    W.write_frames(m.frames, root, ranged=True)
    frames = read_published_frames(spark, root)
    since = tables_written()
    stats = S.vector_stats(frames, ["observation.state", "action"], quantiles=True, exact=True, stored=True)
    W.write_small_json(W.stats_json(stats), f"{root}/meta/stats")
    release_tables(spark, since)
    episodes = spark.read.parquet(f"{root}/meta/episodes")
    W.write_small_json(W.info_json(S.dataset_totals(frames, episodes, m.tasks), fps, {"observation.state": width, "action": width},
                                   videos=W.video_total(episodes, m.cameras), cameras=m.cameras, image_size=image_size), f"{root}/meta/info")
    W.write_source_manifest(m.lineage, f"{root}/meta/source_manifest")
    if not m.rejects.isEmpty():
        m.rejects.write.mode("errorifexists").json(f"{root}/meta/rejected")
