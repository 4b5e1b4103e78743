"""End-to-end publish: landed messages -> published dataset (Entry A + B).

    route (P1, J7) -> preferred topic (A1, A3) -> required check (J9)
    -> decode (F11) -> sampling window + grid (A2, O2) -> align (J1, or J5)
    -> vectors (F8, F9) -> episodes (J6, P11) -> action (W1 or from sources)
    -> renumber (W6, J11) -> frames / tasks / episodes / stats / info (K1-K5)

The aligned frame table is cut from its lineage with a reliable checkpoint
in the cluster's checkpoint folder: it is much smaller than the raw
messages, and a lost executor then recomputes from it instead of from the
raw scan.  Recordings missing a required field are reported, not written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodeframe.functions.decoders import decode_routed
from episodeframe.functions.vectors import build_vector
from episodeframe.operators import align as A
from episodeframe.operators import episodes as EP
from episodeframe.operators import merge as M
from episodeframe.operators import selecting as SEL
from episodeframe.operators import stats as S
from episodeframe.operators import videos as V
from episodeframe.operators.actions import next_state
from episodeframe.operators.blocks import dense_index
from episodeframe.session import cut_lineage
from episodeframe.sinks import writers as W
from episodeframe.sources.config import MappingConfig, topic_dim
from episodeframe.sources.files import read_published_frames

PAYLOAD = ["position", "orientation", "positions", "velocities", "efforts", "data", "value", "pose", "twist"]


@dataclass
class Published:
    frames: DataFrame
    episodes: DataFrame
    tasks: DataFrame
    rejected: DataFrame


def unified_payload(decoded: str = "decoded") -> list:
    """One payload struct layout for every decoder kind, so all streams can
    be aligned in one pass; members a kind lacks are null."""
    d = F.col(decoded)
    return [
        F.coalesce(d["pose"]["position"]).alias("position"),
        F.coalesce(d["pose"]["orientation"]).alias("orientation"),
        F.coalesce(d["joint"]["positions"]).alias("positions"),
        d["joint"]["velocities"].alias("velocities"),
        d["joint"]["efforts"].alias("efforts"),
        d["array"]["data"].alias("data"),
        d["float"]["value"].alias("value"),
        d["odometry"]["pose"].alias("pose"),
        d["odometry"]["twist"].alias("twist"),
    ]


CAMERA = "camera/"  # stream names of cameras, apart from the observations


def align_recordings(messages: DataFrame, config: MappingConfig, joint_and_action: set[str] | None = None,
                     max_frames: int | None = None, collector: bool = False) -> tuple[DataFrame, DataFrame]:
    """Entry A up to aligned frames; returns (frames, rejected recordings with
    the missing required fields).

    Observations and cameras both count for the sampling window and the
    required check.  Every stream is sampled as of the frame (no future sample);
    ``collector`` takes the collector's methods (J5) instead.  Frames hold
    ``state``, with ``from_sources`` also ``action``, and ``camera_index``: per
    camera the position of the sampled image in the camera's own order."""
    spark = messages.sparkSession
    dim = topic_dim(spark, config).withColumn("field", F.when(F.col("kind") == "camera", F.concat(F.lit(CAMERA), "field"))
                                              .otherwise(F.col("field")))
    routed = SEL.route_topics(SEL.filter_topics(messages, config.topic_names()), dim)
    chosen = SEL.preferred_topics(SEL.topic_counts(routed)).where(F.col("selected_topic").isNotNull())
    required = config.required_fields() + [CAMERA + c for c in config.required_fields("camera")]
    missing = SEL.missing_required(chosen.select("recording_id", "field"), required,
                                   all_recordings=messages.select("recording_id"))
    rejected = missing.groupBy("recording_id").agg(F.array_sort(F.collect_set("missing")).alias("missing"))
    ok = (routed.join(chosen.select("recording_id", F.col("selected_topic").alias("topic")),
                      ["recording_id", "topic"], "left_semi")
          .join(rejected.select("recording_id"), "recording_id", "left_anti"))
    cameras = [CAMERA + c for c in config.fields("camera")]
    seen = ok.where(F.col("kind") == "observation").withColumn("decoded", decode_routed("payload", "decoder")).select(
        "recording_id", F.col("field").alias("stream"), "ts_ns", "seq", *unified_payload(),
        F.lit(None).cast("long").alias("image_index"))
    if cameras:
        images = dense_index(ok.where(F.col("kind") == "camera"), ["recording_id", "field"], ["ts_ns", "seq"], "image_index")
        blank = [F.lit(None).cast(seen.schema[c].dataType).alias(c) for c in PAYLOAD]
        seen = seen.union(images.select("recording_id", F.col("field").alias("stream"), "ts_ns", "seq", *blank, "image_index"))
    fields = config.fields("observation")
    methods = {f: A.method_for(f, joint_and_action or set()) if collector else A.ASOF for f in fields}
    methods |= {c: A.ASOF for c in cameras}
    ext = cut_lineage(A.stream_extents(seen))
    params = A.grid_params(A.window_from_extents(ext), A.fps_step_ns(config.fps), max_frames)
    n = A.frame_tasks(params)
    fr = A.align_frames(seen, A.frame_grid(params, partitions=n), A.AlignSpec(methods, [*PAYLOAD, "image_index"]), params=params,
                        extents=ext, partitions=n)
    out = [build_vector(fr, config.state).alias("state")]
    if config.action_mode == "from_sources":
        out.append(build_vector(fr, config.action).alias("action"))
    index = [x for c in cameras for x in (F.lit(c.removeprefix(CAMERA)), F.col(f"`{c}`")["image_index"])]
    out.append((F.create_map(*index) if index else F.create_map().cast("map<string,bigint>")).alias("camera_index"))
    return fr.select("recording_id", "frame_index", "t_ns", *out), rejected


def publish(messages: DataFrame, config: MappingConfig, out_root: str, task: str = "default task",
            steps: DataFrame | None = None, checkpoint: bool = True,
            joint_and_action: set[str] | None = None, collector: bool = False, frames_per_file: int = 1 << 14) -> Published:
    """Run Entry A + B and write the dataset under ``out_root``; a camera's video
    file takes about ``frames_per_file`` frames."""
    frames, rejected = align_recordings(messages, config, joint_and_action, collector=collector)
    if checkpoint:
        frames = cut_lineage(frames)
    spark = messages.sparkSession
    params = frames.groupBy("recording_id").agg(F.min("t_ns").alias("start_ns"),
                                                F.count(F.lit(1)).alias("n_frames"))
    if steps is not None:
        step_ns = A.fps_step_ns(config.fps)
        p = params.withColumn("step_ns", F.lit(step_ns).cast("long"))
        specs = EP.episode_specs(EP.step_ranges_on_grid(steps, p), p, F.lit(task))
    else:
        specs = params.select("recording_id", F.lit(None).cast("long").alias("step_number"),
                              F.lit(0).cast("long").alias("start_index"),
                              F.col("n_frames").alias("end_index"), F.lit(task).alias("task"))
    eps = EP.cut_episodes(frames, specs)
    if config.action_mode == "next_state":
        eps = next_state(eps, ["recording_id", "start_index", "end_index", "step_number", "task"], "episode_frame_index",
                         {"action": "state"})
    tasks = M.first_seen_order(eps.select("task", "recording_id", "start_index"), "task",
                               ["recording_id", "start_index"], "task_index")
    tasks = tasks.withColumn("task_index", F.col("task_index").cast("long"))
    eps = M.attach_task_index(eps, tasks)
    eps = (eps.withColumnRenamed("frame_index", "recording_frame_index")
           .withColumn("episode_key", F.struct("recording_id", "step_number", "start_index")))
    out, episodes = M.renumber(eps, ["episode_key"], ["episode_frame_index"],
                               ["recording_id", "start_index", "step_number"])
    out = out.select((F.col("episode_frame_index") / F.lit(float(config.fps))).alias("timestamp"),
                     "frame_index", "episode_index", "index", "task_index",
                     F.col("state").alias("observation.state"), "action",
                     *[F.col("camera_index")[c].alias(f"observation.images.{c}.index") for c in config.fields("camera")])
    episodes = episodes.join(eps.select("episode_key", "task").distinct(), "episode_key").drop("episode_key")
    cameras = config.fields("camera")
    if cameras:
        ranges = cut_lineage(V.camera_ranges(V.camera_rows(episodes.select("episode_index", "length"), cameras), config.fps, frames_per_file))
        episodes = episodes.join(V.wide(ranges, cameras), "episode_index")
        V.video_files(ranges).write.mode("errorifexists").parquet(f"{out_root.rstrip('/')}/meta/video_files")
    episodes = cut_lineage(episodes)
    W.write_frames(out, out_root)
    W.write_tasks(tasks, out_root)
    W.write_episodes(episodes, out_root)
    # statistics and totals from the written frames: the renumbering runs once
    out = read_published_frames(spark, out_root).select(*[F.col(f"`{c}`") for c in out.columns])
    st = S.vector_stats(out, ["observation.state", "action"])
    W.write_small_json(W.stats_json(st), f"{out_root.rstrip('/')}/meta/stats")
    width = len([f for f in config.state if f.enabled])
    W.write_small_json(W.info_json(S.dataset_totals(out, episodes, tasks), config.fps,
                                   {"observation.state": width, "action": width}, videos=W.video_total(episodes, cameras),
                                   cameras=cameras),
                       f"{out_root.rstrip('/')}/meta/info")
    if not rejected.isEmpty():
        rejected.write.mode("errorifexists").json(f"{out_root.rstrip('/')}/meta/rejected")
    return Published(out, episodes, tasks, rejected)
