"""Time alignment of many streams onto one frame timeline.

Inputs are *message* rows ``(recording, stream, ts_ns, seq, payload)``;
``seq`` is arrival order and breaks every timestamp tie.

Plan shape (no window ever spans a whole raw stream):

1. Each message is assigned the frame ``k`` it first serves: the first frame
   whose time ``t_k >= ts``.  On a regular grid this is arithmetic; on an
   arbitrary timeline (the head camera) it is a blocked running count.
   Messages before the first frame go to frame 0, after the last frame to a
   sentinel frame ``n``.
2. One hash-partitioned aggregation per ``(recording, k)`` reduces raw rows
   to frame-sized rows, with map-side combine: per stream the last row
   (``le``), last row strictly before ``t_k`` (``lt``), first row at or
   after ``t_k`` (``ge``) and first row (``first``).  Grid rows are unioned
   in so every frame exists.
3. One blocked scan over frames fills ``le`` forward and ``first`` backward.
   From those, for every frame and stream:

   * ``asof``  = last row with ts <= t (ties: last arrival)          -- J1
   * ``prev``  = last row with ts <  t                                -- J2-J4
   * ``next``  = first row with ts >= t (ties: first arrival)
   * ``after`` = first row with ts >  t (null iff t >= last stamp)    -- J3 clamp
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodeframe.functions import quaternion as Q
from episodeframe.functions.timeunits import ceil_div, floor_div
from episodeframe.session import cut_lineage
from episodeframe.operators.blocks import BLK, DEFAULT_BLOCK, Scan, dense_index, ordered_scan, tasks_for

REC, STREAM, TS, SEQ = "recording_id", "stream", "ts_ns", "seq"

# Rows generated per grid chunk; the grid of one recording is exploded in
# chunks so no single array holds a whole recording's frames.
GRID_CHUNK = 1 << 16


def fps_step_ns(fps: float) -> int:
    """Grid step as the reference computes it: ``int(1e9 / fps)`` (truncates)."""
    step = int(1e9 / fps)
    if step <= 0:
        raise ValueError("Computed frame interval is invalid")
    return step


# ---------------------------------------------------------------- O1

def stable_order(messages: DataFrame, ts: str = TS, seq: str = SEQ) -> DataFrame:
    """O1: sort messages by (stamp, arrival) inside each partition; ties
    keep arrival order because ``seq`` is part of every ordering here."""
    return messages.sortWithinPartitions(ts, seq)


# ---------------------------------------------------------------- A1 / A2

def stream_extents(messages: DataFrame, rec: str = REC, stream: str = STREAM,
                   ts: str = TS) -> DataFrame:
    """Per (recording, stream): rows, first and last stamp (A1 counts)."""
    return messages.groupBy(rec, stream).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"))


def sampling_window(messages: DataFrame, rec: str = REC, stream: str = STREAM,
                    ts: str = TS) -> DataFrame:
    """A2: start = max of first stamps, end = min of last stamps over the
    non-empty streams of each recording.  ``valid`` is false where the
    reference raises (start >= end)."""
    return window_from_extents(stream_extents(messages.where(F.col(ts).isNotNull()), rec, stream, ts), rec)


def window_from_extents(ext: DataFrame, rec: str = REC) -> DataFrame:
    """A2 from per-stream extents (so one extents pass serves the window,
    the grid and the interpolation clamp)."""
    return (ext.groupBy(rec)
            .agg(F.max("first_ts").alias("start_ns"),
                 F.min("last_ts").alias("end_ns"),
                 F.count(F.lit(1)).alias("n_streams"))
            .withColumn("valid", F.col("start_ns") < F.col("end_ns")))


# ---------------------------------------------------------------- O2

def grid_params(window: DataFrame, step_ns: int, max_frames: int | None = None,
                rec: str = REC) -> DataFrame:
    """Per recording: ``start_ns, step_ns, n_frames`` of the frame grid
    ``range(start, end + 1, step)`` cut to ``max_frames``."""
    n = floor_div(F.col("end_ns") - F.col("start_ns"), F.lit(int(step_ns))) + 1
    if max_frames is not None:
        n = F.least(n, F.lit(int(max_frames)))
    return (window.where("valid")
            .select(rec, "start_ns", F.lit(int(step_ns)).cast("long").alias("step_ns"),
                    n.alias("n_frames")))


def frame_tasks(params: DataFrame) -> int:
    """Partitions for the frames of ``params`` (counted from its one row per
    recording; materialise it where that is costly)."""
    return tasks_for(params.sparkSession, params.agg(F.sum("n_frames")).first()[0])


def frame_grid(params: DataFrame, rec: str = REC, partitions: int | None = None, block: int | None = None) -> DataFrame:
    """O2: one row per frame ``(recording, frame_index, t_ns)``.

    Exploded in two levels (chunks, then frames in a chunk) and the chunk
    rows are spread over partitions, so a very long recording is generated
    by many tasks.  There are as many partitions as the frames need
    (``frame_tasks``): the chunk rows alone would fit into a few.

    With ``block`` the chunks are blocks of so many frames, named by ``_blk`` and
    dealt by it: ``align_frames`` with that ``block`` and those ``partitions``
    scans the frames where they are made, without a shuffle of them."""
    size = block or GRID_CHUNK
    chunks = (params
              .withColumn("_chunk", F.explode(F.sequence(
                  F.lit(0).cast("long"),
                  floor_div(F.col("n_frames") - 1, F.lit(size)))))
              .repartition(partitions or frame_tasks(params), rec, "_chunk"))
    lo = F.col("_chunk") * F.lit(size)
    hi = F.least(F.col("n_frames"), lo + F.lit(size)) - 1
    return (chunks
            .withColumn("frame_index", F.explode(F.sequence(lo, hi)))
            .select(rec, "frame_index",
                    (F.col("start_ns") + F.col("frame_index") * F.col("step_ns")).alias("t_ns"),
                    *([F.col("_chunk").alias(BLK)] if block else [])))


# ---------------------------------------------------------------- frame assignment
#
# Every message gets a half-step key: ``2k`` when t_{k-1} < ts < t_k and
# ``2k + 1`` when ts == t_k exactly (before the first frame: 0; after the
# last frame: 2n).  A frame k sits at key 2k + 1, ahead of its exact hits, so
# for frame k:  keys <= 2k  hold ts < t_k,  key 2k + 1 holds ts == t_k.

def assign_frames_grid(messages: DataFrame, params: DataFrame, rec: str = REC,
                       ts: str = TS) -> DataFrame:
    """Half-step keys on the regular grid of ``params``: arithmetic only."""
    x = F.col(ts) - F.col("start_ns")
    step, n = F.col("step_ns"), F.col("n_frames")
    k = ceil_div(x, step)
    exact = (F.pmod(x, step) == 0).cast("long")
    key = (F.when(x < 0, F.lit(0).cast("long"))
           .when(k >= n, 2 * n)
           .otherwise(2 * k + exact))
    return (messages.join(params.select(rec, "start_ns", "step_ns", "n_frames"), rec)
            .withColumn("_key", key)
            .drop("start_ns", "step_ns", "n_frames"))


def assign_frames_timeline(messages: DataFrame, frames: DataFrame, rec: str = REC,
                           ts: str = TS, seq: str = SEQ,
                           time_block_ns: int = 60_000_000_000) -> DataFrame:
    """Half-step keys against an arbitrary timeline ``frames(rec,
    frame_index, t_ns)`` (dense frame_index, increasing t_ns).

    ``k`` = number of frames with t < ts, by a blocked running count over
    the union of frames and messages ordered by time (messages first at
    equal time); exact hits by a blocked backward fill of the next frame
    time.  Blocks are time buckets, so a long recording spreads over tasks.
    """
    m = messages.withColumn("_is_frame", F.lit(0))
    f = (frames.select(rec, F.col("t_ns").alias(ts), F.col("frame_index"))
         .withColumn("_is_frame", F.lit(1)))
    u = (m.unionByName(f, allowMissingColumns=True)
         .withColumn("_tie", F.coalesce(F.col(seq), F.col("frame_index")))
         .withColumn("_tb", floor_div(F.col(ts), F.lit(time_block_ns)))
         .withColumn("_one", F.col("_is_frame").cast("long"))
         .withColumn("_ft", F.when(F.col("_is_frame") == 1, F.col(ts))))
    sc = ordered_scan(u, [rec], "_tb", [ts, "_is_frame", "_tie"], [
        Scan("_k", "_one", "sum", inclusive=True),
        Scan("_tk", "_ft", "bfill", inclusive=True)])
    key = 2 * F.col("_k") + F.coalesce((F.col(ts) == F.col("_tk")).cast("long"), F.lit(0))
    return (sc.where(F.col("_is_frame") == 0).withColumn("_key", key)
            .drop("_is_frame", "frame_index", "_tie", "_tb", "_one", "_ft", "_k", "_tk"))


# ---------------------------------------------------------------- J1-J5

ASOF, NEAREST, LINEAR, POSE = "asof", "nearest", "linear", "pose"


def method_for(stream_name: str, joint_and_action_streams: set[str] | frozenset = frozenset(),
               downsample: bool = True) -> str:
    """``*_end_pose`` -> pose (position lerp + SLERP); joint-state and
    action streams -> linear; everything else -> nearest.  With
    downsampling off, everything is nearest."""
    if not downsample:
        return NEAREST
    if stream_name.endswith("_end_pose"):
        return POSE
    if stream_name in joint_and_action_streams:
        return LINEAR
    return NEAREST


@dataclass
class AlignSpec:
    """What to align: stream name -> method, and the payload columns."""

    methods: dict[str, str]
    payload: list[str] = field(default_factory=lambda: ["value"])


def _row_struct(payload: list[str]) -> Column:
    return F.struct(F.col(TS).alias("ts"), F.col(SEQ).alias("seq"),
                    *[F.col(p) for p in payload])


def align_frames(messages: DataFrame, frames: DataFrame, spec: AlignSpec,
                 params: DataFrame | None = None, rec: str = REC, stream: str = STREAM,
                 block: int = DEFAULT_BLOCK, keep_block: bool = False,
                 materialize: bool = True, extents: DataFrame | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Align every stream in ``spec`` onto ``frames(rec, frame_index, t_ns)``.

    If ``params`` (from ``grid_params``) is given the timeline is that
    regular grid; otherwise the timeline in ``frames`` is used as-is.
    Output: ``rec, frame_index, t_ns`` and per stream ``<s>`` (payload
    struct, or the value when the payload is one column) and ``<s>__ts``
    (source stamp; null for interpolated values).  ``extents`` (from
    ``stream_extents``, ideally materialised) saves a pass over the
    messages for the interpolation clamp.  ``materialize`` writes the
    frame-sized bucket table once to the checkpoint folder so its several
    consumers never re-aggregate the raw messages.  ``keep_block`` also
    returns ``_blk`` (= frame_index // block) with the rows already
    partitioned by ``(rec, _blk)``, for frame windows that follow.
    ``partitions`` of the frames default to ``frame_tasks(params)``.  Frames of
    ``frame_grid(params, partitions=partitions, block=block)`` are not shuffled.
    """
    names = list(spec.methods)
    msgs = (messages.where(F.col(stream).isin(names) & F.col(TS).isNotNull())
            .select(rec, stream, TS, SEQ, *spec.payload))
    if params is not None:
        tagged = assign_frames_grid(msgs, params, rec)
    else:
        tagged = assign_frames_timeline(msgs, frames, rec)

    # Raw rows -> one row per (recording, key): last and first sample of each
    # stream.  Map-side combine keeps a hot recording's shuffle small.
    row = _row_struct(spec.payload)
    order = F.struct(F.col(TS), F.col(SEQ))
    interp = [s for s in names if spec.methods[s] != ASOF]
    aggs = []
    for s in names:
        is_s = F.col(stream) == F.lit(s)
        aggs.append(F.max_by(row, F.when(is_s, order)).alias(f"_le_{s}"))
        if s in interp:
            aggs.append(F.min_by(row, F.when(is_s, order)).alias(f"_first_{s}"))
    buckets = tagged.groupBy(rec, "_key").agg(*aggs).withColumn("_kind", F.lit(1))
    if materialize:
        # The aggregated buckets feed several consumers (the block scan, its
        # block summaries and downstream frame windows).  Written once to the
        # shared checkpoint folder, no consumer re-aggregates the raw
        # messages, and the lineage is cut for executor loss.  Grid rows are
        # arithmetic and are regenerated instead of written.
        buckets = cut_lineage(buckets)

    # Block = frame index // block (a frame and its exact hits share a key,
    # so they share a block).  The block column is kept: downstream frame
    # windows (next state) reuse this partitioning instead of reshuffling.
    blk = floor_div(floor_div(F.col("_key"), F.lit(2)), F.lit(block))
    if partitions is None and params is not None:
        partitions = frame_tasks(params)

    # Frames join the scan directly at key 2k + 1, ahead of their exact hits.
    dealt = BLK in frames.columns
    grid_rows = frames.select(rec, (2 * F.col("frame_index") + 1).alias("_key"),
                              F.col("frame_index").alias("_k"), F.col("t_ns").alias("_t"),
                              F.lit(0).alias("_kind"), *([BLK] if dealt else []))
    if dealt:
        # only the buckets travel, to the blocks where the frames are generated
        buckets, blk = buckets.withColumn(BLK, blk).repartition(partitions, rec, BLK), BLK
    u = buckets.unionByName(grid_rows, allowMissingColumns=True)

    scans = []
    for s in names:
        scans.append(Scan(f"_prev_{s}", f"_le_{s}", "ffill", inclusive=False))
        scans.append(Scan(f"_nextkey_{s}", "_key", "lead"))
        scans.append(Scan(f"_exact_{s}", f"_le_{s}", "lead"))
        if s in interp:
            scans.append(Scan(f"_next_{s}", f"_first_{s}", "bfill", inclusive=False))
    filled = (ordered_scan(u, [rec], blk, ["_key", "_kind"], _dedupe_lead(scans), keep_block=True, partitions=partitions, dealt=dealt)
              .where(F.col("_kind") == 0))

    if any(spec.methods[s] == LINEAR for s in names):
        ext = extents if extents is not None else stream_extents(msgs, rec, stream)
        last = ext.groupBy(rec).agg(*[F.max(F.when(F.col(stream) == s, F.col("last_ts"))).alias(f"_last_{s}")
                                      for s in names if spec.methods[s] == LINEAR])
        filled = filled.join(last, rec, "left")

    # Stage 1: bracket rows as plain columns (so later expressions reference
    # attributes instead of repeating the coalesces).
    t = F.col("_t")
    stage = [F.col(rec), F.col("_k"), t, F.col(BLK)]
    for s in names:
        exact = F.when(F.col("_nextkey") == F.col("_key"), F.col(f"_exact_{s}"))
        stage.append(F.coalesce(exact, F.col(f"_prev_{s}")).alias(f"_a_{s}"))
        if s in interp:
            stage.append(F.col(f"_prev_{s}").alias(f"_p_{s}"))
            stage.append(F.col(f"_next_{s}").alias(f"_n_{s}"))
            if spec.methods[s] == LINEAR:
                # J3 clamps to the last sample once t >= the stream's last stamp.
                stage.append((t >= F.col(f"_last_{s}")).alias(f"_x_{s}"))
    br = filled.select(*stage)

    # Stage 2: ratios and SLERP terms for the interpolating methods.
    for s in names:
        m = spec.methods[s]
        if m in (LINEAR, POSE):
            prev, nxt = F.col(f"_p_{s}"), F.col(f"_n_{s}")
            ratio = ((t - prev["ts"]) / (nxt["ts"] - prev["ts"])).cast("double")
            if m == POSE:
                ratio = F.least(F.greatest(ratio, F.lit(0.0)), F.lit(1.0))
            br = br.withColumn(f"_r_{s}", ratio)
            if m == POSE and "orientation" in spec.payload:
                br = Q.slerp_columns(br, prev["orientation"], nxt["orientation"],
                                     F.col(f"_r_{s}"), f"_q_{s}")

    outs = [F.col(rec), F.col("_k").alias("frame_index"), t.alias("t_ns")]
    if keep_block:
        outs.append(F.col(BLK))
    single = len(spec.payload) == 1
    for s in names:
        m = spec.methods[s]
        asof = F.col(f"_a_{s}")
        if m == ASOF:
            val, src = asof, asof["ts"]
        else:
            prev, nxt = F.col(f"_p_{s}"), F.col(f"_n_{s}")
            after = F.col(f"_x_{s}") if m == LINEAR else None
            if m == NEAREST:
                pick_next = prev.isNull() | (nxt.isNotNull() & (
                    (nxt["ts"] - t) < (t - prev["ts"])))
                val = F.when(pick_next, nxt).otherwise(prev)
                src = val["ts"]
            elif m == LINEAR:
                interp = _lerp_struct(prev, nxt, F.col(f"_r_{s}"), spec.payload, messages.schema)
                val = (F.when(prev.isNull(), nxt)
                       .when(after, asof)
                       .otherwise(interp))
                src = F.when(prev.isNull(), nxt["ts"]).when(after, asof["ts"])
            elif m == POSE:
                interp = _pose_struct(prev, nxt, F.col(f"_r_{s}"), spec.payload, f"_q_{s}")
                val = (F.when(prev.isNull(), nxt)
                       .when(nxt.isNull(), prev)
                       .otherwise(interp))
                src = F.when(prev.isNull(), nxt["ts"]).when(nxt.isNull(), prev["ts"])
            else:
                raise ValueError(f"unknown method {m!r}")
        if single:
            outs.append(val[spec.payload[0]].alias(s))
        else:
            outs.append(F.struct(*[val[p].alias(p) for p in spec.payload]).alias(s))
        outs.append(src.alias(f"{s}__ts"))
    return br.select(*outs)


def _dedupe_lead(scans: list[Scan]) -> list[Scan]:
    """One ``_nextkey`` lead is enough for all streams."""
    out, seen = [], False
    for sc in scans:
        if sc.out.startswith("_nextkey_"):
            if seen:
                continue
            seen = True
            sc = Scan("_nextkey", "_key", "lead")
        out.append(sc)
    return out


def _lerp(a: Column, b: Column, r: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.IntegerType, T.LongType,
                          T.ShortType, T.DecimalType)):
        return a.cast("double") + r * (b.cast("double") - a.cast("double"))
    if isinstance(dtype, T.ArrayType):
        return F.zip_with(a, b, lambda x, y: x.cast("double") + r * (y.cast("double") - x.cast("double")))
    if isinstance(dtype, T.StructType):
        return F.struct(*[_lerp(a[f.name], b[f.name], r, f.dataType).alias(f.name)
                          for f in dtype.fields])
    return a  # non-numeric leaves keep the earlier sample


def _lerp_struct(prev: Column, nxt: Column, r: Column, payload: list[str],
                 schema: T.StructType) -> Column:
    """Linear interpolation of every numeric leaf (arrays elementwise).
    Null inputs give null (the reference would fail on them)."""
    types = {f.name: f.dataType for f in schema.fields}
    parts = [F.lit(None).cast("long").alias("ts"), F.lit(None).cast("long").alias("seq")]
    for p in payload:
        parts.append(_lerp(prev[p], nxt[p], r, types[p]).alias(p))
    return F.struct(*parts)


def _pose_struct(prev: Column, nxt: Column, r: Column, payload: list[str],
                 quat_col: str) -> Column:
    """``position`` lerp, ``orientation`` SLERP; other payload columns
    keep the earlier sample."""
    parts = [F.lit(None).cast("long").alias("ts"), F.lit(None).cast("long").alias("seq")]
    for p in payload:
        if p == "position":
            a, b = prev[p], nxt[p]
            parts.append(Q.xyz_struct(a["x"] + r * (b["x"] - a["x"]), a["y"] + r * (b["y"] - a["y"]),
                                      a["z"] + r * (b["z"] - a["z"])).alias(p))
        elif p == "orientation":
            parts.append(F.col(quat_col).alias(p))
        else:
            parts.append(prev[p].alias(p))
    return F.struct(*parts)


# ---------------------------------------------------------------- J13

def camera_index_map(camera_frames: DataFrame, main_camera: str, cameras: list[str],
                     rec: str = REC,
                     camera: str = "camera", ts: str = TS, seq: str = SEQ,
                     block: int = DEFAULT_BLOCK) -> DataFrame:
    """Per camera, the image index used by every main-camera frame.

    ``cameras`` is the configured camera list.  Main camera maps 1:1 (``frame_index``); other cameras use the nearest
    image (ties to the earlier one, clamped).  Image index = 0-based
    position in the camera's own ``(ts, seq)`` order.  Returns
    ``rec, frame_index, camera, image_index``.
    """
    idx = dense_index(camera_frames, [rec, camera], [ts, seq], "image_index")
    main = (idx.where(F.col(camera) == main_camera)
            .select(rec, F.col("image_index").alias("frame_index"), F.col(ts).alias("t_ns")))
    others = idx.where(F.col(camera) != main_camera).select(
        rec, F.col(camera).alias(STREAM), ts, seq, "image_index")
    cams = [c for c in cameras if c != main_camera]
    out = main.select(rec, "frame_index", F.lit(main_camera).alias(camera),
                      F.col("frame_index").alias("image_index"))
    if cams:
        spec = AlignSpec({c: NEAREST for c in cams}, payload=["image_index"])
        al = align_frames(others, main, spec, rec=rec, block=block)
        stacked = al.select(rec, "frame_index", F.explode(F.map_from_arrays(
            F.array(*[F.lit(c) for c in cams]), F.array(*[F.col(c) for c in cams]))
        ).alias(camera, "image_index"))
        out = out.unionByName(stacked)
    return out
