"""Alignment queries over ``events`` (messages) and ``embeddings`` (poses)."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodeframe.functions.vectors import FieldSpec
from episodeframe.operators import align as A
from episodeframe.plans.catalog import _MSG_CTE, EVENT_STEP_NS, EVENT_STREAMS, r6, register
from episodeframe.plans.recording import aligned_frames, state_action_frames
from episodeframe.sources.tables import events_as_messages, table

EVENT_LAYOUT = [FieldSpec(s, s, "float.value") for s in EVENT_STREAMS]


def _state_cols(prefix: str, col: str):
    return [r6(F.col(col)[i]).alias(f"{prefix}_{s}") for i, s in enumerate(EVENT_STREAMS)]


def _pivot_sql(val: str, prefix: str) -> str:
    return ", ".join(
        f"round(CAST(CAST(coalesce(max(CASE WHEN stream = '{s}' THEN {val} END), 0.0) AS REAL) AS DOUBLE), 6) AS {prefix}_{s}"
        for s in EVENT_STREAMS)


def _next_sql(prefix: str, out: str) -> str:
    return ", ".join(
        f"CASE WHEN lead(frame_index) OVER w IS NULL THEN {prefix}_{s} "
        f"ELSE lead({prefix}_{s}) OVER w END AS {out}_{s}" for s in EVENT_STREAMS)


# -- flagship: A2 window -> O2 grid -> J1 as-of -> F9 vector -> W1 action
ASOF_FRAMES_SQL = f"""
WITH {_MSG_CTE},
hit AS (
  SELECT g.recording_id, g.frame_index, g.t_ns, m.stream, m.value,
         row_number() OVER (PARTITION BY g.recording_id, g.frame_index, m.stream
                            ORDER BY m.ts_ns DESC, m.seq DESC) AS rn
  FROM grid g JOIN m ON m.recording_id = g.recording_id AND m.ts_ns <= g.t_ns
),
st AS (
  SELECT g.recording_id, g.frame_index, g.t_ns, {_pivot_sql('h.value', 'state')}
  FROM grid g LEFT JOIN hit h ON h.recording_id = g.recording_id
       AND h.frame_index = g.frame_index AND h.rn = 1
  GROUP BY g.recording_id, g.frame_index, g.t_ns
)
SELECT recording_id, frame_index, t_ns, {', '.join(f'state_{s}' for s in EVENT_STREAMS)},
       {_next_sql('state', 'action')}
FROM st WINDOW w AS (PARTITION BY recording_id ORDER BY frame_index)
"""


@register("asof_frames", ASOF_FRAMES_SQL)
def asof_frames(spark, sf_dir):
    msgs = events_as_messages(spark, sf_dir, EVENT_STREAMS)
    fr = state_action_frames(msgs, EVENT_LAYOUT, {s: A.ASOF for s in EVENT_STREAMS}, EVENT_STEP_NS)
    return fr.select("recording_id", "frame_index", "t_ns",
                     *_state_cols("state", "state"), *_state_cols("action", "action"))


# -- per-stream bracket rows, shared by the J2/J3 oracles
_BRACKETS_SQL = f"""
WITH {_MSG_CTE},
gs AS (SELECT g.*, s.stream FROM grid g CROSS JOIN (SELECT DISTINCT stream FROM m) s),
prv AS (
  SELECT gs.recording_id, gs.frame_index, gs.stream, m.ts_ns, m.value,
         row_number() OVER (PARTITION BY gs.recording_id, gs.frame_index, gs.stream
                            ORDER BY m.ts_ns DESC, m.seq DESC) AS rn
  FROM gs JOIN m ON m.recording_id = gs.recording_id AND m.stream = gs.stream AND m.ts_ns < gs.t_ns),
nxt AS (
  SELECT gs.recording_id, gs.frame_index, gs.stream, m.ts_ns, m.value,
         row_number() OVER (PARTITION BY gs.recording_id, gs.frame_index, gs.stream
                            ORDER BY m.ts_ns, m.seq) AS rn
  FROM gs JOIN m ON m.recording_id = gs.recording_id AND m.stream = gs.stream AND m.ts_ns >= gs.t_ns),
lastrow AS (
  SELECT recording_id, stream, ts_ns, value,
         row_number() OVER (PARTITION BY recording_id, stream ORDER BY ts_ns DESC, seq DESC) AS rn
  FROM m),
br AS (
  SELECT gs.recording_id, gs.frame_index, gs.t_ns, gs.stream,
         p.ts_ns AS pts, p.value AS pv, n.ts_ns AS nts, n.value AS nv,
         l.ts_ns AS lts, l.value AS lv
  FROM gs
  LEFT JOIN prv p ON p.recording_id = gs.recording_id AND p.frame_index = gs.frame_index
       AND p.stream = gs.stream AND p.rn = 1
  LEFT JOIN nxt n ON n.recording_id = gs.recording_id AND n.frame_index = gs.frame_index
       AND n.stream = gs.stream AND n.rn = 1
  LEFT JOIN lastrow l ON l.recording_id = gs.recording_id AND l.stream = gs.stream AND l.rn = 1)"""


def _wide_sql(expr: str, src: str) -> str:
    cols = ", ".join(
        f"round(max(CASE WHEN stream = '{s}' THEN {expr} END), 6) AS {s}, "
        f"max(CASE WHEN stream = '{s}' THEN {src} END) AS {s}__ts" for s in EVENT_STREAMS)
    return f"SELECT recording_id, frame_index, t_ns, {cols} FROM br GROUP BY 1, 2, 3"


NEAREST_PICK = "CASE WHEN pts IS NULL OR (nts IS NOT NULL AND (nts - t_ns) < (t_ns - pts)) THEN {n} ELSE {p} END"
LINEAR_VAL = ("CASE WHEN pts IS NULL THEN nv WHEN lts <= t_ns THEN lv "
              "ELSE pv + ((t_ns - pts) / (nts - pts)) * (nv - pv) END")
LINEAR_SRC = "CASE WHEN pts IS NULL THEN nts WHEN lts <= t_ns THEN lts END"


def _wide_spark(fr):
    out = [F.col("recording_id"), F.col("frame_index"), F.col("t_ns")]
    for s in EVENT_STREAMS:
        out += [r6(F.col(s)).alias(s), F.col(f"{s}__ts")]
    return fr.select(*out)


@register("align_nearest", _BRACKETS_SQL + "\n" + _wide_sql(
    NEAREST_PICK.format(n="nv", p="pv"), NEAREST_PICK.format(n="nts", p="pts")))
def align_nearest(spark, sf_dir):
    """J2 on the hourly grid of every user."""
    msgs = events_as_messages(spark, sf_dir, EVENT_STREAMS)
    return _wide_spark(aligned_frames(msgs, {s: A.NEAREST for s in EVENT_STREAMS}, EVENT_STEP_NS))


@register("align_linear", _BRACKETS_SQL + "\n" + _wide_sql(LINEAR_VAL, LINEAR_SRC))
def align_linear(spark, sf_dir):
    """Bracketing linear interpolation, clamped at both ends."""
    msgs = events_as_messages(spark, sf_dir, EVENT_STREAMS)
    return _wide_spark(aligned_frames(msgs, {s: A.LINEAR for s in EVENT_STREAMS}, EVENT_STEP_NS))


# -- A1 / A2 / O2
@register("stream_counts", """
SELECT user_id AS recording_id, event_type AS stream, count(*) AS n_rows,
       min(epoch_us(ts) * 1000) AS first_ts, max(epoch_us(ts) * 1000) AS last_ts
FROM events GROUP BY 1, 2""")
def stream_counts(spark, sf_dir):
    """A1: rows and extent per recording and stream."""
    return A.stream_extents(events_as_messages(spark, sf_dir))


@register("sampling_window", """
WITH e AS (SELECT user_id AS recording_id, event_type AS stream, epoch_us(ts) * 1000 AS ts_ns FROM events),
x AS (SELECT recording_id, stream, min(ts_ns) AS f, max(ts_ns) AS l FROM e GROUP BY 1, 2)
SELECT recording_id, max(f) AS start_ns, min(l) AS end_ns, count(*) AS n_streams,
       max(f) < min(l) AS valid
FROM x GROUP BY 1""")
def sampling_window_q(spark, sf_dir):
    """A2: common window of all non-empty streams."""
    return A.sampling_window(events_as_messages(spark, sf_dir))


@register("frame_grid_10min", """
WITH e AS (SELECT user_id AS recording_id, event_type AS stream, epoch_us(ts) * 1000 AS ts_ns
           FROM events WHERE event_type IN ('view', 'click')),
x AS (SELECT recording_id, stream, min(ts_ns) AS f, max(ts_ns) AS l FROM e GROUP BY 1, 2),
w AS (SELECT recording_id, max(f) AS s, min(l) AS e FROM x GROUP BY 1 HAVING max(f) < min(l)),
g AS (SELECT recording_id, s, unnest(range(0, (e - s) // 600000000000 + 1)) AS k FROM w)
SELECT recording_id, count(*) AS n_frames, min(s + k * 600000000000) AS first_t,
       max(s + k * 600000000000) AS last_t, CAST(sum(k) AS BIGINT) AS sum_k
FROM g GROUP BY 1""")
def frame_grid_10min(spark, sf_dir):
    """O2: grid with step int(1e9 / fps) at fps = 1/600 over the view/click
    window (end inclusive), summarised per recording."""
    msgs = events_as_messages(spark, sf_dir, ["view", "click"])
    params = A.grid_params(A.sampling_window(msgs), A.fps_step_ns(1 / 600))
    g = A.frame_grid(params)
    return g.groupBy("recording_id").agg(F.count(F.lit(1)).alias("n_frames"),
                                         F.min("t_ns").alias("first_t"),
                                         F.max("t_ns").alias("last_t"),
                                         F.sum("frame_index").alias("sum_k"))


# -- J4: pose stream from embeddings, 2.5 ms grid per label
POSE_STEP_NS = 2_500_000
_POSE_WINDOW = ("SELECT recording_id, min(ts_ns) AS s, max(ts_ns) AS e FROM p GROUP BY 1 HAVING min(ts_ns) < max(ts_ns)")


def _pose_sql(rows: str = "true", window: str = _POSE_WINDOW) -> str:
    """CTEs of poses from the embeddings that fulfil ``rows``, up to the
    interpolated poses ``pose``."""
    return f"""
p0 AS (
  SELECT CAST(label AS BIGINT) AS recording_id, vec_id * 1000000 AS ts_ns, vec_id AS seq,
         CAST(embedding[5] AS DOUBLE) AS px, CAST(embedding[6] AS DOUBLE) AS py,
         CAST(embedding[7] AS DOUBLE) AS pz,
         CAST(embedding[1] AS DOUBLE) AS e1, CAST(embedding[2] AS DOUBLE) AS e2,
         CAST(embedding[3] AS DOUBLE) AS e3, CAST(embedding[4] AS DOUBLE) AS e4
  FROM embeddings WHERE {rows}),
p1 AS (SELECT *, sqrt(e1 * e1 + e2 * e2 + e3 * e3 + e4 * e4) AS n FROM p0),
p AS (SELECT recording_id, ts_ns, seq, px, py, pz, e1 / n AS qx, e2 / n AS qy, e3 / n AS qz,
             e4 / n AS qw FROM p1),
win AS ({window}),
grid AS (SELECT recording_id, k AS frame_index, s + k * {POSE_STEP_NS} AS t_ns
         FROM (SELECT recording_id, s, unnest(range(0, (e - s) // {POSE_STEP_NS} + 1)) AS k FROM win)),
prv AS (SELECT g.recording_id, g.frame_index, p.*, row_number() OVER (
          PARTITION BY g.recording_id, g.frame_index ORDER BY p.ts_ns DESC, p.seq DESC) AS rn
        FROM grid g JOIN p ON p.recording_id = g.recording_id AND p.ts_ns < g.t_ns),
nxt AS (SELECT g.recording_id, g.frame_index, p.*, row_number() OVER (
          PARTITION BY g.recording_id, g.frame_index ORDER BY p.ts_ns, p.seq) AS rn
        FROM grid g JOIN p ON p.recording_id = g.recording_id AND p.ts_ns >= g.t_ns),
br AS (
  SELECT g.recording_id, g.frame_index, g.t_ns,
         a.ts_ns AS ats, a.px AS apx, a.py AS apy, a.pz AS apz, a.qx AS aqx, a.qy AS aqy, a.qz AS aqz, a.qw AS aqw,
         b.ts_ns AS bts, b.px AS bpx, b.py AS bpy, b.pz AS bpz, b.qx AS bqx, b.qy AS bqy, b.qz AS bqz, b.qw AS bqw
  FROM grid g
  LEFT JOIN prv a ON a.recording_id = g.recording_id AND a.frame_index = g.frame_index AND a.rn = 1
  LEFT JOIN nxt b ON b.recording_id = g.recording_id AND b.frame_index = g.frame_index AND b.rn = 1),
c1 AS (SELECT *, least(greatest((t_ns - ats) / (bts - ats), 0.0), 1.0) AS r,
              aqx * bqx + aqy * bqy + aqz * bqz + aqw * bqw AS d0 FROM br),
c2 AS (SELECT *, CASE WHEN d0 < 0 THEN -1.0 ELSE 1.0 END AS sgn, abs(d0) AS d,
              acos(least(greatest(abs(d0), -1.0), 1.0)) AS th FROM c1),
c3 AS (SELECT *, CASE WHEN d > 0.9995 THEN 1.0 - r ELSE sin((1.0 - r) * th) / sin(th) END AS w0,
              (CASE WHEN d > 0.9995 THEN r ELSE sin(r * th) / sin(th) END) * sgn AS w1 FROM c2),
c4 AS (SELECT *, aqx * w0 + bqx * w1 AS rx, aqy * w0 + bqy * w1 AS ry, aqz * w0 + bqz * w1 AS rz,
              aqw * w0 + bqw * w1 AS rw FROM c3),
c5 AS (SELECT *, sqrt(rx * rx + ry * ry + rz * rz + rw * rw) AS rn FROM c4),
pose AS (SELECT recording_id, frame_index, t_ns,
  round(CASE WHEN ats IS NULL THEN bpx WHEN bts IS NULL THEN apx ELSE apx + r * (bpx - apx) END, 6) AS px,
  round(CASE WHEN ats IS NULL THEN bpy WHEN bts IS NULL THEN apy ELSE apy + r * (bpy - apy) END, 6) AS py,
  round(CASE WHEN ats IS NULL THEN bpz WHEN bts IS NULL THEN apz ELSE apz + r * (bpz - apz) END, 6) AS pz,
  round(CASE WHEN ats IS NULL THEN bqx WHEN bts IS NULL THEN aqx WHEN rn > 0 THEN rx * (1.0 / rn) ELSE aqx END, 6) AS qx,
  round(CASE WHEN ats IS NULL THEN bqy WHEN bts IS NULL THEN aqy WHEN rn > 0 THEN ry * (1.0 / rn) ELSE aqy END, 6) AS qy,
  round(CASE WHEN ats IS NULL THEN bqz WHEN bts IS NULL THEN aqz WHEN rn > 0 THEN rz * (1.0 / rn) ELSE aqz END, 6) AS qz,
  round(CASE WHEN ats IS NULL THEN bqw WHEN bts IS NULL THEN aqw WHEN rn > 0 THEN rw * (1.0 / rn) ELSE aqw END, 6) AS qw
FROM c5)"""


@register("align_pose_slerp", f"WITH {_pose_sql()} SELECT * FROM pose")
def align_pose_slerp(spark, sf_dir):
    """Position lerp + orientation SLERP, clamped, on a 2.5 ms grid."""
    from episodeframe.sources.tables import embeddings_as_poses
    poses = embeddings_as_poses(spark, sf_dir)
    fr = aligned_frames(poses, {"arm_end_pose": A.POSE}, POSE_STEP_NS,
                        payload=["position", "orientation"])
    p = F.col("arm_end_pose")
    return fr.select("recording_id", "frame_index", "t_ns",
                     *[r6(p["position"][a]).alias(f"p{a}") for a in "xyz"],
                     *[r6(p["orientation"][a]).alias(f"q{a}") for a in "xyzw"])


# -- J5: a pose, a joint and a plain stream of one recording
_MIXED_SQL = f"""
WITH m AS (SELECT CAST(label AS BIGINT) AS recording_id, vec_id % 3 AS st, vec_id * 1000000 AS ts_ns, CAST(embedding[9] AS DOUBLE) AS value FROM embeddings),
ext AS (SELECT recording_id, st, min(ts_ns) AS f, max(ts_ns) AS l FROM m GROUP BY 1, 2),
{_pose_sql("vec_id % 3 = 0", "SELECT recording_id, max(f) AS s, min(l) AS e FROM ext GROUP BY 1 HAVING max(f) < min(l)")},
x AS (SELECT g.recording_id, g.frame_index, g.t_ns, st.st, p.ts_ns AS pts, p.value AS pv
      FROM grid g CROSS JOIN (VALUES (1), (2)) st(st)
      ASOF LEFT JOIN m p ON p.recording_id = g.recording_id AND p.st = st.st AND p.ts_ns < g.t_ns),
y AS (SELECT x.*, n.ts_ns AS nts, n.value AS nv FROM x ASOF LEFT JOIN m n ON n.recording_id = x.recording_id AND n.st = x.st AND n.ts_ns >= x.t_ns),
z AS (SELECT y.*, e.l AS lts, (SELECT max(m.value) FROM m WHERE m.recording_id = y.recording_id AND m.st = y.st AND m.ts_ns = e.l) AS lv
      FROM y LEFT JOIN ext e ON e.recording_id = y.recording_id AND e.st = y.st)
SELECT pose.*, round(a.v, 6) AS joint, round(b.v, 6) AS grip, b.src AS grip_ts
FROM pose LEFT JOIN (SELECT *, {LINEAR_VAL} AS v FROM z WHERE st = 1) a USING (recording_id, frame_index)
LEFT JOIN (SELECT *, {NEAREST_PICK.format(n="nv", p="pv")} AS v, {NEAREST_PICK.format(n="nts", p="pts")} AS src FROM z WHERE st = 2) b
  ON b.recording_id = pose.recording_id AND b.frame_index = pose.frame_index"""


@register("align_mixed_j5", _MIXED_SQL)
def align_mixed(spark, sf_dir):
    """The method follows from the stream's name, in one pass: poses by
    SLERP, joints linearly, others by the nearest sample."""
    from episodeframe.sources.tables import embeddings_as_poses
    kind = F.col("seq") % 3
    poses = embeddings_as_poses(spark, sf_dir).join(
        table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("seq"), F.col("embedding")[8].cast("double").alias("value")), "seq")
    is_pose = kind == 0
    msgs = poses.select("recording_id", F.when(is_pose, "arm_end_pose").when(kind == 1, "joint").otherwise("grip").alias("stream"), "ts_ns", "seq",
                        F.when(~is_pose, F.col("value")).alias("value"), *[F.when(is_pose, F.col(c)).alias(c) for c in ("position", "orientation")])
    methods = {s: A.method_for(s, {"joint"}) for s in ("arm_end_pose", "joint", "grip")}
    fr = aligned_frames(msgs, methods, POSE_STEP_NS, payload=["value", "position", "orientation"])
    p = F.col("arm_end_pose")
    return fr.select("recording_id", "frame_index", "t_ns", *[r6(p["position"][a]).alias(f"p{a}") for a in "xyz"],
                     *[r6(p["orientation"][a]).alias(f"q{a}") for a in "xyzw"], r6(F.col("joint")["value"]).alias("joint"),
                     r6(F.col("grip")["value"]).alias("grip"), F.col("grip__ts").alias("grip_ts"))


# -- head-camera timeline (collector route): click events are the frames
_TIMELINE_SQL = f"""
WITH m AS (
  SELECT user_id AS recording_id, event_type AS stream, epoch_us(ts) * 1000 AS ts_ns,
         event_id AS seq, value FROM events),
fr AS (SELECT recording_id, ts_ns AS t_ns,
              row_number() OVER (PARTITION BY recording_id ORDER BY ts_ns, seq) - 1 AS frame_index
       FROM m WHERE stream = 'click'),
gs AS (SELECT f.*, s.stream FROM fr f CROSS JOIN (SELECT DISTINCT stream FROM m WHERE stream <> 'click') s),
prv AS (SELECT gs.recording_id, gs.frame_index, gs.stream, m.ts_ns, m.value, row_number() OVER (
          PARTITION BY gs.recording_id, gs.frame_index, gs.stream ORDER BY m.ts_ns DESC, m.seq DESC) AS rn
        FROM gs JOIN m ON m.recording_id = gs.recording_id AND m.stream = gs.stream AND m.ts_ns < gs.t_ns),
nxt AS (SELECT gs.recording_id, gs.frame_index, gs.stream, m.ts_ns, m.value, row_number() OVER (
          PARTITION BY gs.recording_id, gs.frame_index, gs.stream ORDER BY m.ts_ns, m.seq) AS rn
        FROM gs JOIN m ON m.recording_id = gs.recording_id AND m.stream = gs.stream AND m.ts_ns >= gs.t_ns),
br AS (SELECT gs.recording_id, gs.frame_index, gs.t_ns, gs.stream, p.ts_ns AS pts, p.value AS pv,
              n.ts_ns AS nts, n.value AS nv
       FROM gs LEFT JOIN prv p ON p.recording_id = gs.recording_id AND p.frame_index = gs.frame_index
            AND p.stream = gs.stream AND p.rn = 1
       LEFT JOIN nxt n ON n.recording_id = gs.recording_id AND n.frame_index = gs.frame_index
            AND n.stream = gs.stream AND n.rn = 1)
SELECT recording_id, frame_index, t_ns, {", ".join(
    f"round(max(CASE WHEN stream = '{s}' THEN {NEAREST_PICK.format(n='nv', p='pv')} END), 6) AS {s}, "
    f"max(CASE WHEN stream = '{s}' THEN {NEAREST_PICK.format(n='nts', p='pts')} END) AS {s}__ts"
    for s in EVENT_STREAMS if s != 'click')}
FROM br GROUP BY 1, 2, 3"""


@register("collector_align", _TIMELINE_SQL)
def collector_align(spark, sf_dir):
    """Collector route: the head camera (``click``) timeline is the frame
    grid; the other streams are aligned by nearest sample (J2)."""
    from episodeframe.operators.blocks import dense_index
    msgs = events_as_messages(spark, sf_dir)
    frames = dense_index(msgs.where(F.col("stream") == "click"), ["recording_id"],
                         ["ts_ns", "seq"], "frame_index").select(
        "recording_id", "frame_index", F.col("ts_ns").alias("t_ns"))
    others = [s for s in EVENT_STREAMS if s != "click"]
    fr = A.align_frames(msgs, frames, A.AlignSpec({s: A.NEAREST for s in others}))
    out = [F.col("recording_id"), F.col("frame_index"), F.col("t_ns")]
    for s in others:
        out += [r6(F.col(s)).alias(s), F.col(f"{s}__ts")]
    return fr.select(*out)


@register("camera_index_map", """
WITH m AS (SELECT user_id AS recording_id, event_type AS camera, epoch_us(ts) * 1000 AS ts_ns,
                  event_id AS seq FROM events),
ix AS (SELECT *, row_number() OVER (PARTITION BY recording_id, camera ORDER BY ts_ns, seq) - 1
              AS image_index FROM m),
mainf AS (SELECT recording_id, image_index AS frame_index, ts_ns AS t_ns FROM ix WHERE camera = 'click'),
gs AS (SELECT f.*, c.camera FROM mainf f CROSS JOIN (SELECT DISTINCT camera FROM ix WHERE camera <> 'click') c),
prv AS (SELECT gs.recording_id, gs.frame_index, gs.camera, ix.ts_ns, ix.image_index, row_number() OVER (
          PARTITION BY gs.recording_id, gs.frame_index, gs.camera ORDER BY ix.ts_ns DESC, ix.seq DESC) AS rn
        FROM gs JOIN ix ON ix.recording_id = gs.recording_id AND ix.camera = gs.camera AND ix.ts_ns < gs.t_ns),
nxt AS (SELECT gs.recording_id, gs.frame_index, gs.camera, ix.ts_ns, ix.image_index, row_number() OVER (
          PARTITION BY gs.recording_id, gs.frame_index, gs.camera ORDER BY ix.ts_ns, ix.seq) AS rn
        FROM gs JOIN ix ON ix.recording_id = gs.recording_id AND ix.camera = gs.camera AND ix.ts_ns >= gs.t_ns)
SELECT gs.recording_id, gs.frame_index, gs.camera,
       CASE WHEN p.ts_ns IS NULL OR (n.ts_ns IS NOT NULL AND (n.ts_ns - gs.t_ns) < (gs.t_ns - p.ts_ns))
            THEN n.image_index ELSE p.image_index END AS image_index
FROM gs LEFT JOIN prv p ON p.recording_id = gs.recording_id AND p.frame_index = gs.frame_index
     AND p.camera = gs.camera AND p.rn = 1
LEFT JOIN nxt n ON n.recording_id = gs.recording_id AND n.frame_index = gs.frame_index
     AND n.camera = gs.camera AND n.rn = 1
UNION ALL
SELECT recording_id, frame_index, 'click' AS camera, frame_index AS image_index FROM mainf""")
def camera_index_map_q(spark, sf_dir):
    """Main camera 1:1, other cameras by nearest image."""
    msgs = events_as_messages(spark, sf_dir).withColumnRenamed("stream", "camera")
    return A.camera_index_map(msgs, "click", EVENT_STREAMS).select(
        "recording_id", "frame_index", "camera", F.col("image_index").cast("long").alias("image_index"))
