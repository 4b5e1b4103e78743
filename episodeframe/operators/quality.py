"""Quality and replay checks.

Predicates are boolean Columns; checks are aggregations returning the
offending rows, so a caller can fail a job when they are non-empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.functions import quaternion as Q


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def pose_is_valid(pose: Column) -> Column:
    """All seven numbers finite and not the identity-at-origin pose
    (position 0, orientation (0, 0, 0, 1))."""
    p, o = pose["position"], pose["orientation"]
    vals = [p["x"], p["y"], p["z"], o["x"], o["y"], o["z"], o["w"]]
    finite = pose.isNotNull() & p.isNotNull() & o.isNotNull()
    for v in vals:
        finite = finite & _finite(v)
    ident = ((p["x"] == 0) & (p["y"] == 0) & (p["z"] == 0) & (o["x"] == 0) & (o["y"] == 0)
             & (o["z"] == 0) & (o["w"] == 1))
    return F.coalesce(finite & ~ident, F.lit(False))


def pose_with_fallback(action_pose: Column, observation_pose: Column) -> Column:
    """P10: the action pose if valid, else the observation pose if valid."""
    return F.coalesce(F.when(pose_is_valid(action_pose), action_pose),
                      F.when(pose_is_valid(observation_pose), observation_pose))


def gripper_with_fallback(action_position: Column, joint_positions: Column,
                          observation_position: Column) -> Column:
    """P10 gripper: finite action position -> first joint-state position
    (negative -> 0) -> finite observation position."""
    js = F.element_at(joint_positions, 1)
    return F.coalesce(F.when(_finite(action_position), action_position),
                      F.when(joint_positions.isNotNull(), F.when(js < 0.0, F.lit(0.0)).otherwise(js)),
                      F.when(_finite(observation_position), observation_position))


def range_status(rng: Column, min_range: Column, max_range: Column) -> Column:
    """Range-sensor status."""
    return (F.when(rng < min_range, F.lit("too close"))
            .when(rng > max_range, F.lit("out of range"))
            .otherwise(F.lit("ok")))


def model_mismatches(episodes: DataFrame, requested: str, model: str = "model") -> DataFrame:
    """P20: episodes whose model differs (case-insensitively) from the
    requested robot type."""
    return episodes.where(F.lower(F.col(model)) != F.lit(requested.lower()))


def clamp_to_limits(v: Column, lower: Column, upper: Column) -> Column:
    """Elementwise clamp of a joint vector into [lower, upper]."""
    return F.zip_with(F.zip_with(v, lower, lambda x, lo: F.greatest(x, lo)), upper,
                      lambda x, hi: F.least(x, hi))


def limit_violations(v: Column, lower: Column, upper: Column) -> Column:
    """Indices (0-based) of elements outside their limits; none for an
    empty vector."""
    flags = F.zip_with(F.zip_with(v, lower, lambda x, lo: x < lo), F.zip_with(v, upper, lambda x, hi: x > hi),
                       lambda a, b: a | b)
    idx = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)))
    return F.filter(idx, lambda i: F.get(flags, i))


def count_mismatch(n_images: Column, n_states: Column) -> Column:
    """Image count differs from the state count by more than
    max(10 % of states, 1)."""
    return F.abs(n_images - n_states) > F.greatest(n_states * 0.1, F.lit(1.0))


def too_few_frames(n_frames: Column, target_hz: float) -> Column:
    """Fewer frames than half a second at ``target_hz``."""
    return n_frames < F.lit(int(target_hz * 0.5))


def replay_summary(frames: DataFrame, episode: str, order: str, ts: str, pose_cols: list[str],
                   gripper_cols: list[str], speed: float = 1.0) -> DataFrame:
    """A12 dry run: frames, frames with at least one command, pose and
    gripper command counts, and replay time = (last - first timestamp) /
    speed when both are finite."""
    pose_n = sum((F.col(c).isNotNull().cast("int") for c in pose_cols), F.lit(0))
    grip_n = sum((F.col(c).isNotNull().cast("int") for c in gripper_cols), F.lit(0))
    f = frames.withColumn("_p", pose_n).withColumn("_g", grip_n)
    first = F.min_by(F.col(ts), F.col(order))
    last = F.max_by(F.col(ts), F.col(order))
    return f.groupBy(episode).agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if((F.col("_p") + F.col("_g")) > 0).alias("valid_frames"),
        F.sum("_p").alias("pose_commands"), F.sum("_g").alias("gripper_commands"),
        first.alias("_t0"), last.alias("_t1")).select(
        episode, "frames", "valid_frames", "pose_commands", "gripper_commands",
        F.when((F.col("frames") > 1) & _finite(F.col("_t0")) & _finite(F.col("_t1")),
               F.greatest(F.lit(0.0), (F.col("_t1") - F.col("_t0")) / speed))
        .otherwise(F.lit(0.0)).alias("replay_seconds"))


def frame_delay(ts: Column, next_ts: Column, speed: float = 1.0) -> Column:
    """Sleep before the next frame: (next - current) / speed, or 0 when
    not positive or not finite."""
    d = (next_ts - ts) / speed
    return F.when(_finite(ts) & _finite(next_ts) & (d > 0), d).otherwise(F.lit(0.0))


def audio_seconds(total_bytes: Column, rate: Column, channels: Column, bit_depth: Column) -> Column:
    """Bytes / (rate * channels * bytes per sample); 0 when unknown."""
    bps = rate * channels * F.floor(bit_depth / 8)
    return F.when(bps > 0, total_bytes / bps).otherwise(F.lit(0.0))


def tracking_error(tx: Column, ty: Column, tyaw: Column, cx: Column, cy: Column, cyaw: Column,
                   pos_tol: float = 0.05, ang_tol: float = 0.1) -> Column:
    """planar distance, wrapped yaw error and whether both are within
    tolerance (defaults 0.05 m / 0.1 rad; the controller uses 0.01 / 0.05)."""
    dist = F.sqrt((tx - cx) * (tx - cx) + (ty - cy) * (ty - cy))
    dyaw = Q.wrap_angle(tyaw - cyaw)
    return F.struct(dist.alias("distance"), dyaw.alias("yaw_error"),
                    ((dist < pos_tol) & (F.abs(dyaw) < ang_tol)).alias("within_tolerance"))
