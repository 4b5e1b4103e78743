"""The JSON route over episodes written from ``embeddings`` (Entry C, F10).

Episode = label, frame = vector in ``vec_id`` order; the label modulo 4 picks the
generation of the file: typed observation and action maps, joint states as a
list with command streams, joint states as an object, and one without actions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from episodeframe.functions.typed import EULER, GRIPPER, JOINTS, ODOM, POSITION, TACTILE, TypedField
from episodeframe.plans import json_route as R
from episodeframe.plans.catalog import r6, register
from episodeframe.session import ensure_checkpoint_dir
from episodeframe.sources.tables import table

CHUNK = 4
STATE = [TypedField("pos", "left_arm_end_pose", POSITION), TypedField("rot", "left_arm_end_pose", EULER),
         TypedField("joints", "right_arm_joint_states", JOINTS, index=(0, 2, 9)), TypedField("grip", "gripper", GRIPPER),
         TypedField("word", "gripper_text", GRIPPER), TypedField("gone", "absent", JOINTS, dim=2), TypedField("base", "odometry", ODOM),
         TypedField("skin", "tactile", TACTILE, dim=3)]
ACTION = [TypedField("pos", "master_left_arm_end_pose_action", POSITION), TypedField("grip", "gripper_action", GRIPPER),
          TypedField("arm", "right_arm_joint_states_action", JOINTS, dim=6), TypedField("one", "right_arm_joint_states_action", JOINTS, index=1),
          TypedField("short", "right_arm_joint_states_action", JOINTS, dim=2), TypedField("nobody", None, EULER)]


def write_episodes(spark, sf_dir: str, path: str) -> None:
    """One JSON line per frame; labels that are null count as -1."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.coalesce("label", F.lit(-1)).cast("long").alias("episode_id"),
                                                  F.transform("embedding", lambda x: x.cast("double")).alias("e"))

    def at(i):
        return F.get("e", F.lit(i - 1))

    def pose(i):
        return F.struct(F.struct(*[at(i + k).alias(c) for k, c in enumerate("xyz")]).alias("position"),
                        F.struct(*[at(i + 3 + k).alias(c) for k, c in enumerate("xyzw")]).alias("orientation"))

    def joints(i, n):
        return F.struct(F.array(*[at(k) for k in range(i, i + n)]).alias("positions"))

    gen = F.pmod("episode_id", F.lit(4))
    v3_obs = F.struct(joints(1, 7).alias("right_arm_joint_states"), pose(8).alias("left_arm_end_pose"), F.struct(at(20).alias("position")).alias("gripper"),
                      F.struct(F.lit("open").alias("position")).alias("gripper_text"), F.struct(pose(21).alias("pose")).alias("odometry"),
                      F.struct(F.array(at(60), at(61)).alias("force")).alias("tactile"))
    v3_act = F.struct(pose(30).alias("master_left_arm_end_pose_action"), joints(40, 5).alias("right_arm_joint_states_action"),
                      F.struct(at(50).alias("position")).alias("gripper_action"))
    v2_act = F.struct(F.array(at(8), at(9)).alias("b_cmd"), joints(10, 1).alias("a_cmd"), pose(11).alias("c_pose"),
                      F.struct(at(18).alias("zeta"), F.lit("x").alias("mode"), at(19).alias("alpha")).alias("d_other"))
    lists = F.array(F.array(*[at(k) for k in range(1, 7)]), F.array(at(1)), F.array(at(2)))
    nothing = F.lit(None).cast("string")

    def doc(s):  # nested JSON in the frame's line
        return F.to_json(s)

    lines = e.select(
        F.col("episode_id"), F.lit("m").alias("model"), F.concat(F.lit("task "), gen.cast("string")).alias("task"), F.col("vec_id").alias("frame_id"),
        F.when(gen == 0, doc(v3_obs)).alias("observation"), F.when(gen == 0, doc(v3_act)).when(gen == 1, doc(v2_act)).when(gen == 2, doc(joints(6, 4))).alias("action"),
        F.when(gen.isin(1, 3), F.to_json(lists)).when(gen == 2, doc(joints(1, 5))).otherwise(nothing).alias("joint_states"))
    parts = [F.concat(F.lit(f'"{c}":'), F.col(c).cast("string") if c in ("episode_id", "frame_id", "observation", "action", "joint_states")
                      else F.concat(F.lit('"'), F.col(c), F.lit('"'))) for c in lines.columns]
    lines.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))).write.text(path)


def _route(spark, sf_dir, **options):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/episodes/{uuid.uuid4().hex}"
    write_episodes(spark, sf_dir, path)
    return R.route(R.read_episode_lines(spark, path), STATE, ACTION, chunk=CHUNK, **options)


def _long(frames):
    """One row per frame, vector and position."""
    rows = F.array(*[F.struct(F.lit(n).alias("vector"), F.col(n).alias("v")) for n in ("state", "action")])
    long = frames.select("episode_id", "form", "task", "frame_pos", F.inline(rows)).select(
        "episode_id", "form", "task", "frame_pos", "vector", F.posexplode("v").alias("pos", "x"))
    return long.select("episode_id", "form", "task", "frame_pos", "vector", "pos", r6(F.col("x")).alias("x"))


def _e(*at: int) -> str:
    return "[" + ", ".join(f"e[{i}]" for i in at) + "]"


def _euler(x, y, z, w) -> str:
    s = f"2 * (e[{w}] * e[{y}] - e[{z}] * e[{x}])"
    return (f"[atan2(2 * (e[{w}] * e[{x}] + e[{y}] * e[{z}]), 1 - 2 * (e[{x}] * e[{x}] + e[{y}] * e[{y}])), "
            f"CASE WHEN abs({s}) >= 1 THEN sign({s}) * pi() / 2 ELSE asin(greatest(-1.0, least(1.0, {s}))) END, "
            f"atan2(2 * (e[{w}] * e[{z}] + e[{x}] * e[{y}]), 1 - 2 * (e[{y}] * e[{y}] + e[{z}] * e[{z}]))]")


_YAW = "[atan2(2 * (e[27] * e[26] + e[24] * e[25]), 1 - 2 * (e[25] * e[25] + e[26] * e[26]))]"
_JSON_SQL = f"""
v AS (SELECT coalesce(label, -1)::BIGINT AS episode_id, vec_id, embedding::DOUBLE[] AS e,
             CAST(row_number() OVER (PARTITION BY coalesce(label, -1) ORDER BY vec_id) - 1 AS BIGINT) AS frame_pos,
             count(*) OVER (PARTITION BY coalesce(label, -1)) AS n, ((coalesce(label, -1) % 4) + 4) % 4 AS gen FROM embeddings),
s AS (SELECT *, CASE gen WHEN 0 THEN {_e(8, 9, 10)} || {_euler(11, 12, 13, 14)} || {_e(1, 3)} || [0.0::DOUBLE] || {_e(20)} || [0.0::DOUBLE, 0.0, 0.0]
                     || {_e(21, 22)} || {_YAW} || {_e(60, 61)} || [0.0::DOUBLE]
                WHEN 2 THEN {_e(*range(1, 6))} ELSE {_e(*range(1, 7))} END AS state FROM v),
a AS (SELECT *, CASE gen WHEN 0 THEN {_e(30, 31, 32)} || {_e(50)} || {_e(*range(40, 45))} || [0.0::DOUBLE] || {_e(41)} || {_e(40, 41)} || [0.0::DOUBLE, 0.0, 0.0]
                WHEN 1 THEN {_e(10)} || {_e(8, 9)} || {_e(*range(11, 18))} || {_e(19, 18)} WHEN 2 THEN {_e(*range(6, 10))}
                WHEN 3 THEN flatten([{", ".join(f"lead(state, least({k}, n - 1 - frame_pos)::INTEGER) OVER w" for k in range(1, CHUNK + 1))}]) END AS action
      FROM s WINDOW w AS (PARTITION BY episode_id ORDER BY frame_pos)),
k AS (SELECT * FROM a WHERE gen <> 3 OR frame_pos < n - 1)"""


def _long_sql(relative: bool) -> str:
    first = "first_value({c}) OVER (PARTITION BY episode_id ORDER BY frame_pos)"
    vec = (lambda c: f"list_transform(list_zip({c}, {first.format(c=c)}), lambda p: p[1] - p[2])") if relative else (lambda c: c)
    return f"""
WITH {_JSON_SQL},
r AS (SELECT episode_id, gen, frame_pos, {vec('state')} AS state, {vec('action')} AS action FROM k),
w AS (SELECT max(len(state)) AS ws, max(len(action)) AS wa FROM r),
l AS (SELECT r.*, 'state' AS vector, state AS x, ws AS w FROM r, w UNION ALL SELECT r.*, 'action', action, wa FROM r, w)
SELECT episode_id, CASE gen WHEN 0 THEN 'v3' ELSE 'joints' END AS form, 'task ' || gen AS task, frame_pos, vector, CAST(p AS INTEGER) AS pos,
       round(CAST(CAST(coalesce(x[p + 1], 0) AS REAL) AS DOUBLE), 6) AS x
FROM l, range(0, 1000) AS t(p) WHERE p < w"""


@register("json_route_frames", _long_sql(False))
def json_route_frames(spark, sf_dir):
    """States and actions of mixed file generations, padded to one width."""
    return _long(_route(spark, sf_dir).frames)


@register("json_route_relative", _long_sql(True))
def json_route_relative(spark, sf_dir):
    """The same, relative to each episode's first frame."""
    return _long(_route(spark, sf_dir, relative_start=True).frames)
