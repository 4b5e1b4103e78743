import json
import math

from pyspark.sql import functions as F

from episodeframe.functions import typed as Y
from episodeframe.functions.typed import EULER, GRIPPER, JOINTS, ODOM, POSITION, TACTILE, TypedField
from episodeframe.plans import json_route as R
from episodeframe.sources.files import read_episodes

POSE = {"position": {"x": 1, "y": 2.5}, "orientation": {"z": math.sin(0.3), "w": math.cos(0.3)}}


def streams(spark, rows):
    return spark.createDataFrame([({k: json.dumps(v) for k, v in r.items()},) for r in rows], "m map<string,string>").select(
        F.transform_values("m", lambda k, v: F.try_parse_json(v)).alias("s"))


def vec(spark, layout, row):
    return [round(x, 6) for x in streams(spark, [row]).select(Y.vector(F.col("s"), layout).alias("v")).first().v]


def test_typed_fields_and_missing_streams(spark):
    layout = [TypedField("p", "a", POSITION), TypedField("r", "a", EULER), TypedField("g", "g", GRIPPER), TypedField("j", "j", JOINTS, index=2),
              TypedField("k", "j", JOINTS, index=(1, 7)), TypedField("w", "j", JOINTS, dim=5), TypedField("n", "j", JOINTS, dim=1),
              TypedField("o", "o", ODOM), TypedField("t", "t", TACTILE, dim=2), TypedField("u", None, "unknown", dim=2)]
    full = {"a": POSE, "g": {"position": 0.25}, "j": {"positions": [1, 2, 3]}, "o": {"pose": POSE}, "t": {"force": [7, 8, 9]}}
    assert sum(f.width for f in layout) == 23
    assert vec(spark, layout, full) == [1, 2.5, 0, 0, 0, 0.6, 0.25, 3, 2, 0, 1, 2, 3, 0, 0, 1, 1, 2.5, 0.6, 7, 8, 0, 0]
    assert vec(spark, [TypedField("g", "g", GRIPPER)], {"g": {"position": "wide"}}) == [0] == vec(spark, [TypedField("g", "g", GRIPPER)], {"g": {}})
    assert vec(spark, [TypedField("t", "t", TACTILE)], {"t": {"force": [1, 2, 3, 4]}}) == [1, 2, 3, 4]
    assert vec(spark, [TypedField("t", "t", TACTILE)], {}) == []


def test_command_streams_in_name_order(spark):
    row = {"z": [1, 2], "b": {"positions": [3]}, "m": POSE | {"position": {"x": 1, "y": 2, "z": 3}}, "a": {"k": 5, "j": 4, "s": "x", "l": [1]}, "q": "text"}
    got = streams(spark, [row]).select(Y.commands(F.col("s")).alias("v")).first().v
    assert [round(x, 6) for x in got] == [4, 5, 3, 1, 2, 3, 0, 0, round(math.sin(0.3), 6), round(math.cos(0.3), 6), 1, 2]


def write(path, **episodes):
    for name, doc in episodes.items():
        (path / f"{name}.json").write_text(json.dumps(doc, indent=1))


def test_generations_in_one_set(spark, tmp_path):
    v3 = [{"frame_id": i, "observation": {"right_arm_joint_states": {"positions": [i, 10]}}, "action": {"master_left_arm_end_pose_action": POSE}} for i in range(3)]
    v2 = [{"frame_id": i, "joint_states": [[i, 1, 2], [], []], "action": {"b": [9], "a": [8]}} for i in range(2)]
    old = [{"frame_id": i, "joint_states": {"positions": [i]}} for i in range(3)]
    write(tmp_path, e0={"episode_id": 0, "model": "m", "task": "t0", "frames": v3}, e1={"episode_id": 1, "frames": v2},
          e2={"episode_id": 2, "task": "t2", "frames": old, "collection_config": {}}, e3={"episode_id": 3, "frames": []})
    frames, bad = read_episodes(spark, str(tmp_path))
    assert [r.episode_id for r in bad.collect()] == [3]
    state, action = [TypedField("j", "right_arm_joint_states", JOINTS, dim=2)], [TypedField("p", "master_left_arm_end_pose_action", POSITION)]
    r = R.route(frames, state, action, chunk=2)
    got = {(x.episode_id, x.frame_pos): (x.task, x.form, list(x.state), list(x.action)) for x in r.frames.collect()}
    assert (r.state_width, r.action_width) == (3, 3)
    assert got[0, 1] == ("t0", "v3", [1, 10, 0], [1, 2.5, 0]) and got[1, 1] == ("unknown", "joints", [1, 1, 2], [8, 9, 0])
    assert {k for k in got if k[0] == 2} == {(2, 0), (2, 1)} and got[2, 0][3] == [1, 2, 0] and got[2, 1][3] == [2, 2, 0]
    rel = {(x.episode_id, x.frame_pos): (list(x.state), list(x.action)) for x in R.route(frames, state, action, chunk=2, relative_start=True).frames.collect()}
    assert rel[0, 2] == ([2, 0, 0], [0, 0, 0]) and rel[1, 0] == ([0, 0, 0], [0, 0, 0])
    delta = {(x.episode_id, x.frame_pos): list(x.action) for x in R.route(frames.where("episode_id <> 0"), state, action, joints=[0, 1, 9], chunk=2, delta=True).frames.collect()}
    assert delta[1, 1] == [7, 8] and delta[2, 0] == [1, 2]
