"""Config, file sources, sinks, point clouds and streaming twins."""

import json
import os
import struct

import pytest
from pyspark.sql import functions as F

from episodeframe.operators.pointcloud import explode_points
from episodeframe.sinks import writers as W
from episodeframe.sources import config as C
from episodeframe.sources import files as FS
from episodeframe.streaming import live as L


def test_config_validation():
    cfg = {"topics": {"observations": {
        "arm": {"decoder": "joint", "candidates": [{"topic": "/a"}, {"topic": "/b", "priority": 5},
                                                   {"topic": "/off", "enabled": False}]},
        "opt": {"decoder": "float", "required": False, "candidates": [{"topic": "/c"}]}},
        "cameras": {"head": {"candidates": [{"topic": "/img"}]}}},
        "state": {"fields": [{"name": "j0", "source": "arm", "extractor": "joint.position[0]"},
                             {"name": "k", "extractor": "constant:2"}]},
        "action": {"mode": "from_sources", "fields": [
            {"name": "j0", "source": "arm", "extractor": "joint.position[0]"},
            {"name": "k", "extractor": "constant:1"}]}}
    m = C.parse_mapping_config(cfg)
    assert m.topic_names() == ["/a", "/b", "/c", "/img"]
    assert [t[4] for t in m.topics] == [0, 5, 0, 0]
    assert m.required_fields() == ["arm"] and m.required_fields("camera") == []
    bad = json.loads(json.dumps(cfg))
    bad["topics"]["observations"]["opt"]["candidates"] = [{"topic": "/a"}]
    with pytest.raises(ValueError, match="duplicate topic"):
        C.parse_mapping_config(bad)
    bad = json.loads(json.dumps(cfg))
    bad["action"]["fields"] = bad["action"]["fields"][:1]
    with pytest.raises(ValueError, match="width"):
        C.parse_mapping_config(bad)
    bad = {"topics": {"observations": {"arm": {"decoder": "jiont", "candidates": [{"topic": "/a", "priority": "x"}]},
                                       "none": {"decoder": "float"}}},
           "state": {"fields": [{"name": "j", "source": "arm", "extractor": "joint.position[-1]"},
                                {"name": "j", "source": "leg", "extractor": "float.value"}]},
           "action": {"mode": "next_state", "fields": [{"name": "a", "extractor": "constant:z"}]}}
    with pytest.raises(C.ConfigError) as e:
        C.parse_mapping_config(bad)
    text = "\n".join(e.value.problems)
    for part in ("unknown decoder 'jiont'", "priority is not a whole number", "no enabled candidate", "joint.position[-1]",
                 "duplicate field 'j'", "source 'leg'", "next_state takes no fields", "constant"):
        assert part in text
    with pytest.raises(C.ConfigError, match="empty"):
        C.parse_mapping_config({})
    sw = C.CollectionSwitches(slave_joint_names=["left_arm_joint_states"], enabled={"odometry", "head_rgb_stream"})
    assert sw.action_names() == ["left_arm_actions"]
    assert sw.data_keys() == ["left_arm_joint_states", "left_arm_actions", "odometry"]
    assert sw.camera_names() == ["head_rgb_stream"]


def test_named_layouts():
    C.register_layout("arm", [C.FieldSpec("j0", "arm", "joint.position[0]"), C.FieldSpec("k", None, "constant:1")])
    assert [f.name for f in C.layout("arm")] == ["j0", "k"]
    with pytest.raises(ValueError, match="bad.x"):
        C.register_layout("bad", [C.FieldSpec("x", "arm", "joint.position[-1]")])
    with pytest.raises(KeyError):
        C.layout("bad")


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(obj) if not isinstance(obj, str) else obj)


def test_episode_json_sources(spark, tmpdir_path):
    ep = {"episode_id": 3, "model": "arm-a", "task": "pick", "timestamp": "t", "duration": 1.0,
          "joint_names": {"left": ["j1"]}, "storage_format": "video",
          "frames": [{"frame_id": 0, "timestamp": 0.0, "observation": {"left_arm_joint_states": {"positions": [1.0]}},
                      "action": {}, "images": {}},
                     {"frame_id": 1, "timestamp": 0.1, "observation": {}, "action": {"x": [1, 2]}, "images": {}}]}
    _write(f"{tmpdir_path}/eps/episode_3.json", ep)
    _write(f"{tmpdir_path}/eps/episode_4.json", {"episode_id": 4, "frames": []})
    frames, bad = FS.read_episodes(spark, f"{tmpdir_path}/eps")
    fr = frames.orderBy("frame_pos").collect()
    assert [r["frame_id"] for r in fr] == [0, 1]
    assert json.loads(fr[0]["observation"]["left_arm_joint_states"]) == {"positions": [1.0]}
    assert [r["episode_id"] for r in bad.collect()] == [4]
    meta = {r["episode_id"]: r for r in FS.read_episode_metadata(spark, f"{tmpdir_path}/eps").collect()}
    assert meta[3]["num_frames"] == 2 and meta[4]["task"] == "unknown"


def test_manifest_sidecars_raw_manifest_stats(spark, tmpdir_path):
    _write(f"{tmpdir_path}/m/manifest.json", {"dataset": {"repo_id": "x/y"}, "tasks": [
        {"task_id": "t0", "task": "pick", "files": ["a.bag", {"path": "b.bag"}]},
        {"taskId": "t1", "description": "place", "files": ["c.bag"]}]})
    man = [tuple(r) for r in FS.read_manifest(spark, f"{tmpdir_path}/m").orderBy("task_index", "file_index").collect()]
    assert man == [(0, "t0", "pick", 0, "a.bag"), (0, "t0", "pick", 1, "b.bag"), (1, "t1", "place", 0, "c.bag")]
    _write(f"{tmpdir_path}/side/rec7/task_meta.json", {"taskName": None, "taskId": 9})
    _write(f"{tmpdir_path}/side/rec8/task_meta.json", "[1, 2]")
    sc = FS.read_sidecars(spark, f"{tmpdir_path}/side/*/task_meta.json").collect()
    assert [r["recording_id"] for r in sc] == ["rec7"]
    _write(f"{tmpdir_path}/raw/manifest.json", {"episode_id": 1, "created": "c", "note": "",
                                                "files": {"pose.jsonl": {"records": 3, "record_format": "ts,pose"},
                                                          "imu.jsonl": {"records": 0, "record_format": "x"}}})
    assert [r["file"] for r in FS.read_raw_manifest(spark, f"{tmpdir_path}/raw").collect()] == ["pose.jsonl"]
    _write(f"{tmpdir_path}/stats.json", {"observation.state": {"min": [0.0], "max": [1.0]}, "action": {"min": [2.0]}})
    st = FS.read_stats_json(spark, f"{tmpdir_path}/stats.json", prefix="observation.").collect()
    assert [(r["feature"], r["max"]) for r in st] == [("observation.state", [1.0])]


def test_robot_joints_xml(spark, tmpdir_path):
    _write(f"{tmpdir_path}/robot.urdf", """<robot name="r">
      <link name="base"/><link name="l1"/>
      <joint name="j1" type="revolute"><parent link="base"/><child link="l1"/>
        <limit lower="-1.5" upper="1.5" effort="10" velocity="2"/></joint>
    </robot>""")
    j = FS.read_robot_joints(spark, f"{tmpdir_path}/robot.urdf").collect()
    assert [(r["name"], r["type"], r["parent"], r["child"], r["lower"], r["upper"]) for r in j] == \
        [("j1", "revolute", "base", "l1", -1.5, 1.5)]


def test_sinks_round_trip(spark, tmpdir_path):
    root = f"{tmpdir_path}/out"
    frames = spark.createDataFrame(
        [(0.1 * i, i % 3, i // 3, i, 0, [float(i)], [float(i + 1)]) for i in range(9)],
        "timestamp double, frame_index long, episode_index long, index long, task_index long, "
        "`observation.state` array<float>, action array<float>")
    W.write_frames(frames, root, files=2)
    back = spark.read.parquet(f"{root}/data")
    assert sorted(r["index"] for r in back.collect()) == list(range(9))
    with pytest.raises(Exception):
        W.write_frames(frames, root)
    W.write_tasks(spark.createDataFrame([(0, "pick")], "task_index long, task string"), root)
    eps = spark.createDataFrame([(0, "pick", 3, 0, 3)], "episode_index long, task string, length long, "
                                "dataset_from_index long, dataset_to_index long")
    W.write_episodes(eps, root)
    assert spark.read.parquet(f"{root}/meta/episodes").first()["tasks"] == ["pick"]
    from episodeframe.operators.stats import dataset_totals, vector_stats
    st = vector_stats(back.withColumnRenamed("observation.state", "state"), ["state", "action"])
    js = json.loads(W.stats_json(st).first()["json"])
    assert js["state"]["max"] == [8.0] and js["action"]["count"] == [9]
    info = json.loads(W.info_json(dataset_totals(back, eps, spark.createDataFrame([(0, "pick")], "task_index long, task string")),
                                  30, {"observation.state": 1, "action": 1}).first()["json"])
    assert info["splits"] == {"train": "0:1"} and info["total_frames"] == 9
    W.write_small_json(W.stats_json(st), f"{root}/meta/stats")
    msgs = spark.createDataFrame([(1, "a", 5, 1, '{"x": 1}'), (1, "a", 3, 2, '{"x": [1, 2]}')],
                                 "recording_id long, stream string, ts_ns long, seq long, payload string")
    W.write_raw_streams(msgs, f"{root}/raw")
    man = W.raw_manifest(spark.read.parquet(f"{root}/raw")).first()
    assert man["records"] == 2 and "ARRAY" in man["record_format"]
    W.write_episode_json(spark.createDataFrame([(1, 0, 0.0), (1, 1, 0.1)], "episode_id long, frame_id long, timestamp double"),
                         f"{root}/episodes")
    assert spark.read.json(f"{root}/episodes").count() == 2
    W.append_episode_rows(eps, f"{root}/meta_rows")
    W.append_episode_rows(eps, f"{root}/meta_rows")
    assert spark.read.parquet(f"{root}/meta_rows").count() == 2


def test_point_cloud_explode(spark):
    pts = [(1.0, 2.0, 3.0), (4.0, 5.0, 6.0)]
    little = b"".join(struct.pack("<fff", *p) + b"\x00\x00\x00\x00" for p in pts)
    big = b"".join(struct.pack(">fff", *p) + b"\x00\x00\x00\x00" for p in pts)
    fields = [{"name": n, "offset": 4 * i, "datatype": 7, "count": 1} for i, n in enumerate("xyz")]
    df = spark.createDataFrame([(1, 2, 1, 16, False, fields, little), (2, 2, 1, 16, True, fields, big)],
                               "cloud_id long, width int, height int, point_step int, is_bigendian boolean, "
                               "fields array<struct<name:string,offset:int,datatype:int,count:int>>, data binary")
    got = sorted((r["cloud_id"], r["point_index"], r["x"], r["y"], r["z"]) for r in explode_points(df).collect())
    assert got == [(c, i, *pts[i]) for c in (1, 2) for i in range(2)]


MSG = [(1, "a", 1_000_000_000, 1, 1.0, "x"), (1, "a", 1_005_000_000, 2, 2.0, "x"),
       (1, "b", 1_001_000_000, 3, 3.0, "x"), (1, "a", 2_500_000_000, 4, 4.0, "x"),
       (2, "a", 1_000_000_000, 5, 5.0, "x"), (1, "a", 2_500_000_000, 6, 6.0, "x")]


def _land(spark, tmpdir_path):
    df = spark.createDataFrame(MSG, L.MESSAGE_SCHEMA)
    df.drop("stream").write.json(f"{tmpdir_path}/in_all")
    for s in ("a", "b"):
        df.where(F.col("stream") == s).drop("stream").write.json(f"{tmpdir_path}/in_{s}")
    return df


def _run(query_df, name, mode, tmpdir_path):
    q = (query_df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", f"{tmpdir_path}/ck_{name}").trigger(availableNow=True).start())
    q.awaitTermination(120)
    return q


def test_streaming_counts_latest_and_decimation(spark, tmpdir_path):
    batch = _land(spark, tmpdir_path)
    schema = L.MESSAGE_SCHEMA
    src = L.ingest(spark, {"a": f"{tmpdir_path}/in_a", "b": f"{tmpdir_path}/in_b"},
                   schema=type(schema)([f for f in schema.fields if f.name != "stream"]))
    _run(L.running_counts(src), "t2", "complete", tmpdir_path)
    got = {(r[0], r[1]): r[2] for r in spark.sql("select * from t2").collect()}
    assert got == {(1, "a"): 4, (1, "b"): 1, (2, "a"): 1}
    _run(L.latest_snapshot(src), "t4", "complete", tmpdir_path)
    lat = {(r[0], r[1]): r[2]["seq"] for r in spark.sql("select * from t4").collect()}
    twin = {(r[0], r[1]): r[2]["seq"] for r in L.latest_snapshot(L.with_event_time(batch)).collect()}
    assert lat == twin and lat[(1, "a")] == 6
    _run(L.decimate(src, period_ms=10), "t7", "append", tmpdir_path)
    d = spark.sql("select recording_id, stream, bucket from t7").collect()
    assert len(d) == 4  # (1,a,100) (1,a,250) once, (1,b,100), (2,a,100); 1.005 s and 1.000 s share a 10 ms bucket


def test_accumulate_window(spark, tmpdir_path):
    tf = spark.createDataFrame([("c1", "p", 0, 1), ("c1", "q", 1, 2), ("c1", "r", 4, 3), ("c2", "p", 2, 4),
                                ("c9", "p", 60, 5)], "child string, parent string, sec long, seq long")
    tf.write.json(f"{tmpdir_path}/tf")
    src = (spark.readStream.schema("child string, parent string, sec long, seq long").json(f"{tmpdir_path}/tf")
           .withColumn("ts", F.timestamp_seconds("sec")))
    _run(L.accumulate_window(src.drop("sec"), 3, "1 second"), "t5", "append", tmpdir_path)
    rows = spark.sql("select window.start, child, last.parent from t5").collect()
    got = sorted((r[0].second, r[1], r[2]) for r in rows)
    assert (0, "c1", "q") in got and (0, "c2", "p") in got and (3, "c1", "r") in got


def test_liveness_alarms(spark, tmpdir_path):
    first = spark.createDataFrame([(1, "a", 0), (1, "a", 2)], "recording_id long, stream string, sec long")
    later = spark.createDataFrame([(1, "a", 20), (1, "a", 21)], "recording_id long, stream string, sec long")
    first.coalesce(1).write.json(f"{tmpdir_path}/live/1")
    later.coalesce(1).write.json(f"{tmpdir_path}/live/2")
    # a later batch: timeouts run once the watermark (from batch 2) has passed them
    spark.createDataFrame([(1, "a", 40)], "recording_id long, stream string, sec long").coalesce(1).write.json(
        f"{tmpdir_path}/live/3")
    src = (spark.readStream.schema("recording_id long, stream string, sec long").option("maxFilesPerTrigger", 1)
           .json(f"{tmpdir_path}/live/*")
           .withColumn("ts", F.timestamp_seconds(F.col("sec") + 1_700_000_000)))
    expected = (src.where("stream = 'a' AND sec = 0").select("recording_id", F.lit("b").alias("stream"), "ts"))
    _run(L.liveness_alarms(src, expected), "t3", "append", tmpdir_path)
    got = sorted((r["stream"], r["alarm"]) for r in spark.sql("select * from t3").collect())
    assert ("a", "silent") in got and ("b", "never seen") in got


def _alarms(spark, path, name, batches, expected):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "recording_id long, stream string, sec long").coalesce(1).write.json(f"{path}/{name}/{k}")
    src = (spark.readStream.schema("recording_id long, stream string, sec long").option("maxFilesPerTrigger", 1)
           .json(f"{path}/{name}/*").withColumn("ts", F.timestamp_seconds(F.col("sec") + 1_700_000_000)))
    seeds = src.where("stream = 'start'").withColumn("stream", F.explode(F.array(*map(F.lit, expected))))
    _run(L.liveness_alarms(src.where("stream <> 'start'"), seeds.select("recording_id", "stream", "ts")), name, "append", path)
    return sorted((r[0], r[1], r[2], r[3] - 1_700_000_000, r[4] - 1_700_000_000) for r in spark.sql(
        f"select recording_id, stream, alarm, unix_seconds(last_ts), unix_seconds(at) from {name}").collect())


def test_liveness_of_recordings_whose_clocks_lie_hours_apart(spark, tmpdir_path):
    """Recording 1 runs four hours ahead of recording 2; both have the same rows."""
    one = [[("start", 0), ("a", 0), ("a", 3), ("b", 2)], [("a", 6), ("a", 9), ("b", 4)], [("a", 12), ("a", 15)],
           [("a", 18), ("b", 18)], [("a", 40), ("b", 19), ("b", 23)]]
    both = [[(r, s, t + ahead) for r, ahead in ((1, 14_400), (2, 0)) for s, t in rows] for rows in one]
    got = _alarms(spark, tmpdir_path, "t3_hours", both, ["a", "b", "c"])
    want = [("a", "silent", 18, 23), ("b", "silent", 4, 9), ("b", "silent", 23, 28), ("c", "never seen", 0, 5)]
    assert got == sorted((r, s, kind, last + ahead, at + ahead) for r, ahead in ((1, 14_400), (2, 0)) for s, kind, last, at in want)


def test_liveness_of_a_recording_that_goes_dark(spark, tmpdir_path):
    ahead = 14_400
    batches = [[(2, "start", 0), (2, "a", 0), (1, "a", ahead)], [(2, "a", 3), (1, "a", ahead + 3)],
               *([(1, "a", ahead + t)] for t in range(6, 22, 3))]
    assert _alarms(spark, tmpdir_path, "t3_dark", batches, ["a"]) == [(2, "a", "silent", 3, 8)]


def test_land_all_keeps_late_and_equal_stamps(spark, tmpdir_path):
    rows = [[(1, "a", 100, 1), (1, "a", 100, 2), (2, "b", 9_000_000_000_000, 1)], [(1, "a", 50, 3), (2, "b", 10, 2)], [(1, "a", 100, 1)]]
    for k, part in enumerate(rows):
        spark.createDataFrame(part, "recording_id long, stream string, ts_ns long, seq long").coalesce(1).write.json(f"{tmpdir_path}/in/{k}")
    src = (spark.readStream.schema("recording_id long, stream string, ts_ns long, seq long").option("maxFilesPerTrigger", 1)
           .json(f"{tmpdir_path}/in/*"))
    L.land_all(src, f"{tmpdir_path}/landed", f"{tmpdir_path}/ck_t8").awaitTermination(120)
    got = spark.read.parquet(f"{tmpdir_path}/landed").select("recording_id", "stream", "ts_ns", "seq").collect()
    assert sorted(map(tuple, got)) == sorted(r for part in rows for r in part)


def test_recording_sessions(spark, tmpdir_path):
    ctl = spark.createDataFrame([(1, "start", 0), (1, "stop", 5), (2, "start", 1)], "recording_id long, action string, sec long")
    ctl.write.json(f"{tmpdir_path}/ctl")
    src = spark.readStream.schema("recording_id long, action string, sec long").json(f"{tmpdir_path}/ctl")
    closed = []
    q = L.recording_sessions(src, lambda df, e: closed.extend(r[0] for r in df.collect()), f"{tmpdir_path}/ck_t6")
    q.awaitTermination(120)
    assert closed == [1]


def test_plain_record_and_formats(spark, tmpdir_path):
    from episodeframe.functions.records import plain_json
    df = spark.createDataFrame([({"header": {"stamp": 1}, "_priv": 2, "pose": {"x": 1.0, "stamp": 5},
                                  "items": [{"a": 1, "stamp": 3}]},)],
                               "m struct<header:struct<stamp:int>,_priv:int,pose:struct<x:double,stamp:int>,"
                               "items:array<struct<a:int,stamp:int>>>")
    got = json.loads(df.select(plain_json(F.col("m"), df.schema["m"].dataType)).first()[0])
    assert got == {"pose": {"x": 1.0}, "items": [{"a": 1}]}
    _write(f"{tmpdir_path}/f/e1.json", {"episode_id": 1, "frames": [
        {"frame_id": 0, "observation": {"right_arm_joint_states": {}}, "action": {"x": 1}}]})
    _write(f"{tmpdir_path}/f/e2.json", {"episode_id": 2, "collection_config": {"a": 1}, "frames": [
        {"frame_id": 0, "observation": {}}] * 6 + [{"frame_id": 6, "action": {}}]})
    _write(f"{tmpdir_path}/f/e3.json", {"episode_id": 3, "frames": [{"frame_id": 0, "joint_states": {"p": []}}]})
    frames, _ = FS.read_episodes(spark, f"{tmpdir_path}/f")
    got = {r["episode_id"]: (r["new_format"], r["has_action"]) for r in FS.episode_formats(frames).collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (True, False)}
    assert frames.select(FS.is_v3_frame(F.col("observation"), F.col("action"))).where("1=1").count() == 9
