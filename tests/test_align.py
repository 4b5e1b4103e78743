"""Alignment edge rules (J1-J5, A2, O2) on hand-made rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from episodeframe.operators import align as A
from tests import refmodel as R

SCHEMA = "recording_id long, stream string, ts_ns long, seq long, value double"

# equal stamps, before first / after last, exact hit, midpoint tie,
# single-row stream, empty optional stream
ROWS = [
    # recording 1, stream a: equal stamps at 100 (seq 2, 3), exact hit at 200
    (1, "a", 50, 1, 5.0), (1, "a", 100, 2, 10.0), (1, "a", 100, 3, 11.0),
    (1, "a", 200, 4, 20.0), (1, "a", 300, 5, 30.0), (1, "a", 300, 6, 31.0),
    # stream b: midpoint tie between 140 and 160 at frame 150
    (1, "b", 40, 7, 1.0), (1, "b", 140, 8, 2.0), (1, "b", 160, 9, 3.0), (1, "b", 320, 10, 4.0),
    # single-row stream c
    (1, "c", 170, 11, 7.0),
    # recording 2
    (2, "a", 0, 1, 0.0), (2, "a", 1000, 2, 1.0), (2, "b", 10, 3, 5.0), (2, "b", 990, 4, 6.0),
]


def _frames(spark, methods, step=50, block=A.DEFAULT_BLOCK, timeline=None, rows=ROWS):
    m = spark.createDataFrame(rows, SCHEMA)
    if timeline is None:
        params = spark.createDataFrame([(1, 50, step, 6), (2, 0, step, 21)],
                                       "recording_id long, start_ns long, step_ns long, n_frames long")
        grid = A.frame_grid(params)
        out = A.align_frames(m, grid, A.AlignSpec(methods), params=params, block=block)
    else:
        grid = spark.createDataFrame(timeline, "recording_id long, frame_index long, t_ns long")
        out = A.align_frames(m, grid, A.AlignSpec(methods), block=block)
    return {(r["recording_id"], r["frame_index"]): r for r in out.collect()}, grid.collect()


def _by_stream(rows=ROWS):
    d = {}
    for rec, s, ts, seq, v in rows:
        d.setdefault((rec, s), []).append((ts, seq, v))
    return d


@pytest.mark.parametrize("block", [A.DEFAULT_BLOCK, 2])
@pytest.mark.parametrize("method", ["asof", "nearest", "linear"])
def test_methods_match_model(spark, method, block):
    streams = ["a", "b", "c", "d"]  # d never appears
    got, grid = _frames(spark, {s: method for s in streams}, block=block)
    model = {"asof": R.asof, "nearest": R.nearest, "linear": R.linear}[method]
    by = _by_stream()
    for g in grid:
        key = (g["recording_id"], g["frame_index"])
        for s in streams:
            rows = by.get((g["recording_id"], s), [])
            exp = model(rows, g["t_ns"])
            if method in ("asof", "nearest") and exp is not None:
                exp = exp[2]
            val = got[key][s]
            if exp is None:
                assert val is None, (key, s)
            else:
                assert val == pytest.approx(exp), (key, s, val, exp)


def test_asof_ties_take_last_arrival(spark):
    got, _ = _frames(spark, {"a": "asof"})
    # frame 1 is t = 100: equal stamps 100 (seq 2 and 3) -> seq 3
    assert got[(1, 1)]["a"] == 11.0
    # frame 0 t = 50 exact hit -> that row
    assert got[(1, 0)]["a"] == 5.0


def test_nearest_midpoint_goes_left_and_exact_takes_first_of_run(spark):
    got, _ = _frames(spark, {"a": "nearest", "b": "nearest"})
    assert got[(1, 2)]["b"] == 2.0          # t = 150, 140 vs 160 tie -> left
    assert got[(1, 1)]["a"] == 10.0         # t = 100 exact, run of two -> first
    assert got[(1, 5)]["a"] == 30.0         # t = 300 exact, run -> first


def test_linear_clamps_to_last_of_final_run(spark):
    got, _ = _frames(spark, {"a": "linear"})
    assert got[(1, 5)]["a"] == 31.0         # t = 300 == last stamp -> last row
    assert got[(1, 0)]["a"] == 5.0          # t = 50 == first stamp -> first row
    assert got[(1, 3)]["a"] == 20.0         # t = 200 exact hit
    assert got[(1, 4)]["a"] == pytest.approx(25.0)  # t = 250 between 200 and 300 (first of run)


def test_timeline_variant_matches_grid(spark):
    methods = {"a": "nearest", "b": "linear"}
    got_grid, grid = _frames(spark, methods)
    tl = [(g["recording_id"], g["frame_index"], g["t_ns"]) for g in grid]
    got_tl, _ = _frames(spark, methods, timeline=tl)
    for k, r in got_grid.items():
        assert got_tl[k]["a"] == r["a"] and got_tl[k]["b"] == pytest.approx(r["b"])


def test_random_against_model(spark):
    rnd = random.Random(7)
    rows = []
    seq = 0
    for rec in (1, 2):
        for s in ("a", "b"):
            for _ in range(40):
                seq += 1
                rows.append((rec, s, rnd.randrange(0, 400, 7), seq, rnd.random()))
    m = spark.createDataFrame(rows, SCHEMA)
    grid = spark.createDataFrame([(rec, k, 13 + 23 * k) for rec in (1, 2) for k in range(17)],
                                 "recording_id long, frame_index long, t_ns long")
    for method, model in (("asof", R.asof), ("nearest", R.nearest), ("linear", R.linear)):
        out = A.align_frames(m, grid, A.AlignSpec({"a": method, "b": method}), block=3).collect()
        by = _by_stream(rows)
        for r in out:
            for s in ("a", "b"):
                exp = model(by[(r["recording_id"], s)], r["t_ns"])
                if method != "linear":
                    exp = exp[2] if exp else None
                assert (r[s] is None and exp is None) or r[s] == pytest.approx(exp)


def test_pose_slerp_against_model(spark):
    rnd = random.Random(3)
    rows, model_rows = [], []
    for i in range(30):
        q = [rnd.uniform(-1, 1) for _ in range(4)]
        n = math.sqrt(sum(x * x for x in q))
        q = [x / n for x in q]
        p = [rnd.uniform(-1, 1) for _ in range(3)]
        ts = rnd.randrange(0, 1000, 10)
        rows.append((1, "arm_end_pose", ts, i, {"x": p[0], "y": p[1], "z": p[2]},
                     {"x": q[0], "y": q[1], "z": q[2], "w": q[3]}))
        model_rows.append((ts, i, (p, q)))
    schema = ("recording_id long, stream string, ts_ns long, seq long, "
              "position struct<x:double,y:double,z:double>, orientation struct<x:double,y:double,z:double,w:double>")
    m = spark.createDataFrame(rows, schema)
    grid = spark.createDataFrame([(1, k, -5 + 37 * k) for k in range(30)], "recording_id long, frame_index long, t_ns long")
    out = A.align_frames(m, grid, A.AlignSpec({"arm_end_pose": "pose"}, ["position", "orientation"])).collect()
    for r in out:
        ep, eq = R.pose(model_rows, r["t_ns"])
        v = r["arm_end_pose"]
        assert [v.position.x, v.position.y, v.position.z] == pytest.approx(ep)
        q = [v.orientation.x, v.orientation.y, v.orientation.z, v.orientation.w]
        assert q == pytest.approx(eq, abs=1e-9)
        assert sum(x * x for x in q) == pytest.approx(1.0)


def test_sampling_window_and_grid(spark):
    m = spark.createDataFrame(ROWS, SCHEMA)
    w = {r["recording_id"]: r for r in A.sampling_window(m).collect()}
    assert (w[1]["start_ns"], w[1]["end_ns"], w[1]["valid"]) == (170, 170, False)  # single-row c
    assert (w[2]["start_ns"], w[2]["end_ns"]) == (10, 990)
    p = A.grid_params(A.sampling_window(m), A.fps_step_ns(30), max_frames=5).collect()
    assert [(r["recording_id"], r["n_frames"]) for r in p] == [(2, 1)]  # 980 ns window, 33 ms step
    p = A.grid_params(A.sampling_window(m), 7, max_frames=5).collect()
    assert [(r["recording_id"], r["n_frames"]) for r in p] == [(2, 5)]
    assert A.fps_step_ns(30) == 33333333
    g = A.frame_grid(A.grid_params(A.sampling_window(m), 100)).where("recording_id = 2").collect()
    assert sorted(r["t_ns"] for r in g) == list(range(10, 991, 100))  # end inclusive when on grid


def test_method_choice():
    assert A.method_for("left_arm_end_pose") == "pose"
    assert A.method_for("left_arm_joint_states", {"left_arm_joint_states"}) == "linear"
    assert A.method_for("odom") == "nearest"
    assert A.method_for("left_arm_end_pose", downsample=False) == "nearest"


def test_frames_get_partitions_by_their_number(spark):
    """Three rows of parameters, ten million frames: a task makes a bounded part."""
    params = spark.createDataFrame([(r, 0, 1, n) for r, n in ((1, 9_000_000), (2, 999_999), (3, 1))],
                                   "recording_id long, start_ns long, step_ns long, n_frames long")
    assert A.frame_tasks(params) == 39
    assert A.frame_grid(params).rdd.getNumPartitions() == 39


def test_cut_episodes_deals_rows_by_their_number(spark):
    from episodeframe.operators import episodes as EP
    specs = spark.createDataFrame([(1, 1, 0, 5_000_000, "a"), (1, 2, 9, 9, "b"), (1, 3, 9, 4, "c")],
                                  "recording_id long, step_number long, start_index long, end_index long, task string")
    assert EP.episode_tasks(specs) == 20
    frames = spark.createDataFrame([(1, k) for k in range(10)], "recording_id long, frame_index long")
    few = specs.withColumn("end_index", F.least("end_index", F.lit(10)))
    assert EP.cut_episodes(frames, few, partitions=20).count() == 10
