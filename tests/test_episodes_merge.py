"""Episode cutting (J6, J8, P5, P11-P13) and merge/stats."""

import math
import random

import pytest
from pyspark.sql import functions as F

from episodeframe.functions import text as TX
from episodeframe.functions.timeunits import normalize_to_ns
from episodeframe.operators import episodes as EP
from episodeframe.operators import merge as M
from episodeframe.operators import stats as S


def _params(spark):
    return spark.createDataFrame([(1, 1000, 100, 10), (2, 0, 10, 5)],
                                 "recording_id long, start_ns long, step_ns long, n_frames long")


def test_step_ranges_skip_rules_and_fallback(spark):
    steps = spark.createDataFrame([
        (1, 1, 1000, 1250, "a"),     # frames 1000..1200 -> [0, 3)
        (1, 2, 1150, 1450, "b"),     # overlaps: 1200..1400 -> [2, 5)
        (1, 3, None, 1300, "x"),     # missing bound
        (1, 4, 1300, 1300, "x"),     # end <= start
        (1, 5, 0, 1000, "x"),        # end <= first frame
        (1, 6, 1900, 5000, "x"),     # start >= last frame (1900)
        (1, 7, 1210, 1290, "x"),     # no frame inside
        (1, 8, 500, 1050, "c"),      # clipped to window -> [0, 1)
        (2, 1, None, None, "x"),     # recording 2: nothing usable -> fallback
    ], "recording_id long, step_number long, start_ns long, end_ns long, task string")
    r = EP.step_ranges_on_grid(steps, _params(spark))
    got = {(x["recording_id"], x["step_number"]): (x["usable"], x["start_index"], x["end_index"]) for x in r.collect()}
    assert got[(1, 1)] == (True, 0, 3)
    assert got[(1, 2)] == (True, 2, 5)
    assert got[(1, 8)] == (True, 0, 1)
    for s in (3, 4, 5, 6, 7):
        assert got[(1, s)][0] is False
    specs = EP.episode_specs(r, _params(spark), F.lit("default"))
    frames = spark.createDataFrame([(rec, k, float(k)) for rec, n in ((1, 10), (2, 5)) for k in range(n)],
                                   "recording_id long, frame_index long, v double")
    eps = EP.cut_episodes(frames, specs).collect()
    rec2 = [e for e in eps if e["recording_id"] == 2]
    assert len(rec2) == 5 and all(e["task"] == "default" and e["step_number"] is None for e in rec2)
    rec1 = sorted((e["step_number"], e["episode_frame_index"], e["frame_index"]) for e in eps if e["recording_id"] == 1)
    assert [x for x in rec1 if x[0] == 2] == [(2, 0, 2), (2, 1, 3), (2, 2, 4)]
    assert sum(1 for x in rec1 if x[2] == 2) == 2  # frame 2 sits in two overlapping steps


def test_explode_range_chunks(spark):
    df = spark.createDataFrame([(1, 0, 10), (2, 5, 5), (3, 3, 4)], "k long, lo long, hi long")
    got = sorted((r["k"], r["i"]) for r in EP.explode_range(df, "lo", "hi", "i", chunk=3).collect())
    assert got == [(1, i) for i in range(10)] + [(3, 3)]


def test_episode_selection(spark):
    df = spark.range(30).withColumnRenamed("id", "episode_index")
    got = sorted(r[0] for r in EP.select_episodes(df, "0,3, 5-7,3,12-12").collect())
    assert got == [0, 3, 5, 6, 7, 12]
    assert EP.select_episodes(df, None).count() == 30


def test_step_action_first_match(spark):
    rows = [(1, 0, 2, "  "), (1, 1, 2, " pick "), (1, 2, 2, "place"), (1, 3, 3, None)]
    df = spark.createDataFrame(rows, "recording_id long, pos long, number long, action string")
    got = {(r[0], r[1]): r[2] for r in EP.step_actions_from_meta(df).collect()}
    assert got == {(1, 2): "pick"}


def test_task_name_chain(spark):
    rows = [
        ("ov", " step ", "meta", {"taskName": "T", "actionDesc": "D"}),
        (None, "  ", "meta", {"taskName": "T", "actionDesc": "D"}),
        (None, None, None, {"taskName": " T ", "actionDesc": "D"}),
        (None, None, None, {"name": "N"}),
        (None, None, None, {"taskId": "42"}),
        (None, None, None, {"description": "only desc"}),
        (None, None, None, {}),
    ]
    df = spark.createDataFrame(rows, "ov string, sa string, msa string, meta map<string,string>")
    got = [r[0] for r in df.select(TX.build_task_name(F.col("ov"), "fb", F.col("meta"), F.col("sa"),
                                                       F.col("msa"))).collect()]
    assert got == ["ov", "meta", "T: D", "N", "42", "only desc", "fb"]
    assert df.select(TX.build_task_name(None, "fb", None, F.lit(" step "))).first()[0] == " step "


def test_platform_description_and_first_present(spark):
    df = spark.createDataFrame([({"task": " direct "},), ({"taskName": "n", "scene_desc": "s"},),
                                ({"name": " "},), ({"task": None, "task_desc": "x"},)],
                               "m map<string,string>")
    got = [r[0] for r in df.select(TX.platform_task_description(F.col("m"))).collect()]
    assert got == ["direct", "n；s", None, None]   # "task" present but null wins over task_desc


def test_timestamp_units(spark):
    df = spark.createDataFrame([("1700000000123456789",), ("1700000000123456",), ("1700000000123",),
                                ("1700000000.5",), ("abc",), (None,), ("-1700000000.25",)], "raw string")
    got = [r[0] for r in df.select(normalize_to_ns("raw")).collect()]
    assert got[0] == 1700000000123456768  # through double, as the reference
    assert got[1] == int(float("1700000000123456") * 1000)
    assert got[2] == int(float("1700000000123") * 1e6)
    assert got[3] == int(1700000000.5 * 1e9)
    assert got[4] is None and got[5] is None
    assert got[6] == int(-1700000000.25 * 1e9)


def test_safe_ids(spark):
    df = spark.createDataFrame([("a b/c-é_1",), ("",)], "s string")
    assert [r[0] for r in df.select(TX.safe_id("s")).collect()] == ["a_b_c-é_1", "task"]
    assert df.select(TX.part_id(F.lit("own/na/me"), F.lit(1), F.lit(23))).first()[0] == "own/na_me_part_001_023"


def test_renumber_is_gapless_and_ordered(spark):
    rnd = random.Random(2)
    rows = []
    for src in range(3):
        for ep in range(rnd.randint(1, 4)):
            for f in range(rnd.randint(1, 5)):
                rows.append((src, src * 100 + ep, rnd.randint(0, 3), f))
    df = spark.createDataFrame(rows, "src long, ep long, t long, f long")
    frames, eps = M.renumber(df, ["ep"], ["f"], ["src", "ep"])
    fr = sorted((r["index"], r["episode_index"], r["frame_index"], r["src"], r["ep"], r["f"]) for r in frames.collect())
    assert [x[0] for x in fr] == list(range(len(rows)))
    assert [(x[3], x[4], x[5]) for x in fr] == sorted((s, e, f) for s, e, _, f in rows)
    e = sorted((r["episode_index"], r["dataset_from_index"], r["dataset_to_index"]) for r in eps.collect())
    assert e[0][1] == 0 and all(a[2] == b[1] for a, b in zip(e, e[1:]))


def test_video_file_index_and_missing_cameras(spark):
    files = spark.createDataFrame([(0, 3), (0, 1), (1, 0), (2, 7), (2, 2)], "src long, local_file_index long")
    got = sorted((r["src"], r["local_file_index"], r["file_index"]) for r in
                 M.video_file_index(files, ["src"]).collect())
    assert got == [(0, 1, 0), (0, 3, 1), (1, 0, 2), (2, 2, 3), (2, 7, 4)]
    cams = spark.createDataFrame([(0, 1, "head"), (0, 1, "wrist"), (0, 3, "head")], "src long, local_file_index long, camera string")
    miss = M.missing_camera_files(cams, ["head", "wrist"], "head", ["src"]).collect()
    assert [(r["src"], r["local_file_index"], r["camera"]) for r in miss] == [(0, 3, "wrist")]


def test_merged_stats_equal_direct_stats(spark):
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 3), [rnd.gauss(0, 1), rnd.uniform(-5, 5)]) for _ in range(200)]
    df = spark.createDataFrame(rows, "src long, v array<double>")
    direct = {(r["feature"], r["pos"]): r for r in S.vector_stats(df, ["v"]).collect()}
    merged = {(r["feature"], r["pos"]): r for r in S.merge_stats(S.vector_stats(df, ["v"], ["src"])).collect()}
    for k, d in direct.items():
        m = merged[k]
        assert m["count"] == d["count"]
        for c in ("mean", "std", "min", "max"):
            assert m[c] == pytest.approx(d[c], rel=1e-9, abs=1e-12)
    vals = [v[0] for _, v in rows]
    mu = sum(vals) / len(vals)
    assert direct[("v", 0)]["std"] == pytest.approx(math.sqrt(sum((x - mu) ** 2 for x in vals) / len(vals)))


def test_quantiles_present_only_when_all_sources_have_them(spark):
    parts = spark.createDataFrame([("s1", "f", 0, 10, 1.0, 0.5, 0.0, 2.0, 0.9), ("s2", "f", 0, 30, 2.0, 0.5, 1.0, 3.0, None)],
                                  "source string, feature string, pos int, count long, mean double, std double, "
                                  "min double, max double, q50 double")
    r = S.merge_stats(parts).first()
    assert r["q50"] is None and r["mean"] == pytest.approx(1.75)
    assert r["std"] == pytest.approx(math.sqrt(0.25 * (0.25 + 1) + 0.75 * (0.25 + 4) - 1.75 ** 2))


def test_empty_after_alignment(spark):
    from episodeframe.operators.selecting import empty_after_alignment
    df = spark.createDataFrame([(1, 0, 1.0, None), (1, 1, 2.0, None), (2, 0, None, 3.0)],
                               "recording_id long, frame_index long, a double, master_arm double")
    got = sorted(tuple(r) for r in empty_after_alignment(df, ["a", "master_arm"], severity={"master_arm": "warn"}).collect())
    assert got == [(1, "master_arm", "warn"), (2, "a", "error")]
