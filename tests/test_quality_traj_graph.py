"""Quality predicates, trajectory maths, transform tree and functions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodeframe.functions import quaternion as Q
from episodeframe.functions import vectors as V
from episodeframe.operators import graph as G
from episodeframe.operators import quality as QC
from episodeframe.operators import trajectory as TR

POSE = "struct<position:struct<x:double,y:double,z:double>,orientation:struct<x:double,y:double,z:double,w:double>>"


def test_pose_validity_and_fallback(spark):
    rows = [
        ({"position": {"x": 0.0, "y": 0.0, "z": 0.0}, "orientation": {"x": 0.0, "y": 0.0, "z": 0.0, "w": 1.0}},),
        ({"position": {"x": float("nan"), "y": 0.0, "z": 0.0}, "orientation": {"x": 0.0, "y": 0.0, "z": 0.0, "w": 1.0}},),
        ({"position": {"x": 1.0, "y": 0.0, "z": 0.0}, "orientation": {"x": 0.0, "y": 0.0, "z": 0.0, "w": 1.0}},),
        ({"position": {"x": 1.0, "y": 0.0, "z": 0.0}, "orientation": {"x": 0.0, "y": 0.0, "z": None, "w": 1.0}},),
        (None,),
    ]
    df = spark.createDataFrame(rows, f"p {POSE}")
    assert [r[0] for r in df.select(QC.pose_is_valid(F.col("p"))).collect()] == [False, False, True, False, False]
    obs = F.struct(F.struct(F.lit(9.0).alias("x"), F.lit(9.0).alias("y"), F.lit(9.0).alias("z")).alias("position"),
                   F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"), F.lit(1.0).alias("w")).alias("orientation"))
    got = [r[0] for r in df.select(QC.pose_with_fallback(F.col("p"), obs)["position"]["x"]).collect()]
    assert got == [9.0, 9.0, 1.0, 9.0, 9.0]


def test_gripper_fallback_and_status(spark):
    df = spark.createDataFrame([(0.3, [0.1], 0.5), (None, [-0.2], 0.5), (float("nan"), None, 0.7), (None, None, None)],
                               "a double, j array<double>, o double")
    got = [r[0] for r in df.select(QC.gripper_with_fallback(F.col("a"), F.col("j"), F.col("o"))).collect()]
    assert got == [0.3, 0.0, 0.7, None]
    st = spark.createDataFrame([(0.01,), (0.5,), (9.0,)], "r double").select(
        QC.range_status(F.col("r"), F.lit(0.02), F.lit(4.0))).collect()
    assert [r[0] for r in st] == ["too close", "ok", "out of range"]


def test_limits_and_counts(spark):
    df = spark.createDataFrame([([-2.0, 0.0, 3.0],)], "v array<double>")
    lo, hi = F.array(F.lit(-1.0), F.lit(-1.0), F.lit(-1.0)), F.array(F.lit(1.0), F.lit(1.0), F.lit(1.0))
    r = df.select(QC.clamp_to_limits(F.col("v"), lo, hi), QC.limit_violations(F.col("v"), lo, hi)).first()
    assert r[0] == [-1.0, 0.0, 1.0] and r[1] == [0, 2]
    c = spark.createDataFrame([(100, 89), (100, 91), (1, 0), (3, 1)], "i long, s long").select(
        QC.count_mismatch(F.col("i"), F.col("s"))).collect()
    assert [x[0] for x in c] == [True, False, False, True]


def test_dead_reckoning_then_body_velocity_is_identity(spark):
    rnd = random.Random(9)
    rows = [(1, i, rnd.uniform(-1, 1), rnd.uniform(-1, 1), rnd.uniform(-3, 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "t long, i long, vx double, vy double, vyaw double")
    poses = TR.dead_reckoning(df, ["t"], "i", "vx", "vy", "vyaw", 0.1, block=7)
    # sequential reference loop
    x = y = th = 0.0
    exp = []
    for _, _, vx, vy, w in rows:
        c, s = math.cos(th), math.sin(th)
        x, y = x + (vx * c - vy * s) * 0.1, y + (vx * s + vy * c) * 0.1
        th = (th + w * 0.1 + math.pi) % (2 * math.pi) - math.pi
        exp.append((x, y, th))
    got = sorted((r["i"], r["x"], r["y"], r["theta"]) for r in poses.collect())
    for (i, gx, gy, gt), (ex, ey, et) in zip(got, exp):
        assert (gx, gy) == pytest.approx((ex, ey), abs=1e-9)
        assert math.cos(gt - et) == pytest.approx(1.0)
    back = TR.body_velocity(poses.select("t", "i", "x", "y", "theta"), ["t"], "i", "x", "y", "theta", 0.1, block=7)
    b = sorted((r["i"], r["vx"], r["vy"], r["vyaw"]) for r in back.collect())
    assert b[0][1] is None
    for (i, vx, vy, w), row in zip(b[1:], rows[1:]):
        assert (vx, vy) == pytest.approx((row[2], row[3]), abs=1e-9)
        assert w == pytest.approx(row[4], abs=1e-9)


def test_upsample_counts_and_linear(spark):
    rows = [(1, i, [float(i), 2.0 * i, 0.0, 0.1 * i, 0.0, 0.2, 1.0 * i]) for i in range(5)]
    df = spark.createDataFrame(rows, "t long, i long, v array<double>")
    up = TR.upsample(df, ["t"], "i", "v", 4).collect()
    assert len(up) == (5 - 1) * 4 + 1
    got = {r["up_index"]: r["v"] for r in up}
    assert got[6] == pytest.approx([1.5, 3.0, 0.0, 0.15, 0.0, 0.2, 1.5])
    pose = {r["up_index"]: r["v"] for r in TR.upsample(df, ["t"], "i", "v", 4, mode="end_pose").collect()}
    assert pose[6][0] == pytest.approx(1.5) and pose[6][6] == pytest.approx(1.5)
    assert pose[6][3] == pytest.approx(0.15, abs=1e-3) and pose[6][5] == pytest.approx(0.2, abs=1e-9)


def ema_by_weights(x, a):
    """Both averages written out as weighted sums of all values."""
    n, x = len(x), np.asarray(x, np.float64)
    one = lambda v: [sum((a if j else 1.0) * (1 - a) ** (t - j) * v[j] for j in range(t + 1)) for t in range(n)]
    return 0.5 * (np.array(one(x)) + np.array(one(x[::-1]))[::-1])


def fits_by_window(x, w, p):
    """A least-squares polynomial over the window around each row (moved inside
    the rows), evaluated at the row."""
    n, m = len(x), w // 2
    out = []
    for t in range(n):
        c = min(max(t, m), n - 1 - m)
        j = np.arange(-m, m + 1) / m
        out.append(np.polynomial.Polynomial.fit(j, x[c - m:c + m + 1], p, domain=[-1, 1], window=[-1, 1])((t - c) / m))
    return out


def smoothed(df):
    return [r["smoothed"] for r in sorted(df.collect(), key=lambda r: r["i"])]


@pytest.mark.parametrize("n, w", [(3, 3), (4, 3), (7, 3), (23, 5), (61, 13)])
def test_smoothing_of_short_rows(spark, n, w):
    rnd = random.Random(n)
    vals = [rnd.random() for _ in range(n)]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)] + [(2, 0, 5.0), (2, 1, 6.0)], "t long, i long, x double")
    a = np.array(vals, dtype=np.float32).astype(np.float64)
    got = TR.smoothen(df, ["t"], "i", "x")
    assert smoothed(got.where("t = 1")) == pytest.approx(fits_by_window(a, w, 2), abs=1e-5)
    assert smoothed(got.where("t = 2")) == [5.0, 6.0]
    assert smoothed(TR.smoothen(df, ["t"], "i", "x", method="ema").where("t = 1")) == pytest.approx(ema_by_weights(a, 0.25), abs=1e-5)


@pytest.mark.parametrize("alpha, block", [(0.25, 128), (0.01, 128), (0.01, 7), (0.9, 1)])
def test_ema_is_exact_across_blocks(spark, alpha, block):
    rnd = random.Random(11)
    vals = [100 * rnd.random() for _ in range(300)]
    df = spark.createDataFrame([(None, i, v) for i, v in enumerate(vals)], "t long, i long, x double")
    exp = ema_by_weights(np.array(vals, dtype=np.float32), alpha)
    assert smoothed(TR.ema_two_sided(df, ["t"], "i", "x", alpha=alpha, block=block)) == pytest.approx(exp, abs=1e-4)


def test_ema_skips_nulls(spark):
    vals = [None, 1.0, None, 3.0, None]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "t long, i long, x double")
    for block in (64, 2):
        got = smoothed(TR.ema_two_sided(df, ["t"], "i", "x", alpha=0.5, block=block))
        assert got == pytest.approx([(1 + 2) / 2, (1 + 2) / 2, (1 + 3) / 2, (2 + 3) / 2, (2 + 3) / 2])


@pytest.mark.parametrize("window, poly", [(None, 2), (5, 2), (31, 5), (9, 4)])
def test_savgol_of_any_window_and_degree(spark, window, poly):
    rnd = random.Random(12)
    vals = [rnd.gauss(0, 1) for _ in range(500)]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "t long, i long, x double")
    a = np.array(vals, dtype=np.float32).astype(np.float64)
    got = smoothed(TR.savgol(df, ["t"], "i", "x", window=window, poly=poly, block=64, run=32))
    assert got == pytest.approx(fits_by_window(a, window or 101, poly), abs=1e-5)


def test_savgol_stays_exact_on_long_rows(spark):
    n = 300_000
    df = spark.range(n).select(F.lit(1).alias("t"), F.col("id").alias("i"), (5 + F.sin(F.col("id") * 0.7)).alias("x"))
    got = TR.savgol(df, ["t"], "i", "x", window=5).where(f"i > {n - 1000}").orderBy("i").collect()
    x = (5 + np.sin(np.arange(n) * 0.7)).astype(np.float32).astype(np.float64)
    assert [r["smoothed"] for r in got] == pytest.approx(fits_by_window(x[-2000:], 5, 2)[-len(got):], abs=1e-5)


def test_power_sums():
    for m in (1, 2, 7, 40):
        assert [TR.power_sum(m, k) for k in range(9)] == [sum(j ** k for j in range(-m, m + 1)) for k in range(9)]


def test_transform_tree(spark):
    rows = [("b", "a", 1, 1, 0.0), ("c", "a", 1, 2, 0.0), ("d", "b", 1, 3, 0.0), ("d", "c", 2, 4, 0.0),
            ("z", "y", 1, 5, 0.0)]
    df = spark.createDataFrame(rows, "child string, parent string, ts long, seq long, tx double")
    latest = G.latest_edges(df)
    assert {r["child"]: r["parent"] for r in latest.collect()}["d"] == "c"
    walk = G.tree_walk(latest).orderBy("path").collect()
    assert [r["frame"] for r in walk] == ["a", "b", "c", "d", "y", "z"]
    assert {r["frame"]: r["depth"] for r in walk}["d"] == 2
    assert sorted(r[0] for r in G.roots(latest).collect()) == ["a", "y"]
    assert G.frame_universe(latest).count() == 6


def test_transform_tree_deep_and_with_a_cycle(spark):
    deep = [(f"n{i + 1}", f"n{i}") for i in range(12)] + [("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("n1", "n5"), (None, "n0")]
    df = spark.createDataFrame(deep, "child string, parent string")
    spark.conf.set("spark.sql.cteRecursionRowLimit", 5)  # the walk has no such limit
    walk = G.tree_walk(df)
    assert {r["frame"]: r["depth"] for r in walk.collect()} == {f"n{i}": i for i in range(13)}
    assert {r["frame"] for r in G.unreached(df, walk).collect()} == {"x", "y", "z", "w"}
    assert G.tree_walk(df.limit(0)).count() == 0


def test_quaternion_functions(spark):
    rnd = random.Random(3)
    rows = [(rnd.uniform(-1, 1), rnd.uniform(-1.4, 1.4), rnd.uniform(-3, 3)) for _ in range(20)]
    df = spark.createDataFrame(rows, "r double, p double, y double")
    q = Q.quat_from_euler(F.col("r"), F.col("p"), F.col("y"))
    out = df.select("r", "p", "y", Q.euler_from_quat(q).alias("e"), Q.quat_norm(q).alias("n")).collect()
    for o in out:
        assert o["n"] == pytest.approx(1.0)
        assert (o["e"]["roll"], o["e"]["pitch"], o["e"]["yaw"]) == pytest.approx((o["r"], o["p"], o["y"]), abs=1e-9)
    bad = spark.createDataFrame([(float("nan"), 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 2.0)],
                                "x double, y double, z double, w double")
    c = bad.select(Q.quat_clean(Q.quat_struct("x", "y", "z", "w")).alias("q")).collect()
    assert [tuple(r["q"]) for r in c] == [(0.0, 0.0, 0.0, 1.0)] * 3
    wr = spark.createDataFrame([(3.5,), (-3.5,), (math.pi,)], "a double").select(Q.wrap_angle("a")).collect()
    assert [r[0] for r in wr] == pytest.approx([3.5 - 2 * math.pi, -3.5 + 2 * math.pi, -math.pi])
    sl = spark.createDataFrame([(0.3,)], "t double").select(Q.slerp(
        Q.quat_struct(0.0, 0.0, 0.0, 1.0), Q.quat_struct(0.0, 0.0, -math.sin(0.5), -math.cos(0.5)), F.col("t")).alias("q")).first()
    assert sl["q"]["z"] == pytest.approx(math.sin(0.15)) and sl["q"]["w"] == pytest.approx(math.cos(0.15))


def test_vector_helpers(spark):
    df = spark.createDataFrame([([1.0, float("nan"), None, 4.0], {"b": [2.0], "a": [1.0, 1.5]})],
                               "v array<double>, m map<string,array<double>>")
    r = df.select(V.drop_nan(F.col("v")), V.flatten_sorted_map(F.col("m")),
                  V.pad_or_truncate(F.slice("v", 1, 1), 3), V.pad_or_truncate(F.col("v"), 2),
                  V.reshape(F.array(*[F.lit(float(i)) for i in range(5)]), 2),
                  V.hold_last(F.array(F.lit(1.0), F.lit(2.0)), F.lit(9)),
                  V.minmax_255(F.array(F.lit(2.0), F.lit(4.0))), V.minmax_255(F.array(F.lit(3.0), F.lit(3.0)))).first()
    assert r[0] == [1.0, 4.0]
    assert r[1] == [1.0, 1.5, 2.0]
    assert r[2] == [1.0, 0.0, 0.0]
    assert r[3][0] == 1.0 and math.isnan(r[3][1])
    assert r[4] == [[0.0, 1.0], [2.0, 3.0], [4.0]]
    assert r[5] == 2.0 and r[6] == [0.0, 255.0] and r[7] == [0.0, 0.0]
    with pytest.raises(ValueError):
        V.validate_extractor("joint.position[-1]")
    with pytest.raises(ValueError):
        V.validate_extractor("pose.bogus")
