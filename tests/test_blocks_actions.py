"""Blocked scans, halo windows and action derivation."""

import random

import pytest
from pyspark.sql import functions as F

from episodeframe.operators import actions as ACT
from episodeframe.operators.blocks import Scan, carry_scan, dense_index
from tests import refmodel as R


def _series(n, rnd, null_rate=0.3):
    return [None if rnd.random() < null_rate else round(rnd.random(), 3) for _ in range(n)]


def test_carry_scan_matches_python_across_blocks(spark):
    rnd = random.Random(1)
    vals = {k: _series(37, rnd) for k in (1, 2)}
    rows = [(k, i, v) for k, s in vals.items() for i, v in enumerate(s)]
    df = spark.createDataFrame(rows, "k long, i long, v double").withColumn("one", F.lit(1.0))
    out = carry_scan(df, ["k"], "i", [Scan("ff", "v", "ffill"), Scan("ffx", "v", "ffill", False),
                                      Scan("bf", "v", "bfill"), Scan("bfx", "v", "bfill", False),
                                      Scan("cs", "one", "sum"), Scan("csx", "one", "sum", False)], block=4)
    for r in out.collect():
        s = vals[r["k"]]
        i = r["i"]
        prev = [x for x in s[: i + 1] if x is not None]
        prevx = [x for x in s[:i] if x is not None]
        nxt = [x for x in s[i:] if x is not None]
        nxtx = [x for x in s[i + 1:] if x is not None]
        assert r["ff"] == (prev[-1] if prev else None)
        assert r["ffx"] == (prevx[-1] if prevx else None)
        assert r["bf"] == (nxt[0] if nxt else None)
        assert r["bfx"] == (nxtx[0] if nxtx else None)
        assert r["cs"] == i + 1 and r["csx"] == i


def test_dense_index_with_small_time_blocks(spark):
    rows = [(1, ts, seq) for seq, ts in enumerate([5, 5, 3, 100, 250, 7, 7, 7])]
    df = spark.createDataFrame(rows, "k long, ts long, seq long")
    out = dense_index(df, ["k"], ["ts", "seq"], "idx", block_col=F.floor(F.col("ts") / 10).cast("long"))
    got = sorted((r["ts"], r["seq"], r["idx"]) for r in out.collect())
    assert [g[2] for g in got] == list(range(len(rows)))


def test_next_state_repeats_last_and_crosses_blocks(spark):
    rows = [(e, i, float(10 * e + i)) for e in (1, 2) for i in range(9)]
    df = spark.createDataFrame(rows, "ep long, i long, s double")
    out = {(r["ep"], r["i"]): r["a"] for r in ACT.next_state(df, ["ep"], "i", {"a": "s"}, block=4).collect()}
    for e in (1, 2):
        for i in range(9):
            assert out[(e, i)] == float(10 * e + min(i + 1, 8))


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_future_chunk_matches_model(spark, block):
    rnd = random.Random(5)
    k = 4
    eps = {e: [None if rnd.random() < 0.25 else [round(rnd.random(), 3), float(e)] for _ in range(11)]
           for e in (1, 2, 3)}
    eps[3] = [[1.0, 1.0]]  # single-frame episode
    rows = [(e, i, s) for e, ss in eps.items() for i, s in enumerate(ss)]
    df = spark.createDataFrame(rows, "ep long, i long, state array<double>")
    out = ACT.future_chunk(df, ["ep"], "i", "state", k=k, block=block)
    got = {(r["ep"], r["i"]): r["action"] for r in out.collect()}
    for e, ss in eps.items():
        exp = R.future_chunk(ss, k)
        for i, x in enumerate(exp):
            assert got[(e, i)] == x, (e, i)
    kept = ACT.drop_last_frame(out, ["ep"], "i", action="action", block=block)
    assert kept.count() == sum(1 for e, ss in eps.items() for x in R.future_chunk(ss, k) if x is not None)


def test_relative_and_delta(spark):
    rows = [(1, 0, None), (1, 1, [1.0, 2.0]), (1, 2, [3.0, 5.0])]
    df = spark.createDataFrame(rows, "ep long, i long, state array<double>")
    df = ACT.next_state(df, ["ep"], "i", {"action": "state"}).withColumn("raw", F.col("state"))
    rel = ACT.relative_to_first(df, ["ep"], "i", ["state", "action"])
    got = {r["i"]: r for r in rel.withColumn("d", ACT.delta_action(F.col("action"), F.col("raw"))).collect()}
    assert got[0]["state"] is None
    assert got[2]["state"] == [2.0, 3.0]           # minus first non-null state [1, 2]
    # actions: [1,2] (i=0), [3,5] (i=1), [3,5] (i=2, last repeats); first action = [1, 2]
    assert got[2]["action"] == [2.0, 3.0]
    assert got[2]["d"] == [-1.0, -2.0]             # relative action minus unshifted state [3, 5]


def test_global_scan_is_the_same_on_small_and_large_tables(spark):
    from episodeframe.operators.blocks import Scan, global_scan
    df = spark.range(500).selectExpr("(id * 7919) % 503 as k", "id % 5 as n").repartition(7)
    scans = [Scan("at", "_one", "sum", inclusive=False), Scan("before", "n", "sum", inclusive=False), Scan("upto", "n", "sum")]
    one, many = ({tuple(r) for r in global_scan(df, ["k"], scans, small=s).select("k", "at", "before", "upto").collect()} for s in (1000, 0))
    assert one == many and sorted(r[1] for r in one) == list(range(500))


def test_scan_carries_over_blocks_without_values_and_null_keys(spark):
    from episodeframe.operators.blocks import Scan, ordered_scan
    rows = [(k, i, i // 3, 5 if i in (1, 13) else None, 1) for k in (None, 7) for i in range(18)]
    df = spark.createDataFrame(rows, "k long, i long, b long, v int, one int")
    got = ordered_scan(df, ["k"], "b", ["i"], [Scan("f", "v"), Scan("r", "v", "bfill", inclusive=False), Scan("n", "one", "sum", inclusive=False)],
                       partitions=3)
    for r in got.collect():
        assert (r.f, r.r, r.n) == (5 if r.i >= 1 else None, 5 if r.i < 13 else None, r.i)
    assert got.count() == len(rows) and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
