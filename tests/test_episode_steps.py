"""Frames cut into episodes where they are made (F2 of round 04)."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from episodeframe.operators import align as A
from episodeframe.operators import episodes as EP
from episodeframe.operators.actions import next_state
from episodeframe.plans import episode_queries as Q

KEYS = ["recording_id", "start_index", "end_index", "step_number", "task"]


def _messages(spark):
    # recording 1 is longer than many blocks, 2 fits into one, 3 has gaps of several blocks
    rows = [(1, t, t % 13) for t in range(0, 1000, 7)] + [(2, t, t) for t in (0, 3, 10)] + [(3, t, t) for t in (5, 5, 300, 305, 900)]
    return spark.createDataFrame([(r, "a", t, i, float(v)) for i, (r, t, v) in enumerate(rows)],
                                 "recording_id long, stream string, ts_ns long, seq long, value double")


def _specs(spark):
    rows = [(1, 0, 3, 40, "x"), (1, 1, 8, 16, "x"), (1, 1, 8, 16, "x"), (1, 2, 10, 90, "y"), (1, None, 0, 100, "z"), (1, 3, 15, 17, None),
            (1, 4, 5, 5, "none"), (1, 5, 95, 5000, "beyond"), (3, 0, 0, 90, "x"), (4, 0, 0, 3, "no such recording"), (None, 0, 0, 3, "null")]
    return spark.createDataFrame(rows, "recording_id long, step_number long, start_index long, end_index long, task string")


@pytest.mark.parametrize("method", [A.ASOF, A.NEAREST])
def test_frames_cut_in_blocks_are_the_frames_cut_by_index(spark, method):
    m, specs = _messages(spark), _specs(spark)
    params = A.grid_params(A.sampling_window(m), 10)
    spec = A.AlignSpec({"a": method})
    frames = A.align_frames(m, A.frame_grid(params), spec, params=params)
    plain = next_state(EP.cut_episodes(frames, specs), KEYS, "episode_frame_index", {"n": "a"})
    frames = A.align_frames(m, A.frame_grid(params, partitions=5, block=8), spec, params=params, block=8, keep_block=True, partitions=5)
    eps = next_state(EP.cut_episodes(frames, specs, partitions=5, block=8), KEYS, "episode_frame_index", {"n": "a"})
    cols = sorted(plain.columns)
    assert sorted(eps.columns) == cols
    want, got = (Counter(map(tuple, x.select(cols).collect())) for x in (plain, eps))
    assert got == want and got.total() == 37 + 8 * 2 + 80 + 100 + 2 + 5 + 90
    # what is shuffled are blocks, buckets and episodes; never a frame
    plan = eps._jdf.queryExecution().executedPlan().toString()
    assert plain._jdf.queryExecution().executedPlan().toString().count("frame_index") and "Generate explode" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and ("frame_index" in x or "start_index" in x)]


def test_next_state_takes_heads_of_episodes_that_began_earlier_only(spark):
    # 40 short episodes in the blocks of one long recording; three of them cross into the next block
    rows = [(e, 4 * e + i, (4 * e + i) // 50, i, float(i)) for e in range(40) for i in range(4)]
    df = spark.createDataFrame(rows, "e long, frame_index long, _blk long, i long, v double")
    out = next_state(df, ["e"], "i", {"n": "v"})
    assert all(r.n == min(r.i + 1, 3) for r in out.collect())
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_at" in plan and plan.count("BroadcastExchange") >= 1


def test_steps_in_small_blocks_are_the_same(spark, tmp_path, monkeypatch):
    """Recordings of 60 days are 1,440 hourly frames each: one block as shipped, 15 of 100 frames."""
    day = 86_400_000_000
    rows = [(10 * u + k, u, s, 60 * day * (k // 5) + k % 5, 1.0 * k + u, "{}") for u in range(6)
            for k, s in enumerate(["signup", "purchase", "error", "view", "click"] * 2)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, us long, value double, props string")
    ev.withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz")).drop("us").write.parquet(f"{tmp_path}/events.parquet")
    talk = [(u, t, "user", f"text {t % 3}") for u in range(0, 6, 2) for t in range(28)] + [(77, 0, "user", "no recording")]
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")

    def results():
        return Counter(map(tuple, Q.episode_steps(spark, str(tmp_path)).collect()))

    whole = results()
    assert {k[0] for k in whole} == set(range(6)) and whole.total() > 3 * 1_440 + 3 * 28 * 71
    monkeypatch.setattr(Q, "STEP_BLOCK", 100)
    assert results() == whole
