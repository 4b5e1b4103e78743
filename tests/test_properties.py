"""Property tests (Hypothesis) for exact integer maths, unit normalisation
and alignment against the brute-force model."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from episodeframe.functions.timeunits import ceil_div, floor_div, normalize_to_ns
from episodeframe.operators import align as A
from tests import refmodel as R

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(-2**62, 2**62), st.integers(1, 10**13)), min_size=1, max_size=30))
def test_floor_ceil_div_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", floor_div("a", "b").alias("f"), ceil_div("a", "b").alias("c")).collect()
    for r in got:
        assert r["f"] == r["a"] // r["b"]
        assert r["c"] == -((-r["a"]) // r["b"])


def _norm_model(raw):
    try:
        x = float(raw)
    except (TypeError, ValueError):
        return None
    if math.isnan(x) or math.isinf(x):
        return None
    a = abs(x)
    if a >= 1e17:
        v = x
    elif a >= 1e14:
        v = x * 1_000
    elif a >= 1e11:
        v = x * 1_000_000
    else:
        v = x * 1_000_000_000
    n = int(v)
    return n if -2**63 <= n < 2**63 else None


@SETTINGS
@given(st.lists(st.one_of(st.floats(-1e19, 1e19, allow_nan=False, allow_infinity=False),
                          st.integers(-10**18, 10**18)), min_size=1, max_size=30))
def test_normalize_matches_model(spark, values):
    rows = [(repr(float(v)),) for v in values]
    got = [r[0] for r in spark.createDataFrame(rows, "raw string").select(normalize_to_ns("raw")).collect()]
    assert got == [_norm_model(r[0]) for r in rows]


stamps = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60)), min_size=1, max_size=25)


@SETTINGS
@given(stamps, st.integers(0, 20), st.integers(1, 9), st.integers(2, 12))
def test_alignment_matches_model(spark, rows, start, step, n):
    msgs = [(1, s, ts, i, float(i)) for i, (s, ts) in enumerate(rows)]
    m = spark.createDataFrame(msgs, "recording_id long, stream string, ts_ns long, seq long, value double")
    params = spark.createDataFrame([(1, start, step, n)], "recording_id long, start_ns long, step_ns long, n_frames long")
    grid = A.frame_grid(params)
    by = {}
    for _, s, ts, seq, v in msgs:
        by.setdefault(s, []).append((ts, seq, v))
    for method, model in (("asof", R.asof), ("nearest", R.nearest), ("linear", R.linear)):
        out = A.align_frames(m, grid, A.AlignSpec({"a": method, "b": method}), params=params,
                             block=2, materialize=False).collect()
        assert len(out) == n
        for r in out:
            for s in ("a", "b"):
                exp = model(by.get(s, []), r["t_ns"])
                if method != "linear" and exp is not None:
                    exp = exp[2]
                if exp is None:
                    assert r[s] is None
                else:
                    assert math.isclose(r[s], exp, rel_tol=1e-9, abs_tol=1e-9), (method, s, r["t_ns"])
