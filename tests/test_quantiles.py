import numpy as np
import pytest
from pyspark.sql import functions as F

from episodeframe.operators import stats as S


@pytest.mark.parametrize("bins", [16, 1024])
def test_exact_quantiles_of_any_distribution(spark, bins):
    rng = np.random.default_rng(7)
    groups = {"one": [3.0], "two": [1.0, 2.0], "equal": [5.0] * 9, "negative": [-0.0, 0.0, -1.5], "hot": list(rng.integers(0, 3, 900).astype(float)),
              "wide": [-1e308, 1e308, 1.0, 0.0], "steep": list(np.exp(rng.normal(0, 20, 200))), "near": list(1 + np.arange(50) * 2.0 ** -52)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan")), ("none", None), ("two", float("inf"))]
    got = {r.g: r for r in S.exact_quantiles(spark.createDataFrame(rows, "g string, value double"), ["g"], bins=bins).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for name, q in S.QUANTILES.items():
            low, high = (np.quantile(vs, q, method=m) for m in ("lower", "higher"))
            part = q * (len(vs) - 1) - np.floor(q * (len(vs) - 1))
            assert got[g][name] == pytest.approx(low + (high - low) * part, rel=1e-12, abs=0), (g, name)


def test_exact_vector_stats_and_their_merge(spark):
    rows = [(s, [float(i * s % 7), float(i)]) for s in (1, 2, 3) for i in range(20 * s)]
    df = spark.createDataFrame(rows, "src int, v array<float>")
    part = S.vector_stats(df, ["v"], ["src"], quantiles=True, exact=True)
    one = {r.pos: r for r in part.where("src = 2").collect()}
    assert one[1].q50 == 19.5 and one[1]["count"] == 40
    merged = {r.pos: r for r in S.merge_stats(part).collect()}
    want = sum(n * np.quantile([float(i) for i in range(n)], 0.9) for n in (20, 40, 60)) / 120
    assert merged[1].q90 == pytest.approx(want)
    assert S.merge_stats(part.withColumn("q10", F.when(F.col("src") > 1, F.col("q10")))).where("pos = 0").first().q10 is None


def test_vector_stats_store_the_long_values_once_and_agree(spark):
    from episodeframe import session
    from episodeframe.operators import stats as S
    xs = [float(i * i % 997) for i in range(400)] + [float("nan"), float("inf"), None]
    df = spark.createDataFrame([([x],) for x in xs], "v array<double>")
    values = S.long_vectors(df, ["v"])
    before = len(session._written)
    got = S.vector_stats(df, ["v"], quantiles=True, exact=True).first()
    full = [p for p in session._written[before:] if spark.read.parquet(p).count() >= 400]
    want = S.exact_quantiles(values, ["feature", "pos"], bins=3).first()
    assert len(full) == 1 and got["count"] == 402
    s = sorted(x for x in xs[:400])
    assert got["q50"] == want["q50"] == (s[199] + s[200]) / 2 and got["q99"] == want["q99"]
