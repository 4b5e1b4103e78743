import numpy as np
import pytest
from pyspark.sql import functions as F

from episodeframe.llm import queries, whitening


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, whitening string, x string")


def brute(vectors):
    x = np.unique(np.floor(256 * np.asarray(vectors, np.float32).astype(float)).astype(int), axis=0)
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    values, vec = np.linalg.eigh(c.T @ c / n)
    return n, s, values[::-1], vec[:, ::-1]


@pytest.mark.parametrize("kind", ["random", "equal eigenvalues", "low rank", "tiny"])
def test_rank_one_updates_keep_the_decomposition(kind):
    rng = np.random.default_rng(5)
    rows = {"random": rng.normal(size=(60, 7)) * [1, 2, 3, 50, 5, 6, 1e-3],
            "equal eigenvalues": np.vstack([np.eye(6), -np.eye(6)] * 3),
            "low rank": rng.normal(size=(40, 2)) @ rng.normal(size=(2, 8)),
            "tiny": rng.normal(size=(30, 5)) * 1e-9 + 4}[kind]
    state = whitening.Spectrum.empty(rows.shape[1])
    for r in rows:
        state.add(r)
    left, right = whitening.Spectrum.empty(rows.shape[1]), whitening.Spectrum.empty(rows.shape[1])
    for i, r in enumerate(rows):
        (left if i % 3 else right).add(r)
    left.combine(right)
    c = rows - rows.mean(0)
    for s in (state, left):
        scale = np.abs(c.T @ c).max()
        assert np.allclose(s.vec.T @ s.vec, np.eye(rows.shape[1]), atol=1e-10)
        assert np.allclose(s.vec @ np.diag(s.lam) @ s.vec.T, c.T @ c, atol=1e-9 * scale)
        assert np.allclose(s.lam, np.linalg.eigvalsh(c.T @ c), atol=1e-9 * scale)


def test_query_against_a_direct_eigendecomposition(spark):
    got = queries.op11_whitening(spark, "/root/testdata/sf0.001").toPandas()
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    n, s, values, vec = brute([r.embedding for r in rows])
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n}
    x = {r.vec_id: np.floor(256 * np.asarray(r.embedding, np.float32).astype(float)).astype(int) for r in rows}
    for c in range(1, 5):
        part = got[got.component == c].set_index("vec_id")
        want = {i: ((n * v - s) / n) @ vec[:, c - 1] / np.sqrt(values[c - 1]) for i, v in x.items()}
        sign = np.sign(part.whitened[rows[0].vec_id] * want[rows[0].vec_id])
        assert max(abs(part.whitened[i] * sign - w) for i, w in want.items()) < 1e-9
        assert np.allclose(part.explained, values[c - 1] / values.sum(), rtol=1e-9)
        assert all(part.deviation[i] == ((n * v - s) ** 2).sum() for i, v in x.items())
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_dropped_rows_copies_padding_and_extra_columns(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [3.0, -1.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 0.0]),
            (7, [float("inf"), 0.0]), (8, [0.0, 0.0]), (9, [5.0]), (None, [1.001, 2.0])]
    df = table(spark, rows)
    model = whitening.fit(df)
    n, s, values, _ = brute([[1, 2], [3, -1], [0, 0], [5, 0]])
    assert (model.n, list(model.sums)) == (n, list(s)) and np.allclose(model.eigenvalues, values)
    out = whitening.whiten(df, model)
    assert out.columns == [*df.columns, "whitening_"]
    got = {r.vec_id: r.whitening_ for r in out.collect()}
    assert set(got) == {1, 2, 3, 8, 9, None} and got[1] == got[2] == got[None]


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])], [(1, [2.0, 1.0]), (2, [4.0, 1.0])]])
def test_empty_and_degenerate_tables(spark, rows):
    df = table(spark, rows)
    model = whitening.fit(df)
    got = queries.whitened_rows(df, model).collect()
    width = min(4, max((len(v) for _, v in rows), default=0))
    assert len(got) == len(rows) * width
    varies = len({tuple(v) for _, v in rows}) > 1
    for r in got:
        assert (r.whitened is not None) == (varies and r.component == 1)
        assert (r.identity_error is None) == (not varies)
        assert r.explained == ((1.0 if r.component == 1 else 0.0) if varies else None)


def test_long_sums_are_exact(spark):
    big = [(i, [float(2 ** 40 + 4096 * i), 1.0]) for i in range(5)]
    df = table(spark, big)
    got = {r.vec_id: r.deviation for r in queries.whitened_rows(df, whitening.fit(df)).where("component = 1").collect()}
    x = {i: int(np.floor(256 * float(np.float32(v[0])))) for i, v in big}
    xs = sorted(set(x.values()))
    n, s = len(xs), sum(xs)
    assert all(got[i] == (n * v - s) ** 2 for i, v in x.items())
