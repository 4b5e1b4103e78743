"""Nearest neighbours and cover-tree links against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodeframe.llm import ann, covertree
from episodeframe.llm.covertree import build

ROWS = "vec_id long, embedding array<float>, label int, score string, root string"


def table(spark, vectors, labels, extra=()):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], lab, "x", "y")
                                  for i, (v, lab) in enumerate(zip(vectors, labels))] + list(extra), ROWS)


def data(seed=1, n=300, dim=12):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).astype(np.float32)
    v[n // 2:] = v[rng.integers(0, 8, n - n // 2)] + rng.normal(scale=0.12, size=(n - n // 2, dim)).astype(np.float32)
    v[::7] = v[3]  # copies
    v[5] = v[4] * 2  # same direction
    return v, rng.integers(0, 3, n)


BAD = [(900, None, 1, "x", "y"), (901, [], 1, "x", "y"), (902, [0.0] * 12, 1, "x", "y"), (903, [float("nan")] + [1.0] * 11, 1, "x", "y"),
       (904, [None] + [1.0] * 11, 1, "x", "y"), (905, [float("inf")] * 12, 1, "x", "y"), (906, [1.0] * 12, None, "x", "y"),
       (907, [1.0, 2.0], 1, "x", "y")]


def brute_links(v, labels, threshold=0.93):
    x = v.astype(np.float64)
    norm = np.linalg.norm(x, axis=1)
    link = ((x @ x.T) / (norm[:, None] * norm) >= threshold) & (labels[:, None] == labels)
    np.fill_diagonal(link, False)
    comp = np.arange(len(v))
    for _ in range(len(v)):
        new = np.minimum(comp, np.where(link, comp, len(v)).min(1))
        if (new == comp).all():
            break
        comp = new
    return link.sum(1), comp


@pytest.mark.parametrize("block", [2048, 24])
def test_cover_tree_links_are_exact(spark, block):
    v, labels = data()
    got = {r.vec_id: r for r in covertree.link(table(spark, v.tolist(), labels.tolist(), BAD), block=block, most_centers=50).collect()}
    n, comp = brute_links(v, labels)
    assert len(got) == len(v) + len(BAD)
    for i in range(len(v)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n[i], comp[i], comp[i] == i)
    for i, *_ in BAD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_cover_tree_covers_and_nests():
    v, _ = data(n=200)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True).astype(np.float64)
    todo = [build(unit)]
    assert sorted(todo[0].rows) == list(range(200))
    while todo:
        node = todo.pop()
        far = np.sqrt(np.maximum(0, 2 - 2 * unit[node.rows] @ unit[node.center]))
        assert far.max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            assert node.children[0].center == node.center
            todo += node.children


def test_links_of_an_empty_table_and_null_ids(spark):
    v, labels = data(n=20)
    df = table(spark, v.tolist(), labels.tolist())
    assert covertree.link(df.limit(0)).count() == 0
    got = covertree.link(df.limit(1).union(spark.createDataFrame([(None, [1.0] * 12, 1, "x", "y")], ROWS))).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]


def test_many_tables_find_the_exact_neighbours(spark):
    v, labels = data(n=400)
    df = table(spark, v.tolist(), labels.tolist(), BAD)
    index = ann.Index(probes=10_000)
    for bucket in (8192, 16):
        got = {}
        for r in ann.search(df, F.col("vec_id") % 20 == 0, index=index, bucket=bucket).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        x = v.astype(np.float64)
        norm = np.linalg.norm(x, axis=1)
        assert set(got) == set(range(0, 400, 20))  # 900 is null
        misses = 0
        for q, near in got.items():
            near.sort()
            assert [r for r, *_ in near] == list(range(1, 6))
            s = (x @ x[q]) / (norm * norm[q])
            s[q] = -2
            want = np.lexsort((np.arange(400), -np.round(s, 12)))[:5]
            misses += [i for _, i, _ in near] != want.tolist()
            assert [c for *_, c in near] == pytest.approx(np.sort(s)[::-1][:5].tolist(), abs=1e-9) or misses
        assert misses <= 1


def test_recall_and_few_candidates(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {(r.query_id, r.vec_id) for r in ann.search(df, F.col("vec_id") % 50 == 0).collect()}
    rows = df.orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, len(x), 50):
        s = x @ x[q]
        s[q] = -2
        want = np.argsort(-s)[:5]
        hits, total = hits + sum((q, int(i)) in got for i in want), total + 5
    assert hits / total >= 0.9
    v, labels = data(n=20)
    small = ann.search(table(spark, v[:3].tolist(), labels[:3].tolist()), F.col("vec_id") == 0, index=ann.Index(probes=10_000)).collect()
    assert len(small) <= 2 and ann.search(df.limit(0), F.col("vec_id") >= 0).count() == 0


@pytest.mark.parametrize("n", [2, 3, 6, 10, 20])
def test_small_tables_give_all_neighbours(spark, n):
    """Few rows share a bucket of the production index there."""
    v = np.random.default_rng(102 + n).normal(size=(n, 64)).astype(np.float32)
    got = {}
    for r in ann.search(table(spark, v.tolist(), [0] * n, BAD), F.col("vec_id") < 900, bucket=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x = v / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    assert set(got) == set(range(n))
    for q, near in got.items():
        near.sort()
        assert [r for r, *_ in near] == list(range(1, min(5, n - 1) + 1))
        if n <= 6:  # all others
            s = x @ x[q]
            s[q] = -2
            assert [i for _, i, _ in near] == np.argsort(-s)[:n - 1].tolist()
            assert [c for *_, c in near] == pytest.approx(np.sort(s)[::-1][:n - 1].tolist(), abs=1e-6)


def test_a_far_row_gets_its_neighbours_from_all_rows(spark):
    """Copies of the query fill no place, blocks of queries and rows are split."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(60, 12)) * 0.02 + np.r_[1.0, np.zeros(11)]
    v[7] = v[8] = np.r_[-1.0, np.zeros(11)]  # opposite to all others
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.search(table(spark, v.tolist(), [0] * 60), F.col("vec_id") == 7,
                                                                             index=ann.Index(tables=1, probes=1), bucket=9).collect())
    x = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = x.astype(np.float32).astype(np.float64) @ x[7]
    s[7] = -2
    assert [(q, r) for q, r, _ in got] == [(7, r) for r in range(1, 6)] and {i for *_, i in got} == set(np.argsort(-s)[:5].tolist())
