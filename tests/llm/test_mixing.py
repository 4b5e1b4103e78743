import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from episodeframe.llm import mixing
from tests.llm.helpers import EXTRA, documents


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Bisection on the common level instead of rounds."""
    order = sorted(sizes, key=lambda r: (r[0] is None, r[0] or ""))
    w = {s: weights[i % 3] for i, (s, _) in enumerate(order)}
    total, low, high = sum(n for _, n in sizes), 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(mid * w[s], most * n) for s, n in sizes) < total else (low, mid)
    return {s: min(high * w[s], most * n) for s, n in sizes}


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text("ab", max_size=3)), st.integers(0, 5000), min_size=1, max_size=12))
def test_targets_fill_by_weight_below_the_limit(sizes):
    got = mixing.targets(list(sizes.items()))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()), abs=1e-6)
    assert got == pytest.approx(brute_targets(list(sizes.items())), rel=1e-6, abs=1e-4)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=6), st.integers(1, 17))
def test_tree_keeps_exact_quotas_and_even_shards(quotas, shards):
    got = mixing.split_quotas(np.array(quotas), shards, 3)
    assert (got.sum(0) == quotas).all() and (got >= 0).all()
    assert got.sum(1).max() - got.sum(1).min() <= 5
    assert (got == mixing.split_quotas(np.array(quotas), shards, 3)).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=9), st.integers(0, 200))
def test_nearest_subset(words, goal):
    best = min(abs(sum(w for i, w in enumerate(words) if m >> i & 1) - goal) for m in range(1 << len(words)))
    assert abs(sum(words[i] for i in mixing.nearest_subset(words, goal)) - goal) == best


@pytest.mark.parametrize("scale", [1, 900])  # exact sums, rounded sums
@pytest.mark.parametrize("large", [0.15, 0.36, 0.4])
def test_part_pass_around_a_very_long_document(large, scale):
    rng = np.random.default_rng(5)
    for draw in range(6):
        words = rng.integers(0, 400 * scale, 4096)
        words[0] = int(words[1:].sum() * large / (1 - large))
        for part in (0.2, 0.37, 0.5, 0.63, 0.9):
            rest = float(words.sum() * part)
            frame = pd.DataFrame({"source": "a", "passes": 1, "block": np.arange(4096), "words": words, "rest": rest,
                                  "ord": rng.permutation(4096)})
            if draw % 2:  # the long document right before the cut
                before = frame["ord"][1:][words[1:].cumsum() < rest - words[0] / 2].index
                frame.loc[before, "ord"] = -1
                frame.loc[0, "ord"] = 0
            got = mixing._part_pass(frame)["block"].to_numpy()
            assert len(set(got)) == len(got) and abs(words[got].sum() - rest) <= max(0.5, 1e-6 * rest), (draw, part)


def test_part_pass_of_several_long_documents():
    words = np.r_[np.full(3, 120_000), np.full(4093, 10)]  # 650 of 1,000: two long ones and many short ones less
    for seed in range(4):
        frame = pd.DataFrame({"source": "a", "passes": 0, "block": np.arange(4096), "words": words, "rest": 260_003.0,
                              "ord": np.random.default_rng(seed).permutation(4096)})
        assert words[mixing._part_pass(frame)["block"].to_numpy()].sum() == 260_000


def rows(seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(400):
        s = "hot" if i % 3 == 0 else rng.choice(["a", "b", "C", None, "é"])
        out.append((i, " ".join(["w"] * rng.randrange(0, 60)) or None, "en", s))
    return out + [out[3], out[3], (None, "null id text", "en", "a"), (1000, "w " * 3000, "en", "tiny")]


def test_report_meets_targets(spark):
    data = rows()
    got = mixing.mix_report(documents(spark, data, EXTRA), blocks=16).collect()
    assert len(got) == len(data)
    size = Counter()
    for _, t, _, s in data:
        size[s] += len((t or "").split())
    want, taken = brute_targets(list(size.items())), Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], rel=1e-6)
        assert r.taken == r["size"] * r.copies and r.copies <= 3
        taken[r.source] += r.taken
    for s in size:
        if s != "tiny":  # one document: nothing lies nearer than all of it or none
            assert abs(taken[s] - want[s]) <= max(60, 0.01 * want[s]), s
    again = mixing.mix_report(documents(spark, data[::-1], EXTRA), blocks=16).collect()
    assert sorted((str(r.doc_id), r.copies) for r in got) == sorted((str(r.doc_id), r.copies) for r in again)


def test_sources_with_a_very_long_document_meet_their_targets(spark):
    rng, data = random.Random(4), []
    for s, large in zip("abcdef", (0.15, 0.22, 0.36, 0.4, 0.3, 0.36)):
        short = [rng.randrange(1, 60) for _ in range(700)]
        data += [(len(data) + i, "w " * n, "en", s) for i, n in enumerate([*short, int(sum(short) * large / (1 - large))])]
    for seed in (20, 21, 22):
        taken, want = Counter(), {}
        for r in mixing.mix_report(documents(spark, data), blocks=4096, seed=seed).collect():
            taken[r.source] += r.taken
            want[r.source] = r.target
        assert all(abs(taken[s] - want[s]) <= 1 for s in want), (seed, taken, want)


def test_mix_returns_the_reported_rows_in_even_shards(spark):
    docs = documents(spark, rows(), EXTRA)
    out = mixing.mix(docs, blocks=16, shards=4, shard_col="shard_no")
    assert out.columns == [*docs.columns, "shard_no"]
    got = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    want = Counter()
    for r in mixing.mix_report(docs, blocks=16).collect():
        want[r.doc_id] += r.copies
    total = Counter()
    for (i, _, _), n in got.items():
        total[i] += n
    assert {k: v for k, v in want.items() if v} == dict(total)
    shards = Counter(r.shard_no for r in out.collect())
    assert len(shards) == 4


def test_empty_and_wordless_tables(spark):
    docs = documents(spark, rows())
    assert mixing.mix_report(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    blank = documents(spark, [(1, None, "en", "a"), (2, "  ", "en", None)])
    assert [(r.target, r.taken) for r in mixing.mix_report(blank).collect()] == [(0.0, 0), (0.0, 0)]
    assert mixing.mix(blank).count() == 0
