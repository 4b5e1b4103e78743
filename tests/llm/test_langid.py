import itertools
import math
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from episodeframe.llm import langid, queries
from tests.llm.helpers import EXTRA, documents

PIECES = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "bab", "abab"]


def lattice(langs=2, seed=1):
    p = np.random.default_rng(seed).dirichlet(np.ones(len(PIECES)), langs).T
    return langid.Lattice([f"l{k}" for k in range(langs)], PIECES, p, 1e-9)


def segmentations(s):
    for cuts in itertools.product((0, 1), repeat=len(s) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(s[at:i])
                at = i
        yield parts + [s[at:]]


def brute(lat, word, k):
    known = {c for c in PIECES if len(c) == 1}
    total = 0.0
    for parts in segmentations("▁" + word):
        p = 1.0
        for x in parts:
            p *= lat.table[x][k] if x in lat.table else (1e-9 if len(x) == 1 and x not in known else 0.0)
        total += p
    return total


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abz", min_size=1, max_size=9))
def test_forward_sums_all_segmentations(word):
    lat = lattice()
    want = [math.log(brute(lat, word, k)) for k in range(2)]
    assert lat.log_likelihood(word) == pytest.approx(want, rel=1e-9)
    assert langid.Scorer(lat).likelihoods([word])[0] == pytest.approx(want, rel=1e-9)


def test_long_and_rare_words_do_not_underflow():
    lat, words = lattice(), ["ab" * 3000, "z" * 40, "日本" * 20, "a"]
    got = langid.Scorer(lat).likelihoods(words)
    assert np.isfinite(got).all()
    assert got == pytest.approx(np.array([lat.log_likelihood(w) for w in words]), rel=1e-9)


def test_expected_counts_are_posterior_means():
    lat, word = lattice(), "abab"
    want = defaultdict(float)
    for parts in segmentations("▁" + word):
        if all(x in lat.table for x in parts):
            p = math.prod(lat.table[x][0] for x in parts)
            for x in parts:
                want[x] += p
    counts = defaultdict(float)
    lat.expected(word, 0, 3.0, counts)
    total = brute(lat, word, 0)
    assert {x: c for (_, x), c in counts.items()} == pytest.approx({x: 3 * c / total for x, c in want.items()}, rel=1e-6)


def test_awkward_texts(spark):
    train = documents(spark, [(1, "la casa de los ninos y la madre " * 30, "es"), (2, "the house of the children and the mother " * 30, "en")])
    lat = langid.fit(train, public_tokenizers.path("piece_bpe_32k.model"))
    docs = documents(spark, [(1, None), (2, ""), (3, "12 34 !?"), (4, "the mother and the house"), (4, "the mother and the house"),
                             (5, "la madre y la casa " * 20_000), (None, "los ninos")], EXTRA)
    got = langid.identify(docs, lat)
    assert got.count() == 7 and {c for c in docs.columns if c not in ("score", "lang_pred")} < set(got.columns)
    by = {(r.doc_id, r.text and r.text[:3]): (r["lang_pred"], r["score"]) for r in got.collect()}
    assert by[1, None] == by[2, ""] == by[3, "12 "] == ("und", 0.0)
    assert by[4, "the"][0] == "en" and by[5, "la "][0] == "es" and by[None, "los"][0] == "es"
    assert all(0 <= s <= 1 for _, s in by.values())
    assert langid.identify(docs.limit(0), lat).count() == 0
    assert langid.fit(train.limit(0), public_tokenizers.path("piece_bpe_32k.model")) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}


def test_held_out_accuracy(spark):
    got = queries.op2_language(spark, "/root/testdata/sf0.001").join(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    assert len(rows) > 20 and sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.97


def test_long_runs_count_and_are_learned(spark):
    lat = lattice()
    one, long = defaultdict(float), defaultdict(float)
    lat.expected("ab" * 4, 1, 1.0, one)
    lat.expected("ab" * 4000, 1, 1.0, long)
    assert sum(len(p) * c for (_, p), c in long.items()) == pytest.approx(8001, rel=1e-6)  # every character is in one piece
    assert sum(len(p) * c for (_, p), c in one.items()) == pytest.approx(9, rel=1e-9)
    rows = [(i, "zxqj" * 25 + str(i % 3), "zz") for i in range(20)] + [(100 + i, "the cat and the dog run home", "en") for i in range(20)]
    model = langid.fit(documents(spark, rows), public_tokenizers.path("piece_bpe_32k.model"))
    assert model.langs == ["en", "zz"]
    got = {r.doc_id: r.lang_pred for r in langid.identify(documents(spark, rows), model).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_every_ordinary_piece_is_summed():
    pieces = langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert max(map(len, pieces)) == 16 and "▁international" in pieces
    longest = next(p for p in pieces if len(p) == 16 and p.startswith("▁") and p[1:].isalpha())
    probs = np.full((len(pieces), 1), 1e-6)
    probs[pieces.index(longest)] = 0.5
    lat = langid.Lattice(["x"], pieces, probs, 1e-9)
    word = longest[1:]
    assert lat.log_likelihood(word)[0] == pytest.approx(math.log(0.5), abs=1e-3)
    assert langid.Scorer(lat).likelihoods([word])[0, 0] == pytest.approx(lat.log_likelihood(word)[0], rel=1e-9)
