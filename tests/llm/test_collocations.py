import re
from collections import Counter
from itertools import product

import numpy as np
import pytest

from episodeframe.llm import collocations as co
from tests.llm.helpers import EXTRA, documents


def brute(rows, least, cover=80):
    """(lang, phrase) -> (a, l, r, n, score) straight from the rule."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            ws = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i:i + k])) for k in range(1, 5) for i in range(len(ws) - k + 1))
    cands = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= least}
    out = {}
    for (lang, p), a in cands.items():
        if any(g == lang and len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (g, q), b in cands.items()):
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang, " ".join(p)] = (a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)
    return out


def texts():
    rng = np.random.default_rng(3)
    words = ["The", "the", "a", "é", "zz", "\x1cq", "of", "ß" * 300, "x-y"]
    out = []
    for i in range(120):
        ws = [words[j] for j in rng.zipf(1.5, 30) % len(words)]
        out.append((i, "".join(w + s for w, s in zip(ws, rng.choice([" ", "  ", "\t", ". ", "\n", ","], 30, p=[.7, .05, .05, .1, .05, .05]))),
                    ["en", "de", None][i % 3]))
    return out + [(None, None, "en"), (5, "", "en"), (5, "the the the the the the the", "en"), (6, "...", "xx"), (7, "lonely", "fr")]


@pytest.mark.parametrize("shard, paths", [(co.SHARD_TOKENS, co.PATHS_PER_RANGE), (40, 7)])
def test_query_path_against_brute_force(spark, monkeypatch, shard, paths):
    monkeypatch.setattr(co, "SHARD_TOKENS", shard)
    monkeypatch.setattr(co, "PATHS_PER_RANGE", paths)
    monkeypatch.setattr(co, "PENDING_PATHS", 50)
    rows = texts()
    df = documents(spark, rows, EXTRA).repartition(3)
    got = co.phrases(df, least=4).collect()
    want = brute([(t, g) for _, t, g in rows], 4)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in got} == want and len(got) == len(want) > 50
    first = co.top(co.phrases(df, least=4), 5).collect()
    for lang in {r.lang for r in got}:
        order = sorted(((-v[4], -v[0], p.encode()) for (g, p), v in want.items() if g == lang))[:5]
        assert [r.phrase.encode() for r in sorted((r for r in first if r.lang == lang), key=lambda r: r["rank"])] == [p for *_, p in order]


def test_full_bit_tables_lose_nothing(spark):
    rows = texts()
    got = co.phrases(documents(spark, rows), least=4, bits=6).collect()
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in got} == brute([(t, g) for _, t, g in rows], 4)


def test_automaton_counts_unions_and_shares_states():
    rng = np.random.default_rng(1)
    words = [b"a", b"b", b"c"]
    full = [p for k in range(1, 5) for p in product(range(3), repeat=k)]

    def some(seed, n):
        pick = np.random.default_rng(seed).integers(0, len(full), n)
        rows = np.array([list(full[i]) + [-1] * (4 - len(full[i])) for i in pick], np.int32).reshape(-1, 4)
        return co.summed(rows, np.ones(n, np.int64))

    total, union = Counter(), co.Union()
    for seed in range(6):
        path, weight = some(seed, int(rng.integers(1, 90)))
        a = co.Automaton.from_bytes(co.Automaton.build(words, path, weight).to_bytes())
        back, w = a.ends()
        used = {x: i for i, x in enumerate(a.words)}
        assert [([words[i] for i in p if i >= 0], c) for p, c in zip(path, weight)] == [
            ([a.words[i] for i in p if i >= 0], c) for p, c in zip(back, w)] and used
        for p, c in zip(path, weight):
            for k in range(1, sum(p >= 0) + 1):
                total[tuple(words[i] for i in p[:k])] += c
        union.add(a)
    merged = union.automaton()
    asked = [tuple(words[i] for i in p) for p in full] + [(b"q",), (b"a", b"q")]
    assert list(merged.compose(asked)) == [total[p] for p in asked]
    # nine paths with the same two endings: the endings are stored once
    path = np.array([[i, 9, 7, 8] for i in range(9)], np.int32)
    shared = co.Automaton.build([b"%d" % i for i in range(10)], path, np.full(9, 2))
    assert len(shared.label) == 9 + 3 and len(co.Automaton.build([], path[:0], np.zeros(0, int)).label) == 0


def test_empty_tables(spark):
    assert co.phrases(documents(spark, [])).count() == 0
    assert co.phrases(documents(spark, [(1, None), (2, " . ")])).count() == 0


def test_frequent_words_without_a_phrase(spark):
    rows = [(i, "solo. solo, alone", "de") for i in range(9)] + [(i, "go on", "en") for i in range(9)]
    got = co.phrases(documents(spark, rows), least=5).collect()
    assert [(r.lang, r.phrase, r.a) for r in got] == [("en", "go on", 9)]
