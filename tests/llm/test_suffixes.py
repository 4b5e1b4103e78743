import hashlib

import numpy as np
import pytest

from episodeframe.llm import queries, suffixes
from tests.llm.helpers import EXTRA, documents


def brute(rows, length):
    """(n_bytes, spans, kept) per row of (id, text): rows with one id and one text are one document."""
    docs = sorted({(suffixes.NO_ID if i is None else i, (t or "").encode()) for i, t in rows})
    seen, out = set(), {}
    for i, data in docs:
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            w = data[s:s + length]
            if w in seen:
                gone[s:s + length] = True
            seen.add(w)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        out[i, data] = ([(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])], bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


def check(got, rows, length):
    want = brute(rows, length)
    assert len(got) == len(rows)
    seen = []
    for r in got:
        key = suffixes.NO_ID if r.doc_id is None else r.doc_id
        fits = [k for k, (spans, kept) in want.items() if k[0] == key and r.n_bytes == len(k[1])
                and [(s.start, s.end) for s in r.spans] == spans and bytes(r.kept) == kept]
        assert fits, (r.doc_id, [(s.start, s.end) for s in r.spans])
        seen += fits[:1]
    assert set(seen) == set(want)


def texts():
    rng = np.random.default_rng(9)
    words = ["alpha", "be", "gâté", "d", "epsilon", "zeta zeta", "eta"]

    def prose(n):
        return " ".join(words[i] for i in rng.integers(0, len(words), n))

    common, line = prose(30), prose(12)
    rows = [(i, prose(int(rng.integers(1, 40)))) for i in range(40)]
    rows += [(100 + i, f"{prose(4)} {common} {prose(4)} {line}") for i in range(25)]
    rows += [(200 + i, rows[3][1]) for i in range(8)] + [(300, rows[50][1].replace("a", "á", 1)), (301, rows[50][1] + "!" + rows[50][1])]
    rows += [(400, "a" * 300), (401, "ab" * 90), (402, "a" * 41), (403, "a" * 40), (404, "a" * 39), (405, ""), (406, None),
             (407, "xyz" * 400 + "a" * 120), (None, common), (None, common), (500, common + line), (500, common + line), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize("length, core, most", [(40, 12, 4096), (40, 12, 2), (33, 32, 3)])
def test_against_brute_force(spark, monkeypatch, length, core, most):
    monkeypatch.setattr(suffixes, "COLLECTION", 30)
    monkeypatch.setattr(suffixes, "CHUNK", 500)
    rows = texts()
    df = documents(spark, rows, EXTRA).repartition(3)
    check(suffixes.dedup(df, length=length, core=core, most=most).collect(), rows, length)


def test_one_id_with_different_texts(spark):
    rows = [(1, "p" + "q" * 9 + "long enough text here"), (1, "long enough text here and more"), (2, "long enough text here")]
    got = suffixes.dedup(documents(spark, rows), length=10, core=4).collect()
    assert {sum(s.end - s.start for s in r.spans) for r in got if r.doc_id == 2} == {21}
    assert sorted(sum(s.end - s.start for s in r.spans) for r in got if r.doc_id == 1) == [0, 21]


def test_collection_is_the_sorted_order_of_all_suffixes():
    rng = np.random.default_rng(2)
    for trial in range(12):
        data = [bytes(rng.integers(97, 99 + trial % 3, int(rng.integers(0, 30))).astype(np.uint8)) for _ in range(int(rng.integers(1, 25)))]
        data += data[:2]
        bwt, lcp = suffixes.collection(data)
        rows = sorted((tuple(b + 1 for b in t[s:]) + (0, i), i, s) for i, t in enumerate(data) for s in range(len(t) + 1))
        assert [data[i][s - 1] + 1 if s else 0 for _, i, s in rows] == bwt.tolist()

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n
        cut = [data[i][s:] for _, i, s in rows]
        assert [0] + [common(a, b) for a, b in zip(cut, cut[1:])] == lcp.tolist()
        text, size = suffixes.suffix_rows(bwt, len(data), max(map(len, data)))
        assert [(i, len(data[i]) - s) for _, i, s in rows] == list(zip(text.tolist(), size.tolist()))


def test_a_round_inserts_several_symbols(monkeypatch):
    rounds, least = [], suffixes._range_min

    def counted(*args):
        rounds.append(1)
        return least(*args)
    monkeypatch.setattr(suffixes, "_range_min", counted)
    rng = np.random.default_rng(3)
    data = [bytes(rng.integers(0, 2, 160).astype(np.uint8)) for _ in range(40)]
    data += [b"", b"\0", b"\0\0", bytes(9), data[0][:-3], data[1] + b"\0"]
    bwt, lcp = suffixes.collection(data)
    assert 0 < len(rounds) <= 161 // 5
    rows = sorted((t[s:], i, s) for i, t in enumerate(data) for s in range(len(t) + 1))
    assert [data[i][s - 1] + 1 if s else 0 for _, i, s in rows] == bwt.tolist()
    for (a, _, _), (b, _, _), n in zip(rows, rows[1:], lcp[1:].tolist()):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


@pytest.mark.parametrize("core, letters", [(12, 3), (30, 2), (1, 2)])
def test_minimizers_that_occur_twice(core, letters):
    data = np.random.default_rng(core).integers(97, 97 + letters, 3000).astype(np.uint8)
    data[500:900] = 97
    ends, length = np.array([700, 705, 3000]), 40
    hashes = suffixes.Hashes(suffixes._MULT)
    group, _, _, start, run, twice = suffixes.segments(data, ends, core, length, hashes)
    h = hashes.all_of(hashes.sums(data), core)
    for g, a, r, t in zip(group, start, run, twice):
        span = h[a:a + r + length - core]
        assert span.min() == g and t == (np.count_nonzero(span == g) > 1)
    assert run.sum() == 700 - 39 + 2295 - 39 and twice.any()


def test_query_on_a_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op12_suffixes(spark, "/root/testdata/sf0.001").collect()}
    want = brute(rows, 100)
    assert len(got) == len(rows) and any(r.n_spans for r in got.values())
    for (i, data), (spans, kept) in want.items():
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(data), sum(b - a for a, b in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_empty_tables(spark):
    assert suffixes.dedup(documents(spark, [])).count() == 0
    got = suffixes.dedup(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r.n_bytes, r.spans, bytes(r.kept)) for r in got] == [(0, [], b"")] * 2
