import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from episodeframe.llm import simhash
from tests.llm.helpers import EXTRA, documents


def brute_fingerprint(text, n=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = (words + [word], "") if word else (words, "")
        else:
            word += c
    if not words:
        return 0
    sh = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2 ** 64 - 1)).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB é\n\t\x0b\x1cß", max_size=60))
def test_fingerprint_is_the_definition(text):
    assert simhash.fingerprint_of(text) & (2 ** 64 - 1) == brute_fingerprint(text)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 64 - 1), st.sets(st.integers(0, 63), max_size=4), st.integers(0, 2))
def test_masks_cover_every_pair_in_radius(x, flips, level):
    y = x
    for b in flips:
        y ^= 1 << b
    assert any((x & m) == (y & m) for m in (k & (2 ** 64 - 1) for k in simhash.covering_masks(4, level)))


def test_links_give_the_brute_force_components_through_all_levels(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(260):  # a dense group, chains, and loners
        f = fps[rng.randrange(6)] if rng.random() < 0.7 else fps[-1]
        for b in rng.sample(range(64), rng.randrange(1, 6)):
            f ^= 1 << b
        fps.append(f)
    fps = sorted(set(fps))
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute_components(fps, 4)
    for bucket in (2048, 8):  # 8: buckets go on to deeper masks
        edges = [(r.a, r.b) for r in simhash.links(df, 4, bucket).collect()]
        at = {f: i for i, f in enumerate(signed)}
        for a, b in edges:
            assert np.bitwise_count(np.uint64((a ^ b) & (2 ** 64 - 1))) <= 4
        root = list(range(len(fps)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in edges:
            x, y = find(at[a]), find(at[b])
            root[max(x, y)] = min(x, y)
        assert [find(i) for i in range(len(fps))] == want


def test_near_duplicates_with_awkward_rows(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here " * 20
    rows = [(5, base), (3, base.upper()), (9, base + "now"), (1, "other words entirely different from all"), (2, None), (4, ""),
            (7, " \n"), (8, "x" * 200_000), (5, base), (None, "a null id"), (11, "one")]
    docs = documents(spark, rows, EXTRA)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    comp = {r.doc_id: r.component_id for r in got}
    assert comp[5] == comp[3] == comp[9] == 3
    assert comp[2] == comp[4] == comp[7] == 2 and comp[1] == 1 and comp[11] == 11 and comp[None] is None
    fps = {r.doc_id: r.fp & (2 ** 64 - 1) for r in got}
    assert all(fps[i] == brute_fingerprint(t) for i, t in rows)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 8), (False, 11), (True, 0)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.deduplicate(docs.limit(0)).count() == 0


def test_repeated_rows_leave_one(spark):
    docs = documents(spark, [(1, "same words here now ok"), (1, "same words here now ok"), (2, "same words here now ok")])
    assert [r.doc_id for r in simhash.deduplicate(docs).collect()] == [1]
