import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from episodeframe.llm import packing
from tests.llm.helpers import EXTRA, documents

VOCAB = public_tokenizers.path("word_bpe_49k.json")
RAW = Tokenizer.from_file(VOCAB)


def ids_of(text):
    return RAW.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet="aBzé ß.,'s9\n\t\u00a0\u0301İΣ中<|endoftext|>", max_size=25), max_size=5))
def test_cached_ids_are_the_tokenizers(texts):
    got = packing.WordTokenizer(VOCAB, room=3).encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [ids_of(t)[:-1] for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 200), min_size=1, max_size=10))
def test_program_meets_demand_and_beats_first_fit(histogram):
    sizes, demand = np.array(sorted(histogram)), np.array([histogram[s] for s in sorted(histogram)])
    solved = packing.solve(sizes, demand.astype(float), 32)
    assert np.allclose(sum(n * p for p, n in solved), demand, atol=1e-6)
    assert all(sizes @ p <= 32 for p, _ in solved)
    bins = []
    for s in sorted((s for s, n in histogram.items() for _ in range(n)), reverse=True):
        k = next((i for i, b in enumerate(bins) if b >= s), None)
        if k is None:
            bins.append(32 - s)
        else:
            bins[k] -= s
    assert (sizes @ demand) / 32 - 1e-6 <= sum(n for _, n in solved) <= len(bins) + 1e-6
    used = sum((n * p for p, n in packing.plan_patterns(histogram, 32)), np.zeros(33, int))
    assert all(used[s] <= n for s, n in histogram.items()) and used.sum() == sum(used[s] for s in histogram)


def test_pieces_are_a_partition_and_sequences_gapless(spark):
    rng = random.Random(4)
    words = ["alpha", "Beta,", "gamma.", "x1", "naïve", "Ünder", "o'clock"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 160)))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, "word " * 9000), (7, rows[7][1]), (None, "a null id")]
    docs = documents(spark, rows, EXTRA)
    length = 256
    pieces, tokens = packing.pack(docs, VOCAB, length=length, grid=8)
    got = pieces.collect()
    want = sorted(len(ids_of(t)) for _, t in rows)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.uid, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert sorted(sum(p.length for p in ps) for ps in by_doc.values()) == want
    text = {i: t for i, t in rows}
    for ps in by_doc.values():
        ps.sort(key=lambda p: p.start)
        ids = np.array(ids_of(text[ps[0].id]), "<u4")
        assert len(ids) == ps[0].doc_tokens and ps[0].start == 0
        assert all(a.start + a.length == b.start for a, b in zip(ps, ps[1:]))
        assert all(zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for p in ps)
    padding = total = 0
    for ps in by_seq.values():
        ps.sort(key=lambda p: p.offset)
        n = sum(p.length for p in ps)
        assert ps[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(ps, ps[1:])) and n <= length
        padding += 0 if n & (n - 1) == 0 else length - n
        total += n
    assert padding <= 0.03 * total
    every = spark.createDataFrame([(uid, ids_of(text[ps[0].id])) for uid, ps in by_doc.items()], "uid long, ids array<int>")
    seqs = packing.sequences(pieces, every, length).collect()
    assert len(seqs) == len(by_seq) and all(len(s.ids) == length or len(s.ids) & (len(s.ids) - 1) == 0 for s in seqs)


def test_empty_table_and_one_length(spark):
    docs = documents(spark, [(i, "one two three") for i in range(50)])
    assert packing.pack(docs.limit(0), VOCAB)[0].count() == 0
    pieces, _ = packing.pack(docs, VOCAB, length=16, grid=4)
    assert sum(r.length for r in pieces.collect()) == 50 * len(ids_of("one two three"))


def test_fast_words_give_the_tokenizers_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    raw, fast = Tokenizer.from_file(path), packing.fast_words(path)
    rng = np.random.default_rng(8)
    letters = list("abcdefghijklmnopqrstuvwxyzeeeeaaatttßéñøæªµÿ")
    words = sorted({"".join(rng.choice(letters, int(rng.integers(1, 25)))) for _ in range(20_000)}
                   | {"a", "the", "zzzzzzzzzz", "aaaa" * 200, "é", "straße", "µ"})
    ids, ends = fast(words)
    want = [raw.encode(w, add_special_tokens=False).ids for w in words]
    assert len(ends) == len(words)
    assert [ids[s:e].tolist() for s, e in zip([0, *ends], ends)] == want
