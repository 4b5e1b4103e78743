import random
import zlib

from episodeframe.llm import queries, toxicity
from tests.llm.helpers import EXTRA, documents


def corpus(n=240):
    rng = random.Random(5)
    syllables = ["ta", "ren", "lo", "mi", "sel", "dor", "an", "ki", "vu", "pe"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randrange(1, 5)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 120))]
        if i % 4 == 0:
            for bad in rng.sample(["grumpfish", "zonkhead", "wretchling"], 2):
                words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_held_out_recall_and_clean_documents(spark):
    rows = corpus()
    labelled = spark.createDataFrame([r for r in rows if r[0] % 3], "doc_id long, text string, toxic int")
    model = toxicity.fit(labelled)
    docs = documents(spark, [r[:2] for r in rows if r[0] % 3 == 0] + [(900, None), (901, ""), (902, " \n"), (903, "y" * 100_000)], EXTRA)
    got = {r.doc_id: (r["score"], r["predicted"]) for r in toxicity.score(docs, model).collect()}
    bad = [got[i][1] for i, _, t in rows if i % 3 == 0 and t]
    good = [got[i][1] for i, _, t in rows if i % 3 == 0 and not t]
    assert sum(bad) / len(bad) >= 0.9 and sum(good) / len(good) <= 0.05
    assert got[900] == got[901] == got[902] and got[900][1] == 0 and got[903][1] == 0
    assert all(0 <= s <= 1 and p == int(s >= 0.3) for s, p in got.values())


def test_without_labels_nothing_is_toxic(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, toxic int")
    one = spark.createDataFrame([(1, "some text", 1), (2, None, 0)], "doc_id long, text string, toxic int")
    assert toxicity.fit(empty) is None and toxicity.fit(one) is None
    got = toxicity.score(documents(spark, [(1, "a"), (None, None)]), None).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.0, 0), (0.0, 0)]


def test_windows_cover_whole_texts():
    long = "abcdefghij" * 50
    parts = toxicity.windows_of(f"One {long} two")
    assert parts[0] == "one" and parts[-1] == "two"
    assert all(any(long[i:i + 16] in p for p in parts) for i in range(len(long) - 16))
    assert parts[-2].endswith(long[-10:])


def test_query_marks_held_out_rows(spark):
    got = queries.op1_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
