import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodeframe.plans.publish import publish
from episodeframe.sources.config import parse_mapping_config
from episodeframe.sources.files import read_published_frames
from episodeframe.streaming import sessions as S
from episodeframe.streaming.live import MESSAGE_SCHEMA

ROWS = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField("action", T.StringType())])
HOUR = 3_600_000_000_000


def land(path, batches, start=0):
    """One JSON file per batch, in this order of age; a row (rec, action, ts) is a control row."""
    os.makedirs(path, exist_ok=True)
    for k, rows in enumerate(batches, start):
        f = f"{path}/{k:03d}.json"
        with open(f, "w") as out:
            for r in rows:
                names = ("recording_id", "action", "ts_ns") if len(r) == 3 else ("recording_id", "stream", "ts_ns", "seq", "value")
                d = dict(zip(names, r))
                if "value" in d:
                    d["payload"] = json.dumps({"value": d["value"]})
                out.write(json.dumps(d) + "\n")
        os.utime(f, (1_700_000_000 + k, 1_700_000_000 + k))


def source(spark, path):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).json(path)


def test_every_row_lands_in_exactly_one_table_across_restarts(spark, tmpdir_path):
    rng = random.Random(4)
    rows = [(r, s, r * 4 * HOUR + i * 100 + (0 if s == "a" else 7), i, float(i)) for r in (1, 2) for s in "ab" for i in range(40)]
    rows += [(1, "a", None, 900, 0.0), (None, "a", 5, 901, 0.0), (1, "a", rows[5][2], 902, 1.0)]
    moved = sorted(rows, key=lambda r: (r[2] or 0) % (4 * HOUR) + rng.choice([0, 0, 0, 900]))
    batches = [moved[i:i + 25] for i in range(0, len(moved), 25)]
    path, root, ck = (f"{tmpdir_path}/{x}" for x in ("in", "out", "ck"))
    land(path, batches[:3])
    S.record(source(spark, path), root, ck, delay_ns=300).awaitTermination(300)
    land(path, batches[3:], 3)
    S.record(source(spark, path), root, ck, delay_ns=300).awaitTermination(300)

    store = S.Store(spark, root)
    assert store.committed() == list(range(len(batches)))
    key = lambda r: (r.recording_id, r.stream, r.ts_ns, r.seq, r.batch_id)
    got = {t: sorted(map(key, store.read(t, store.committed(), MESSAGE_SCHEMA).collect()), key=str) for t in ("on_time", "late")}
    clock, want = {}, {"on_time": [], "late": []}
    for n, part in enumerate(batches):
        for r in part:
            late = r[0] is None or r[2] is None or r[2] < clock.get(r[0], -1) - 300
            want["late" if late else "on_time"].append((*r[:4], n))
        for r in part:
            if r[0] is not None and r[2] is not None:
                clock[r[0]] = max(clock.get(r[0], r[2]), r[2])
    assert got == {t: sorted(v, key=str) for t, v in want.items()} and len(got["late"]) > 5
    assert len(got["late"]) + len(got["on_time"]) == len(rows) == store.landed(MESSAGE_SCHEMA).count()


def writer(fail=()):
    """Publisher that writes the messages; it fails after writing for the calls named in ``fail``."""
    calls = []

    def run(messages, recordings, path):
        calls.append(path)
        messages.write.parquet(path)
        if len(calls) - 1 in fail:
            raise RuntimeError("lost")
    run.calls = calls
    return run


BATCHES = [[(1, "start", 0), (1, "a", 10, 1, 0.0), (2, "a", 10, 1, 0.0), (1, "stop", 100)],   # stopped before the last rows
           [(1, "a", 60, 2, 0.0), (2, "a", 20, 2, 0.0)],
           [(1, "a", 100, 3, 0.0), (1, "b", 50, 4, 0.0), (1, "a", 130, 5, 0.0), (2, "stop", 90)],
           [(1, "a", 95, 6, 0.0)],                                                             # after the publication
           [(3, "stop", 5)], [(3, "a", 4, 1, 0.0)], [(1, "b", 96, 7, 0.0)]]


def published(spark, store):
    out = {}
    for m in store.manifest().collect():
        assert m.recording_id not in out
        rows = spark.read.parquet(m.data_set).where(F.col("recording_id") == m.recording_id).collect()
        out[m.recording_id] = (m.batch_id, sorted(r.seq for r in rows))
    return out


def test_stop_before_the_last_rows_replay_and_close(spark, tmpdir_path):
    path, root, ck = (f"{tmpdir_path}/{x}" for x in ("in", "out", "ck"))
    land(path, BATCHES)
    run = writer(fail={0})
    q = S.record(source(spark, path), root, ck, run, delay_ns=20)
    with pytest.raises(Exception, match="lost"):
        q.awaitTermination(300)
    assert S.Store(spark, root).manifest().count() == 0     # written, not committed
    S.record(source(spark, path), root, ck, run, delay_ns=20).awaitTermination(300)
    store = S.Store(spark, root)
    # 1: its clock reached the stop in batch 2; 2 and 3: a batch brought nothing more
    assert published(spark, store) == {1: (2, [1, 2, 3, 4]), 2: (3, [1, 2]), 3: (6, [1])}
    again = spark.createDataFrame([(1, "a", 99, 9, 0.0, None, None)], ROWS)
    calls = len(run.calls)
    S.run_batch(store, again, 2, run, 20)                    # a committed batch does nothing
    assert len(run.calls) == calls and published(spark, store)[1] == (2, [1, 2, 3, 4])
    missed = sorted((r.recording_id, r.seq) for r in S.after_publication(store).collect())
    assert missed == [(1, 5), (1, 6), (1, 7)]
    assert store.landed().count() == sum(len(r) == 5 for b in BATCHES for r in b)


def test_close_publishes_what_waits(spark, tmpdir_path):
    path, root, ck = (f"{tmpdir_path}/{x}" for x in ("in", "out", "ck"))
    land(path, [[(1, "a", 10, 1, 0.0), (1, "stop", 100), (4, "stop", 3)]])
    run = writer()
    S.record(source(spark, path), root, ck, run).awaitTermination(300)
    store = S.Store(spark, root)
    assert store.manifest().count() == 0
    S.close_pending(store, MESSAGE_SCHEMA, run)
    assert published(spark, store) == {1: (1, [1]), 4: (1, [])}
    S.close_pending(store, MESSAGE_SCHEMA, run)
    assert published(spark, store) == {1: (1, [1]), 4: (1, [])}


def test_sessions_publish_a_training_set(spark, tmpdir_path):
    sec = 1_000_000_000
    rows = [(r, s, r * HOUR + i * sec, i, float(i)) for r in (1, 2) for s in ("pose", "grip") for i in range(9)]
    path, root, ck = (f"{tmpdir_path}/{x}" for x in ("in", "out", "ck"))
    land(path, [rows[:20], [(1, "stop", HOUR + 5 * sec)], rows[20:]])
    cfg = parse_mapping_config({"fps": 1, "topics": {"observations": {
        "pose": {"decoder": "float", "candidates": [{"topic": "pose"}]}, "grip": {"decoder": "float", "candidates": [{"topic": "grip"}]}}},
        "state": {"fields": [{"name": "p", "source": "pose", "extractor": "float.value"}, {"name": "g", "source": "grip", "extractor": "float.value"}]}})
    S.record(source(spark, path), root, ck, lambda m, r, p: publish(m.withColumnRenamed("stream", "topic"), cfg, p, task="t")).awaitTermination(300)
    m = S.Store(spark, root).manifest().collect()
    assert [r.recording_id for r in m] == [1]
    frames = read_published_frames(spark, m[0].data_set).orderBy("index").collect()
    assert [tuple(f["observation.state"]) for f in frames] == [(float(i), float(i)) for i in range(6)]
