"""End-to-end publish route on the smoke tables."""

import json

from pyspark.sql import functions as F

from episodeframe.plans.publish import publish
from episodeframe.sources.config import parse_mapping_config
from episodeframe.sources.files import read_published_frames, read_stats_json
from episodeframe.sources.tables import events_as_messages

CFG = {
    "fps": 30,
    "topics": {"observations": {
        "click": {"decoder": "float", "candidates": [{"topic": "click"}]},
        "view": {"decoder": "float", "candidates": [{"topic": "view"}]},
        "commerce": {"decoder": "float", "candidates": [{"topic": "purchase"}, {"topic": "signup", "priority": 3}]},
        "faults": {"decoder": "float", "required": False, "candidates": [{"topic": "error"}]}}},
    "state": {"fields": [{"name": "click", "source": "click", "extractor": "float.value"},
                         {"name": "view", "source": "view", "extractor": "float.value"},
                         {"name": "commerce", "source": "commerce", "extractor": "float.value"},
                         {"name": "k", "extractor": "constant:1"}]},
}


def test_publish_round_trip(spark, tmpdir_path):
    m = events_as_messages(spark, "/root/testdata/sf0.001").select(
        "recording_id", F.col("stream").alias("topic"), "ts_ns", "seq",
        F.to_json(F.struct(F.col("value"))).alias("payload"))
    # one frame per hour: the smoke events are sparse and span a month
    cfg = parse_mapping_config({**CFG, "fps": 1 / 3600})
    out = f"{tmpdir_path}/ds"
    res = publish(m, cfg, out, task="collect")
    frames = read_published_frames(spark, out)
    n = frames.count()
    assert n > 0
    idx = sorted(r[0] for r in frames.select("index").collect())
    assert idx == list(range(n))
    eps = spark.read.parquet(f"{out}/meta/episodes").collect()
    assert sum(e["length"] for e in eps) == n
    for e in eps[:5]:  # the announced folder exists and holds the episode's first frame
        folder = f"{out}/data/chunk_index={e['data/chunk_index']}/file_index={e['data/file_index']}"
        assert spark.read.parquet(folder).where(F.col("index") == e["dataset_from_index"]).count() == 1
    assert spark.read.parquet(f"{out}/meta/tasks").first()["task"] == "collect"
    st = read_stats_json(spark, f"{out}/meta/stats/*.txt").collect()
    assert {r["feature"] for r in st} == {"observation.state", "action"}
    info = json.loads(spark.read.text(f"{out}/meta/info").first()[0])
    assert info["data_path"] == "data/chunk_index={chunk_index}/file_index={file_index}"
    assert info["total_frames"] == n and info["splits"]["train"] == f"0:{len(eps)}"
    widths = {r[0] for r in frames.select(F.size("`observation.state`")).distinct().collect()}
    assert widths == {4}
    # recordings lacking a required field are reported and not published
    rej = {r["recording_id"] for r in res.rejected.collect()}
    topics = {}
    for r in m.select("recording_id", "topic").distinct().collect():
        topics.setdefault(r[0], set()).add(r[1])
    expect = {rec for rec, t in topics.items()
              if not ({"click", "view"} <= t and t & {"purchase", "signup"})}
    assert rej == expect


def test_source_folder_of_a_row_without_a_pattern(spark, tmpdir_path):
    from episodeframe.plans import merge_job as J
    for name in ("a b", "c"):
        spark.range(2).write.parquet(f"{tmpdir_path}/{name}/table=data")
    df = J._read(spark, tmpdir_path, "table=data", "id long")
    assert sorted(r["_folder"] for r in df.collect()) == ["a b", "a b", "c", "c"]
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
