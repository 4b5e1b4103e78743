import json

import pytest
from pyspark.sql import functions as F

from episodeframe.functions import variants as V
from episodeframe.operators import sidecars as S
from episodeframe.sources.files import read_sidecar_files, read_sidecar_lines

SEC = 1_000_000_000


def params(spark, rows=(("r1", 1_700_000_000 * SEC, SEC, 100),)):
    return spark.createDataFrame(list(rows), "recording_id string, start_ns long, step_ns long, n_frames long")


def cut(spark, index=None, meta=None, rec="r1", **kw):
    raw = [(rec, k, 0, d if isinstance(d, str) else json.dumps(d)) for k, d in ((S.STEP_INDEX, index), (S.TASK_META, meta)) if d is not None]
    docs, broken = S.documents(spark.createDataFrame(raw, "recording_id string, kind string, part int, text string"))
    specs, rejects = S.episodes(docs, params(spark), "fallback", **kw)
    got = sorted((r.start_index, r.end_index, r.step_number, r.task) for r in specs.collect())
    return got, sorted((r.kind, -1 if r.pos is None else r.pos, r.reason) for r in rejects.unionByName(broken).collect())


def test_variant_access(spark):
    d = spark.createDataFrame([('{"a":null,"n":3.7,"s":" 7 ","t":"3.5","b":true,"o":{"x":1},"l":[]}',)], "t string").select(
        F.try_parse_json("t").alias("v"))
    m = lambda k: V.member("v", k)
    r = d.select(V.kind(m("a")).alias("null"), m("zz").isNull().alias("missing"), V.kind(V.first_present("v", ["zz", "a", "n"])).alias("first"),
                 V.as_integer(m("n")).alias("n"), V.as_integer(m("s")).alias("s"), V.as_integer(m("t")).alias("t"), V.as_integer(m("b")).alias("b"),
                 V.as_integer(m("o")).alias("o"), V.as_string(m("n")).alias("text"), V.truthy(m("l")).isNull().alias("l"),
                 V.truthy(m("o")).isNotNull().alias("full"), V.as_number_text(m("a")).alias("nn")).first()
    assert (r.null, r.missing, r["first"], r.n, r.s, r.t, r.b, r.o, r.text, r.l, r.full, r.nn) == (
        "VOID", True, "VOID", 3, 7, None, 1, None, None, True, True, None)


def test_steps_in_every_unit_and_alias(spark):
    t = 1_700_000_000
    steps = [{"step_number": 1, "start_ts": t + 10, "end_ts": t + 20, "action": " pick "},
             {"number": "2", "startTs": str((t + 5) * 1000), "endTs": (t + 6) * 1000},
             {"stepNumber": 3.9, "start_ns": (t + 90) * SEC, "end_ns": (t + 500) * SEC, "action": 5},
             {"step_number": None, "number": 4, "start_time": (t + 30) * 1_000_000, "end_time": f"{t + 31}.5", "action": ""}]
    got, bad = cut(spark, {"steps": steps}, {"taskName": "Sort", "actionDesc": " cups ", "stepList": [
        {"number": 2, "action": " "}, {"number": 2, "action": " lift "}, {"number": "2", "action": "late"}, "x", {"number": None, "step_number": 3, "action": "no"}]})
    assert got == [(5, 7, 2, "lift"), (10, 21, 1, " pick "), (30, 32, None, "Sort: cups"), (90, 100, 3, "Sort: cups")] and bad == []


@pytest.mark.parametrize("index, reasons", [
    ({"steps": []}, []), ({}, []), ({"steps": None}, [(-1, S.STEPS_NOT_A_LIST)]), ({"steps": {"a": 1}}, [(-1, S.STEPS_NOT_A_LIST)]),
    ({"steps": [3, "x", None]}, [(0, S.STEP_NOT_AN_OBJECT), (1, S.STEP_NOT_AN_OBJECT), (2, S.STEP_NOT_AN_OBJECT)]),
    ({"steps": [{"start_ts": None, "startTs": 1_700_000_000, "end_ts": 1_700_000_050}, {"start_ts": "abc", "end_ts": 1_700_000_050}]},
     [(0, S.BAD_BOUNDS), (1, S.BAD_BOUNDS)]),
    ({"steps": [{"start_ts": 1_600_000_000, "end_ts": 1_700_000_000}, {"start_ts": 1_700_000_099, "end_ts": 1_800_000_000},
                {"start_ts": 1_700_000_020, "end_ts": 1_700_000_010}, {"start_ts": 1_700_000_020.2, "end_ts": 1_700_000_020.7}]},
     [(0, S.OUTSIDE), (1, S.OUTSIDE), (2, S.INVERTED), (3, S.NO_FRAME)])])
def test_one_whole_episode_and_reasons(spark, index, reasons):
    got, bad = cut(spark, index, {"task_name": "T"})
    assert got == [(0, 100, None, "T")]
    assert [(p, r) for _, p, r in bad] == reasons


def test_task_text_fallbacks(spark):
    assert cut(spark, None, {"taskName": 5, "name": " ", "taskId": 17})[0][0][3] == "17"
    assert cut(spark, None, {"taskId": None, "description": " d "})[0][0][3] == "d"
    assert cut(spark, None, {"name": "n"}, override="O")[0][0][3] == "O"
    assert cut(spark, "[1]", "{x")[1] == [(S.STEP_INDEX, -1, S.NOT_AN_OBJECT), (S.TASK_META, -1, S.NOT_JSON)]
    assert cut(spark, {"steps": []}, rec="gone")[1] == [(S.STEP_INDEX, -1, S.NO_RECORDING)]


def test_files_and_lines_read_alike(spark, tmp_path):
    doc = {"steps": [{"start_ts": 1_700_000_001, "end_ts": 1_700_000_002}]}
    (tmp_path / "r1").mkdir()
    (tmp_path / "r1" / "step_index.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "r1" / "task_meta.json").write_text("{")
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(d) for d in (
        {"recording_id": 1, "kind": "step_index", "part": 0, "doc": doc}, {"recording_id": 1, "kind": "task_meta", "part": 0, "doc": "{"})))
    for raw in (read_sidecar_files(spark, f"{tmp_path}/r1/*.json"), read_sidecar_lines(spark, f"{tmp_path}/lines.json")):
        docs, broken = S.documents(raw)
        steps, bad = S.listed_steps(docs)
        assert [(r.start_ns, r.end_ns) for r in steps.collect()] == [(1_700_000_001 * SEC, 1_700_000_002 * SEC)]
        assert bad.count() == 0 and [(r.kind, r.reason) for r in broken.collect()] == [("task_meta", S.NOT_JSON)]


def test_steps_in_parts_keep_their_order(spark):
    raw = [("r1", S.TASK_META, 1, '{"steps":[{"number":1,"action":"second"}]}'), ("r1", S.TASK_META, 0, '{"name":"N","steps":[{"number":1,"action":"first"}]}'),
           ("r1", S.STEP_INDEX, 0, '{"steps":[{"number":1,"start_ts":1700000001,"end_ts":1700000002}]}'),
           ("r1", S.STEP_INDEX, 1, '{"steps":[{"number":9,"start_ts":1700000005,"end_ts":1700000006}]}')]
    docs, _ = S.documents(spark.createDataFrame(raw, "recording_id string, kind string, part int, text string"))
    specs, _ = S.episodes(docs, params(spark), "f")
    assert sorted((r.start_index, r.task) for r in specs.collect()) == [(1, "first"), (5, "N")]
