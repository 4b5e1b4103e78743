"""Sidecar documents to steps and task texts.

The sidecars are written as JSON lines from ``conversations`` and read back: a
conversation's turns are the steps of the recording of the same number, in
parts of four, under the key names, stamp units and value types that such files
mix; its texts are also the step list of the task's own document.  Some
documents and steps are broken on purpose, by number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodeframe.operators import align as A
from episodeframe.operators import episodes as EP
from episodeframe.operators import sidecars as S
from episodeframe.operators.actions import next_state
from episodeframe.plans.catalog import _MSG_CTE, EVENT_STEP_NS, EVENT_STREAMS, r6, register
from episodeframe.plans.episode_queries import _NORM_SQL, DAY_NS
from episodeframe.session import cut_lineage, ensure_checkpoint_dir
from episodeframe.sources.files import read_sidecar_lines
from episodeframe.sources.tables import events_as_messages, table

PART = 4
FALLBACK = "no task"


def _json(**fields) -> F.Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


def _step_json(t0: F.Column) -> F.Column:
    """A turn as a step, by (conversation + turn) mod 10."""
    a = t0 + F.col("turn") * 2 * DAY_NS
    b = a + 3 * DAY_NS
    number = F.floor(F.col("turn") / 2).cast("long")
    said = F.when(F.col("role") == "user", F.col("text"))
    null = F.lit(None).cast("string")

    def unit(x, ns):
        return F.call_function("div", x, F.lit(ns))

    shapes = [
        _json(step_number=number, start_ts=unit(a, 10 ** 9), end_ts=unit(b, 10 ** 9), action=said),
        _json(number=number.cast("string"), startTs=unit(a, 10 ** 6).cast("string"), endTs=unit(b, 10 ** 6).cast("string"), action=said),
        _json(stepNumber=number + F.lit(0.5), start_ns=a, end_ns=b, action=said),
        _json(number=number, start_ts=unit(a, 10 ** 6), end_ts=unit(a, 10 ** 6), action=said),
        _json(step_number=null, number=number, start_time=unit(a, 1000), end_time=unit(b, 1000), action=F.lit(4)),
        _json(step_number=number, start_ts=null, startTime=unit(a, 10 ** 9), endTime=unit(b, 10 ** 9), action=said),
        _json(number=F.lit("n/a"), startTime=unit(a, 10 ** 9).cast("string"), endTime=unit(b, 10 ** 9).cast("string"), action=F.lit("  ")),
        F.lit('"pause"'),
        _json(number=number, start_ts=unit(t0 - 10 * DAY_NS, 10 ** 9), end_ts=unit(t0 - 5 * DAY_NS, 10 ** 9), action=said),
        _json(number=number, start_ts=unit(t0, 10 ** 9) + 1000, end_ts=unit(t0, 10 ** 9) + 2000, action=said),
    ]
    case = (F.col("recording_id") + F.col("turn")) % 10
    out = F.when(case == 0, shapes[0])
    for k, s in enumerate(shapes[1:], 1):
        out = out.when(case == k, s)
    return out


def _listed(js: str) -> F.Column:
    rows = F.array_sort(F.collect_list(F.struct("turn", js)))
    return F.concat(F.lit("["), F.array_join(F.transform(rows, lambda r: r[js]), ","), F.lit("]"))


def _meta_json(steps: F.Column, first: F.Column) -> F.Column:
    """A conversation's task document, by number mod 6; parts after the first hold steps only."""
    k = F.col("recording_id") % 6
    named = F.to_json(F.struct(F.concat(F.lit(" "), first, F.lit(" ")).alias("taskName"), F.lit("short").alias("actionDesc")))
    other = F.to_json(F.struct(F.lit("").alias("name"), first.alias("task_name")))

    return (F.when(k == 0, F.concat(F.regexp_replace(named, r"\}$", ""), F.lit(',"stepList":'), steps, F.lit("}")))
            .when(k == 1, F.concat(F.regexp_replace(other, r"\}$", ""), F.lit(',"steps":'), steps, F.lit("}")))
            .when(k == 2, F.concat(F.lit('{"taskId":'), F.col("recording_id").cast("string"), F.lit(',"stepList":[],"steps":'), steps, F.lit("}")))
            .when(k == 3, steps)
            .when(k == 4, F.lit("{broken"))
            .otherwise('{"taskId":null,"stepList":[{"number":null,"step_number":0,"action":"never"}]}'))


def write_sidecars(spark, sf_dir: str, params: DataFrame, path: str) -> None:
    """Sidecar lines of all conversations; stamps lie around the recording's window start."""
    c = (table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "recording_id")
         .join(params.select("recording_id", F.col("start_ns").alias("_t0")), "recording_id", "left")
         .withColumn("part", F.floor(F.col("turn") / PART).cast("int")))
    t0 = F.coalesce("_t0", F.lit(0).cast("long"))
    c = c.withColumn("step", _step_json(t0)).withColumn(
        "meta_step", F.to_json(F.struct(F.floor(F.col("turn") / 2).cast("long").alias("number"), F.col("text").alias("action"))))
    g = c.groupBy("recording_id", "part").agg(_listed("step").alias("steps"), _listed("meta_step").alias("meta_steps"),
                                              F.min_by("text", "turn").alias("first"))
    index = g.select("recording_id", F.lit(S.STEP_INDEX).alias("kind"), "part", F.when(
        F.col("recording_id") % 11 == 4, F.lit('{"steps":{"a":1}}')).otherwise(
            F.concat(F.lit('{"steps":'), F.col("steps"), F.lit("}"))).alias("doc"))
    meta = g.select("recording_id", F.lit(S.TASK_META).alias("kind"), "part", _meta_json(F.col("meta_steps"), F.col("first")).alias("doc"))
    index.unionByName(meta).write.json(path)


def _episodes(spark, sf_dir):
    msgs = events_as_messages(spark, sf_dir, EVENT_STREAMS)
    params = cut_lineage(A.grid_params(A.sampling_window(msgs), EVENT_STEP_NS))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sidecars/{uuid.uuid4().hex}"
    write_sidecars(spark, sf_dir, params, path)
    docs, broken = S.documents(read_sidecar_lines(spark, path))
    specs, rejects = S.episodes(docs, params, FALLBACK)
    return msgs, params, specs, rejects.unionByName(broken)


_STEPS_SQL = f"""
p AS (SELECT recording_id, start_ns AS t0, 3600000000000 AS st, (end_ns - start_ns) // 3600000000000 + 1 AS n,
             start_ns + (end_ns - start_ns) // 3600000000000 * 3600000000000 AS tl FROM win),
c AS (SELECT conv_id AS recording_id, turn, turn // {PART} AS part, row_number() OVER (PARTITION BY conv_id, turn // {PART} ORDER BY turn) - 1 AS pos,
             turn // 2 AS number, text, CASE WHEN role = 'user' THEN text END AS said, (conv_id + turn) % 10 AS x,
             coalesce(t0, 0) AS z, coalesce(t0, 0) + turn * 2 * {DAY_NS} AS a, coalesce(t0, 0) + turn * 2 * {DAY_NS} + 3 * {DAY_NS} AS b
      FROM conversations LEFT JOIN p ON p.recording_id = conv_id),
raw AS (SELECT *, CAST(CASE x WHEN 0 THEN a // 1000000000 WHEN 1 THEN a // 1000000 WHEN 2 THEN a WHEN 3 THEN a // 1000000 WHEN 4 THEN a // 1000
                  WHEN 6 THEN a // 1000000000 WHEN 8 THEN (z - 10 * {DAY_NS}) // 1000000000 WHEN 9 THEN z // 1000000000 + 1000 END AS DOUBLE) AS sx,
             CAST(CASE x WHEN 0 THEN b // 1000000000 WHEN 1 THEN b // 1000000 WHEN 2 THEN b WHEN 3 THEN a // 1000000 WHEN 4 THEN b // 1000
                  WHEN 6 THEN b // 1000000000 WHEN 8 THEN (z - 5 * {DAY_NS}) // 1000000000 WHEN 9 THEN z // 1000000000 + 2000
                  WHEN 5 THEN b // 1000000000 END AS DOUBLE) AS ex,
             CASE WHEN x NOT IN (4, 6) THEN number END AS step_number, CASE WHEN x NOT IN (4, 6) AND length(trim(said)) > 0 THEN said END AS action FROM c),
st AS (SELECT raw.recording_id, part, pos, x, step_number, action, t0, st, n, tl,
              {_NORM_SQL.format(x='sx')} AS start_ns, {_NORM_SQL.format(x='ex')} AS end_ns
       FROM raw JOIN p USING (recording_id) WHERE raw.recording_id % 11 <> 4 AND x <> 7),
rg AS (SELECT *, CASE WHEN start_ns IS NULL OR end_ns IS NULL THEN 'start or end missing or invalid'
                      WHEN end_ns <= t0 OR start_ns >= tl THEN 'outside the sampled window'
                      WHEN end_ns <= start_ns THEN 'end is not after start'
                      WHEN (least(end_ns, tl) - t0) // st + 1 <= (greatest(start_ns, t0) - t0 + st - 1) // st THEN 'no frame inside' END AS reason,
              (greatest(start_ns, t0) - t0 + st - 1) // st AS start_index, (least(end_ns, tl) - t0) // st + 1 AS end_index FROM st)"""


@register("sidecar_steps", f"""
WITH {_MSG_CTE}, {_STEPS_SQL},
us AS (SELECT recording_id, step_number, start_index, end_index, action FROM rg WHERE reason IS NULL),
ep AS (SELECT * FROM us UNION ALL SELECT recording_id, NULL, 0, n, NULL FROM p WHERE recording_id NOT IN (SELECT recording_id FROM us)),
j8 AS (SELECT recording_id, number AS step_number, arg_min(trim(text), turn) AS msa FROM c
       WHERE length(trim(text)) > 0 AND recording_id % 6 IN (0, 1, 2) GROUP BY 1, 2),
meta AS (SELECT recording_id, arg_min(CASE recording_id % 6 WHEN 2 THEN CAST(recording_id AS VARCHAR) ELSE nullif(trim(text), '') END, turn) AS title,
                CASE WHEN recording_id % 6 = 0 THEN 'short' END AS act FROM c WHERE recording_id % 6 IN (0, 1, 2) GROUP BY 1),
named AS (SELECT ep.*, coalesce(action, msa, CASE WHEN title IS NOT NULL AND act IS NOT NULL THEN title || ': ' || act END, title, act, '{FALLBACK}') AS task
          FROM ep LEFT JOIN j8 USING (recording_id, step_number) LEFT JOIN meta ON meta.recording_id = ep.recording_id),
hit AS (SELECT g.recording_id, g.frame_index, m.value, row_number() OVER (
          PARTITION BY g.recording_id, g.frame_index ORDER BY m.ts_ns DESC, m.seq DESC) AS rn
        FROM grid g JOIN m ON m.recording_id = g.recording_id AND m.ts_ns <= g.t_ns AND m.stream = 'view'),
j AS (SELECT named.*, g.frame_index, g.frame_index - start_index AS episode_frame_index, round(CAST(CAST(coalesce(h.value, 0.0) AS REAL) AS DOUBLE), 6) AS s_view
      FROM named JOIN grid g ON g.recording_id = named.recording_id AND g.frame_index >= start_index AND g.frame_index < end_index
      LEFT JOIN hit h ON h.recording_id = g.recording_id AND h.frame_index = g.frame_index AND h.rn = 1)
SELECT recording_id, step_number, start_index, episode_frame_index, frame_index, task, s_view,
       coalesce(lead(s_view) OVER (PARTITION BY recording_id, start_index, end_index, step_number, task ORDER BY episode_frame_index), s_view) AS a_view
FROM j""")
def sidecar_steps(spark, sf_dir):
    """Hourly frames cut by the steps of the sidecars, with the task text each
    step gets from its own action, the task's step list or the task's title;
    next-state action inside each episode."""
    msgs, params, specs, _ = _episodes(spark, sf_dir)
    n = A.frame_tasks(params)
    frames = A.align_frames(msgs, A.frame_grid(params, partitions=n), A.AlignSpec({"view": A.ASOF}), params=params, partitions=n)
    frames = frames.select("recording_id", "frame_index", F.coalesce(F.col("view"), F.lit(0.0)).cast("float").alias("s_view"))
    specs = cut_lineage(specs)
    n = EP.episode_tasks(specs, least=n)
    eps = EP.cut_episodes(frames, specs, partitions=n)
    eps = next_state(eps, ["recording_id", "start_index", "end_index", "step_number", "task"], "episode_frame_index", {"a_view": "s_view"},
                     partitions=n)
    return eps.select("recording_id", "step_number", "start_index", "episode_frame_index", "frame_index", "task",
                      r6(F.col("s_view")).alias("s_view"), r6(F.col("a_view")).alias("a_view"))


@register("sidecar_rejects", f"""
WITH {_MSG_CTE}, {_STEPS_SQL},
parts AS (SELECT DISTINCT recording_id, part, recording_id IN (SELECT recording_id FROM p) AS known FROM c)
SELECT recording_id, 'step_index' AS kind, part, pos, reason FROM rg WHERE reason IS NOT NULL
UNION ALL SELECT recording_id, 'step_index', part, pos, 'step is not an object' FROM c
  WHERE x = 7 AND recording_id % 11 <> 4 AND recording_id IN (SELECT recording_id FROM p)
UNION ALL SELECT recording_id, 'step_index', part, NULL, 'steps is not a list' FROM parts WHERE known AND recording_id % 11 = 4
UNION ALL SELECT recording_id, 'task_meta', part, NULL,
  CASE recording_id % 6 WHEN 3 THEN 'document is not an object' ELSE 'not a JSON document' END FROM parts WHERE recording_id % 6 IN (3, 4)
UNION ALL SELECT recording_id, kind, part, NULL, 'no recording' FROM parts, (VALUES ('step_index'), ('task_meta')) AS k(kind)
  WHERE NOT known AND NOT (kind = 'task_meta' AND recording_id % 6 IN (3, 4))""")
def sidecar_rejects(spark, sf_dir):
    """Every sidecar document and step that gives no episode, with its reason;
    sidecars whose number has no recording are among them."""
    return _episodes(spark, sf_dir)[3].select("recording_id", "kind", F.col("part").cast("long").alias("part"),
                                              F.col("pos").cast("long").alias("pos"), "reason")
