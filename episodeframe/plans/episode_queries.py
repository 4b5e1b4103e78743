"""Episode and task queries.

Steps come from ``conversations``: recording = ``conv_id`` (matched to the
events user of the same id), step number = ``turn``, action = ``text``;
step bounds are derived from the recording's sampling window (start of
step i = window start + 2 days * i, three days long), written in seconds
and milliseconds so they pass through the unit normalisation (P13).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from episodeframe.functions import text as T
from episodeframe.functions.timeunits import normalize_to_ns
from episodeframe.operators import align as A
from episodeframe.operators import episodes as EP
from episodeframe.operators.actions import next_state
from episodeframe.operators.blocks import BLK
from episodeframe.plans.catalog import _MSG_CTE, EVENT_STEP_NS, EVENT_STREAMS, r6, register
from episodeframe.session import cut_lineage
from episodeframe.sources.tables import events_as_messages, table

DAY_NS = 86_400_000_000_000
FALLBACK_TASK = "events user task"
# frames of one block, from the grid to the next state: an episode is compared with the frames of the blocks it touches
STEP_BLOCK = 1 << 14


def conversation_steps(spark, sf_dir, params):
    c = table(spark, sf_dir, "conversations")
    s = (c.join(params.select(F.col("recording_id").alias("conv_id"), F.col("start_ns").alias("_w0")),
                "conv_id")
         .select(F.col("conv_id").alias("recording_id"), F.col("turn").alias("step_number"),
                 F.col("text"),
                 ((F.col("_w0") + F.col("turn") * 2 * DAY_NS) / F.lit(1e9)).alias("start_raw"),
                 ((F.col("_w0") + F.col("turn") * 2 * DAY_NS + 3 * DAY_NS) / F.lit(1e6)).alias("end_raw")))
    return (s.withColumn("start_ns", normalize_to_ns("start_raw"))
            .withColumn("end_ns", normalize_to_ns("end_raw"))
            .withColumn("task", T.build_task_name(None, FALLBACK_TASK, step_action=F.col("text"))))


_NORM_SQL = """CAST(CASE WHEN abs({x}) >= 1e17 THEN trunc({x}) WHEN abs({x}) >= 1e14 THEN trunc({x} * 1e3)
       WHEN abs({x}) >= 1e11 THEN trunc({x} * 1e6) ELSE trunc({x} * 1e9) END AS BIGINT)"""


@register("episode_steps", f"""
WITH {_MSG_CTE},
hit AS (SELECT g.recording_id, g.frame_index, m.value, row_number() OVER (
          PARTITION BY g.recording_id, g.frame_index ORDER BY m.ts_ns DESC, m.seq DESC) AS rn
        FROM grid g JOIN m ON m.recording_id = g.recording_id AND m.ts_ns <= g.t_ns AND m.stream = 'click'),
fr AS (SELECT g.recording_id, g.frame_index, round(CAST(CAST(coalesce(h.value, 0.0) AS REAL) AS DOUBLE), 6) AS s_click
       FROM grid g LEFT JOIN hit h ON h.recording_id = g.recording_id AND h.frame_index = g.frame_index AND h.rn = 1),
p AS (SELECT recording_id, start_ns AS t0, 3600000000000 AS st, (end_ns - start_ns) // 3600000000000 + 1 AS n FROM win),
s0 AS (SELECT c.conv_id AS recording_id, c.turn AS step_number, c.text, p.t0, p.st, p.n,
              (p.t0 + c.turn * 2 * {DAY_NS}) / 1e9 AS start_raw,
              (p.t0 + c.turn * 2 * {DAY_NS} + 3 * {DAY_NS}) / 1e6 AS end_raw
       FROM conversations c JOIN p ON p.recording_id = c.conv_id),
s1 AS (SELECT *, {_NORM_SQL.format(x='start_raw')} AS start_ns, {_NORM_SQL.format(x='end_raw')} AS end_ns,
              t0 + (n - 1) * st AS tl,
              CASE WHEN length(trim(text)) > 0 THEN text ELSE '{FALLBACK_TASK}' END AS task FROM s0),
s2 AS (SELECT *, (greatest(start_ns, t0) - t0 + st - 1) // st AS start_index,
              (least(end_ns, tl) - t0) // st + 1 AS end_index FROM s1
       WHERE end_ns > t0 AND start_ns < tl AND end_ns > start_ns),
us AS (SELECT recording_id, step_number, start_index, end_index, task FROM s2 WHERE end_index > start_index),
sp AS (SELECT * FROM us UNION ALL
       SELECT recording_id, NULL, 0, n, '{FALLBACK_TASK}' FROM p
       WHERE recording_id NOT IN (SELECT recording_id FROM us)),
ep AS (SELECT sp.recording_id, sp.step_number, sp.task, sp.start_index, sp.end_index,
              unnest(range(sp.start_index, sp.end_index)) AS frame_index FROM sp),
j AS (SELECT ep.*, ep.frame_index - ep.start_index AS episode_frame_index, fr.s_click
      FROM ep JOIN fr ON fr.recording_id = ep.recording_id AND fr.frame_index = ep.frame_index)
SELECT recording_id, step_number, episode_frame_index, frame_index, task, s_click,
       CASE WHEN lead(episode_frame_index) OVER w IS NULL THEN s_click ELSE lead(s_click) OVER w END AS a_click
FROM j WINDOW w AS (PARTITION BY recording_id, start_index, end_index, step_number, task ORDER BY episode_frame_index)""")
def episode_steps(spark, sf_dir):
    """J6 interval cut of the hourly frames by conversation steps (overlapping,
    so frames repeat), P13 stamps, P11 task text, W1 next state per episode."""
    msgs = events_as_messages(spark, sf_dir, EVENT_STREAMS)
    params = cut_lineage(A.grid_params(A.sampling_window(msgs), EVENT_STEP_NS))
    ranges = EP.step_ranges_on_grid(conversation_steps(spark, sf_dir, params), params)
    specs = cut_lineage(EP.episode_specs(ranges, params, F.lit(FALLBACK_TASK)))
    # dealt by recording and block before the frames exist; grid, alignment, cut and next state run where they are made
    n = EP.episode_tasks(specs, least=A.frame_tasks(params))
    frames = A.align_frames(msgs, A.frame_grid(params, partitions=n, block=STEP_BLOCK), A.AlignSpec({"click": A.ASOF}), params=params,
                            block=STEP_BLOCK, keep_block=True, partitions=n)
    frames = frames.select("recording_id", "frame_index", BLK,
                           F.coalesce(F.col("click"), F.lit(0.0)).cast("float").alias("s_click"))
    eps = EP.cut_episodes(frames, specs, partitions=n, block=STEP_BLOCK)
    eps = next_state(eps, ["recording_id", "start_index", "end_index", "step_number", "task"], "episode_frame_index", {"a_click": "s_click"})
    return eps.select("recording_id", "step_number", "episode_frame_index", "frame_index", "task",
                      r6(F.col("s_click")).alias("s_click"), r6(F.col("a_click")).alias("a_click"))


@register("episode_steps_unmatched", f"""
WITH {_MSG_CTE}
SELECT conv_id AS recording_id, turn AS step_number,
       CASE WHEN conv_id IN (SELECT recording_id FROM m) THEN 'no sampling window' ELSE 'no recording' END AS reason
FROM conversations WHERE conv_id NOT IN (SELECT recording_id FROM win)""")
def episode_steps_unmatched(spark, sf_dir):
    """Steps that ``episode_steps`` cannot cut: their conversation has no event
    recording, or its streams have no common window."""
    msgs = events_as_messages(spark, sf_dir, EVENT_STREAMS)
    windows = A.grid_params(A.sampling_window(msgs), EVENT_STEP_NS).select(F.col("recording_id").alias("conv_id"))
    known = msgs.select(F.col("recording_id").alias("conv_id")).distinct().withColumn("known", F.lit(True))
    lost = table(spark, sf_dir, "conversations").join(windows, "conv_id", "left_anti").join(known, "conv_id", "left")
    return lost.select(F.col("conv_id").alias("recording_id"), F.col("turn").alias("step_number"),
                       F.when(F.col("known"), "no sampling window").otherwise("no recording").alias("reason"))


def conversation_meta(spark, sf_dir):
    """Task metadata per conversation as a MAP: taskName = first user turn,
    actionDesc = first assistant turn (whole texts)."""
    c = table(spark, sf_dir, "conversations")
    agg = c.groupBy("conv_id").agg(
        F.min_by(F.col("text"), F.when(F.col("role") == "user", F.col("turn"))).alias("u"),
        F.min_by(F.col("text"), F.when(F.col("role") == "assistant", F.col("turn"))).alias("a"))
    return agg.select("conv_id", F.map_from_arrays(
        F.array(F.lit("taskName"), F.lit("actionDesc")), F.array("u", "a")).alias("task_meta"))


@register("step_action_lookup", """
WITH s AS (SELECT conv_id, turn AS pos, turn // 2 AS number,
                  CASE WHEN length(trim(text)) > 0 THEN trim(text) END AS a FROM conversations)
SELECT conv_id AS recording_id, number AS step_number, arg_min(a, pos) AS meta_step_action
FROM s WHERE a IS NOT NULL GROUP BY 1, 2""")
def step_action_lookup(spark, sf_dir):
    """Step number (= turn // 2, so numbers repeat) -> first listed
    non-blank action."""
    c = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("recording_id"), F.col("turn").alias("pos"),
        F.floor(F.col("turn") / 2).cast("long").alias("number"), F.col("text").alias("action"))
    return EP.step_actions_from_meta(c)


@register("task_names", """
WITH meta AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS u,
                     arg_min(text, turn) FILTER (WHERE role = 'assistant') AS a
              FROM conversations GROUP BY 1),
j8 AS (SELECT conv_id, turn // 2 AS number,
              arg_min(trim(text), turn) AS msa FROM conversations
       WHERE length(trim(text)) > 0 GROUP BY 1, 2),
st AS (SELECT c.conv_id, c.turn, c.turn // 2 AS number,
              CASE WHEN c.role = 'user' THEN c.text END AS step_action FROM conversations c),
x AS (SELECT st.*, j8.msa,
             CASE WHEN length(trim(meta.u)) > 0 THEN trim(meta.u) END AS title,
             CASE WHEN length(trim(meta.a)) > 0 THEN trim(meta.a) END AS act
      FROM st LEFT JOIN j8 ON j8.conv_id = st.conv_id AND j8.number = st.number
      LEFT JOIN meta ON meta.conv_id = st.conv_id)
SELECT conv_id, turn, coalesce(CASE WHEN length(trim(step_action)) > 0 THEN step_action END, msa,
       CASE WHEN title IS NOT NULL AND act IS NOT NULL THEN title || ': ' || act END,
       title, act, 'unknown') AS task
FROM x""")
def task_names(spark, sf_dir):
    """P11 full chain: user turns carry a step action; assistant turns fall
    back to the task-meta step list (J8), then ``title: action``."""
    c = table(spark, sf_dir, "conversations")
    steps = c.select("conv_id", "turn", F.floor(F.col("turn") / 2).cast("long").alias("step_number"),
                     F.when(F.col("role") == "user", F.col("text")).alias("step_action"))
    j8 = EP.step_actions_from_meta(
        c.select(F.col("conv_id").alias("recording_id"), F.col("turn").alias("pos"),
                 F.floor(F.col("turn") / 2).cast("long").alias("number"), F.col("text").alias("action")))
    x = (steps.join(j8.withColumnRenamed("recording_id", "conv_id"), ["conv_id", "step_number"], "left")
         .join(conversation_meta(spark, sf_dir), "conv_id", "left"))
    return x.select("conv_id", "turn", T.build_task_name(
        None, "unknown", meta=F.col("task_meta"), step_action=F.col("step_action"),
        meta_step_action=F.col("meta_step_action")).alias("task"))


@register("platform_task_desc", """
WITH d AS (SELECT doc_id, CASE WHEN toxic IS NULL THEN text END AS direct, source, lang
           FROM documents LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id))
SELECT doc_id, coalesce(CASE WHEN length(trim(direct)) > 0 THEN trim(direct) END,
                        CASE WHEN concat_ws('；', nullif(trim(source), ''), nullif(trim(lang), '')) <> ''
                             THEN concat_ws('；', nullif(trim(source), ''), nullif(trim(lang), '')) END)
       AS task_description,
       regexp_replace(trim(source), '[^\\p{L}\\p{N}_-]', '_', 'g') AS safe_source
FROM d""")
def platform_task_desc(spark, sf_dir):
    """P12 task description from a raw task map (the whole text of documents
    without a label row, else name / action joined by '；') and P21 safe ids."""
    labelled = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    d = table(spark, sf_dir, "documents").join(labelled, "doc_id", "left")
    raw = F.create_map(F.lit("task_desc"), F.when(F.col("toxic").isNull(), F.col("text")),
                       F.lit("taskName"), F.col("source"), F.lit("actionDesc"), F.col("lang"))
    return d.select("doc_id", T.platform_task_description(raw).alias("task_description"),
                    T.safe_id(F.col("source")).alias("safe_source"))


@register("timestamp_units", f"""
WITH e AS (SELECT event_id, event_type, epoch_us(ts) * 1000 AS ts_ns, props FROM events),
r AS (SELECT event_id, CASE event_type
        WHEN 'signup' THEN CAST(ts_ns AS VARCHAR)
        WHEN 'purchase' THEN CAST(ts_ns // 1000 AS VARCHAR)
        WHEN 'error' THEN CAST(ts_ns // 1000000 AS VARCHAR) || '.5'
        WHEN 'view' THEN CAST(ts_ns // 1000000000 AS VARCHAR) || '.25'
        ELSE props END AS raw FROM e),
x AS (SELECT event_id, raw, TRY_CAST(raw AS DOUBLE) AS v FROM r)
SELECT event_id, raw, CASE WHEN v IS NULL OR isnan(v) OR isinf(v) THEN NULL ELSE {_NORM_SQL.format(x='v')} END AS ts_ns
FROM x""")
def timestamp_units(spark, sf_dir):
    """P13 over raw stamps written in ns, us, ms, s and unparseable text."""
    e = events_as_messages(spark, sf_dir)
    ts = F.col("ts_ns")
    raw = (F.when(F.col("stream") == "signup", ts.cast("string"))
           .when(F.col("stream") == "purchase", F.call_function("div", ts, F.lit(1000)).cast("string"))
           .when(F.col("stream") == "error",
                 F.concat(F.call_function("div", ts, F.lit(1_000_000)).cast("string"), F.lit(".5")))
           .when(F.col("stream") == "view",
                 F.concat(F.call_function("div", ts, F.lit(1_000_000_000)).cast("string"), F.lit(".25")))
           .otherwise(F.col("payload")))
    return e.select(F.col("seq").alias("event_id"), raw.alias("raw")).withColumn(
        "ts_ns", normalize_to_ns("raw"))


@register("episode_selection", """
WITH t AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS episode_index FROM orders)
SELECT o_orderkey, CAST(episode_index AS BIGINT) AS episode_index FROM t
WHERE episode_index IN (0, 3, 5, 6, 7, 8, 9, 12, 13, 14, 100, 101, 102, 103, 104, 105)""")
def episode_selection_q(spark, sf_dir):
    """P5: "0,3,5-9,12-14,100-105" selection over orders numbered 0.. by key."""
    from episodeframe.operators.blocks import block_of, dense_index
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    o = dense_index(o, [], ["o_orderkey"], "episode_index", block_col=block_of("o_orderkey", 1 << 20))
    return EP.select_episodes(o, "0,3,5-9,12-14, 100-105")
