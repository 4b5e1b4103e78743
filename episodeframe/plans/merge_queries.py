"""Merge/publish queries (Entry B): many sources -> one renumbered dataset.

Mapping: task = ``o_orderpriority``; a source dataset = (task, customer
nation); episodes = orders in ``o_orderkey`` order; frames = line items in
``(l_linenumber, l_partkey, l_suppkey)`` order (line numbers repeat); state = [quantity, extendedprice, discount, tax],
action = [quantity, extendedprice * (1 - discount), tax, discount];
timestamp = line number.  Ten episodes share one local video file.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from episodeframe.operators import merge as M
from episodeframe.operators import stats as S
from episodeframe.functions.timeunits import floor_div
from episodeframe.operators.blocks import block_of, dense_index, tasks_for
from episodeframe.plans.catalog import r6, register
from episodeframe.session import cut_lineage
from episodeframe.sources.tables import table

EPISODES_PER_FILE = 10


def source_frames(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    f = (l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .select(F.col("o_orderpriority").alias("task"), F.col("c_nationkey").alias("nation"),
                 F.col("l_orderkey").alias("source_episode"), "l_linenumber", "l_partkey",
                 "l_suppkey", "l_returnflag",
                 F.col("l_linenumber").cast("double").alias("timestamp"),
                 F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax")
                 .cast("array<float>").alias("state"),
                 F.array(F.col("l_quantity"), F.col("l_extendedprice") * (1 - F.col("l_discount")),
                         F.col("l_tax"), F.col("l_discount")).cast("array<float>").alias("action")))
    return f


def tasks_table(frames):
    """K2: task_index in manifest order (sorted task names)."""
    t = M.first_seen_order(frames.select("task").distinct(), "task", "task", "task_index")
    return t.withColumn("task_index", F.col("task_index").cast("long"))


def merged(spark, sf_dir, f=None):
    f = f if f is not None else cut_lineage(source_frames(spark, sf_dir))  # the join runs once
    tasks = tasks_table(f)
    # tasks are numbered by name, so the episodes' order needs no task join before the numbering
    frames, episodes = M.renumber(f, ["source_episode"], ["l_linenumber", "l_partkey", "l_suppkey"],
                                  ["task", "nation", "source_episode"], materialize=False)
    return M.attach_task_index(frames, tasks), M.attach_task_index(episodes, tasks), tasks


def _vec(c, p):
    return [r6(F.col(c)[i]).alias(f"{p}{i}") for i in range(4)]


_MERGE_CTE = """
f AS (SELECT o.o_orderpriority AS task, c.c_nationkey AS nation, l.l_orderkey AS source_episode,
             l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag, CAST(l.l_linenumber AS DOUBLE) AS timestamp,
             [CAST(l_quantity AS REAL), CAST(l_extendedprice AS REAL), CAST(l_discount AS REAL),
              CAST(l_tax AS REAL)] AS state,
             [CAST(l_quantity AS REAL), CAST(l_extendedprice * (1 - l_discount) AS REAL),
              CAST(l_tax AS REAL), CAST(l_discount AS REAL)] AS action
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey),
t AS (SELECT task, CAST(row_number() OVER (ORDER BY task) - 1 AS BIGINT) AS task_index
      FROM (SELECT DISTINCT task FROM f)),
e0 AS (SELECT t.task_index, f.task, nation, source_episode, count(*) AS length
       FROM f JOIN t USING (task) GROUP BY ALL),
e AS (SELECT *, CAST(row_number() OVER (ORDER BY task_index, nation, source_episode) - 1 AS BIGINT) AS episode_index,
             CAST(coalesce(sum(length) OVER (ORDER BY task_index, nation, source_episode
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS dataset_from_index
      FROM e0)"""


def _vec_sql(c, p):
    return ", ".join(f"round(CAST({c}[{i + 1}] AS DOUBLE), 6) AS {p}{i}" for i in range(4))


@register("merge_renumber", f"""
WITH {_MERGE_CTE},
fr AS (SELECT f.*, e.episode_index, e.dataset_from_index, e.task_index,
              CAST(row_number() OVER (PARTITION BY f.source_episode ORDER BY f.l_linenumber, f.l_partkey, f.l_suppkey) - 1 AS BIGINT) AS frame_index
       FROM f JOIN e USING (source_episode))
SELECT episode_index, frame_index, dataset_from_index + frame_index AS "index", task_index, timestamp,
       {_vec_sql('state', 's')}, {_vec_sql('action', 'a')}
FROM fr""")
def merge_renumber(spark, sf_dir):
    """W6 + J11 + U1 + K1 shape: the published frames table."""
    frames, _, _ = merged(spark, sf_dir)
    return frames.select("episode_index", "frame_index", "index", "task_index", "timestamp",
                         *_vec("state", "s"), *_vec("action", "a"))


@register("merge_tasks", f"WITH {_MERGE_CTE} SELECT task_index, task FROM t")
def merge_tasks(spark, sf_dir):
    """K2: tasks table."""
    return tasks_table(source_frames(spark, sf_dir).select("task")).select("task_index", "task")


_FILES_CTE = f"""
se AS (SELECT *, row_number() OVER (PARTITION BY task_index, nation ORDER BY source_episode) - 1 AS src_ep FROM e),
lf AS (SELECT DISTINCT task_index, nation, src_ep // {EPISODES_PER_FILE} AS local_file_index FROM se),
gf AS (SELECT *, CAST(row_number() OVER (ORDER BY task_index, nation, local_file_index) - 1 AS BIGINT) AS file_index FROM lf)"""


@register("merge_episodes", f"""
WITH {_MERGE_CTE}, {_FILES_CTE}
SELECT se.episode_index, se.task, se.length, se.dataset_from_index,
       se.dataset_from_index + se.length AS dataset_to_index, gf.file_index AS video_file_index,
       format('videos/chunk-{{:03d}}/file-{{:03d}}.mp4', 0, gf.file_index) AS video_path
FROM se JOIN gf ON gf.task_index = se.task_index AND gf.nation = se.nation
     AND gf.local_file_index = se.src_ep // {EPISODES_PER_FILE}""")
def merge_episodes(spark, sf_dir):
    """K3 episodes table with W7 dense video file index, J12 mapping and
    F23 path template."""
    from episodeframe.functions.text import chunk_file_path
    _, eps, _ = merged(spark, sf_dir)
    se = dense_index(eps, ["task_index", "nation"], ["source_episode"], "src_ep",
                     block_col=block_of("source_episode", 1 << 20))
    se = se.withColumn("local_file_index", floor_div(F.col("src_ep"), EPISODES_PER_FILE))
    files = M.video_file_index(se.select("task_index", "nation", "local_file_index").distinct(),
                               ["task_index", "nation"])
    mapped, _ = M.map_video_files(se, files, ["task_index", "nation", "local_file_index"])
    return mapped.select("episode_index", "task", "length", "dataset_from_index", "dataset_to_index",
                         F.col("file_index").alias("video_file_index"),
                         chunk_file_path(F.lit(0), F.col("file_index"), "videos", "mp4").alias("video_path"))


@register("missing_camera_files", f"""
WITH {_MERGE_CTE}, {_FILES_CTE},
cam AS (SELECT DISTINCT se.task_index, se.nation, se.src_ep // {EPISODES_PER_FILE} AS local_file_index,
               f.l_returnflag AS camera
        FROM se JOIN f USING (source_episode)),
base AS (SELECT DISTINCT task_index, nation, local_file_index FROM cam WHERE camera = 'A'),
want AS (SELECT b.*, c.camera FROM base b CROSS JOIN (VALUES ('A'), ('N'), ('R')) c(camera))
SELECT * FROM want w WHERE NOT EXISTS (
  SELECT 1 FROM cam c WHERE c.task_index = w.task_index AND c.nation = w.nation
    AND c.local_file_index = w.local_file_index AND c.camera = w.camera)""")
def missing_camera_files_q(spark, sf_dir):
    """Camera files (cameras = return flags present in a file's
    episodes) missing for a file index the first camera has."""
    f = cut_lineage(source_frames(spark, sf_dir))
    _, eps, _ = merged(spark, sf_dir, f)
    se = dense_index(eps, ["task_index", "nation"], ["source_episode"], "src_ep",
                     block_col=block_of("source_episode", 1 << 20))
    # the flags of an episode need no frame numbers; both sides are dealt by the number of frames
    n = max(tasks_for(spark, f.count()), int(spark.conf.get("spark.sql.shuffle.partitions")))
    cam = (f.select("source_episode", F.col("l_returnflag").alias("camera")).repartition(n, "source_episode").distinct()
           .join(se.select("source_episode", "task_index", "nation", "src_ep").repartition(n, "source_episode"), "source_episode")
           .select("task_index", "nation",
                   floor_div(F.col("src_ep"), EPISODES_PER_FILE).alias("local_file_index"),
                   "camera"))
    return M.missing_camera_files(cam, ["A", "N", "R"], "A", ["task_index", "nation"])


@register("dataset_totals", f"""
WITH {_MERGE_CTE}
SELECT (SELECT count(*) FROM e) AS total_episodes, (SELECT count(*) FROM f) AS total_frames,
       (SELECT count(*) FROM t) AS total_tasks""")
def dataset_totals(spark, sf_dir):
    """Info.json totals."""
    frames, eps, tasks = merged(spark, sf_dir)
    return S.dataset_totals(frames, eps, tasks)


@register("episode_summary", f"""
WITH {_MERGE_CTE},
fr AS (SELECT f.*, e.episode_index, e.dataset_from_index,
              row_number() OVER (PARTITION BY f.source_episode
                                 ORDER BY f.l_linenumber, f.l_partkey, f.l_suppkey) - 1 AS frame_index
       FROM f JOIN e USING (source_episode))
SELECT episode_index, count(*) AS length, min(dataset_from_index + frame_index) AS dataset_from_index,
       max(dataset_from_index + frame_index) + 1 AS dataset_to_index,
       arg_min(timestamp, frame_index) AS from_timestamp, arg_max(timestamp, frame_index) AS to_timestamp,
       arg_max(timestamp, frame_index) - arg_min(timestamp, frame_index) AS duration
FROM fr GROUP BY episode_index""")
def episode_summary_q(spark, sf_dir):
    """Per-episode summary of the merged frames."""
    frames, _, _ = merged(spark, sf_dir)
    return S.episode_summary(frames)


_STATS_SQL_BODY = """
lv AS (SELECT task, nation, 'observation.state' AS feature, CAST(p - 1 AS INTEGER) AS pos,
              CAST(state[p] AS DOUBLE) AS value FROM f, range(1, 5) r(p)
       UNION ALL
       SELECT task, nation, 'action', CAST(p - 1 AS INTEGER), CAST(action[p] AS DOUBLE) FROM f, range(1, 5) r(p))"""


@register("vector_stats", f"""
WITH {_MERGE_CTE}, {_STATS_SQL_BODY}
SELECT feature, pos, count(value) AS count, round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std
FROM lv GROUP BY feature, pos""")
def vector_stats_q(spark, sf_dir):
    """A5: elementwise min/max/mean/population std of state and action
    (statistics need the frames, not their new numbering)."""
    frames = source_frames(spark, sf_dir)
    st = S.vector_stats(frames, ["state", "action"])
    return st.select(F.when(F.col("feature") == "state", "observation.state").otherwise(F.col("feature"))
                     .alias("feature"), "pos", "count", r6(F.col("min")).alias("min"),
                     r6(F.col("max")).alias("max"), r6(F.col("mean")).alias("mean"),
                     r6(F.col("std")).alias("std"))


@register("stats_merge", f"""
WITH {_MERGE_CTE}, {_STATS_SQL_BODY},
part AS (SELECT task, nation, feature, pos, count(value) AS count, avg(value) AS mean,
                stddev_pop(value) AS std, min(value) AS min, max(value) AS max
         FROM lv GROUP BY ALL),
m AS (SELECT feature, pos, sum(count) AS count, sum(count * mean) / sum(count) AS mean,
             sum(count * (std * std + mean * mean)) / sum(count) AS m2, min(min) AS min, max(max) AS max
      FROM part GROUP BY feature, pos)
SELECT feature, pos, CAST(count AS BIGINT) AS count, round(mean, 6) AS mean,
       round(sqrt(greatest(0.0, m2 - mean * mean)), 6) AS std, round(min, 6) AS min, round(max, 6) AS max
FROM m""")
def stats_merge(spark, sf_dir):
    """Per-source partial stats (one source = task x nation) merged
    count-weighted; equals A5 over the union."""
    fr = source_frames(spark, sf_dir).withColumnRenamed("state", "observation.state")
    part = S.vector_stats(fr, ["observation.state", "action"], ["task", "nation"])
    m = S.merge_stats(part)
    return m.select("feature", "pos", F.col("count").cast("long").alias("count"),
                    *[r6(F.col(c)).alias(c) for c in ["mean", "std", "min", "max"]])


_QUANTILES_SQL = ", ".join(f"quantile_cont(value, {p}) AS {q}" for q, p in S.QUANTILES.items())


@register("stats_quantiles", f"""
WITH {_MERGE_CTE}, {_STATS_SQL_BODY},
x AS (SELECT feature, pos, {_QUANTILES_SQL} FROM lv GROUP BY feature, pos)
SELECT feature, pos, {", ".join(f"round({q}, 6) AS {q}" for q in S.QUANTILES)} FROM x""")
def stats_quantiles(spark, sf_dir):
    """Exact quantiles over all sources, by rank refinement."""
    fr = source_frames(spark, sf_dir).withColumnRenamed("state", "observation.state")
    q = S.exact_quantiles(S.long_vectors(fr, ["observation.state", "action"]), ["feature", "pos"])
    return q.select("feature", "pos", *[r6(F.col(n)).alias(n) for n in S.QUANTILES])


@register("stats_merge_quantiles", f"""
WITH {_MERGE_CTE}, {_STATS_SQL_BODY},
part AS (SELECT task, nation, feature, pos, count(value) AS n, {_QUANTILES_SQL} FROM lv GROUP BY ALL)
SELECT feature, pos, {", ".join(f"round(CASE WHEN bool_and({q} IS NOT NULL) THEN sum(n * {q}) / sum(n) END, 6) AS {q}" for q in S.QUANTILES)}
FROM part GROUP BY feature, pos""")
def stats_merge_quantiles(spark, sf_dir):
    """Exact quantiles of each source merged by count-weighted mean,
    present only when every source has them."""
    fr = source_frames(spark, sf_dir).withColumnRenamed("state", "observation.state")
    part = S.vector_stats(fr, ["observation.state", "action"], ["task", "nation"], quantiles=True, exact=True)
    m = S.merge_stats(part)
    return m.select("feature", "pos", *[r6(F.col(q)).alias(q) for q in S.QUANTILES])
