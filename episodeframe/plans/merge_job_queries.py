"""The merge job over data sets written from ``lineitem`` (Entry B), and
per-camera video ranges (K3, K5).

A source is (task, customer nation) as in ``merge_queries``; its episodes are
orders, its folder holds frames, episodes and the list of its video files, and a
manifest names the folders per task.  Some sources are broken on purpose, by
number, and one that does not exist is named.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from episodeframe.operators import merge as M
from episodeframe.operators import videos as V
from episodeframe.operators.blocks import block_of, dense_index, tasks_for
from episodeframe.plans import merge_job as J
from episodeframe.plans.catalog import r6, register
from episodeframe.plans.merge_queries import _MERGE_CTE, _vec, _vec_sql, tasks_table
from episodeframe.session import cut_lineage, delete_folder, ensure_checkpoint_dir, release_tables, shuffles_removed, tables_written
from episodeframe.sources.files import read_manifest, read_published_frames
from episodeframe.sources.tables import table

CAMERAS = ["front", "wrist"]
FPS, FRAMES_PER_FILE, WIDTH = 10, 40, 4
SRC = ["task_index", "nation"]
LINE_COLUMNS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LAYOUT = J.Layout("table=data", "table=episodes", "table=video_files")

# sources that are broken: task, remainder of the nation's number by 8
BAD_WIDTH, NO_DATA, GHOST_EPISODE, NO_FILE = (1, 7), (2, 3), (3, 5), (0, 6)


def _is(kind: tuple[int, int]) -> F.Column:
    return (F.col("task_index") == kind[0]) & (F.col("nation") % 8 == kind[1])


def _owners(spark, sf_dir):
    """Per (task, nation, order) with line items: how often the source holds each
    of them (``copies``) and how many frames that makes.  Orders are joined to
    their customers before the line items, which are only counted."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_episode"), "o_custkey", F.col("o_orderpriority").alias("task"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    own = o.join(c, o.o_custkey == c.c_custkey).groupBy("task", "nation", "source_episode").agg(F.count(F.lit(1)).alias("copies"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("source_episode")).agg(F.count(F.lit(1)).alias("lines"))
    return own.join(lines, "source_episode").select(
        "task", "nation", "source_episode", "copies", (F.col("copies") * F.col("lines")).alias("length"))


def _indexed(spark, sf_dir, eps, n_frames: int):
    """Frames of ``merge_queries.source_frames`` with their episode's number and
    their position in it; the line items are shuffled once and carry their own
    columns, vectors are made from them later."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_episode"), *LINE_COLUMNS)
    # an order that several sources hold gives each of them its line items, each position to one of the copies
    per = eps.groupBy("source_episode").agg(F.array_sort(F.collect_list(F.struct(*SRC, "copies", "episode_index"))).alias("_in"))
    copies = F.flatten(F.transform("_in", lambda e: F.array_repeat(F.struct(*[e[k].alias(k) for k in SRC]), e["copies"].cast("int"))))
    per = per.select("source_episode", copies.alias("_copies"), F.transform("_in", lambda e: e["episode_index"]).alias("_episodes"))
    rows = dense_index(lines, ["source_episode"], ["l_linenumber", "l_partkey", "l_suppkey"], "_line", block_col=block_of("l_linenumber", 1 << 16),
                       attach=per, partitions=tasks_for(spark, n_frames))
    rows = rows.select(*LINE_COLUMNS, "_line", F.size("_copies").alias("_n"), "_episodes", F.posexplode("_copies").alias("_copy", "_of"))
    return rows.select(*LINE_COLUMNS, *[F.col("_of")[k].alias(k) for k in SRC],
                       (F.col("_line") * F.col("_n") + F.col("_copy")).alias("index"), F.explode("_episodes").alias("episode_index"))


def write_sources(spark, sf_dir: str, base: str) -> str:
    """Write the sources below ``base``; returns the manifest's path."""
    since = tables_written()
    with shuffles_removed(spark):
        path = _write_sources(spark, sf_dir, base)
    release_tables(spark, since)
    return path


def _write_sources(spark, sf_dir: str, base: str) -> str:
    own = cut_lineage(_owners(spark, sf_dir))
    own = M.attach_task_index(own, tasks_table(own))
    n_frames = own.agg(F.sum("length")).first()[0]
    eps = own.groupBy(*SRC, "source_episode").agg(F.sum("length").alias("length"), F.sum("copies").alias("copies"))
    eps = cut_lineage(dense_index(eps, SRC, ["source_episode"], "episode_index", block_col=block_of("source_episode", 1 << 20)))
    name = F.format_string("%d-%02d", F.col("task_index").cast("int"), F.col("nation").cast("int"))

    def write(df, table):
        df.withColumn("source", name).withColumn("table", F.lit(table)).drop(*SRC).write.mode("append").partitionBy("source", "table").parquet(base)

    # every table in ranges of its sources: a task writes files of a few sources, not a file of each
    rows = _indexed(spark, sf_dir, eps, n_frames).where(~_is(NO_DATA)).drop("l_partkey", "l_suppkey")
    rows = rows.repartitionByRange(tasks_for(spark, n_frames), *SRC, "episode_index")
    state = F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").cast("array<float>")
    action = F.array(F.col("l_quantity"), F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("l_tax"), F.col("l_discount")).cast("array<float>")
    action = F.when(_is(BAD_WIDTH) & (F.col("l_linenumber") == 2), F.slice(action, 1, 3)).otherwise(action)
    write(rows.select(*SRC, F.col("l_linenumber").cast("double").alias("timestamp"), "episode_index", "index",
                      state.alias("observation.state"), action.alias("action")), "data")
    # every camera has the episodes' frames, so their ranges are computed for one of them
    ranges = V.camera_ranges(V.camera_rows(eps.select(*SRC, "episode_index", "length"), CAMERAS[:1]), FPS, FRAMES_PER_FILE, SRC)
    ranges = cut_lineage(ranges).withColumn("camera", F.explode(F.array(*map(F.lit, CAMERAS))))
    listed = eps.select(*SRC, "episode_index", "length").join(V.wide(ranges, CAMERAS, SRC), [*SRC, "episode_index"])
    ghost = listed.where(_is(GHOST_EPISODE) & (F.col("episode_index") == 0)).withColumn("episode_index", F.lit(1 << 40))
    write(listed.unionByName(ghost).repartitionByRange(*SRC, "episode_index"), "episodes")
    files = V.video_files(ranges, SRC).where(~(_is(NO_FILE) & (F.col("camera") == "wrist") & (F.col("file_index") == 0)))
    write(files.repartitionByRange(*SRC, "file_index"), "video_files")

    # the manifest: per task its folders by nation, as text or as objects
    folder = F.concat(F.lit("source="), name)
    entry = F.when(F.col("nation") % 2 == 0, F.to_json(F.struct(F.concat(F.lit("raw/"), folder, F.lit("/")).alias("path")))).otherwise(
        F.concat(F.lit('"'), folder, F.lit('"')))
    files = F.array_sort(F.collect_list(F.struct("nation", entry.alias("entry"))))
    tasks = (own.select(*SRC, "task").distinct().groupBy("task_index", "task")  # one row per task, an entry per nation
             .agg(F.array_join(F.transform(files, lambda x: x["entry"]), ",").alias("files")).orderBy("task_index").collect())
    text = ",".join('{"task_id":"t%d","task":%s,"files":[%s%s]}' % (
        t.task_index, json.dumps(t.task), t.files, ',"source=none"' if t.task_index == 4 else "") for t in tasks)
    path = f"{base}-manifest"
    spark.createDataFrame([('{"tasks":[' + text + "]}",)], "value string").coalesce(1).write.text(path)
    return path


def _merged(spark, sf_dir):
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/merge/{uuid.uuid4().hex}"
    manifest = read_manifest(spark, write_sources(spark, sf_dir, base))
    return J.merge_published(spark, manifest, base, WIDTH, CAMERAS, strict=False, layout=LAYOUT), base


def _case(kind: tuple[int, int]) -> str:
    return f"task_index = {kind[0]} AND nation % 8 = {kind[1]}"


_JOB_SQL = f"""
src AS (SELECT DISTINCT e0.task_index, e0.task, e0.nation FROM e0),
pos AS (SELECT *, CAST(row_number() OVER (PARTITION BY task_index ORDER BY nation) - 1 AS INTEGER) AS file_index,
               ({_case(BAD_WIDTH)}) AND EXISTS (SELECT 1 FROM f WHERE f.task = src.task AND f.nation = src.nation AND l_linenumber = 2) AS wide,
               ({_case(NO_DATA)}) AS gone, ({_case(GHOST_EPISODE)}) AS ghost, ({_case(NO_FILE)}) AS lost FROM src),
ok AS (SELECT * FROM pos WHERE NOT (wide OR gone OR ghost OR lost)),
e1 AS (SELECT e0.*, row_number() OVER (PARTITION BY e0.task_index, e0.nation ORDER BY source_episode) - 1 AS local_ep,
              coalesce(sum(length) OVER (PARTITION BY e0.task_index, e0.nation ORDER BY source_episode ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
       FROM e0 JOIN ok USING (task_index, nation)),
e2 AS (SELECT *, s // {FRAMES_PER_FILE} AS local_file,
              CAST(row_number() OVER (ORDER BY task_index, nation, source_episode) - 1 AS BIGINT) AS new_ep,
              CAST(coalesce(sum(length) OVER (ORDER BY task_index, nation, source_episode ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first
       FROM e1),
fl AS (SELECT task_index, nation, local_file, min(s) AS f0, CAST(row_number() OVER (ORDER BY task_index, nation, local_file) - 1 AS BIGINT) AS file_index
       FROM e2 GROUP BY 1, 2, 3),
e3 AS (SELECT e2.*, fl.file_index, (s - f0) / {FPS}.0 AS ft, (s - f0 + length) / {FPS}.0 AS tt FROM e2 JOIN fl USING (task_index, nation, local_file))"""


@register("merge_job_frames", f"""
WITH {_MERGE_CTE}, {_JOB_SQL},
fr AS (SELECT f.*, e3.new_ep, e3.first, e3.task_index, row_number() OVER (PARTITION BY f.source_episode ORDER BY f.l_linenumber, f.l_partkey, f.l_suppkey) - 1 AS k
       FROM f JOIN e3 ON e3.source_episode = f.source_episode)
SELECT new_ep AS episode_index, CAST(k AS BIGINT) AS frame_index, CAST(first + k AS BIGINT) AS "index", task_index, timestamp,
       {_vec_sql('state', 's')}, {_vec_sql('action', 'a')} FROM fr""")
def merge_job_frames(spark, sf_dir):
    """Sources written, merged, published and read back."""
    m, base = _merged(spark, sf_dir)
    root = f"{base}-merged"
    J.write_merged(m, root, FPS, WIDTH)
    delete_folder(spark, base)  # the sources, which only this merge reads
    return read_published_frames(spark, root).withColumnRenamed("observation.state", "state").select(
        "episode_index", "frame_index", "index", "task_index", "timestamp", *_vec("state", "s"), *_vec("action", "a"))


def _camera_sql(c: str) -> str:
    return (f"file_index // {V.CHUNK_FILES} AS \"videos/{c}/chunk_index\", file_index AS \"videos/{c}/file_index\", "
            f"round(ft, 6) AS \"videos/{c}/from_timestamp\", round(tt, 6) AS \"videos/{c}/to_timestamp\"")


@register("merge_job_episodes", f"""
WITH {_MERGE_CTE}, {_JOB_SQL}
SELECT new_ep AS episode_index, task, length, first AS dataset_from_index, first + length AS dataset_to_index,
       {", ".join(map(_camera_sql, CAMERAS))} FROM e3""")
def merge_job_episodes(spark, sf_dir):
    """Episodes of the merged set with their places in the cameras' files."""
    m, _ = _merged(spark, sf_dir)
    return m.episodes.select("episode_index", "task", "length", "dataset_from_index", "dataset_to_index", *[
        (r6(F.col(f"`{V.column(c, f)}`")) if f.endswith("timestamp") else F.col(f"`{V.column(c, f)}`")).alias(V.column(c, f))
        for c in CAMERAS for f in V.FIELDS])


_FILE = "printf('source=%d-%02d', task_index, nation)"


@register("merge_job_rejects", f"""
WITH {_MERGE_CTE}, {_JOB_SQL},
p AS (SELECT *, CASE WHEN nation % 2 = 0 THEN 'raw/' || {_FILE} || '/' ELSE {_FILE} END AS file FROM pos)
SELECT task_index::BIGINT AS task_index, file_index::BIGINT AS file_index, file, 'vector width differs' AS reason,
       (SELECT count(*) FROM f WHERE f.task = p.task AND f.nation = p.nation AND l_linenumber = 2) AS n FROM p WHERE wide
UNION ALL SELECT task_index, file_index, file, 'no data rows', 0 FROM p WHERE gone
UNION ALL SELECT task_index, file_index, file, 'episode without data rows', 1 FROM p WHERE ghost
UNION ALL SELECT task_index, file_index, file, 'video file missing', 1 FROM p WHERE lost
UNION ALL SELECT 4, (SELECT count(*) FROM pos WHERE task_index = 4), 'source=none', 'source not found', 0 WHERE EXISTS (SELECT 1 FROM pos WHERE task_index = 4)""")
def merge_job_rejects(spark, sf_dir):
    """Sources left out, with the reason and how many rows are at fault."""
    return _merged(spark, sf_dir)[0].rejects.select(F.col("task_index").cast("long").alias("task_index"),
                                                    F.col("file_index").cast("long").alias("file_index"), "file", "reason", "n")


@register("merge_job_lineage", f"""
WITH {_MERGE_CTE}, {_JOB_SQL},
p AS (SELECT task_index, nation, file_index, task, CASE WHEN nation % 2 = 0 THEN 'raw/' || {_FILE} || '/' ELSE {_FILE} END AS file FROM pos
      UNION ALL SELECT 4, NULL, (SELECT count(*) FROM pos WHERE task_index = 4), max(task), 'source=none' FROM pos WHERE task_index = 4 HAVING count(*) > 0),
g AS (SELECT task_index, nation, count(*) AS n_episodes, CAST(sum(length) AS BIGINT) AS n_frames, min(new_ep) AS from_episode, min(first) AS dataset_from_index,
             max(first + length) AS dataset_to_index FROM e2 GROUP BY 1, 2)
SELECT p.task_index::BIGINT AS task_index, file_index::BIGINT AS file_index, 't' || p.task_index AS task_id, task, file,
       n_episodes, n_frames, from_episode, dataset_from_index, dataset_to_index
FROM p LEFT JOIN g ON g.task_index = p.task_index AND g.nation = p.nation""")
def merge_job_lineage(spark, sf_dir):
    """K6: every source of the manifest and the range it became."""
    m = _merged(spark, sf_dir)[0].lineage
    return m.select(F.col("task_index").cast("long").alias("task_index"), F.col("file_index").cast("long").alias("file_index"), "task_id", "task",
                    "file", "n_episodes", "n_frames", "from_episode", "dataset_from_index", "dataset_to_index")


@register("camera_video_ranges", f"""
WITH o AS (SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS episode_index FROM orders),
n AS (SELECT l_orderkey, l_returnflag AS camera, count(*) AS n_frames FROM lineitem GROUP BY 1, 2),
r AS (SELECT camera, episode_index, n_frames, CAST(coalesce(sum(n_frames) OVER (PARTITION BY camera ORDER BY episode_index
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM n JOIN o ON o_orderkey = l_orderkey),
x AS (SELECT *, s // 500 AS file_index FROM r)
SELECT camera, episode_index, n_frames, file_index // {V.CHUNK_FILES} AS chunk_index, file_index,
       round((s - min(s) OVER (PARTITION BY camera, file_index)) / 30.0, 6) AS from_timestamp,
       round((s + n_frames - min(s) OVER (PARTITION BY camera, file_index)) / 30.0, 6) AS to_timestamp FROM x""")
def camera_video_ranges(spark, sf_dir):
    """Video ranges of cameras with frame counts of their own (episode =
    order, camera = return flag, frames = line items)."""
    o = dense_index(table(spark, sf_dir, "orders").select("o_orderkey"), [], ["o_orderkey"], "episode_index", block_col=block_of("o_orderkey", 1 << 20))
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_returnflag").alias("camera")).agg(F.count(F.lit(1)).alias("n_frames"))
    r = V.camera_ranges(n.join(o, F.col("l_orderkey") == F.col("o_orderkey")), 30, 500)
    return r.select("camera", "episode_index", "n_frames", "chunk_index", "file_index", r6(F.col("from_timestamp")).alias("from_timestamp"),
                    r6(F.col("to_timestamp")).alias("to_timestamp"))
