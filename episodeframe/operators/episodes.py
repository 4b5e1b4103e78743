"""Cutting recordings into task episodes.

Steps become index ranges on the frame grid by arithmetic, and ranges are
exploded in bounded chunks and equi-joined to frames on ``(recording,
frame_index)``, or joined to frames that lie in blocks on ``(recording, block)``:
the plan never compares every frame with every step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.functions.text import nonblank
from episodeframe.functions.timeunits import ceil_div, floor_div
from episodeframe.operators.blocks import BLK, tasks_for

REC = "recording_id"
CHUNK = 1 << 16


def explode_range(df: DataFrame, lo: str, hi: str, out: str, chunk: int = CHUNK,
                  spread: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """One row per integer in ``[lo, hi)`` of every input row, generated in
    chunks of at most ``chunk`` values (no row builds an array bigger than
    that); ``spread`` keys redistribute chunk rows before the inner explode,
    over ``partitions`` (default: the session's)."""
    lo_c, hi_c = F.col(lo), F.col(hi)
    n_chunks = floor_div(hi_c - lo_c - 1, F.lit(chunk))
    c = df.where(hi_c > lo_c).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks)))
    if spread:
        c = c.repartition(*([partitions] if partitions else []), *spread, "_chunk")
    a = lo_c + F.col("_chunk") * F.lit(chunk)
    b = F.least(hi_c, a + F.lit(chunk)) - 1
    return c.withColumn(out, F.explode(F.sequence(a, b))).drop("_chunk")


def step_ranges_on_grid(steps: DataFrame, params: DataFrame, rec: str = REC) -> DataFrame:
    """J6 bounds: each step ``(rec, step_number, start_ns, end_ns, ...)``
    -> ``start_index, end_index`` (half-open) on the recording's grid
    ``(start_ns, step_ns, n_frames)``, and ``usable``.

    Skipped (usable = false): missing bounds, outside the sampled window
    (end <= first frame or start >= last frame), end <= start, or no frame
    inside.  Frames t with start <= t <= end belong to the step."""
    p = params.select(rec, F.col("start_ns").alias("_t0"), F.col("step_ns").alias("_st"),
                      F.col("n_frames").alias("_n"))
    s = steps.join(p, rec)
    t0, st, n = F.col("_t0"), F.col("_st"), F.col("_n")
    tl = t0 + (n - 1) * st
    lo = F.greatest(F.col("start_ns"), t0)
    hi = F.least(F.col("end_ns"), tl)
    start_index = ceil_div(lo - t0, st)
    end_index = floor_div(hi - t0, st) + 1
    ok = (F.col("start_ns").isNotNull() & F.col("end_ns").isNotNull()
          & (F.col("end_ns") > t0) & (F.col("start_ns") < tl)
          & (F.col("end_ns") > F.col("start_ns")))
    s = (s.withColumn("start_index", F.when(ok, start_index))
         .withColumn("end_index", F.when(ok, end_index)))
    return (s.withColumn("usable", F.coalesce(ok & (F.col("end_index") > F.col("start_index")), F.lit(False)))
            .drop("_t0", "_st", "_n"))


def episode_specs(ranges: DataFrame, params: DataFrame, default_task: Column, rec: str = REC) -> DataFrame:
    """Usable steps, plus one whole-recording episode (step_number null,
    task = ``default_task``) for recordings with no usable step."""
    usable = ranges.where("usable").select(rec, "step_number", "start_index", "end_index", "task")
    fallback = (params.join(usable.select(rec).distinct(), rec, "left_anti")
                .select(rec, F.lit(None).cast("long").alias("step_number"),
                        F.lit(0).cast("long").alias("start_index"),
                        F.col("n_frames").alias("end_index"), default_task.alias("task")))
    return usable.unionByName(fallback)


def episode_tasks(specs: DataFrame, least: int = 1) -> int:
    """Partitions for the frames of all episodes (counted from the specs;
    materialise them where that is costly), at least ``least``."""
    n = specs.agg(F.sum(F.greatest(F.col("end_index") - F.col("start_index"), F.lit(0)))).first()[0]
    return max(least, tasks_for(specs.sparkSession, n))


def cut_episodes(frames: DataFrame, specs: DataFrame, rec: str = REC, partitions: int | None = None,
                 block: int | None = None) -> DataFrame:
    """Frames of every episode spec; overlapping steps repeat frames.
    Adds ``episode_frame_index`` (0.. inside the episode).  ``partitions``
    (``episode_tasks``) is the number of partitions on both sides of the join
    (default: the session's).

    ``block`` is for frames that carry ``_blk`` (= frame_index // block) and lie
    in ``partitions`` partitions by ``(rec, _blk)`` (``align_frames`` with
    ``keep_block``): an episode goes once to every block that it touches and is
    compared with the frames there, so that no frame is shuffled and no episode's
    text travels once per frame.  ``_blk`` is kept for ``next_state``."""
    if block:
        first, last = (floor_div(c, F.lit(block)) for c in (F.col("start_index"), F.col("end_index") - 1))
        at = specs.where(F.col("end_index") > F.col("start_index")).withColumn(BLK, F.explode(F.sequence(first, last)))
        at = at.repartition(*([partitions] if partitions else []), rec, BLK)
        inside = (F.col("frame_index") >= F.col("start_index")) & (F.col("frame_index") < F.col("end_index"))
        # the frames are on the left: the merge holds the episodes of one block at a time
        return (frames.join(at.hint("shuffle_merge"), [rec, BLK]).where(inside)
                .withColumn("episode_frame_index", F.col("frame_index") - F.col("start_index")))
    rows = explode_range(specs, "start_index", "end_index", "frame_index", spread=[rec], partitions=partitions)
    if partitions:
        # below the session's number the join would be dealt once more
        partitions = max(partitions, int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows, frames = (x.repartition(partitions, rec, "frame_index") for x in (rows, frames))
    # The exploded side is as large as the frames, but Catalyst sizes an
    # explode from its small input; never let it be broadcast.
    return (rows.hint("shuffle_merge").join(frames, [rec, "frame_index"])
            .withColumn("episode_frame_index", F.col("frame_index") - F.col("start_index")))


def step_actions_from_meta(step_list: DataFrame, rec: str = REC, pos: str = "pos",
                           number: str = "number", action: str = "action") -> DataFrame:
    """Step number -> action text from a task's step list; the first
    listed step with that number and a non-blank action wins."""
    s = step_list.withColumn("_a", nonblank(F.col(action)))
    return (s.where(F.col("_a").isNotNull() & F.col(number).isNotNull())
            .groupBy(rec, F.col(number).alias("step_number"))
            .agg(F.min_by("_a", pos).alias("meta_step_action")))


def episode_selection(spec: str | None) -> Column | None:
    """P5 + U2: ``"0,1,2"`` / ``"0-5"`` (inclusive) -> sorted distinct
    ``array<int>``; ``None`` selects everything."""
    if spec is None:
        return None
    parts = F.split(F.regexp_replace(F.lit(spec), r"\s+", ""), ",")
    def one(p):
        a = F.split(p, "-")
        return F.when(F.size(a) == 2, F.sequence(a[0].cast("int"), a[1].cast("int"))).otherwise(
            F.array(p.cast("int")))
    arr = F.flatten(F.transform(F.filter(parts, lambda p: F.length(p) > 0), one))
    return F.array_sort(F.array_distinct(arr))


def select_episodes(df: DataFrame, spec: str | None, col: str = "episode_index") -> DataFrame:
    """P5 as a semi join against the exploded selection."""
    sel = episode_selection(spec)
    if sel is None:
        return df
    wanted = df.sparkSession.range(1).select(F.explode(sel).alias(col))
    return df.join(F.broadcast(wanted), col, "left_semi")
