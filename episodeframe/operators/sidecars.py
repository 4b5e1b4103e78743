"""Episode steps and task texts from sidecar documents.

A sidecar is a row ``(recording_id, kind, part, doc)``: ``doc`` is a VARIANT
object, ``kind`` is ``task_meta`` or ``step_index``.  A long step list may come
in several parts; its steps are numbered by ``(part, pos)``.  Key names, stamps
and numbers of the documents vary in name, type and unit, and a key with a null
value is not the same as a missing key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.functions import text as T
from episodeframe.functions import variants as V
from episodeframe.functions.timeunits import normalize_to_ns
from episodeframe.operators.episodes import step_ranges_on_grid

REC = "recording_id"
TASK_META, STEP_INDEX = "task_meta", "step_index"

# Reasons of rejected sidecars and steps.
NOT_JSON, NOT_AN_OBJECT = "not a JSON document", "document is not an object"
STEPS_NOT_A_LIST, STEP_NOT_AN_OBJECT = "steps is not a list", "step is not an object"
BAD_BOUNDS, OUTSIDE = "start or end missing or invalid", "outside the sampled window"
INVERTED, NO_FRAME, NO_RECORDING = "end is not after start", "no frame inside", "no recording"


def documents(raw: DataFrame, rec: str = REC) -> tuple[DataFrame, DataFrame]:
    """Parsed sidecars and rejects of ``(recording_id, kind, part, text)``."""
    v = raw.withColumn("doc", F.try_parse_json("text"))
    reason = F.when(F.col("doc").isNull(), NOT_JSON).when(V.kind("doc") != "OBJECT", NOT_AN_OBJECT)
    return (v.where(reason.isNull()).drop("text"),
            v.where(reason.isNotNull()).select(rec, "kind", "part", F.lit(None).cast("int").alias("pos"), reason.alias("reason")))


def task_meta(docs: DataFrame, rec: str = REC) -> DataFrame:
    """Per recording: ``title``, ``action_desc`` (P11, of the first part)."""
    m = docs.where(F.col("kind") == TASK_META)
    ident = V.member("doc", "taskId")
    title = F.coalesce(*[T.nonblank(V.as_string(V.member("doc", k))) for k in T.TITLE_KEYS],
                       F.when(V.kind(ident) == "STRING", V.as_string(ident))
                       .when(V.kind(ident) != "VOID", F.try_variant_get(ident, "$", "string")))
    act = F.coalesce(*[T.nonblank(V.as_string(V.member("doc", k))) for k in T.ACTION_DESC_KEYS])
    both = m.groupBy(rec).agg(F.min_by(F.struct(title.alias("title"), act.alias("action_desc")), "part").alias("m"))
    return both.select(rec, "m.*")


def meta_step_actions(docs: DataFrame, rec: str = REC) -> DataFrame:
    """``(recording, step_number, meta_step_action)`` of the task's own step
    list; the first listed step of a number with a text for its action."""
    steps = V.elements(F.coalesce(V.truthy(V.member("doc", "stepList")), V.member("doc", "steps")))
    s = docs.where(F.col("kind") == TASK_META).select(rec, "part", F.posexplode(steps).alias("pos", "s"))
    s = s.select(rec, F.struct("part", "pos").alias("at"), V.as_integer(V.first_present("s", ["number", "step_number"])).alias("step_number"),
                 T.nonblank(V.as_string(V.member("s", "action"))).alias("a"))
    return (s.where("step_number is not null and a is not null").groupBy(rec, "step_number")
            .agg(F.min_by("a", "at").alias("meta_step_action")))


def listed_steps(docs: DataFrame, rec: str = REC) -> tuple[DataFrame, DataFrame]:
    """Steps ``(recording, part, pos, step_number, start_ns, end_ns, action)`` of
    the step index, and rejects of entries that are no steps."""
    index = docs.where(F.col("kind") == STEP_INDEX)
    steps = V.member("doc", "steps")
    bad_list = index.where(steps.isNotNull() & (V.kind(steps) != "ARRAY")).select(
        rec, "kind", "part", F.lit(None).cast("int").alias("pos"), F.lit(STEPS_NOT_A_LIST).alias("reason"))
    s = index.select(rec, "kind", "part", F.posexplode(V.elements(steps)).alias("pos", "s"))
    is_step = V.kind("s") == "OBJECT"
    bad = s.where(~is_step).select(rec, "kind", "part", "pos", F.lit(STEP_NOT_AN_OBJECT).alias("reason"))
    action = V.as_string(V.member("s", "action"))
    good = s.where(is_step).select(
        rec, "part", "pos", V.as_integer(V.first_present("s", T.STEP_NUMBER_KEYS)).alias("step_number"),
        normalize_to_ns(V.as_number_text(V.first_present("s", T.START_KEYS))).alias("start_ns"),
        normalize_to_ns(V.as_number_text(V.first_present("s", T.END_KEYS))).alias("end_ns"),
        F.when(F.length(F.trim(action)) > 0, action).alias("action"))
    return good, bad_list.unionByName(bad)


def _step_reason(step: Column) -> Column:
    return (F.when(F.col("start_ns").isNull() | F.col("end_ns").isNull(), BAD_BOUNDS)
            .when((F.col("end_ns") <= F.col("_first")) | (F.col("start_ns") >= F.col("_last")), OUTSIDE)
            .when(F.col("end_ns") <= F.col("start_ns"), INVERTED)
            .otherwise(NO_FRAME))


def episodes(docs: DataFrame, params: DataFrame, fallback: str, override: str | None = None, rec: str = REC) -> tuple[DataFrame, DataFrame]:
    """Episodes of every recording of ``params`` (recording, start_ns, step_ns,
    n_frames) as its sidecars cut them, and the rejects.

    Episodes: recording, step_number, start_index, end_index, task; one whole
    episode (no step number) where no step is usable.  Rejects: recording, kind,
    part, pos, reason; sidecars without a recording are rejected as a whole."""
    listed, bad = listed_steps(docs, rec)
    ranges = step_ranges_on_grid(listed, params.select(rec, "start_ns", "step_ns", "n_frames"), rec)
    usable = ranges.where("usable")
    window = params.select(rec, F.col("start_ns").alias("_first"),
                           (F.col("start_ns") + (F.col("n_frames") - 1) * F.col("step_ns")).alias("_last"))
    skipped = ranges.where("not usable").join(window, rec).select(
        rec, F.lit(STEP_INDEX).alias("kind"), "part", "pos", _step_reason(F.col("start_ns")).alias("reason"))
    orphans = docs.join(params.select(rec), rec, "left_anti").select(
        rec, "kind", "part", F.lit(None).cast("int").alias("pos"), F.lit(NO_RECORDING).alias("reason"))

    whole = params.join(usable.select(rec).distinct(), rec, "left_anti").select(
        rec, F.lit(None).cast("long").alias("step_number"), F.lit(0).cast("long").alias("start_index"),
        F.col("n_frames").alias("end_index"), F.lit(None).cast("string").alias("action"))
    cut = usable.select(rec, "step_number", "start_index", "end_index", "action").unionByName(whole)
    named = (cut.join(meta_step_actions(docs, rec), [rec, "step_number"], "left").join(task_meta(docs, rec), rec, "left"))
    both = F.concat(F.col("title"), F.lit(": "), F.col("action_desc"))
    given = F.lit(override) if override else F.lit(None).cast("string")
    task = F.coalesce(given, F.col("action"), F.col("meta_step_action"), both, F.col("title"), F.col("action_desc"), F.lit(fallback))
    return (named.select(rec, "step_number", "start_index", "end_index", task.alias("task")),
            bad.join(params.select(rec), rec, "left_semi").unionByName(skipped).unionByName(orphans))
