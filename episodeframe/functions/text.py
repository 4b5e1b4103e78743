"""String rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chunk_file_path(chunk, file, root: str = "data", ext: str = "parquet") -> Column:
    """``<root>/chunk-%03d/file-%03d.<ext>``."""
    return F.format_string(f"{root}/chunk-%03d/file-%03d.{ext}", _c(chunk), _c(file))


def file_index_from_name(path) -> Column:
    """F23 inverse: the integer after ``file-`` in the file stem; null when
    the name does not match."""
    return F.regexp_extract(_c(path), r"file-(\d+)\.[^./]*$", 1).try_cast("long")


def nonblank(c) -> Column:
    """Trimmed string, or null when blank."""
    t = F.trim(_c(c).cast("string"))
    return F.when(F.length(t) > 0, t)


def first_present(m, keys: list[str]) -> Column:
    """Value of the first key that *exists* in map ``m`` (even when its
    value is null); a plain coalesce would skip present-but-null keys."""
    m = _c(m)
    expr = None
    for k in keys:
        cond = F.map_contains_key(m, F.lit(k))
        expr = F.when(cond, m[k]) if expr is None else expr.when(cond, m[k])
    return expr


# Key aliases read from task metadata and step records.
TITLE_KEYS = ["taskName", "name", "task_name"]
ACTION_DESC_KEYS = ["actionDesc", "action_desc", "description"]
STEP_NUMBER_KEYS = ["step_number", "number", "stepNumber"]
START_KEYS = ["start_ts", "startTs", "start_time", "startTime", "start_ns", "startNs"]
END_KEYS = ["end_ts", "endTs", "end_time", "endTime", "end_ns", "endNs"]
DIRECT_TASK_KEYS = ["task", "task_desc", "taskDesc", "description", "taskDescription"]
PLATFORM_NAME_KEYS = ["taskName", "task_name", "name"]
PLATFORM_ACTION_KEYS = ["action_desc", "actionDesc"]
PLATFORM_SCENE_KEYS = ["scene_desc", "sceneDesc"]
FULLWIDTH_SEMICOLON = "；"


def task_meta_title(meta) -> Column:
    """First non-blank of taskName/name/task_name (trimmed), else taskId."""
    m = _c(meta)
    return F.coalesce(*[nonblank(m[k]) for k in TITLE_KEYS], m["taskId"].cast("string"))


def task_meta_action(meta) -> Column:
    m = _c(meta)
    return F.coalesce(*[nonblank(m[k]) for k in ACTION_DESC_KEYS])


def build_task_name(override, fallback, meta=None, step_action=None, meta_step_action=None) -> Column:
    """Override -> step action -> task-meta step action ->
    ``title: action`` -> title -> action -> fallback.

    ``step_action`` is returned as given when it is not blank (the reference
    does not trim it); the task-meta step action comes trimmed from J8."""
    ov = _c(override) if override is not None else F.lit(None).cast("string")
    parts = [F.when(F.length(ov) > 0, ov)]
    if step_action is not None:
        sa = _c(step_action)
        parts.append(F.when(F.length(F.trim(sa)) > 0, sa))
    if meta_step_action is not None:
        parts.append(_c(meta_step_action))
    if meta is not None:
        title, act = task_meta_title(meta), task_meta_action(meta)
        parts += [F.when(title.isNotNull() & act.isNotNull(), F.concat(title, F.lit(": "), act)),
                  title, act]
    parts.append(_c(fallback) if not isinstance(fallback, str) else F.lit(fallback))
    return F.coalesce(*parts)


def platform_task_description(raw) -> Column:
    """Direct description, else non-blank name / action / scene joined
    by a full-width semicolon; null (rejected upstream) when all empty."""
    m = _c(raw)
    direct = nonblank(first_present(m, DIRECT_TASK_KEYS))
    parts = [nonblank(first_present(m, ks)) for ks in
             (PLATFORM_NAME_KEYS, PLATFORM_ACTION_KEYS, PLATFORM_SCENE_KEYS)]
    joined = F.concat_ws(FULLWIDTH_SEMICOLON, *parts)
    return F.coalesce(direct, F.when(F.length(joined) > 0, joined))


def normalize_msgtype(t) -> Column:
    """``pkg/Type`` -> ``pkg/msg/Type``; other shapes kept (trimmed)."""
    s = F.trim(_c(t))
    return F.when(F.size(F.split(s, "/")) == 2,
                  F.concat(F.split(s, "/")[0], F.lit("/msg/"), F.split(s, "/")[1])).otherwise(s)


def rename(c, mapping: dict[str, str]) -> Column:
    """Map lookup, unknown names kept."""
    if not mapping:
        return _c(c)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, _c(c)), _c(c))


def safe_id(c, default: str = "task") -> Column:
    """Every character that is not alphanumeric, '-' or '_' -> '_';
    empty -> ``default``."""
    s = F.regexp_replace(F.trim(_c(c).cast("string")), r"[^\p{L}\p{N}_-]", "_")
    return F.when(F.length(s) > 0, s).otherwise(F.lit(default))


def part_id(repo, task_index, file_index) -> Column:
    """``<owner>/<name with '/' -> '_'>_part_%03d_%03d``."""
    r = _c(repo)
    owner = F.substring_index(r, "/", 1)
    name = F.regexp_replace(F.substr(r, F.instr(r, "/") + 1), "/", "_")
    return F.format_string("%s/%s_part_%03d_%03d", owner, name, _c(task_index), _c(file_index))
