"""Registered queries over the landed tables, each with its DuckDB oracle.

Every query reads whole tables (no id subsets, no row caps) and returns
scalar, aliased columns so the Spark result and the SQL oracle compare by
name.  Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(c.cast("double"), 6)


# The event streams of the landed ``events`` table, in the
# order used for vectors, and the grid step for its sparse data (1 hour).
EVENT_STREAMS = ["signup", "purchase", "error", "view", "click"]
EVENT_STEP_NS = 3_600_000_000_000

_MSG_CTE = """
m AS (
  SELECT user_id AS recording_id, event_type AS stream, epoch_us(ts) * 1000 AS ts_ns,
         event_id AS seq, value
  FROM events WHERE event_type IN ('signup','purchase','error','view','click')
),
ext AS (SELECT recording_id, stream, min(ts_ns) AS f, max(ts_ns) AS l FROM m GROUP BY 1, 2),
win AS (SELECT recording_id, max(f) AS start_ns, min(l) AS end_ns FROM ext GROUP BY 1
        HAVING max(f) < min(l)),
grid AS (
  SELECT recording_id, k AS frame_index, start_ns + k * 3600000000000 AS t_ns
  FROM (SELECT recording_id, start_ns,
               unnest(range(0, (end_ns - start_ns) // 3600000000000 + 1)) AS k FROM win)
)"""


def load_all() -> None:
    """Import every query module so its ``register`` calls run."""
    from episodeframe.plans import (action_queries, align_queries, episode_queries,  # noqa: F401
                                    merge_job_queries,
                                    function_queries, json_queries, model_queries,
                                    merge_queries, publish_queries, quality_queries, sidecar_queries, stream_queries,
                                    trajectory_queries)
