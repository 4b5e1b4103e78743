"""Queries over the publish route (Entry A): as-of frames, actions from
sources, sampled camera indices, rejected recordings."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodeframe.plans.catalog import r6, register
from episodeframe.plans.publish import align_recordings
from episodeframe.sources.config import parse_mapping_config
from episodeframe.sources.tables import events_as_messages

CONFIG = {
    "fps": 1 / 3600,
    "topics": {
        "observations": {"click": {"decoder": "float", "candidates": [{"topic": "click"}]},
                         "view": {"decoder": "float", "candidates": [{"topic": "view"}]},
                         "faults": {"decoder": "float", "required": False, "candidates": [{"topic": "error"}]},
                         "sales": {"decoder": "float", "candidates": [{"topic": "purchase"}]}},
        "cameras": {"head": {"required": True, "candidates": [{"topic": "signup"}]}}},
    "state": {"fields": [{"name": "click", "source": "click", "extractor": "float.value"},
                         {"name": "view", "source": "view", "extractor": "float.value"},
                         {"name": "faults", "source": "faults", "extractor": "float.value"}]},
    "action": {"mode": "from_sources", "fields": [{"name": "sales", "source": "sales", "extractor": "float.value"},
                                                  {"name": "click", "source": "click", "extractor": "float.value"},
                                                  {"name": "k", "extractor": "constant:2.5"}]},
}

_ROUTE_SQL = """
m AS (SELECT user_id AS rec, event_type AS topic, epoch_us(ts) * 1000 AS ts_ns, event_id AS seq, value FROM events
      WHERE event_type IN ('click', 'view', 'error', 'purchase', 'signup')),
missing AS (SELECT r.rec, t.field FROM (SELECT DISTINCT user_id AS rec FROM events) r
            CROSS JOIN (VALUES ('camera/head', 'signup'), ('click', 'click'), ('sales', 'purchase'), ('view', 'view')) t(field, topic)
            WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.rec = r.rec AND m.topic = t.topic)),
ext AS (SELECT rec, topic, min(ts_ns) AS f, max(ts_ns) AS l FROM m WHERE rec NOT IN (SELECT rec FROM missing) GROUP BY ALL),
p AS (SELECT rec, max(f) AS t0, min(l) AS t1 FROM ext GROUP BY rec HAVING max(f) < min(l)),
fr AS (SELECT rec, unnest(range(0, (t1 - t0) // 3600000000000 + 1)) AS frame_index, t0 FROM p),
g AS (SELECT rec, frame_index, t0 + frame_index * 3600000000000 AS t_ns FROM fr),
i AS (SELECT *, row_number() OVER (PARTITION BY rec, topic ORDER BY ts_ns, seq) - 1 AS image_index FROM m),
s AS (SELECT rec, topic, ts_ns, arg_max(value, seq) AS v, max(image_index) AS image_index FROM i GROUP BY ALL)"""


def _sampled(topic: str) -> str:
    return f"SELECT g.rec, g.frame_index, s.v, s.image_index FROM g ASOF LEFT JOIN (SELECT * FROM s WHERE topic = '{topic}') s " \
           "ON g.rec = s.rec AND g.t_ns >= s.ts_ns"


def _sql(body: str) -> str:
    parts = ", ".join(f"{n} AS ({_sampled(t)})" for n, t in (("c", "click"), ("v", "view"), ("e", "error"), ("b", "purchase"), ("h", "signup")))
    return f"WITH {_ROUTE_SQL}, {parts} {body}"


def _frames(spark, sf_dir):
    m = events_as_messages(spark, sf_dir).select(
        "recording_id", F.col("stream").alias("topic"), "ts_ns", "seq", F.to_json(F.struct(F.col("value"))).alias("payload"))
    return align_recordings(m, parse_mapping_config(CONFIG))


@register("publish_asof_frames", _sql("""
SELECT g.rec AS recording_id, g.frame_index, g.t_ns, round(CAST(CAST(coalesce(c.v, 0) AS FLOAT) AS DOUBLE), 6) AS s0,
       round(CAST(CAST(coalesce(v.v, 0) AS FLOAT) AS DOUBLE), 6) AS s1, round(CAST(CAST(coalesce(e.v, 0) AS FLOAT) AS DOUBLE), 6) AS s2
FROM g JOIN c USING (rec, frame_index) JOIN v USING (rec, frame_index) JOIN e USING (rec, frame_index)"""))
def publish_asof_frames(spark, sf_dir):
    """Entry A: required check, window over observations and cameras, as-of
    sampling, state vector."""
    fr, _ = _frames(spark, sf_dir)
    return fr.select("recording_id", "frame_index", "t_ns", *[r6(F.col("state")[i].cast("double")).alias(f"s{i}") for i in range(3)])


@register("from_sources_actions", _sql("""
SELECT g.rec AS recording_id, g.frame_index, round(CAST(CAST(coalesce(b.v, 0) AS FLOAT) AS DOUBLE), 6) AS a0,
       round(CAST(CAST(coalesce(c.v, 0) AS FLOAT) AS DOUBLE), 6) AS a1, 2.5::DOUBLE AS a2
FROM g JOIN b USING (rec, frame_index) JOIN c USING (rec, frame_index)"""))
def from_sources_actions(spark, sf_dir):
    """The action vector sampled from its own sources."""
    fr, _ = _frames(spark, sf_dir)
    return fr.select("recording_id", "frame_index", *[r6(F.col("action")[i].cast("double")).alias(f"a{i}") for i in range(3)])


@register("camera_asof_index", _sql("""
SELECT g.rec AS recording_id, g.frame_index, h.image_index FROM g JOIN h USING (rec, frame_index)"""))
def camera_asof_index(spark, sf_dir):
    """Per frame the image that the camera showed last."""
    fr, _ = _frames(spark, sf_dir)
    return fr.select("recording_id", "frame_index", F.col("camera_index")["head"].alias("image_index"))


@register("publish_rejects", _sql("SELECT rec AS recording_id, array_to_string(list_sort(list(field)), ',') AS missing FROM missing GROUP BY rec"))
def publish_rejects(spark, sf_dir):
    """Recordings that lack a required observation or camera."""
    _, rejected = _frames(spark, sf_dir)
    return rejected.select("recording_id", F.array_join("missing", ",").alias("missing"))
