"""Topic selection and quality queries (A1, A3, A4, A10-A13, A16, J7, J9,
J10, P2-P4, P7, P10, P19, P20, P22, W8, F19)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodeframe.operators import quality as QC
from episodeframe.operators import selecting as SEL
from episodeframe.operators.stats import valid_range
from episodeframe.plans.catalog import r6, register
from episodeframe.sources.config import CollectionSwitches, parse_mapping_config, topic_dim
from episodeframe.sources.tables import events_as_messages, table

# The mapping config used for the ``events`` recordings.
EVENT_CONFIG = {
    "topics": {
        "observations": {
            "commerce": {"decoder": "float", "candidates": [
                {"topic": "purchase", "priority": 0}, {"topic": "signup", "priority": 0}]},
            "activity": {"decoder": "float", "candidates": [{"topic": "view"}, {"topic": "click"}]},
            "faults": {"decoder": "float", "required": False, "candidates": [{"topic": "error"}]},
            "gripper": {"decoder": "joint", "candidates": [{"topic": "gripper_state"}]},
            "legacy": {"decoder": "float", "enabled": False, "candidates": [{"topic": "legacy"}]},
        },
        "cameras": {"head": {"required": True, "candidates": [{"topic": "head_camera"}]}},
    },
    "state": {"fields": [{"name": "commerce", "source": "commerce", "extractor": "float.value"},
                         {"name": "activity", "source": "activity", "extractor": "float.value"}]},
}
VALUE_LIMIT = 100.0

_DIM_SQL = """dim(topic, field, priority, required) AS (VALUES
  ('purchase', 'commerce', 0, true), ('signup', 'commerce', 0, true),
  ('view', 'activity', 0, true), ('click', 'activity', 1, true),
  ('error', 'faults', 0, false), ('gripper_state', 'gripper', 0, true))"""


def routed_events(spark, sf_dir):
    cfg = parse_mapping_config(EVENT_CONFIG)
    m = events_as_messages(spark, sf_dir).withColumnRenamed("stream", "topic")
    m = SEL.filter_topics(m, cfg.topic_names())
    return SEL.route_topics(m, topic_dim(spark, cfg)), cfg


@register("topic_selection", f"""
WITH {_DIM_SQL},
c AS (SELECT e.user_id AS recording_id, d.field, d.topic, d.priority, count(*) AS n_rows
      FROM events e JOIN dim d ON d.topic = e.event_type GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY recording_id, field
                 ORDER BY n_rows = 0, priority, n_rows DESC, topic) AS rn FROM c)
SELECT recording_id, field, topic AS selected_topic, CAST(priority AS INTEGER) AS priority, n_rows
FROM r WHERE rn = 1""")
def topic_selection(spark, sf_dir):
    """P1 + J7 + A1 + A3: per recording and field, the preferred topic."""
    routed, _ = routed_events(spark, sf_dir)
    pick = SEL.preferred_topics(SEL.topic_counts(routed))
    return pick.select("recording_id", "field", "selected_topic", "priority", "n_rows")


@register("missing_required", f"""
WITH {_DIM_SQL},
u AS (SELECT DISTINCT user_id AS recording_id FROM events),
need AS (SELECT DISTINCT field FROM dim WHERE required
         UNION SELECT 'head'),
have AS (SELECT DISTINCT e.user_id AS recording_id, d.field FROM events e JOIN dim d ON d.topic = e.event_type)
SELECT u.recording_id, need.field AS missing FROM u CROSS JOIN need
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.recording_id = u.recording_id AND h.field = need.field)""")
def missing_required(spark, sf_dir):
    """Required observation fields and cameras with no data per recording."""
    routed, cfg = routed_events(spark, sf_dir)
    required = cfg.required_fields("observation") + cfg.required_fields("camera")
    allrec = events_as_messages(spark, sf_dir).select("recording_id")
    return SEL.missing_required(routed.select("recording_id", "field"), required,
                                all_recordings=allrec)


@register("missing_data_keys", """
WITH keys(data_key, severity) AS (VALUES ('view', 'error'), ('click', 'error'), ('purchase', 'error'),
       ('view_actions', 'error'), ('odometry', 'error'), ('master_arm_data', 'warn')),
u AS (SELECT DISTINCT user_id AS recording_id FROM events),
have AS (SELECT DISTINCT user_id AS recording_id, event_type AS data_key FROM events)
SELECT u.recording_id, k.data_key, k.severity FROM u CROSS JOIN keys k
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.recording_id = u.recording_id AND h.data_key = k.data_key)""")
def missing_data_keys(spark, sf_dir):
    """P2 + J10: keys enabled by the collection switches that are missing or
    empty per recording (master-arm keys warn only)."""
    sw = CollectionSwitches(slave_joint_names=["view", "click", "purchase"],
                            slave_action_names=["view_actions"],
                            enabled={"odometry", "master_arm_data"})
    keys = [(k, "warn" if k.startswith("master_arm") else "error") for k in sw.data_keys()]
    m = events_as_messages(spark, sf_dir)
    present = m.select("recording_id", F.col("stream").alias("field"))
    return SEL.missing_data_keys(present, keys, all_recordings=m.select("recording_id"))


@register("reject_counts", f"""
WITH x AS (SELECT event_type AS topic, props, value,
                  json_valid(props) AND try_cast(json_extract(props, '$.k') AS INTEGER) IS NOT NULL AS ok
           FROM events),
r AS (SELECT topic, 'empty_payload' AS reason FROM x WHERE props IS NULL OR length(props) = 0
      UNION ALL SELECT topic, 'decode_error' FROM x WHERE NOT ok AND props IS NOT NULL AND length(props) > 0
      UNION ALL SELECT topic, 'value_over_limit' FROM x WHERE value > {VALUE_LIMIT})
SELECT topic, reason, count(*) AS count FROM r GROUP BY ALL""")
def reject_counts(spark, sf_dir):
    """P3 + P4 + A4: empty payloads, unreadable payloads and values over the
    configured limit, counted per topic."""
    m = events_as_messages(spark, sf_dir).withColumnRenamed("stream", "topic")
    kept, _ = SEL.drop_empty_payloads(m)
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    dec = SEL.tolerant_decode(m, schema)
    empty = F.col("payload").isNull() | (F.length("payload") == 0)
    return SEL.reject_counts(dec, {
        "empty_payload": empty,
        "decode_error": ~empty & (F.col("decode_error") | F.col("decoded")["k"].isNull()),
        "value_over_limit": F.col("value") > VALUE_LIMIT})


# -- poses from embeddings: observation = elements 1-7, action = a coarsened copy
def pose_frames(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    v = [F.col("embedding")[i].cast("double") for i in range(16)]
    n1 = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2] + v[3] * v[3])
    n2 = F.sqrt(v[10] * v[10] + v[11] * v[11] + v[12] * v[12] + v[13] * v[13])
    obs = F.struct(F.struct(v[4].alias("x"), v[5].alias("y"), v[6].alias("z")).alias("position"),
                   F.struct((v[0] / n1).alias("x"), (v[1] / n1).alias("y"), (v[2] / n1).alias("z"),
                            (v[3] / n1).alias("w")).alias("orientation"))
    ident = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"), F.lit(1.0).alias("w"))
    act = F.struct(F.struct(F.round(v[7], 1).alias("x"), F.round(v[8], 1).alias("y"),
                            F.round(v[9], 1).alias("z")).alias("position"),
                   F.when(v[10] > 0, ident).otherwise(F.struct(
                       (v[10] / n2).alias("x"), (v[11] / n2).alias("y"), (v[12] / n2).alias("z"),
                       (v[13] / n2).alias("w"))).alias("orientation"))
    return e.select(F.col("label").cast("long").alias("episode"), "vec_id",
                    (F.col("vec_id") * 0.01).alias("timestamp"), obs.alias("obs_pose"),
                    act.alias("act_pose"), v[14].alias("grip_action"),
                    F.array(v[15]).alias("grip_joints"), v[14].alias("grip_obs"))


_POSE_SQL = """
p AS (SELECT CAST(label AS BIGINT) AS episode, vec_id, vec_id * 0.01 AS timestamp,
             CAST(embedding[8] AS DOUBLE) AS e8, CAST(embedding[9] AS DOUBLE) AS e9,
             CAST(embedding[10] AS DOUBLE) AS e10, CAST(embedding[11] AS DOUBLE) AS e11,
             CAST(embedding[16] AS DOUBLE) AS e16, CAST(embedding[15] AS DOUBLE) AS e15 FROM embeddings),
q AS (SELECT *, NOT (round(e8, 1) = 0 AND round(e9, 1) = 0 AND round(e10, 1) = 0 AND e11 > 0) AS act_valid FROM p)"""


@register("pose_fallback", f"""
WITH {_POSE_SQL}
SELECT episode, vec_id, act_valid, CASE WHEN act_valid THEN 'action' ELSE 'observation' END AS pose_source,
       round(coalesce(e15, CASE WHEN e16 < 0 THEN 0.0 ELSE e16 END), 6) AS gripper
FROM q""")
def pose_fallback(spark, sf_dir):
    """P7 valid pose + P10 source fallback (action pose, else observation
    pose) and gripper fallback."""
    f = pose_frames(spark, sf_dir)
    chosen = QC.pose_with_fallback(F.col("act_pose"), F.col("obs_pose"))
    return f.select("episode", "vec_id", QC.pose_is_valid(F.col("act_pose")).alias("act_valid"),
                    F.when(QC.pose_is_valid(F.col("act_pose")), F.lit("action"))
                    .when(chosen.isNotNull(), F.lit("observation")).alias("pose_source"),
                    r6(QC.gripper_with_fallback(F.col("grip_action"), F.col("grip_joints"),
                                                F.col("grip_obs"))).alias("gripper"))


@register("replay_dry_run", f"""
WITH {_POSE_SQL},
d AS (SELECT *, lead(timestamp) OVER (PARTITION BY episode ORDER BY vec_id) AS nt FROM q)
SELECT episode, count(*) AS frames, count(*) AS valid_frames, count(*) AS pose_commands,
       count(*) AS gripper_commands,
       CASE WHEN count(*) > 1 THEN round(greatest(0.0, (arg_max(timestamp, vec_id) - arg_min(timestamp, vec_id)) / 2.0), 6)
            ELSE 0.0 END AS replay_seconds,
       round(sum(CASE WHEN nt IS NOT NULL AND (nt - timestamp) / 2.0 > 0 THEN (nt - timestamp) / 2.0 ELSE 0.0 END), 6) AS total_delay
FROM d GROUP BY episode""")
def replay_dry_run(spark, sf_dir):
    """A12 dry run at speed 2 with W8 inter-frame delays summed."""
    from episodeframe.operators.actions import next_state
    from episodeframe.operators.blocks import dense_index, block_of
    f = pose_frames(spark, sf_dir).withColumn(
        "pose", QC.pose_with_fallback(F.col("act_pose"), F.col("obs_pose"))).withColumn(
        "grip", QC.gripper_with_fallback(F.col("grip_action"), F.col("grip_joints"), F.col("grip_obs")))
    f = dense_index(f, ["episode"], ["vec_id"], "idx", block_col=block_of("vec_id", 1 << 16))
    f = next_state(f, ["episode"], "idx", {"next_ts": "timestamp"})
    f = f.withColumn("_delay", F.when(F.col("next_ts") != F.col("timestamp"),
                                      QC.frame_delay(F.col("timestamp"), F.col("next_ts"), 2.0))
                     .otherwise(F.lit(0.0)))
    s = QC.replay_summary(f, "episode", "idx", "timestamp", ["pose"], ["grip"], speed=2.0)
    d = f.groupBy("episode").agg(r6(F.sum("_delay")).alias("total_delay"))
    return s.join(d, "episode").select("episode", "frames", "valid_frames", "pose_commands",
                                       "gripper_commands", r6(F.col("replay_seconds")).alias("replay_seconds"),
                                       "total_delay")


def faulty_frames(spark, sf_dir):
    """Frames whose poses and grippers fail in every way, by number: NaN,
    infinite, all zero with w = 1, or null."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("episode"), F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    i, nan, inf = F.col("vec_id"), F.lit(float("nan")), F.lit(float("inf"))

    def pose(px, at, w):
        return F.struct(F.struct(px.alias("x"), *[F.col("e")[at + k].alias(c) for k, c in ((1, "y"), (2, "z"))]).alias("position"),
                        F.struct(*[F.col("e")[at + 3 + k].alias(c) for k, c in enumerate("xyz")], w.alias("w")).alias("orientation"))

    zero, one = F.lit(0.0), F.lit(1.0)
    still = F.struct(F.struct(*[zero.alias(c) for c in "xyz"]).alias("position"), F.struct(*[zero.alias(c) for c in "xyz"], one.alias("w")).alias("orientation"))
    x, w = F.col("e")[0], F.col("e")[6]
    act = F.when(i % 7 == 2, still).when(i % 7 != 3, pose(F.when(i % 7 == 1, nan).otherwise(x), 0, F.when(i % 7 == 4, inf).otherwise(w)))
    obs = F.when(i % 5 == 1, still).when(i % 5 != 0, pose(F.col("e")[7], 7, F.col("e")[13]))
    return e.select(
        "vec_id", "episode", (i * 0.1).alias("timestamp"), QC.pose_with_fallback(act, obs).alias("pose"),
        QC.gripper_with_fallback(
            F.when(i % 4 == 2, nan).when(i % 4 == 3, -inf).when(i % 4 != 1, F.col("e")[8]),
            F.when(i % 3 == 1, F.array(-F.abs(F.col("e")[9]))).when(i % 3 == 2, F.array(F.abs(F.col("e")[9]))),
            F.when(i % 5 == 1, inf).when(i % 5 != 0, F.col("e")[10])).alias("grip"))


_FAULTY_SQL = """
f AS (SELECT vec_id, label AS episode, vec_id * 0.1 AS timestamp,
        CASE WHEN vec_id % 7 NOT IN (1, 2, 3, 4) THEN embedding[1] WHEN vec_id % 5 NOT IN (0, 1) THEN embedding[8] END::DOUBLE AS px,
        CASE WHEN vec_id % 4 = 0 THEN embedding[9]::DOUBLE WHEN vec_id % 3 = 1 THEN 0.0 WHEN vec_id % 3 = 2 THEN abs(embedding[10])::DOUBLE
             WHEN vec_id % 5 NOT IN (0, 1) THEN embedding[11]::DOUBLE END AS grip FROM embeddings)"""


@register("faulty_commands", f"WITH {_FAULTY_SQL} SELECT vec_id, round(px, 6) AS px, round(grip, 6) AS grip FROM f")
def faulty_commands(spark, sf_dir):
    """P7 + P10: the pose and gripper that is left after each kind of fault."""
    return faulty_frames(spark, sf_dir).select("vec_id", r6(F.col("pose.position.x")).alias("px"), r6(F.col("grip")).alias("grip"))


@register("faulty_replay", f"""
WITH {_FAULTY_SQL}
SELECT episode, count(*) AS frames, count(*) FILTER (WHERE px IS NOT NULL OR grip IS NOT NULL) AS valid_frames, count(px) AS pose_commands,
       count(grip) AS gripper_commands, round(CASE WHEN count(*) > 1 THEN (max(timestamp) - min(timestamp)) / 4.0 ELSE 0 END, 6) AS replay_seconds
FROM f GROUP BY 1""")
def faulty_replay(spark, sf_dir):
    """A12 over frames of which some give no command at all."""
    s = QC.replay_summary(faulty_frames(spark, sf_dir), "episode", "vec_id", "timestamp", ["pose"], ["grip"], speed=4.0)
    return s.withColumn("replay_seconds", r6(F.col("replay_seconds")))


@register("range_status", """
SELECT p_partkey, CASE WHEN p_size < 5 THEN 'too close' WHEN p_size > 45 THEN 'out of range' ELSE 'ok' END AS status,
       round(degrees(p_size / 10.0), 6) AS fov_deg
FROM part""")
def range_status(spark, sf_dir):
    """P19 range status (range = p_size, limits 5..45) and F21 degrees."""
    from episodeframe.functions.quaternion import degrees
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", QC.range_status(F.col("p_size"), F.lit(5), F.lit(45)).alias("status"),
                    r6(degrees(F.col("p_size") / 10.0)).alias("fov_deg"))


@register("model_mismatch", "SELECT o_orderkey, o_orderstatus AS model FROM orders WHERE lower(o_orderstatus) <> 'f'")
def model_mismatch(spark, sf_dir):
    """P20: episodes (orders) whose model (status) is not the requested 'f'."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("model"))
    return QC.model_mismatches(o, "f")


_LIMIT_SQL = "least(greatest(CAST(embedding[{i}] AS DOUBLE), -0.15), 0.15)"


@register("joint_limits", f"""
SELECT vec_id, {", ".join(f"round({_LIMIT_SQL.format(i=i)}, 6) AS j{i - 8}" for i in range(8, 15))},
       CAST({" + ".join(f"CASE WHEN abs(CAST(embedding[{i}] AS DOUBLE)) > 0.15 THEN 1 ELSE 0 END" for i in range(8, 15))} AS INTEGER) AS n_violations
FROM embeddings""")
def joint_limits(spark, sf_dir):
    """Clamp 7 joint values (elements 8-14) into [-0.15, 0.15] and
    count violations."""
    e = table(spark, sf_dir, "embeddings")
    v = F.slice("embedding", 8, 7).cast("array<double>")
    lo, hi = F.array_repeat(F.lit(-0.15), 7), F.array_repeat(F.lit(0.15), 7)
    cl = QC.clamp_to_limits(v, lo, hi)
    return e.select("vec_id", *[r6(cl[i]).alias(f"j{i}") for i in range(7)],
                    F.size(QC.limit_violations(v, lo, hi)).alias("n_violations"))


@register("image_state_check", """
WITH c AS (SELECT user_id AS recording_id, count(*) FILTER (WHERE event_type = 'click') AS n_images,
                  count(*) FILTER (WHERE event_type = 'view') AS n_states FROM events GROUP BY 1)
SELECT recording_id, n_images, n_states,
       abs(n_images - n_states) > greatest(n_states * 0.1, 1.0) AS count_mismatch,
       greatest(n_images, n_states) < 15 AS too_few_frames
FROM c""")
def image_state_check(spark, sf_dir):
    """Image (click) vs state (view) counts per recording; too few
    frames below half a second at 30 Hz."""
    m = events_as_messages(spark, sf_dir)
    c = m.groupBy("recording_id").agg(F.count_if(F.col("stream") == "click").alias("n_images"),
                                      F.count_if(F.col("stream") == "view").alias("n_states"))
    return c.select("recording_id", "n_images", "n_states",
                    QC.count_mismatch(F.col("n_images"), F.col("n_states")).alias("count_mismatch"),
                    QC.too_few_frames(F.greatest("n_images", "n_states"), 30).alias("too_few_frames"))


@register("audio_length", """
SELECT user_id AS recording_id, CAST(sum(octet_length(CAST(props AS BLOB))) AS BIGINT) AS total_bytes,
       round(sum(octet_length(CAST(props AS BLOB))) / (16000 * 1 * (16 // 8)), 6) AS seconds
FROM events GROUP BY 1""")
def audio_length(spark, sf_dir):
    """Audio seconds from byte counts (props bytes as PCM; 16 kHz mono
    16-bit)."""
    m = events_as_messages(spark, sf_dir)
    s = m.groupBy("recording_id").agg(F.sum(F.octet_length("payload")).alias("total_bytes"))
    return s.select("recording_id", "total_bytes",
                    r6(QC.audio_seconds(F.col("total_bytes"), F.lit(16000), F.lit(1), F.lit(16))).alias("seconds"))


@register("scan_valid_range", """
WITH x AS (SELECT vec_id, list_filter(embedding[1:16], lambda v: v IS NOT NULL AND NOT isnan(v) AND NOT isinf(v)) AS ok
           FROM embeddings)
SELECT vec_id, round(CAST(list_min(ok) AS DOUBLE), 6) AS min_range, round(CAST(list_max(ok) AS DOUBLE), 6) AS max_range,
       CAST(len(ok) AS INTEGER) AS n_valid FROM x""")
def scan_valid_range(spark, sf_dir):
    """A16 + P8 + O3: valid min/max of the first 16 readings of each scan."""
    from episodeframe.functions.vectors import drop_nan
    e = table(spark, sf_dir, "embeddings")
    scan = F.slice("embedding", 1, 16)
    vr = valid_range(scan)
    return e.select("vec_id", r6(vr["min"]).alias("min_range"), r6(vr["max"]).alias("max_range"),
                    F.size(drop_nan(scan)).alias("n_valid"))


@register("tracking_error", """
WITH x AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS tx, CAST(embedding[2] AS DOUBLE) AS ty,
                  CAST(embedding[3] AS DOUBLE) * 20 AS tyaw, CAST(embedding[4] AS DOUBLE) AS cx,
                  CAST(embedding[5] AS DOUBLE) AS cy, CAST(embedding[6] AS DOUBLE) * 20 AS cyaw FROM embeddings),
y AS (SELECT *, sqrt((tx - cx) * (tx - cx) + (ty - cy) * (ty - cy)) AS d,
             ((tyaw - cyaw + pi()) - 2 * pi() * floor((tyaw - cyaw + pi()) / (2 * pi()))) - pi() AS dy FROM x)
SELECT vec_id, round(d, 6) AS distance, round(dy, 6) AS yaw_error, d < 0.05 AND abs(dy) < 0.1 AS within_tolerance
FROM y""")
def tracking_error(spark, sf_dir):
    """F19 + F6: distance, wrapped yaw error, tolerance check."""
    e = table(spark, sf_dir, "embeddings")
    v = [F.col("embedding")[i].cast("double") for i in range(6)]
    te = QC.tracking_error(v[0], v[1], v[2] * 20, v[3], v[4], v[5] * 20)
    return e.select("vec_id", r6(te["distance"]).alias("distance"), r6(te["yaw_error"]).alias("yaw_error"),
                    te["within_tolerance"].alias("within_tolerance"))
