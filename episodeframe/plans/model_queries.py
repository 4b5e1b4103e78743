"""Robot-model limits by joint name (S11 into P22) and the raw-stream manifest
round trip (K8, A10, S10)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from episodeframe.operators import joint_limits as L
from episodeframe.plans.catalog import r6, register
from episodeframe.session import ensure_checkpoint_dir
from episodeframe.sinks import writers as W
from episodeframe.sources.files import read_raw_manifest_lines, read_robot_joints
from episodeframe.sources.tables import events_as_messages, table

JOINTS, MODELS = 8, 3


def _folder(spark, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def write_models(spark, sf_dir: str, path: str) -> None:
    """A robot model file per model: joint ``j<k>`` may move 0.1 around the mean
    of vector element k, in thousandths.  Joint 5 has no limits, joint 6 of the
    last model is missing."""
    e = table(spark, sf_dir, "embeddings").where("label is not null")
    means = (e.select((F.col("label") % MODELS).alias("model"), F.posexplode(F.slice("embedding", 1, JOINTS)).alias("k", "x"))
             .groupBy("model", "k").agg(F.floor(F.avg(F.col("x").cast("double")) * 1000).alias("m")))
    limit = F.when(F.col("k") == 5, F.lit("")).otherwise(F.format_string(
        '<limit lower="%s" upper="%s" effort="10" velocity="2.5"/>', ((F.col("m") - 100) / 1000).cast("string"), ((F.col("m") + 100) / 1000).cast("string")))
    joint = F.format_string('<joint name="j%d" type="revolute"><parent link="l%d"/><child link="l%d"/>%s</joint>',
                            F.col("k"), F.col("k"), F.col("k") + 1, limit)
    joints = means.where(f"not (model = {MODELS - 1} and k = 6)").groupBy("model").agg(  # a model's few joints
        F.concat(F.lit('<robot name="r">'), F.array_join(F.array_sort(F.collect_list(joint)), ""), F.lit("</robot>")).alias("value"))
    joints.write.partitionBy("model").text(path)


def _vectors(spark, sf_dir):
    """Vectors of eight joints; odd models list them backwards."""
    e = table(spark, sf_dir, "embeddings").where("label is not null").select(
        "vec_id", (F.col("label") % MODELS).alias("model"), F.slice("embedding", 1, JOINTS).alias("v"))
    names = F.array(*[F.lit(f"j{k}") for k in range(JOINTS)])
    odd = F.col("model") % 2 == 1
    return e.select("vec_id", "model", F.when(odd, F.reverse(names)).otherwise(names).alias("names"), F.when(odd, F.reverse("v")).otherwise(F.col("v")).alias("v"))


def _limits(spark, sf_dir):
    path = _folder(spark, "models")
    write_models(spark, sf_dir, path)
    return L.limit_maps(read_robot_joints(spark, path))


_MODEL_SQL = f"""
x AS (SELECT vec_id, label % {MODELS} AS model, k, embedding[k + 1]::DOUBLE AS value FROM embeddings, range(0, {JOINTS}) AS t(k) WHERE label IS NOT NULL),
l AS (SELECT model, k, floor(avg(value) * 1000) AS m FROM x GROUP BY 1, 2),
j AS (SELECT x.*, CASE WHEN x.k <> 5 AND NOT (x.model = {MODELS - 1} AND x.k = 6) THEN (m - 100) / 1000 END AS lower,
             CASE WHEN x.k <> 5 AND NOT (x.model = {MODELS - 1} AND x.k = 6) THEN (m + 100) / 1000 END AS upper,
             CASE WHEN x.model % 2 = 1 THEN {JOINTS - 1} - x.k ELSE x.k END AS pos FROM x JOIN l ON l.model = x.model AND l.k = x.k)"""


@register("model_limit_violations", f"""
WITH {_MODEL_SQL}
SELECT vec_id, model, CAST(pos AS INTEGER) AS pos, 'j' || k AS joint, round(value, 6) AS value, round(lower, 6) AS lower, round(upper, 6) AS upper
FROM j WHERE value < lower OR value > upper""")
def model_limit_violations(spark, sf_dir):
    """P22 by joint name: every joint outside the limits of its model's file."""
    v = L.violations(_vectors(spark, sf_dir), _limits(spark, sf_dir), "names", "v", ["vec_id"])
    return v.select("vec_id", "model", "pos", "joint", *[r6(F.col(c)).alias(c) for c in ("value", "lower", "upper")])


@register("model_unknown_joints", f"""
WITH {_MODEL_SQL}
SELECT model, 'j6' AS joint, count(*) AS n FROM j WHERE model = {MODELS - 1} AND k = 6 GROUP BY 1""")
def model_unknown_joints(spark, sf_dir):
    """Joints of the vectors that the model's file does not have."""
    return L.unknown_joints(_vectors(spark, sf_dir), _limits(spark, sf_dir), "names", "v")


@register("model_clamped", f"""
WITH {_MODEL_SQL}
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(least(greatest(value, coalesce(lower, value)), coalesce(upper, value)), 6) AS value FROM j""")
def model_clamped(spark, sf_dir):
    """Vectors clamped to their model's limits, in the vectors' own order."""
    c = L.clamped(_vectors(spark, sf_dir), _limits(spark, sf_dir), "names", "v", "c")
    return c.select("vec_id", F.posexplode("c").alias("pos", "value")).select("vec_id", "pos", r6(F.col("value")).alias("value"))


STREAMS = ["signup", "purchase", "error", "view", "click", "never"]


@register("raw_manifest_round_trip", """
WITH m AS (SELECT user_id AS recording_id, event_type AS stream, event_id % 3 = 0 AS plain,
                  row_number() OVER (PARTITION BY user_id, event_type ORDER BY epoch_us(ts), event_id) AS k FROM events)
SELECT recording_id, stream, count(*) AS records,
       CASE WHEN bool_or(plain) FILTER (WHERE k = 1) THEN 'OBJECT<id: BIGINT>' ELSE 'OBJECT<id: BIGINT, p: STRING>' END AS record_format,
       CASE WHEN bool_and(plain) THEN 'OBJECT<id: BIGINT>' ELSE 'OBJECT<id: BIGINT, p: STRING>' END AS merged_format
FROM m GROUP BY 1, 2""")
def raw_manifest_round_trip(spark, sf_dir):
    """A10 of raw streams whose records differ in shape, with streams that stay
    empty, written and read back without the empty ones."""
    m = events_as_messages(spark, sf_dir)
    shape = F.when(F.col("seq") % 3 == 0, F.to_json(F.struct(F.col("seq").alias("id")))).otherwise(
        F.to_json(F.struct(F.col("seq").alias("id"), F.col("stream").alias("p"))))
    expected = m.select("recording_id").distinct().withColumn("stream", F.explode(F.array(*map(F.lit, STREAMS))))
    path = _folder(spark, "raw_manifest")
    W.write_raw_manifest(W.raw_manifest(m.withColumn("payload", shape), expected=expected), path)
    return read_raw_manifest_lines(spark, path)
