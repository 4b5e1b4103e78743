"""Scalar, array, map and string function queries (F1-F3, F5-F10,
F12-F16, F18, F20, F22, F23, P6, P9, P14-P16, A14, A15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodeframe.functions import quaternion as Q
from episodeframe.functions import text as TX
from episodeframe.functions import timeunits as TU
from episodeframe.functions import vectors as V
from episodeframe.operators.merge import first_seen_order
from episodeframe.operators.stats import width_profile
from episodeframe.plans.catalog import r6, register
from episodeframe.sources.tables import events_as_messages, table


def _e(i):
    return F.col("embedding")[i].cast("double")


def _ed(i):  # DuckDB, 0-based like the Spark helper
    return f"CAST(embedding[{i + 1}] AS DOUBLE)"


_QN = f"sqrt({_ed(0)}*{_ed(0)} + {_ed(1)}*{_ed(1)} + {_ed(2)}*{_ed(2)} + {_ed(3)}*{_ed(3)})"


@register("pose_functions", f"""
WITH q AS (SELECT vec_id, {_ed(0)} / {_QN} AS x, {_ed(1)} / {_QN} AS y, {_ed(2)} / {_QN} AS z,
                  {_ed(3)} / {_QN} AS w, {_ed(4)} AS px, {_ed(5)} AS py FROM embeddings),
e AS (SELECT *, atan2(2.0 * (w * x + y * z), 1.0 - 2.0 * (x * x + y * y)) AS roll,
             CASE WHEN abs(2.0 * (w * y - z * x)) >= 1 THEN sign(2.0 * (w * y - z * x)) * pi() / 2
                  ELSE asin(2.0 * (w * y - z * x)) END AS pitch,
             atan2(2.0 * (w * z + x * y), 1.0 - 2.0 * (y * y + z * z)) AS yaw FROM q),
r AS (SELECT *, cos(roll / 2) AS cr, sin(roll / 2) AS sr, cos(pitch / 2) AS cp, sin(pitch / 2) AS sp,
             cos(yaw / 2) AS cy, sin(yaw / 2) AS sy FROM e)
SELECT vec_id, round(roll, 6) AS roll, round(pitch, 6) AS pitch, round(yaw, 6) AS yaw,
       round(degrees(yaw), 6) AS yaw_deg,
       round(abs((sr * cp * cy - cr * sp * sy) * x + (cr * sp * cy + sr * cp * sy) * y
                 + (cr * cp * sy - sr * sp * cy) * z + (cr * cp * cy + sr * sp * sy) * w), 6) AS roundtrip_dot,
       round(((yaw * 7 + pi()) - 2 * pi() * floor((yaw * 7 + pi()) / (2 * pi()))) - pi(), 6) AS wrapped,
       round(cos(yaw), 6) AS m00, round(-sin(yaw), 6) AS m01, round(px, 6) AS m03, round(py, 6) AS m13,
       round(atan2(sin(yaw), cos(yaw)), 6) AS theta_back
FROM r""")
def pose_functions(spark, sf_dir):
    """F5 clean-up, F1 Euler, F2 yaw, F3 round trip (|q . q'| = 1), F6 wrap,
    F7 planar matrix and back, F21 degrees."""
    e = table(spark, sf_dir, "embeddings")
    q = Q.quat_clean(Q.quat_struct(_e(0), _e(1), _e(2), _e(3)))
    d = e.select("vec_id", q.alias("q"), _e(4).alias("px"), _e(5).alias("py"))
    eu = Q.euler_from_quat(F.col("q"))
    d = d.withColumn("eu", eu)
    rq = Q.quat_from_euler(F.col("eu")["roll"], F.col("eu")["pitch"], F.col("eu")["yaw"])
    m = Q.planar_to_matrix(F.col("px"), F.col("py"), Q.yaw_from_quat(F.col("q")))
    d = d.withColumn("m", m)
    return d.select("vec_id", r6(F.col("eu")["roll"]).alias("roll"), r6(F.col("eu")["pitch"]).alias("pitch"),
                    r6(F.col("eu")["yaw"]).alias("yaw"), r6(Q.degrees(F.col("eu")["yaw"])).alias("yaw_deg"),
                    r6(F.abs(Q.quat_dot(rq, F.col("q")))).alias("roundtrip_dot"),
                    r6(Q.wrap_angle(F.col("eu")["yaw"] * 7)).alias("wrapped"),
                    r6(F.col("m")[0]).alias("m00"), r6(F.col("m")[1]).alias("m01"),
                    r6(F.col("m")[3]).alias("m03"), r6(F.col("m")[7]).alias("m13"),
                    r6(Q.matrix_to_planar(F.col("m"))["theta"]).alias("theta_back"))


def sample_struct():
    """A decoded payload built from one embedding: pose, joint array,
    multi-array, float value and odometry."""
    pos = F.struct(_e(4).alias("x"), _e(5).alias("y"), _e(6).alias("z"))
    ori = F.struct(_e(0).alias("x"), _e(1).alias("y"), _e(2).alias("z"), _e(3).alias("w"))
    odom = F.struct(F.struct(_e(10).alias("x"), _e(11).alias("y"), _e(12).alias("z")).alias("position"),
                    F.struct(_e(13).alias("x"), _e(14).alias("y"), _e(15).alias("z"), _e(16).alias("w")).alias("orientation"))
    twist = F.struct(F.struct(_e(17).alias("x"), _e(18).alias("y"), _e(19).alias("z")).alias("linear"),
                     F.struct(_e(20).alias("x"), _e(21).alias("y"), _e(22).alias("z")).alias("angular"))
    return F.struct(pos.alias("position"), ori.alias("orientation"),
                    F.slice("embedding", 8, 7).cast("array<double>").alias("positions"),
                    F.slice("embedding", 24, 6).cast("array<double>").alias("data"),
                    _e(30).alias("value"), odom.alias("pose"), twist.alias("twist"))


LAYOUT = [V.FieldSpec("px", "s", "pose.position.x"), V.FieldSpec("yaw", "s", "pose.euler.yaw"),
          V.FieldSpec("j2", "s", "joint.position[2]"), V.FieldSpec("j10", "s", "joint.position[10]"),
          V.FieldSpec("a0", "s", "array[0]"), V.FieldSpec("val", "s", "float.value"),
          V.FieldSpec("oy", "s", "odom.position.y"), V.FieldSpec("oyaw", "s", "odom.euler.yaw"),
          V.FieldSpec("c", None, "constant:1.5"), V.FieldSpec("off", "s", "float.value", enabled=False),
          V.FieldSpec("miss", "nosuch", "float.value")]


def _yaw_sql(x, y, z, w):
    return f"atan2(2.0 * ({w} * {z} + {x} * {y}), 1.0 - 2.0 * ({y} * {y} + {z} * {z}))"


_F32 = "round(CAST(CAST({} AS REAL) AS DOUBLE), 6)"


@register("vector_functions", f"""
SELECT vec_id,
  {_F32.format(_ed(4))} AS v0, {_F32.format(_yaw_sql(_ed(0), _ed(1), _ed(2), _ed(3)))} AS v1,
  {_F32.format(_ed(9))} AS v2, CAST(0.0 AS DOUBLE) AS v3, {_F32.format(_ed(23))} AS v4, {_F32.format(_ed(30))} AS v5,
  {_F32.format(_ed(11))} AS v6, {_F32.format(_yaw_sql(_ed(13), _ed(14), _ed(15), _ed(16)))} AS v7,
  CAST(1.5 AS DOUBLE) AS v8, CAST(0.0 AS DOUBLE) AS v9, 10 AS width,
  round({_ed(4)} + {_ed(5)} + {_ed(6)} + {_ed(0)} + {_ed(1)} + {_ed(2)} + {_ed(3)}, 6) AS pose7_sum,
  round({_ed(17)} + {_ed(18)} + {_ed(19)} + {_ed(20)} + {_ed(21)} + {_ed(22)}, 6) AS twist_sum,
  round({_ed(7)} + {_ed(8)} + {_ed(9)} + {_ed(10)} + {_ed(11)} + {_ed(12)} + {_ed(13)}, 6) AS pad12_sum,
  CAST(len(embedding) AS INTEGER) AS pad12_len_src, 3 AS reshape_rows,
  round({_ed(13)}, 6) AS hold_last,
  round(greatest({", ".join(f"abs({_ed(6 + i)} - {_ed(i)})" for i in range(6))}), 6) AS max_abs_delta,
  round(sqrt({" + ".join(f"({_ed(6 + i)} - {_ed(i)}) * ({_ed(6 + i)} - {_ed(i)})" for i in range(6))}), 6) AS distance,
  round(({_ed(0)} - least({", ".join(_ed(i) for i in range(8))})) / (greatest({", ".join(_ed(i) for i in range(8))}) - least({", ".join(_ed(i) for i in range(8))})) * 255.0, 6) AS scaled0,
  len(list_filter(embedding, lambda x: x > 0)) <> 32 AS width_reject,
  round({_ed(3)}, 6) AS sel_j3, round({_ed(1)}, 6) AS sel_j1, 2 AS n_selected,
  round({_ed(1)}, 6) AS flat0, round({_ed(2)}, 6) AS flat1, round({_ed(0)}, 6) AS flat2
FROM embeddings""")
def vector_functions(spark, sf_dir):
    """F8 extractors (incl. short array, missing source, constant, disabled
    slot), F9 float32 vector, F12 flatteners, F14 pad/truncate, F15 reshape,
    F16 hold-last, F18 deltas, F20 min-max scale, F22 width check, P6 joint
    selection, F13 sorted-key map flatten."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", sample_struct().alias("s"))
    vec = V.build_vector(e, LAYOUT)
    a6, b6 = F.slice("embedding", 1, 6).cast("array<double>"), F.slice("embedding", 7, 6).cast("array<double>")
    names = F.array(*[F.lit(f"j{i}") for i in range(7)])
    sel = V.select_joints(F.slice("embedding", 1, 7).cast("array<double>"), names, ["j3", "jX", "j1"])
    mp = F.create_map(F.lit("b"), F.array(_e(0)), F.lit("a"), F.array(_e(1), _e(2)))
    pad = V.pad_or_truncate(F.slice("embedding", 8, 7), 12)
    d = e.select("vec_id", vec.alias("vec"), V.pose7(F.col("s")).alias("p7"),
                 V.odom13(F.col("s")).alias("o13"), pad.alias("pad"),
                 V.reshape(F.slice("embedding", 1, 12), 4).alias("rs"),
                 V.hold_last(F.col("s")["positions"], F.lit(20)).alias("hl"),
                 V.max_abs_delta(a6, b6).alias("mad"), V.distance(a6, b6).alias("dist"),
                 V.minmax_255(F.slice("embedding", 1, 8).cast("array<double>")).alias("mm"),
                 (F.size(F.filter("embedding", lambda x: x > 0)) != 32).alias("width_reject"),
                 sel.alias("sel"), V.flatten_sorted_map(mp).alias("flat"), F.size("embedding").alias("n_src"))
    out = [F.col("vec_id")]
    for i in range(10):
        out.append(r6(F.col("vec")[i]).alias(f"v{i}"))
    out += [F.size("vec").alias("width"),
            r6(F.aggregate("p7", F.lit(0.0), lambda a, x: a + x)).alias("pose7_sum"),
            r6(F.aggregate(F.slice("o13", 8, 6), F.lit(0.0), lambda a, x: a + x)).alias("twist_sum"),
            r6(F.aggregate("pad", F.lit(0.0), lambda a, x: a + x)).alias("pad12_sum"),
            F.col("n_src").alias("pad12_len_src"), F.size("rs").alias("reshape_rows"),
            r6(F.col("hl")).alias("hold_last"), r6(F.col("mad")).alias("max_abs_delta"),
            r6(F.col("dist")).alias("distance"), r6(F.col("mm")[0]).alias("scaled0"), F.col("width_reject"),
            r6(F.col("sel")[0]).alias("sel_j3"), r6(F.col("sel")[1]).alias("sel_j1"),
            F.size("sel").alias("n_selected"),
            r6(F.col("flat")[0]).alias("flat0"), r6(F.col("flat")[1]).alias("flat1"),
            r6(F.col("flat")[2]).alias("flat2")]
    return d.select(*out)


@register("message_functions", """
WITH e AS (SELECT event_id, event_type, epoch_us(ts) * 1000 AS ts_ns, props, value FROM events)
SELECT event_id,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k_first_present,
  NULL::DOUBLE AS a_first_present, value AS a_coalesce,
  round((ts_ns // 1000000000) + (ts_ns % 1000000000) / 1e9, 3) AS stamp_s,
  (ts_ns // 1000000000) * 1000000000 + ts_ns % 1000000000 AS stamp_ns,
  'events/msg/' || event_type AS msgtype,
  CASE event_type WHEN 'click' THEN 'head_camera' WHEN 'view' THEN 'left_wrist' ELSE event_type END AS renamed,
  format('data/chunk-{:03d}/file-{:03d}.parquet', event_id // 1000, event_id % 1000) AS path,
  event_id % 1000 AS file_back,
  'robot/' || regexp_replace(event_type, '[^\\p{L}\\p{N}_-]', '_', 'g') || format('_part_{:03d}_{:03d}', 1, 2) AS part_id
FROM e""")
def message_functions(spark, sf_dir):
    """P9 first-present (present-but-null beats coalesce), P14 header stamps,
    P15 msgtype normalisation, P16 renaming, F23 path templates, P21 ids."""
    m = events_as_messages(spark, sf_dir)
    mp = F.from_json("payload", "map<string,int>")
    m2 = F.create_map(F.lit("a"), F.lit(None).cast("double"), F.lit("k"), F.col("value"))
    sec = F.call_function("div", F.col("ts_ns"), F.lit(1_000_000_000))
    nsec = F.pmod(F.col("ts_ns"), F.lit(1_000_000_000))
    path = TX.chunk_file_path(F.call_function("div", F.col("seq"), F.lit(1000)), F.pmod(F.col("seq"), F.lit(1000)))
    return m.select(
        F.col("seq").alias("event_id"),
        TX.first_present(mp, ["x", "k"]).alias("k_first_present"),
        TX.first_present(m2, ["a", "k"]).alias("a_first_present"),
        F.coalesce(m2["a"], m2["k"]).alias("a_coalesce"),
        F.round(TU.header_stamp(sec, nsec, F.lit(None)), 3).alias("stamp_s"),
        TU.header_stamp_ns(sec, nsec).alias("stamp_ns"),
        TX.normalize_msgtype(F.col("msgtype")).alias("msgtype"),
        TX.rename(F.col("stream"), {"click": "head_camera", "view": "left_wrist"}).alias("renamed"),
        path.alias("path"), TX.file_index_from_name(path).alias("file_back"),
        TX.part_id(F.concat(F.lit("robot/"), F.col("stream")), F.lit(1), F.lit(2)).alias("part_id"))


@register("first_seen_streams", """
WITH f AS (SELECT event_type AS stream, min((epoch_us(ts), event_id)) AS fs FROM events GROUP BY 1)
SELECT stream, CAST(row_number() OVER (ORDER BY fs) - 1 AS INTEGER) AS ordinal FROM f""")
def first_seen_streams(spark, sf_dir):
    """Stream names in first-seen order (by stamp, then arrival)."""
    m = events_as_messages(spark, sf_dir)
    return first_seen_order(m, "stream", ["ts_ns", "seq"]).select("stream", F.col("ordinal").cast("int"))


@register("width_profile", """
SELECT label, min(len(list_filter(embedding, lambda x: x > 0))) AS min_width,
       max(len(list_filter(embedding, lambda x: x > 0))) AS max_width,
       count(DISTINCT len(list_filter(embedding, lambda x: x > 0))) AS n_widths
FROM embeddings GROUP BY label""")
def width_profile_q(spark, sf_dir):
    """Vector widths per episode (positive elements only, so widths
    vary); mixed widths show as n_widths > 1."""
    e = table(spark, sf_dir, "embeddings").select("label", F.filter("embedding", lambda x: x > 0).alias("v"))
    return width_profile(e, "v", ["label"]).select(
        "label", F.col("min_width").cast("long").alias("min_width"),
        F.col("max_width").cast("long").alias("max_width"), "n_widths")


@register("decode_payloads", f"""
SELECT vec_id, round({_ed(4)}, 6) AS px, round({_ed(3)}, 6) AS qw, round({_ed(9)}, 6) AS j2,
       CAST(7 AS INTEGER) AS n_joints, round({_ed(30)}, 6) AS value, CAST(NULL AS DOUBLE) AS bad
FROM embeddings""")
def decode_payloads(spark, sf_dir):
    """payloads written as JSON text (pose, joint state, float) and
    decoded back with the typed decoders; an unreadable payload gives null."""
    from episodeframe.functions.decoders import decode
    e = table(spark, sf_dir, "embeddings").select("vec_id", sample_struct().alias("s"))
    landed = e.select(
        "vec_id",
        F.to_json(F.struct(F.col("s.position"), F.col("s.orientation"))).alias("pose_json"),
        F.to_json(F.struct(F.col("s.positions").alias("positions"))).alias("joint_json"),
        F.to_json(F.struct(F.col("s.value").alias("value"))).alias("float_json"))
    d = landed.select("vec_id", decode("pose_json", "pose").alias("p"), decode("joint_json", "joint").alias("j"),
                      decode("float_json", "float").alias("f"), decode(F.lit("{not json"), "float").alias("b"))
    return d.select("vec_id", r6(F.col("p.position.x")).alias("px"), r6(F.col("p.orientation.w")).alias("qw"),
                    r6(F.col("j.positions")[2]).alias("j2"), F.size("j.positions").alias("n_joints"),
                    r6(F.col("f.value")).alias("value"), F.col("b.value").alias("bad"))


@register("decode_routed_payloads", f"""
WITH k AS (SELECT *, vec_id % 11 = 0 AS broken, vec_id % 5 AS kind FROM embeddings)
SELECT vec_id, CASE WHEN NOT broken AND kind = 0 THEN round({_ed(0)}, 6) END AS px, CASE WHEN NOT broken AND kind = 0 THEN round({_ed(6)}, 6) END AS qw,
       CASE WHEN NOT broken AND kind = 1 THEN round({_ed(2)}, 6) END AS joint, CASE WHEN NOT broken AND kind = 2 THEN round({_ed(1)}, 6) END AS odom_y,
       CASE WHEN NOT broken AND kind = 2 THEN round({_ed(9)}, 6) END AS turn, CASE WHEN NOT broken AND kind = 3 THEN round({_ed(20)}, 6) END AS value,
       CASE WHEN NOT broken AND kind = 4 THEN 12 END AS n_array, CASE WHEN NOT broken AND kind = 4 THEN round({_ed(41)}, 6) END AS last
FROM k""")
def decode_routed_payloads(spark, sf_dir):
    """F11 with all five decoders, routed by a decoder column as the topic
    dimension gives it; unreadable payloads give null."""
    from episodeframe.functions.decoders import decode_routed
    xyz = lambda at: F.struct(*[_e(at + k).alias(c) for k, c in enumerate("xyz")])
    quat = F.struct(*[_e(3 + k).alias(c) for k, c in enumerate("xyzw")])
    pose = F.struct(xyz(0).alias("position"), quat.alias("orientation"))
    bodies = {"pose": pose, "joint": F.struct(F.array(*map(_e, range(7))).alias("positions")),
              "odometry": F.struct(pose.alias("pose"), F.struct(xyz(4).alias("linear"), xyz(7).alias("angular")).alias("twist")),
              "float": F.struct(_e(20).alias("value")), "array": F.struct(F.array(*map(_e, range(30, 42))).alias("data"))}
    kind = F.col("vec_id") % 5
    payload, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, (n, b) in enumerate(bodies.items()):
        payload, name = F.when(kind == k, F.to_json(b)).otherwise(payload), F.when(kind == k, n).otherwise(name)
    m = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 11 == 0, "{cut").otherwise(payload).alias("payload"), name.alias("decoder"))
    d = m.select("vec_id", decode_routed("payload", "decoder").alias("d"))
    data = F.col("d.array.data")
    return d.select("vec_id", r6(F.col("d.pose.position.x")).alias("px"), r6(F.col("d.pose.orientation.w")).alias("qw"), r6(F.col("d.joint.positions")[2]).alias("joint"),
                    r6(F.col("d.odometry.pose.position.y")).alias("odom_y"), r6(F.col("d.odometry.twist.angular.z")).alias("turn"),
                    r6(F.col("d.float.value")).alias("value"), F.size(data).alias("n_array"), r6(F.element_at(data, -1)).alias("last"))


@register("sensor_vectors", f"""
SELECT vec_id, round({_ed(0)}, 6) AS i0, round({_ed(3)}, 6) AS i3, round({_ed(6)}, 6) AS i6, round({_ed(9)}, 6) AS i9, 10 AS imu_width,
       round({_ed(10)}, 6) AS p0, round({_ed(12)}, 6) AS p2, round({_yaw_sql(_ed(0), _ed(1), _ed(2), _ed(3))}, 6) AS p5,
       round({_ed(10)}, 6) AS o0, round({_ed(11)}, 6) AS o1, round({_yaw_sql(_ed(0), _ed(1), _ed(2), _ed(3))}, 6) AS o2
FROM embeddings""")
def sensor_vectors(spark, sf_dir):
    """F12 IMU vector, F10 position + Euler and odometry (x, y, yaw), from
    elements 1-13 as a sensor record."""
    xyz = lambda at: F.struct(*[_e(at + k).alias(c) for k, c in enumerate("xyz")])
    quat = F.struct(*[_e(k).alias(c) for k, c in enumerate("xyzw")])
    pose = F.struct(xyz(10).alias("position"), quat.alias("orientation"))
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.struct(quat.alias("orientation"), xyz(4).alias("angular_velocity"), xyz(7).alias("linear_acceleration")).alias("imu"),
        pose.alias("pose"), F.struct(pose.alias("pose")).alias("odom"))
    e = e.select("vec_id", V.imu10(F.col("imu")).alias("i"), V.position_euler6(F.col("pose")).alias("p"),
                 V.odom_xy_yaw(F.col("odom")).alias("o"))
    return e.select("vec_id", *[r6(F.col("i")[k]).alias(f"i{k}") for k in (0, 3, 6, 9)], F.size("i").alias("imu_width"),
                    *[r6(F.col("p")[k]).alias(f"p{k}") for k in (0, 2, 5)], *[r6(F.col("o")[k]).alias(f"o{k}") for k in range(3)])


@register("union_width_rejects", """
SELECT vec_id, 'b' AS source, len(list_filter(embedding, lambda x: x > 0))::INT AS width FROM embeddings
WHERE label % 2 = 1 AND len(list_filter(embedding, lambda x: x > 0)) <> 32""")
def union_width_rejects(spark, sf_dir):
    """U1 union of two sources with different columns, F22 rows of another
    vector width than 32."""
    from episodeframe.operators.merge import union_sources
    e = table(spark, sf_dir, "embeddings")
    a = e.where(F.col("label") % 2 == 0).select("vec_id", F.lit("a").alias("source"), F.slice("embedding", 1, 32).alias("v"))
    b = e.where(F.col("label") % 2 == 1).select(F.filter("embedding", lambda x: x > 0).alias("v"), "vec_id",
                                                F.lit("b").alias("source"), F.lit(1).alias("extra"))
    return V.width_rejects(union_sources([a, b]), "v", 32).select("vec_id", "source", F.size("v").alias("width"))
