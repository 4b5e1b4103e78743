"""Trajectory and transform-tree queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodeframe.functions.timeunits import epoch_ns
from episodeframe.operators import graph as G
from episodeframe.operators import trajectory as TR
from episodeframe.operators.blocks import block_of, dense_index
from episodeframe.plans.catalog import r6, register
from episodeframe.session import cut_lineage
from episodeframe.sources.tables import table

DT = 0.1


def velocity_rows(spark, sf_dir):
    """Body velocities per label trajectory: vx, vy = elements 8, 9;
    vyaw = element 10 * 10."""
    e = table(spark, sf_dir, "embeddings")
    v = [F.col("embedding")[i].cast("double") for i in (7, 8, 9)]
    d = e.select(F.col("label").cast("long").alias("traj"), "vec_id", v[0].alias("vx"), v[1].alias("vy"),
                 (v[2] * 10).alias("vyaw"))
    return cut_lineage(dense_index(d, ["traj"], ["vec_id"], "idx", block_col=block_of("vec_id", 1 << 16)))


def _wrap_sql(a: str) -> str:
    return f"(({a} + pi()) - 2 * pi() * floor(({a} + pi()) / (2 * pi())) - pi())"


_DR_SQL = f"""
v AS (SELECT CAST(label AS BIGINT) AS traj, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx,
             CAST(embedding[8] AS DOUBLE) AS vx, CAST(embedding[9] AS DOUBLE) AS vy,
             CAST(embedding[10] AS DOUBLE) * 10 AS vyaw FROM embeddings),
a AS (SELECT *, coalesce(sum(vyaw * {DT}) OVER (PARTITION BY traj ORDER BY idx
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS thb FROM v),
b AS (SELECT *, (vx * cos(thb) - vy * sin(thb)) * {DT} AS dx, (vx * sin(thb) + vy * cos(thb)) * {DT} AS dy FROM a),
c AS (SELECT traj, idx, vx, vy, vyaw, sum(dx) OVER w AS x, sum(dy) OVER w AS y, {_wrap_sql(f'(thb + vyaw * {DT})')} AS theta
      FROM b WINDOW w AS (PARTITION BY traj ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register("dead_reckoning", f"""
WITH {_DR_SQL}
SELECT traj, idx, round(x, 6) AS x, round(y, 6) AS y, round(theta, 6) AS theta FROM c""")
def dead_reckoning(spark, sf_dir):
    """Poses integrated from body velocities (dt = 0.1 s, start at the
    origin), by two blocked running sums."""
    p = TR.dead_reckoning(velocity_rows(spark, sf_dir), ["traj"], "idx", "vx", "vy", "vyaw", DT)
    return p.select("traj", "idx", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"),
                    r6(F.col("theta")).alias("theta"))


@register("body_velocity", f"""
WITH {_DR_SQL},
d AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(theta) OVER w AS pt
      FROM c WINDOW w AS (PARTITION BY traj ORDER BY idx))
SELECT traj, idx, round((( x - px) * cos(pt) + (y - py) * sin(pt)) / {DT}, 6) AS bvx,
       round((-(x - px) * sin(pt) + (y - py) * cos(pt)) / {DT}, 6) AS bvy,
       round({_wrap_sql('(theta - pt)')} / {DT}, 6) AS bvyaw
FROM d""")
def body_velocity(spark, sf_dir):
    """W9 over the W10 poses: recovers the body velocities (first row null)."""
    p = TR.dead_reckoning(velocity_rows(spark, sf_dir), ["traj"], "idx", "vx", "vy", "vyaw", DT)
    p = cut_lineage(p.select("traj", "idx", "x", "y", "theta"))
    b = TR.body_velocity(p, ["traj"], "idx", "x", "y", "theta", DT)
    return b.select("traj", "idx", r6(F.col("vx")).alias("bvx"), r6(F.col("vy")).alias("bvy"),
                    r6(F.col("vyaw")).alias("bvyaw"))


FACTOR = 3


def _q_sql(r, p, y, pre):
    return (f"sin({r}/2)*cos({p}/2)*cos({y}/2) - cos({r}/2)*sin({p}/2)*sin({y}/2) AS {pre}x, "
            f"cos({r}/2)*sin({p}/2)*cos({y}/2) + sin({r}/2)*cos({p}/2)*sin({y}/2) AS {pre}y, "
            f"cos({r}/2)*cos({p}/2)*sin({y}/2) - sin({r}/2)*sin({p}/2)*cos({y}/2) AS {pre}z, "
            f"cos({r}/2)*cos({p}/2)*cos({y}/2) + sin({r}/2)*sin({p}/2)*sin({y}/2) AS {pre}w")


@register("trajectory_upsample", f"""
WITH t AS (SELECT CAST(label AS BIGINT) AS traj, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx,
                  CAST(embedding[1:7] AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT *, lead(v) OVER (PARTITION BY traj ORDER BY idx) AS nv FROM t),
k AS (SELECT n.*, kk.k FROM n, LATERAL (SELECT unnest(CASE WHEN nv IS NULL THEN [0] ELSE [0, 1, 2] END) AS k) kk),
b AS (SELECT *, k / {FACTOR}.0 AS f, coalesce(nv, v) AS w FROM k),
q AS (SELECT *, {_q_sql('v[4]', 'v[5]', 'v[6]', 'qa_')}, {_q_sql('w[4]', 'w[5]', 'w[6]', 'qb_')} FROM b),
l AS (SELECT *, qa_x + f * (qb_x - qa_x) AS rx, qa_y + f * (qb_y - qa_y) AS ry,
             qa_z + f * (qb_z - qa_z) AS rz, qa_w + f * (qb_w - qa_w) AS rw FROM q),
m AS (SELECT *, CASE WHEN sqrt(rx*rx + ry*ry + rz*rz + rw*rw) = 0 THEN 1.0 ELSE sqrt(rx*rx + ry*ry + rz*rz + rw*rw) END AS nn FROM l),
o AS (SELECT *, rx / nn AS qx, ry / nn AS qy, rz / nn AS qz, rw / nn AS qw FROM m),
e AS (SELECT *, 2.0 * (qw * qy - qz * qx) AS sinp FROM o)
SELECT traj, idx * {FACTOR} + k AS up_index,
  round(v[1] + f * (w[1] - v[1]), 6) AS d0, round(v[2] + f * (w[2] - v[2]), 6) AS d1,
  round(v[3] + f * (w[3] - v[3]), 6) AS d2,
  round(atan2(2.0 * (qw * qx + qy * qz), 1.0 - 2.0 * (qx * qx + qy * qy)), 6) AS d3,
  round(CASE WHEN abs(sinp) >= 1 THEN sign(sinp) * pi() / 2 ELSE asin(sinp) END, 6) AS d4,
  round(atan2(2.0 * (qw * qz + qx * qy), 1.0 - 2.0 * (qy * qy + qz * qz)), 6) AS d5,
  round(v[7] + f * (w[7] - v[7]), 6) AS d6
FROM e""")
def trajectory_upsample(spark, sf_dir):
    """F24 (end-pose mode, factor 3) + F3 + F1 over each label's 7-dim
    trajectory (elements 1-7)."""
    e = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("long").alias("traj"), "vec_id",
        F.slice("embedding", 1, 7).cast("array<double>").alias("v"))
    e = dense_index(e, ["traj"], ["vec_id"], "idx", block_col=block_of("vec_id", 1 << 16))
    u = TR.upsample(e, ["traj"], "idx", "v", FACTOR, mode="end_pose")
    return u.select("traj", F.col("up_index"), *[r6(F.col("v")[i]).alias(f"d{i}") for i in range(7)])


_TRAJ_SQL = """e AS (SELECT CAST(label AS BIGINT) AS traj, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx,
              CAST(embedding[1] AS DOUBLE) AS x, count(*) OVER (PARTITION BY label) AS n FROM embeddings)"""


def _element_rows(spark, sf_dir):
    """Element 1 over each label trajectory."""
    e = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("long").alias("traj"), "vec_id", F.col("embedding")[0].alias("x"))
    return cut_lineage(dense_index(e, ["traj"], ["vec_id"], "idx", block_col=block_of("vec_id", 1 << 16)))


def _savgol_sql(window: str) -> str:
    """Quadratic fit over each row's window (moved inside the trajectory),
    evaluated at the row; T >= 5."""
    return f"""
WITH {_TRAJ_SQL},
w AS (SELECT *, ({window} - 1) // 2 AS m FROM e),
s AS (SELECT traj, idx, m, least(greatest(idx - m, 0), n - 1 - 2 * m) + m AS c FROM w),
k AS (SELECT s.traj, s.idx, any_value(s.m)::DOUBLE AS m, any_value(s.idx - s.c) AS v, sum(e.x) AS s0,
             sum((e.idx - s.c) * e.x) AS s1, sum((e.idx - s.c) * (e.idx - s.c) * e.x) AS s2
      FROM s JOIN e ON e.traj = s.traj AND e.idx BETWEEN s.c - s.m AND s.c + s.m GROUP BY 1, 2),
q AS (SELECT *, 2 * m + 1 AS c0, m * (m + 1) * (2 * m + 1) / 3 AS c2,
             m * (m + 1) * (2 * m + 1) * (3 * m * m + 3 * m - 1) / 15 AS c4 FROM k),
a AS (SELECT *, (c0 * s2 - c2 * s0) / (c0 * c4 - c2 * c2) AS a2 FROM q)
SELECT traj, idx, round((s0 - a2 * c2) / c0 + s1 / c2 * v + a2 * v * v, 4) + 0.0 AS smoothed FROM a"""


@register("smooth_savgol", _savgol_sql(
    "(CASE WHEN round_even(n / 5, 0) < 3 THEN 3 WHEN round_even(n / 5, 0) % 2 = 0 THEN round_even(n / 5, 0) + 1"
    " ELSE round_even(n / 5, 0) END)::BIGINT"))
def smooth_savgol(spark, sf_dir):
    """Savitzky-Golay (window = odd(T/5), poly 2, polynomial ends)."""
    s = TR.smoothen(_element_rows(spark, sf_dir), ["traj"], "idx", "x", method="savgol")
    return s.withColumn("smoothed", F.round(F.col("smoothed").cast("double"), 4))


@register("smooth_savgol_5", _savgol_sql("5"))
def smooth_savgol_5(spark, sf_dir):
    """W12 with a window of five rows."""
    s = TR.smoothen(_element_rows(spark, sf_dir), ["traj"], "idx", "x", method="savgol", window=5)
    return s.withColumn("smoothed", F.round(F.col("smoothed").cast("double"), 4))


def _ema_sql(a: float) -> str:
    return f"""
WITH RECURSIVE {_TRAJ_SQL},
f AS (SELECT traj, idx, x AS y FROM e WHERE idx = 0
      UNION ALL SELECT e.traj, e.idx, {a} * e.x + {1 - a} * f.y FROM f JOIN e ON e.traj = f.traj AND e.idx = f.idx + 1),
b AS (SELECT traj, idx, x AS y FROM e WHERE idx = n - 1
      UNION ALL SELECT e.traj, e.idx, {a} * e.x + {1 - a} * b.y FROM b JOIN e ON e.traj = b.traj AND e.idx = b.idx - 1)
SELECT f.traj, f.idx, round(0.5 * (f.y + b.y), 4) + 0.0 AS smoothed FROM f JOIN b USING (traj, idx)"""


def _smooth_ema(spark, sf_dir, alpha):
    s = TR.ema_two_sided(_element_rows(spark, sf_dir), ["traj"], "idx", "x", alpha=alpha, block=16)
    return s.select("traj", "idx", F.round(F.col("smoothed").cast("double"), 4).alias("smoothed"))


@register("smooth_ema", _ema_sql(0.25))
def smooth_ema(spark, sf_dir):
    """Two-sided EMA (alpha 0.25) of element 1 per label trajectory."""
    return _smooth_ema(spark, sf_dir, 0.25)


@register("smooth_ema_slow", _ema_sql(0.01))
def smooth_ema_slow(spark, sf_dir):
    """W11 with alpha 0.01: the memory spans every block."""
    return _smooth_ema(spark, sf_dir, 0.01)


# -- transform tree: customer -> nation -> region -> world
def transforms(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    dyn = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
           .select(F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("child"),
                   F.col("n_name").alias("parent"), epoch_ns("o_orderdate").alias("ts"),
                   F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("tx"),
                   F.lit(False).alias("is_static")))
    st1 = (n.join(r, n.n_regionkey == r.r_regionkey)
           .select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"), F.lit(0).cast("long").alias("ts"),
                   F.col("n_nationkey").cast("long").alias("seq"), F.lit(0.0).alias("tx"), F.lit(True).alias("is_static")))
    st2 = r.select(F.col("r_name").alias("child"), F.lit("world").alias("parent"), F.lit(0).cast("long").alias("ts"),
                   F.col("r_regionkey").cast("long").alias("seq"), F.lit(0.0).alias("tx"), F.lit(True).alias("is_static"))
    return dyn.unionByName(st1).unionByName(st2)


_TF_SQL = """
dyn AS (SELECT 'customer_' || CAST(o.o_custkey AS VARCHAR) AS child, n.n_name AS parent,
               epoch_us(o.o_orderdate) * 1000 AS ts, o.o_orderkey AS seq, o.o_totalprice AS tx
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
tf AS (SELECT * FROM dyn
       UNION ALL SELECT n.n_name, r.r_name, 0, n.n_nationkey, 0.0 FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
       UNION ALL SELECT r_name, 'world', 0, r_regionkey, 0.0 FROM region),
latest AS (SELECT child, arg_max(parent, (ts, seq)) AS parent, arg_max(tx, (ts, seq)) AS tx,
                  max(ts) AS ts FROM tf GROUP BY child)"""


@register("latest_transforms", f"WITH {_TF_SQL} SELECT child, parent, ts, round(tx, 6) AS tx FROM latest")
def latest_transforms(spark, sf_dir):
    """Latest transform per child frame (by stamp, then arrival)."""
    l = G.latest_edges(transforms(spark, sf_dir))
    return l.select("child", "parent", "ts", r6(F.col("tx")).alias("tx"))


@register("transform_tree", f"""
WITH RECURSIVE {_TF_SQL.strip()},
rt AS (SELECT DISTINCT parent AS frame FROM latest WHERE parent NOT IN (SELECT child FROM latest)),
walk(frame, root, depth, path) AS (
  SELECT frame, frame, 0, [frame] FROM rt
  UNION ALL
  SELECT l.child, w.root, w.depth + 1, list_append(w.path, l.child) FROM walk w JOIN latest l ON l.parent = w.frame)
SELECT frame, root, CAST(depth AS INTEGER) AS depth, array_to_string(path, '/') AS path FROM walk""")
def transform_tree(spark, sf_dir):
    """J15 + U4: walk from every root through the latest edges (recursive
    CTE); path joined with '/'."""
    w = G.tree_walk(G.latest_edges(transforms(spark, sf_dir)))
    return w.select("frame", "root", F.col("depth").cast("int").alias("depth"),
                    F.array_join("path", "/").alias("path"))


@register("frame_universe", f"""
WITH {_TF_SQL}
SELECT frame, frame IN (SELECT parent FROM latest) AND frame NOT IN (SELECT child FROM latest) AS is_root
FROM (SELECT child AS frame FROM latest UNION SELECT parent FROM latest)""")
def frame_universe(spark, sf_dir):
    """U3 + U4: every frame and whether it is a root."""
    l = G.latest_edges(transforms(spark, sf_dir))
    u = G.frame_universe(l)
    r = G.roots(l).withColumn("is_root", F.lit(True))
    return u.join(r, "frame", "left").select("frame", F.coalesce(F.col("is_root"), F.lit(False)).alias("is_root"))
