"""Rotation and planar-pose maths as Column expressions.

All functions take and return Columns, so they stay inside whole-stage
codegen.  Quaternions are ``(x, y, z, w)``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PI = math.pi


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def quat_struct(x, y, z, w) -> Column:
    return F.struct(_c(x).alias("x"), _c(y).alias("y"), _c(z).alias("z"), _c(w).alias("w"))


def xyz_struct(x, y, z) -> Column:
    return F.struct(_c(x).alias("x"), _c(y).alias("y"), _c(z).alias("z"))


def euler_from_quat(q: Column) -> Column:
    """quaternion -> struct(roll, pitch, yaw); pitch is +-pi/2 (sign of
    sinp) when abs(sinp) >= 1."""
    x, y, z, w = q["x"], q["y"], q["z"], q["w"]
    sinr = 2.0 * (w * x + y * z)
    cosr = 1.0 - 2.0 * (x * x + y * y)
    sinp = 2.0 * (w * y - z * x)
    siny = 2.0 * (w * z + x * y)
    cosy = 1.0 - 2.0 * (y * y + z * z)
    pitch = F.when(F.abs(sinp) >= 1.0, F.signum(sinp) * (PI / 2)).otherwise(F.asin(sinp))
    return F.struct(F.atan2(sinr, cosr).alias("roll"), pitch.alias("pitch"),
                    F.atan2(siny, cosy).alias("yaw"))


def yaw_from_quat(q: Column) -> Column:
    """heading only."""
    x, y, z, w = q["x"], q["y"], q["z"], q["w"]
    return F.atan2(2.0 * (w * z + x * y), 1.0 - 2.0 * (y * y + z * z))


def quat_from_euler(roll, pitch, yaw) -> Column:
    """extrinsic x-y-z Euler angles (roll about x, then pitch about y,
    then yaw about z, fixed axes) -> quaternion (x, y, z, w)."""
    r, p, y = _c(roll) / 2.0, _c(pitch) / 2.0, _c(yaw) / 2.0
    cr, sr, cp, sp, cy, sy = F.cos(r), F.sin(r), F.cos(p), F.sin(p), F.cos(y), F.sin(y)
    return quat_struct(sr * cp * cy - cr * sp * sy,
                       cr * sp * cy + sr * cp * sy,
                       cr * cp * sy - sr * sp * cy,
                       cr * cp * cy + sr * sp * sy)


def quat_dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"] + a["w"] * b["w"]


def quat_norm(q: Column) -> Column:
    return F.sqrt(quat_dot(q, q))


def _scale(q: Column, s: Column) -> Column:
    return quat_struct(q["x"] * s, q["y"] * s, q["z"] * s, q["w"] * s)


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def quat_clean(q: Column, eps: float = 1e-6) -> Column:
    """NaN/Inf parts or norm < eps -> identity; else normalised."""
    ok = _finite(q["x"]) & _finite(q["y"]) & _finite(q["z"]) & _finite(q["w"])
    n = quat_norm(q)
    ident = quat_struct(0.0, 0.0, 0.0, 1.0)
    return F.when(ok & (n >= eps), _scale(q, 1.0 / n)).otherwise(ident)


def slerp(q0: Column, q1: Column, t: Column) -> Column:
    """spherical interpolation, shortest path.

    Flip ``q1`` when the dot product is negative; above 0.9995 use a
    normalised lerp; the result is normalised (``q0`` if its norm is 0)."""
    d0 = quat_dot(q0, q1)
    sgn = F.when(d0 < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    d = F.abs(d0)
    theta = F.acos(F.least(F.greatest(d, F.lit(-1.0)), F.lit(1.0)))
    s = F.sin(theta)
    lin = d > 0.9995
    w0 = F.when(lin, 1.0 - t).otherwise(F.sin((1.0 - t) * theta) / s)
    w1 = F.when(lin, t).otherwise(F.sin(t * theta) / s) * sgn
    raw = quat_struct(q0["x"] * w0 + q1["x"] * w1, q0["y"] * w0 + q1["y"] * w1,
                      q0["z"] * w0 + q1["z"] * w1, q0["w"] * w0 + q1["w"] * w1)
    n = quat_norm(raw)
    return F.when(n > 0, _scale(raw, 1.0 / n)).otherwise(q0)


def slerp_columns(df, q0: Column, q1: Column, t: Column, out: str):
    """F4 as staged projections (same maths as ``slerp``): the dot product,
    angle and weights become columns first, so the final expression refers
    to attributes instead of repeating sub-expressions."""
    d0 = quat_dot(q0, q1)
    df = df.withColumn(f"{out}_d0", d0)
    d = F.abs(F.col(f"{out}_d0"))
    df = (df.withColumn(f"{out}_th", F.acos(F.least(F.greatest(d, F.lit(-1.0)), F.lit(1.0))))
          .withColumn(f"{out}_lin", d > 0.9995))
    th, lin = F.col(f"{out}_th"), F.col(f"{out}_lin")
    sgn = F.when(F.col(f"{out}_d0") < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    df = (df.withColumn(f"{out}_w0", F.when(lin, 1.0 - t).otherwise(F.sin((1.0 - t) * th) / F.sin(th)))
          .withColumn(f"{out}_w1", F.when(lin, t).otherwise(F.sin(t * th) / F.sin(th)) * sgn))
    w0, w1 = F.col(f"{out}_w0"), F.col(f"{out}_w1")
    df = df.withColumn(f"{out}_raw", quat_struct(q0["x"] * w0 + q1["x"] * w1, q0["y"] * w0 + q1["y"] * w1,
                                                 q0["z"] * w0 + q1["z"] * w1, q0["w"] * w0 + q1["w"] * w1))
    raw = F.col(f"{out}_raw")
    df = df.withColumn(f"{out}_n", quat_norm(raw))
    n = F.col(f"{out}_n")
    df = df.withColumn(out, F.when(n > 0, _scale(raw, 1.0 / n)).otherwise(q0))
    return df.drop(f"{out}_d0", f"{out}_th", f"{out}_lin", f"{out}_w0", f"{out}_w1",
                   f"{out}_raw", f"{out}_n")


def wrap_angle(a) -> Column:
    """wrap to [-pi, pi) as ``(a + pi) mod 2pi - pi``."""
    return F.pmod(_c(a) + F.lit(PI), F.lit(2 * PI)) - F.lit(PI)


def planar_to_matrix(x, y, theta) -> Column:
    """planar pose -> row-major 4x4 homogeneous transform (16 doubles)."""
    c, s = F.cos(_c(theta)), F.sin(_c(theta))
    z0, o1 = F.lit(0.0), F.lit(1.0)
    return F.array(c, -s, z0, _c(x).cast("double"),
                   s, c, z0, _c(y).cast("double"),
                   z0, z0, o1, z0,
                   z0, z0, z0, o1)


def matrix_to_planar(m) -> Column:
    """F7 inverse: struct(x, y, theta) from a row-major 4x4 array."""
    m = _c(m)
    return F.struct(m[3].alias("x"), m[7].alias("y"), F.atan2(m[4], m[0]).alias("theta"))


def degrees(a) -> Column:
    """F21."""
    return F.degrees(_c(a))
