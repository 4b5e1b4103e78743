"""Vector builders and array helpers as Column expressions (F8-F16, F18,
F20, F22, P6, P8).

Extractors read the aligned payload of one stream.  A payload is a struct
with any of: ``position{x,y,z}``, ``orientation{x,y,z,w}``, ``positions``
(joint array), ``data`` (multi-array), ``value`` (float), ``pose{position,
orientation}`` (odometry).  Missing source or short array gives 0.0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.functions import quaternion as Q

# The extractor names accepted in a vector layout, with the
# payload field each one reads and the part of it.
SCALARS = {
    "pose.position.x": ("position", "x"), "pose.position.y": ("position", "y"), "pose.position.z": ("position", "z"),
    "pose.euler.roll": ("orientation", "roll"), "pose.euler.pitch": ("orientation", "pitch"),
    "pose.euler.yaw": ("orientation", "yaw"),
    "odom.position.x": ("pose.position", "x"), "odom.position.y": ("pose.position", "y"),
    "odom.euler.yaw": ("pose.orientation", "yaw"),
    "float.value": ("value", ""),
}
ARRAYS = {"joint.position": "positions", "array": "data"}
SUPPORTED_EXTRACTORS = tuple(SCALARS)


@dataclass(frozen=True)
class Extractor:
    """A parsed extractor: a constant, or a part of a payload field.

    ``part`` is a struct member, an Euler angle, an array position, or empty
    for the field itself."""

    constant: float | None = None
    field: str = ""
    part: str | int = ""

    @classmethod
    def parse(cls, text: str) -> Extractor:
        kind, colon, number = text.partition(":")
        if kind == "constant" and colon:
            try:
                return cls(constant=float(number))
            except ValueError:
                raise ValueError(f"not a constant: {text!r}") from None
        if text in SCALARS:
            return cls(None, *SCALARS[text])
        name, bracket, rest = text.partition("[")
        if bracket and rest.endswith("]") and name in ARRAYS and rest[:-1].isascii() and rest[:-1].isdigit():
            return cls(None, ARRAYS[name], int(rest[:-1]))
        raise ValueError(f"not an extractor: {text!r}")

    def column(self, sample: Column | None, fields: set[str]) -> Column:
        """The value as a double; 0.0 where the payload lacks it."""
        if self.constant is not None:
            return F.lit(self.constant)
        top, _, inner = self.field.partition(".")
        known = sample is not None and top in fields
        if self.part in ("roll", "pitch", "yaw"):
            quat = (sample[top][inner] if inner else sample[top]) if known else None
            value = Q.euler_from_quat(_quat_or_identity(quat))[self.part]
        elif not known:
            return F.lit(0.0)
        else:
            value = sample[top][inner] if inner else sample[top]
            if isinstance(self.part, int):
                value = F.try_element_at(value, F.lit(self.part + 1))
            elif self.part:
                value = value[self.part]
            value = F.coalesce(value.cast("double"), F.lit(0.0))
        return value if sample is None else F.when(sample.isNull(), 0.0).otherwise(value)


def validate_extractor(extractor: str, label: str = "field") -> None:
    """Raise unless ``extractor`` parses."""
    try:
        Extractor.parse(extractor)
    except ValueError as e:
        raise ValueError(f"{label}: {e}") from e


def _struct_fields(df: DataFrame, col: str) -> set[str]:
    dt = df.schema[col].dataType
    return {f.name for f in getattr(dt, "fields", [])}


def _quat_or_identity(o: Column | None) -> Column:
    """Missing quaternion parts default to (0, 0, 0, 1)."""
    if o is None:
        return Q.quat_struct(0.0, 0.0, 0.0, 1.0)
    return Q.quat_struct(*[F.coalesce(o[c], F.lit(d)) for c, d in zip("xyzw", (0.0, 0.0, 0.0, 1.0))])


def extract(extractor: str, sample: Column | None, fields: set[str]) -> Column:
    """F8: one scalar from a payload struct; 0.0 when the source is missing.

    ``fields`` are the payload struct's field names (known from the schema at
    plan time)."""
    parsed = Extractor.parse(extractor)
    return parsed.column(sample, fields) if sample is not None or parsed.constant is not None else F.lit(0.0)


@dataclass(frozen=True)
class FieldSpec:
    """One slot of a vector layout: output name, source stream, extractor."""

    name: str
    source: str | None
    extractor: str
    enabled: bool = True


def build_vector(df: DataFrame, layout: list[FieldSpec], as_float: bool = True) -> Column:
    """ordered fields -> ``array<float>`` (cast at the end; doubles kept
    when ``as_float`` is false)."""
    cols = []
    for f in layout:
        if not f.enabled:
            continue
        if f.extractor.startswith("constant:") or f.source is None or f.source not in df.columns:
            cols.append(extract(f.extractor, None, set()))
        else:
            fields = _struct_fields(df, f.source)
            if not fields:  # a bare numeric column: float.value / constant semantics
                cols.append(F.coalesce(F.col(f.source).cast("double"), F.lit(0.0)))
            else:
                cols.append(extract(f.extractor, F.col(f.source), fields))
    v = F.array(*cols)
    return v.cast("array<float>") if as_float else v


def missing_mask(df: DataFrame, layout: list[FieldSpec]) -> Column:
    """Which slots were zero-filled because their source had no sample."""
    return F.array(*[
        (F.lit(False) if (f.extractor.startswith("constant:") or f.source is None)
         else (F.lit(True) if f.source not in df.columns else F.col(f.source).isNull()))
        for f in layout if f.enabled])


def check_action_width(state_layout: list[FieldSpec], action_layout: list[FieldSpec]) -> None:
    ns = sum(1 for f in state_layout if f.enabled)
    na = sum(1 for f in action_layout if f.enabled)
    if na and na != ns:
        raise ValueError(f"action width {na} must equal state width {ns}")


# ---------------------------------------------------------------- F10 / F12

def pose7(p: Column) -> Column:
    """pose -> [x, y, z, qx, qy, qz, qw]."""
    return F.array(p["position"]["x"], p["position"]["y"], p["position"]["z"],
                   p["orientation"]["x"], p["orientation"]["y"], p["orientation"]["z"],
                   p["orientation"]["w"]).cast("array<double>")


def odom13(o: Column) -> Column:
    """odometry -> pose 7 + linear 3 + angular 3."""
    tw = o["twist"]
    return F.concat(pose7(o["pose"]), F.array(
        tw["linear"]["x"], tw["linear"]["y"], tw["linear"]["z"],
        tw["angular"]["x"], tw["angular"]["y"], tw["angular"]["z"]).cast("array<double>"))


def imu10(i: Column) -> Column:
    """IMU -> orientation 4 + angular velocity 3 + linear acceleration 3."""
    o, av, la = i["orientation"], i["angular_velocity"], i["linear_acceleration"]
    return F.array(o["x"], o["y"], o["z"], o["w"], av["x"], av["y"], av["z"],
                   la["x"], la["y"], la["z"]).cast("array<double>")


def position_euler6(p: Column) -> Column:
    """F10 ``position`` + ``orientation_euler``: [x, y, z, roll, pitch, yaw]."""
    e = Q.euler_from_quat(p["orientation"])
    return F.array(p["position"]["x"], p["position"]["y"], p["position"]["z"],
                   e["roll"], e["pitch"], e["yaw"]).cast("array<double>")


def odom_xy_yaw(o: Column) -> Column:
    """F10 ``odom_xy_yaw``."""
    return F.array(o["pose"]["position"]["x"], o["pose"]["position"]["y"],
                   Q.yaw_from_quat(o["pose"]["orientation"])).cast("array<double>")


def select_joints(values: Column, names: Column, wanted: list[str]) -> Column:
    """Pick joints by name in request order; unknown names skipped."""
    pos = F.filter(F.transform(F.array(*[F.lit(n) for n in wanted]),
                               lambda n: F.array_position(names, n)), lambda p: p > 0)
    return F.transform(pos, lambda p: F.element_at(values, p.cast("int")))


# ---------------------------------------------------------------- F13-F16

def flatten_sorted_map(m: Column) -> Column:
    """flatten a ``map<string, array<double>>`` in sorted key order."""
    return F.flatten(F.transform(F.array_sort(F.map_keys(m)), lambda k: F.element_at(m, k)))


def pad_or_truncate(v: Column, n: int, fill: float = 0.0) -> Column:
    """F14 (fill 0) / F15 (fill NaN): exactly ``n`` elements."""
    filler = F.array_repeat(F.lit(fill).cast("double"), F.lit(n))
    return F.slice(F.concat(v.cast("array<double>"), filler), 1, n)


def reshape(flat: Column, d: int) -> Column:
    """flat vector -> array of rows of width ``d`` (the last row may be
    short; an empty vector has no rows)."""
    last = F.greatest(F.ceil(F.size(flat) / F.lit(d)).cast("int") - 1, F.lit(0))
    rows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(flat, i * d + 1, d))
    return F.filter(rows, lambda r: F.size(r) > 0)


def hold_last(v: Column, i: Column) -> Column:
    """F16: element ``min(i, len - 1)`` (0-based)."""
    return F.element_at(v, F.least(i, F.size(v) - 1) + 1)


# ---------------------------------------------------------------- F18, F20, F22, P8

def vec_delta(a: Column, b: Column) -> Column:
    """``b - a`` elementwise."""
    return F.zip_with(a, b, lambda x, y: y - x)


def max_abs_delta(a: Column, b: Column) -> Column:
    return F.array_max(F.transform(vec_delta(a, b), lambda x: F.abs(x)))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance between two vectors."""
    return F.sqrt(F.aggregate(vec_delta(a, b), F.lit(0.0), lambda acc, x: acc + x * x))


def minmax_255(v: Column) -> Column:
    """scale to 0-255 (all zero when max == min)."""
    lo, hi = F.array_min(v), F.array_max(v)
    return F.transform(v, lambda x: F.when(hi == lo, F.lit(0.0))
                       .otherwise((x - lo) / (hi - lo) * 255.0))


def width_rejects(df: DataFrame, col: str, width: int) -> DataFrame:
    """rows whose vector width differs from ``width``."""
    return df.where(F.col(col).isNull() | (F.size(col) != width))


def drop_nan(v: Column) -> Column:
    """Remove null and NaN elements."""
    return F.filter(v, lambda x: x.isNotNull() & ~F.isnan(x))
