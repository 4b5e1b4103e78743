"""Typed vector fields over JSON records of any shape.

A frame's sensors and commands are maps from stream name to a VARIANT.  A layout
names, per field, the stream, the kind of value and, for joints, which of them;
a stream that is missing gives zeros, so a layout's width is known at plan time
(except for whole tactile arrays)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from episodeframe.functions import quaternion as Q
from episodeframe.functions import variants as V

POSITION, EULER, GRIPPER, JOINTS, ODOM, TACTILE = (
    "position", "orientation_euler", "gripper_position", "joint_positions", "odom_xy_yaw", "tactile")
_FIXED = {POSITION: 3, EULER: 3, GRIPPER: 1, ODOM: 3}


@dataclass(frozen=True)
class TypedField:
    """``index`` picks joints by position (one or a list), else ``dim`` pads or
    cuts the list to a width; ``dim`` None keeps a tactile array whole."""

    name: str
    source: str | None
    kind: str
    index: int | tuple[int, ...] | None = None
    dim: int | None = None

    @property
    def width(self) -> int | None:
        if self.kind in _FIXED:
            return _FIXED[self.kind]
        if self.kind == JOINTS and self.index is not None:
            return 1 if isinstance(self.index, int) else len(self.index)
        return self.dim


def number(v: Column, path: str, default: float = 0.0) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "double"), F.lit(default))


def _orientation(v: Column, path: str) -> Column:
    return Q.quat_struct(*[number(v, f"{path}.{c}", d) for c, d in zip("xyzw", (0.0, 0.0, 0.0, 1.0))])


def _numbers(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "array<double>"), F.array().cast("array<double>"))


def fit(v: Column, width: int) -> Column:
    """Exactly ``width`` elements, zeros behind."""
    return F.slice(F.concat(v, F.array_repeat(F.lit(0.0), F.lit(width))), 1, width)


def value(field: TypedField, v: Column) -> Column:
    """the field's numbers out of the stream's VARIANT (NULL: missing)."""
    if field.kind == POSITION:
        return F.array(*[number(v, f"$.position.{c}") for c in "xyz"])
    if field.kind == EULER:
        e = Q.euler_from_quat(_orientation(v, "$.orientation"))
        missing = F.array(*[F.lit(0.0)] * 3)
        return F.when(v.isNull(), missing).otherwise(F.array(e["roll"], e["pitch"], e["yaw"]))
    if field.kind == GRIPPER:
        p = V.member(v, "position")
        scalar = V.kind(p).isin("BIGINT", "DECIMAL", "DOUBLE", "BOOLEAN")
        return F.array(F.coalesce(F.when(scalar, V.as_number_text(p).try_cast("double")), F.lit(0.0)))
    if field.kind == ODOM:
        yaw = Q.yaw_from_quat(_orientation(v, "$.pose.orientation"))
        return F.array(number(v, "$.pose.position.x"), number(v, "$.pose.position.y"), F.when(v.isNull(), 0.0).otherwise(yaw))
    if field.kind == JOINTS:
        joints = _numbers(v, "$.positions")
        if field.index is None:
            return fit(joints, field.dim or 0)
        picks = (field.index,) if isinstance(field.index, int) else field.index
        return F.array(*[F.coalesce(F.get(joints, F.lit(i)), F.lit(0.0)) for i in picks])
    if field.kind == TACTILE:
        force = _numbers(v, "$.force")
        return force if field.dim is None else fit(force, field.dim)
    return F.array_repeat(F.lit(0.0), F.lit(field.dim or 0))


def vector(streams: Column, layout: list[TypedField]) -> Column:
    """Concatenated fields of a ``map<string, variant>``."""
    none = F.lit(None).cast("variant")
    return F.concat(*[value(f, F.try_element_at(streams, F.lit(f.source)) if f.source else none) for f in layout])


def command(v: Column) -> Column:
    """One command stream flat: a list as it is, an object's ``positions``, a pose
    as seven numbers, else the object's numbers in the order of their keys."""
    rest = F.transform(F.filter(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")),
                                lambda e: V.kind(e["value"]).isin("BIGINT", "DECIMAL", "DOUBLE")),
                       lambda e: F.struct(e["key"].alias("k"), F.try_variant_get(e["value"], "$", "double").alias("n")))
    pose = F.array(*[number(v, f"$.position.{c}") for c in "xyz"], *[number(v, f"$.orientation.{c}") for c in "xyzw"])
    return (F.when(V.kind(v) == "ARRAY", _numbers(v, "$")).when(V.member(v, "positions").isNotNull(), _numbers(v, "$.positions"))
            .when(V.member(v, "position").isNotNull() & V.member(v, "orientation").isNotNull(), pose)
            .when(V.kind(v) == "OBJECT", F.transform(F.array_sort(rest), lambda x: x["n"])).otherwise(F.array().cast("array<double>")))


def commands(streams: Column) -> Column:
    """all command streams in the order of their names."""
    return F.flatten(F.transform(F.array_sort(F.map_keys(streams)), lambda k: command(F.element_at(streams, k))))
