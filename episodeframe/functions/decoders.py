"""Message decoders (F11): landed JSON payload -> typed record.

Each decoder kind has a fixed schema; ``from_json`` parses only the fields
in it.  Unreadable payloads give null (count them with P4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_XYZ = T.StructType([T.StructField(c, T.DoubleType()) for c in "xyz"])
_QUAT = T.StructType([T.StructField(c, T.DoubleType()) for c in "xyzw"])
_POSE = T.StructType([T.StructField("position", _XYZ), T.StructField("orientation", _QUAT)])
_ARR = T.ArrayType(T.DoubleType())

# Decoder kinds and their record shapes.
DECODER_SCHEMAS: dict[str, T.StructType] = {
    "pose": _POSE,
    "joint": T.StructType([T.StructField("names", T.ArrayType(T.StringType())),
                           T.StructField("positions", _ARR), T.StructField("velocities", _ARR),
                           T.StructField("efforts", _ARR)]),
    "odometry": T.StructType([T.StructField("pose", _POSE),
                              T.StructField("twist", T.StructType([T.StructField("linear", _XYZ),
                                                                   T.StructField("angular", _XYZ)]))]),
    "float": T.StructType([T.StructField("value", T.DoubleType())]),
    "array": T.StructType([T.StructField("data", _ARR)]),
}


def decode(payload: Column | str, kind: str) -> Column:
    """decode one payload column with the ``kind`` decoder."""
    if kind not in DECODER_SCHEMAS:
        raise ValueError(f"unknown decoder {kind!r}; known: {sorted(DECODER_SCHEMAS)}")
    c = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(c, DECODER_SCHEMAS[kind], {"mode": "PERMISSIVE"})


def decode_routed(payload: Column | str, decoder: Column | str) -> Column:
    """Decode a payload whose decoder kind comes from the topic dimension
    (J7): one union struct with one member per kind, only the routed one set."""
    c = F.col(payload) if isinstance(payload, str) else payload
    d = F.col(decoder) if isinstance(decoder, str) else decoder
    return F.struct(*[F.when(d == k, decode(c, k)).alias(k) for k in DECODER_SCHEMAS])
