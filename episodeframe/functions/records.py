"""Message -> plain record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields never copied into plain records (sensor stamp, header).
EXCLUDED_FIELDS = frozenset({"stamp", "header"})


def plain_record(c: Column, dtype: T.DataType, exclude: frozenset = EXCLUDED_FIELDS) -> Column:
    """Rebuild ``c`` without excluded and private (``_``-prefixed) fields,
    recursively through structs, arrays and map values.  The shape is known
    from the schema at plan time, so this is one projection."""
    if isinstance(dtype, T.StructType):
        keep = [f for f in dtype.fields if f.name not in exclude and not f.name.startswith("_")]
        return F.when(c.isNotNull(), F.struct(*[plain_record(c[f.name], f.dataType, exclude).alias(f.name)
                                                for f in keep]))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StructType, T.ArrayType, T.MapType)):
        return F.transform(c, lambda x: plain_record(x, dtype.elementType, exclude))
    if isinstance(dtype, T.MapType) and isinstance(dtype.valueType, (T.StructType, T.ArrayType, T.MapType)):
        return F.transform_values(c, lambda k, v: plain_record(v, dtype.valueType, exclude))
    return c


def plain_json(c: Column, dtype: T.DataType) -> Column:
    return F.to_json(plain_record(c, dtype))
