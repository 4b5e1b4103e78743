"""Point-cloud explode (F25, re-aimed from the depth-points viewer).

A cloud row ``(cloud_id, width, height, point_step, is_bigendian, fields,
data)`` becomes one row per point with the requested float fields.  The
decode is vectorised per Arrow batch (NumPy strided views over the binary
blob); the output is ordinary rows for normal aggregations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Point-field datatype codes and their NumPy types.
POINT_DTYPES = {1: "i1", 2: "u1", 3: "i2", 4: "u2", 5: "i4", 6: "u4", 7: "f4", 8: "f8"}


def explode_points(clouds: DataFrame, names: tuple[str, ...] = ("x", "y", "z"),
                   key: str = "cloud_id") -> DataFrame:
    """One row per point: ``key, point_index, <names> (double)``; points
    whose values are not finite are kept (callers filter)."""
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("point_index", T.LongType())] +
                          [T.StructField(n, T.DoubleType()) for n in names])

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                n = int(row.width) * int(row.height)
                step = int(row.point_step)
                buf = np.frombuffer(bytes(row.data), dtype=np.uint8)
                n = min(n, len(buf) // step) if step else 0
                out = {key: np.full(n, getattr(row, key), dtype=np.int64),
                       "point_index": np.arange(n, dtype=np.int64)}
                offsets = {f["name"]: (int(f["offset"]), int(f["datatype"])) for f in row.fields}
                order = ">" if row.is_bigendian else "<"
                for name in names:
                    if name not in offsets:
                        out[name] = np.full(n, np.nan)
                        continue
                    off, code = offsets[name]
                    dt = np.dtype(order + POINT_DTYPES[code])
                    view = np.ndarray((n,), dtype=dt, buffer=buf, offset=off, strides=(step,))
                    out[name] = view.astype(np.float64)
                yield pd.DataFrame(out)

    return clouds.mapInPandas(fn, schema)
