"""Limits of a robot model applied by joint name (S11 into P22).

Limits come as rows (model, joint name, lower, upper) in any order; a vector's
order comes with it as an array of names.  A joint of the model without limits
is free; a name that the model does not have is unknown, and reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "model"


def limit_maps(joints: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per model: ``limits``, a map from joint name to (lower, upper),
    as many entries as the model has joints; a name listed twice counts once,
    with the narrower bounds."""
    one = joints.groupBy(model, "name").agg(F.max("lower").alias("lower"), F.min("upper").alias("upper"))
    return one.groupBy(model).agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("lower", "upper")))).alias("limits"))


def _entries(names: Column, values: Column, limits: Column) -> Column:
    """One struct per position: pos, joint, value, known, lower, upper."""
    def entry(n: Column, i: Column) -> Column:
        bound = F.try_element_at(limits, n)
        return F.struct(i.alias("pos"), n.alias("joint"), F.get(values, i).cast("double").alias("value"),
                        F.coalesce(F.map_contains_key(limits, n), F.lit(False)).alias("known"), bound["lower"].alias("lower"), bound["upper"].alias("upper"))
    return F.transform(names, entry)


def _joined(df: DataFrame, maps: DataFrame, names: str, values: str, model: str) -> DataFrame:
    return df.join(maps.select(model, F.col("limits").alias("_limits")), model, "left").withColumn(
        "_entries", _entries(F.col(names), F.col(values), F.col("_limits"))).drop("_limits")


def violations(df: DataFrame, maps: DataFrame, names: str, values: str, keys: list[str], model: str = MODEL) -> DataFrame:
    """One row per joint outside its limits: keys, model, pos, joint, value, lower, upper."""
    bad = F.filter("_entries", lambda e: (e["value"] < e["lower"]) | (e["value"] > e["upper"]))
    rows = _joined(df, maps, names, values, model).select(*keys, model, F.inline(bad))
    return rows.drop("known")


def unknown_joints(df: DataFrame, maps: DataFrame, names: str, values: str, model: str = MODEL) -> DataFrame:
    """(model, joint, n): names that a vector has and its model has not."""
    unknown = F.filter("_entries", lambda e: ~e["known"])
    return (_joined(df, maps, names, values, model).select(model, F.explode(F.transform(unknown, lambda e: e["joint"])).alias("joint"))
            .groupBy(model, "joint").agg(F.count(F.lit(1)).alias("n")))


def clamped(df: DataFrame, maps: DataFrame, names: str, values: str, out: str, model: str = MODEL) -> DataFrame:
    """``out``: the vector with every limited joint inside its limits; null and
    NaN stay as they are."""
    def one(e: Column) -> Column:
        x = e["value"]
        inside = F.least(F.greatest(x, F.coalesce(e["lower"], x)), F.coalesce(e["upper"], x))
        return F.when(x.isNull() | F.isnan(x), x).otherwise(inside)
    return _joined(df, maps, names, values, model).withColumn(out, F.transform("_entries", one)).drop("_entries")
