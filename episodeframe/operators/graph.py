"""Transform-tree queries.

Edges are ``(child, parent)`` rows with an arrival key; the latest edge per
child wins.  The walk from the roots is one join per tree level, with the path
kept as an array so ordering by it gives the depth-first listing (children
sorted by name).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodeframe.session import cut_lineage


def latest_edges(transforms: DataFrame, child: str = "child", order: list[str] | None = None) -> DataFrame:
    """One row per child frame, the one with the greatest ``order``
    (default ``(ts, seq)``)."""
    order = order or ["ts", "seq"]
    others = [c for c in transforms.columns if c != child]
    agg = transforms.groupBy(child).agg(
        F.max_by(F.struct(*others), F.struct(*order)).alias("_t"))
    return agg.select(child, *[F.col("_t")[c].alias(c) for c in others])


def frame_universe(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """Every frame named as a child or a parent."""
    return (edges.select(F.col(child).alias("frame"))
            .union(edges.select(F.col(parent).alias("frame"))).distinct())


def roots(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """U4: parents that are nobody's child."""
    p = edges.select(F.col(parent).alias("frame")).distinct()
    c = edges.select(F.col(child).alias("frame"))
    return p.join(c, "frame", "left_anti")


def tree_walk(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """``(frame, root, depth, path)`` for every frame reachable from a
    root; ordering by ``path`` gives the depth-first listing.

    One equi-join per level, each level a written table, so neither the number
    of rows nor the depth has a limit.  A frame that is already on its own path
    is not entered again; frames on cycles without a root are what
    ``unreached`` reports."""
    e = cut_lineage(edges.select(F.col(child).alias("_c"), F.col(parent).alias("_p")).where("_c is not null"))
    level = roots(e, "_c", "_p").where("frame is not null").select(
        "frame", F.col("frame").alias("root"), F.lit(0).alias("depth"), F.array("frame").alias("path"))
    levels = []
    while True:
        level = cut_lineage(level)
        if levels and level.isEmpty():
            break
        levels.append(level)
        level = (level.join(e, F.col("frame") == F.col("_p")).where(~F.array_contains("path", F.col("_c")))
                 .select(F.col("_c").alias("frame"), "root", (F.col("depth") + 1).alias("depth"),
                         F.concat("path", F.array("_c")).alias("path")))
    return functools.reduce(DataFrame.union, levels)


def unreached(edges: DataFrame, walk: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """Frames that no root reaches: they lie on or below a cycle."""
    return frame_universe(edges, child, parent).where("frame is not null").join(walk.select("frame"), "frame", "left_anti")
