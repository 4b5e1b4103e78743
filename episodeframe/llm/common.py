"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episodeframe.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["cut_lineage", "shared_path", "id_crc", "fresh", "bounded_sample", "connected_components", "word_count"]

#: Words of the size and shingle contracts: runs without space, tab and LF..CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def id_crc(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use (column names ignore case)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def bounded_sample(rows: DataFrame, by: str, most: dict | int) -> DataFrame:
    """At most ``most`` rows (a number, or one per value of ``by``) of each
    group, the first by a hash of ``id`` and ``text``.

    Groups are thinned by the hash before they meet in a task, so a task gets
    about twice what it keeps, however large a group is."""
    groups = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}
    if not groups:
        return rows
    key, cases, bounds = F.xxhash64("id", "text"), F.lit(0.0), F.lit(0)
    for g, n in groups.items():
        k = most[g] if isinstance(most, dict) else most
        cases = F.when(F.col(by) == g, F.lit(min(1.0, (2 * k + 50) / n))).otherwise(cases)
        bounds = F.when(F.col(by) == g, F.lit(k)).otherwise(bounds)
    thin = rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < cases * (1 << 30))
    first = Window.partitionBy(by).orderBy(key, "id")
    return (thin.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= max(most.values()) if isinstance(most, dict)
                                                                    else F.col("_r") <= most)
            .where(F.col("_r") <= bounds).drop("_r"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph, distributed.

    ``edges`` has long columns ``a`` and ``b``.  Returns ``node``, ``root`` for
    every node of an edge; ``root`` is the smallest node of its component.
    Alternates large-star and small-star contraction, so the number of rounds
    grows with the logarithm of the longest path.  Each round is one written
    table in the shared checkpoint folder: nothing of the graph is gathered on
    the driver and a lost executor repeats at most one round.  Empty input
    gives empty output; self loops and repeated edges are harmless.
    """
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct())
    seen = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour hangs on the smallest neighbour
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours of a node hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut_lineage(small)
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or tuple(state) == seen:
            break
        seen = tuple(state)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
