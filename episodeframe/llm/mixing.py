"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into hashed blocks of documents.  From the target words of
a source follows how many of its (permuted) blocks the mix takes: whole passes
over the source, then a part of one more.  These exact block quotas are split
recursively among the output shards: each tree node draws, by a seeded
multivariate hypergeometric, how many blocks of each source go left.  A shard
then owns a run of the permuted blocks that no other shard has, and its
documents are shuffled within the shard.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage, word_count

WEIGHTS = (5.0, 2.0, 1.0)
_OUT, _IN = 12, 24  # blocks of a part pass that are chosen anew against rounding


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS,
            most: float = 3.0) -> dict[str | None, float]:
    """Target words per source.  Sources by code point, null last, weigh
    ``weights`` in turn and share the sum of all sizes; a target stops at
    ``most`` times its source's size and the excess is shared again by weight
    among the rest until none is above."""
    order = sorted(sizes, key=lambda r: (r[0] is None, r[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    limit = {s: most * n for s, n in order}
    out: dict[str | None, float] = {}
    left, rest = float(sum(n for _, n in order)), list(weight)
    while rest:
        unit = left / sum(weight[s] for s in rest)
        full = [s for s in rest if unit * weight[s] > limit[s]]
        if not full:
            out |= {s: unit * weight[s] for s in rest}
            break
        for s in full:
            out[s] = limit[s]
            left -= limit[s]
        rest = [s for s in rest if s not in out]
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source per shard (shards x sources), summing exactly to
    ``quotas``: a binary tree over the shards whose nodes draw the left half's
    blocks, without replacement, from all blocks of the node."""
    out = np.zeros((shards, len(quotas)), np.int64)
    nodes = [(0, shards, np.asarray(quotas, np.int64))]
    while nodes:
        low, high, have = nodes.pop()
        if high - low == 1:
            out[low] = have
            continue
        mid = (low + high) // 2
        take = int(have.sum()) * (mid - low) // (high - low)
        rng = np.random.Generator(np.random.PCG64([seed, low, high]))
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if have.sum() else have * 0
        nodes += [(low, mid, left), (mid, high, have - left)]
    return out


def _pass_order(seed: int, passes: Column) -> Column:
    """Order of a source's blocks within a pass (a permutation by hash)."""
    return F.xxhash64(F.lit(seed), passes, "block")


def nearest_subset(words: list[int], goal: float, units: int = 1_000_000, step: int = 64) -> list[int]:
    """Positions of a subset of ``words`` whose sum comes nearest to ``goal``,
    early positions first (subset sums as bits of an integer, in about
    ``units`` steps: exact if the goal and the largest useful word count are
    below).  The sums before every ``step``-th word are kept, those between
    are formed again on the way back."""
    use = [i for i, w in enumerate(words) if 0 < w <= 2 * goal]  # none at all is nearer than a larger one
    if not use:
        return []
    # sums over goal + largest are never nearest: less one word they are still over the goal
    unit = max(1, math.ceil(min(sum(words[i] for i in use), goal + max(words[i] for i in use)) / units))
    scaled, exact = [round(words[i] / unit) for i in use], goal / unit
    want = round(exact)
    mask = (1 << want + max(scaled) + 1) - 1
    reach, kept, n = 1, [], 0
    while n < len(scaled) and not reach >> want & 1:
        if n % step == 0:
            kept.append(reach)
        reach |= reach << scaled[n] & mask
        n += 1
    below = (reach & ((1 << want + 1) - 1)).bit_length() - 1
    above = reach >> want
    above = want + (above & -above).bit_length() - 1 if above else below
    at, out = (below if abs(exact - below) <= abs(above - exact) else above), []
    for k in range(len(kept) - 1, -1, -1):
        low, sums = k * step, [kept[k]]
        for w in scaled[low:min(low + step, n)]:
            sums.append(sums[-1] | sums[-1] << w & mask)
        for i in range(len(sums) - 2, -1, -1):
            if not sums[i] >> at & 1:
                out.append(use[low + i])
                at -= scaled[low + i]
    return out


def _part_pass(blocks: pd.DataFrame) -> pd.DataFrame:
    """Blocks of a source's part pass: of all its blocks (at most ``blocks``
    rows a source) the subset nearest to the rest, early ones in permuted
    order first.  Where sums were rounded, blocks that bring the words nearer
    change sides, and then those nearest in size to the gap (``_OUT`` taken,
    ``_IN`` not taken) are chosen anew."""
    b = blocks.sort_values(["ord", "block"], ignore_index=True)
    rest, words = float(b["rest"].iloc[0]), b["words"].astype(int).tolist()
    taken = set(nearest_subset(words, rest))
    gap = rest - sum(words[i] for i in taken)
    for i, w in enumerate(words):
        if abs(left := gap + (w if i in taken else -w)) < abs(gap):
            taken ^= {i}
            gap = left
    near = sorted((i for i, w in enumerate(words) if w), key=lambda i: abs(words[i] - abs(gap)))
    some = [i for i in near if i in taken][:_OUT] + [i for i in near if i not in taken][:_IN]
    goal = gap + sum(words[i] for i in some if i in taken)
    anew = {some[k] for k in nearest_subset([words[i] for i in some], goal)}
    if abs(goal - sum(words[i] for i in anew)) < abs(gap):
        taken = taken - set(some) | anew
    b = b.iloc[sorted(taken)]
    return pd.DataFrame({"source": b["source"], "pass": b["passes"], "block": b["block"], "ord": b["ord"]})


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, blocks: int = 4096, shards: int = 256,
         seed: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the mix takes: (documents, sources, draws).

    documents: one row per row of ``docs``: id, source, size, ``key`` (hash of
    the row's id and text), ``block``.  sources: source, source_size, target.
    draws: (source, pass, block, shard): the block's documents go to ``shard``
    once more.  At most ``blocks`` blocks a source, so draws have at most
    (most + 1) x blocks rows a source; the driver sees one row per source.
    """
    spark = docs.sparkSession
    meta = cut_lineage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("key")))
    meta = meta.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    per_block = cut_lineage(meta.groupBy("source", "block").agg(F.sum("size").alias("words")))
    sizes = [(r[0], r[1]) for r in per_block.groupBy("source").agg(F.sum("words")).collect()]
    goal = targets(sizes, weights, most)
    rows = [(s, n, float(goal[s]), int(goal[s] // n) if n else 0) for s, n in sizes]
    sources = spark.createDataFrame(rows, "source string, source_size long, target double, passes int")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    each = per_block.join(F.broadcast(sources), per_block["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    kind = "source string, pass int, block long, ord long"
    whole = (each.where("passes > 0").select("source", F.explode(F.expr("sequence(0, passes - 1)")).alias("pass"), "block")
             .withColumn("ord", _pass_order(seed, F.col("pass"))))
    part = (each.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")).where("rest > 0")
            .withColumn("ord", _pass_order(seed, F.col("passes"))).groupBy("source").applyInPandas(_part_pass, kind))
    taken = cut_lineage(whole.select("source", "pass", "block", "ord").union(part))
    # the splitting tree over the exact quotas; shards own runs of the permuted blocks
    quota = {r[0]: r[1] for r in taken.groupBy("source").count().collect()}
    names = sorted(quota, key=lambda s: (s is None, s or ""))
    share = split_quotas(np.array([quota[s] for s in names], np.int64), shards, seed)
    runs, ends = [], share.cumsum(0)
    for k, s in enumerate(names):
        runs += [(s, i, int(ends[i, k] - share[i, k]), int(ends[i, k])) for i in range(shards) if share[i, k]]
    runs_df = spark.createDataFrame(runs, "source string, shard int, low long, high long")
    nth = taken.withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy("pass", "ord", "block")) - 1)
    draws = nth.join(F.broadcast(runs_df), nth["source"].eqNullSafe(runs_df["source"]) & (F.col("n") >= F.col("low"))
                     & (F.col("n") < F.col("high"))).select(nth["source"], "pass", "block", "shard")
    return meta, sources, cut_lineage(draws)


def _drawn(rows: DataFrame, draws: DataFrame, source: str, block: str, broadcast_rows: int = 500_000) -> DataFrame:
    """``rows`` joined to their draws (struct array ``_draws``)."""
    lists = draws.groupBy(F.col("source").alias("_s"), F.col("block").alias("_b")).agg(
        F.sort_array(F.collect_list(F.struct("shard", "pass"))).alias("_draws"))
    if draws.count() <= broadcast_rows:  # at most 4 x blocks rows a source
        lists = F.broadcast(lists)
    out = rows.join(lists, F.col(source).eqNullSafe(F.col("_s")) & (F.col(block) == F.col("_b")), "left").drop("_s", "_b")
    return out.withColumn("_draws", F.coalesce("_draws", F.array().cast("array<struct<shard:int,pass:int>>")))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **options) -> DataFrame:
    """Per row of ``docs``: id, source, ``size``, ``source_size``, ``target``,
    ``copies`` and ``taken`` (size x copies).

    Null texts have size 0 and are taken with their block; a null source is a
    source of its own, the last; if all sizes are 0 all targets are 0 and
    nothing is taken.  Repeated rows share a block and are taken alike, so no
    row exceeds ``most`` times its size.  Reruns agree: all choices are hashes.
    """
    meta, sources, draws = plan(docs, id_col, text_col, source_col, **options)
    rows = _drawn(meta, draws, "source", "block").withColumn("copies", F.size("_draws"))
    rows = rows.join(F.broadcast(sources), rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    return rows.select(F.col("id").alias(id_col), rows["source"].alias(source_col), "size", "source_size", "target",
                       "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", blocks: int = 4096,
        seed: int = 20, shard_col: str | None = None, **options) -> DataFrame:
    """The mixed documents: rows of ``docs`` as often as they are drawn, by
    shard and shuffled within it; columns as in ``docs`` (and ``shard_col``).
    Cases as in ``mix_report``."""
    _, _, draws = plan(docs, id_col, text_col, source_col, blocks=blocks, seed=seed, **options)
    # the row travels as one struct, so its columns cannot clash with the plan's
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(source_col).cast("string").alias("source"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("key"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    out = _drawn(rows, draws, "source", "block").withColumn("draw", F.explode("_draws")).select(
        "doc", F.col("draw")["shard"].alias("shard"), "key", F.col("draw")["pass"].alias("pass"))
    out = out.withColumn("ord", F.xxhash64(F.lit(seed + 1), "shard", "pass", "key"))
    out = out.repartition("shard").sortWithinPartitions("shard", "ord")
    return out.select("doc.*", *([F.col("shard").alias(shard_col)] if shard_col else []))
