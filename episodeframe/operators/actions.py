"""Action derivation over frame tables.

Frame tables have a dense ``frame_index`` (0..n-1) per episode, so every
bounded window here runs on halo blocks and every unbounded one as a
blocked scan or a per-episode aggregate: no window spans a whole episode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodeframe.operators.blocks import (BLK, DEFAULT_BLOCK, HALO, Scan, block_of, carry_scan,
                                           drop_halo, halo_blocks, halo_window, null_safe_join)


def next_state(df: DataFrame, keys: list[str], index: str, cols: dict[str, str],
               block: int = DEFAULT_BLOCK, partitions: int | None = None) -> DataFrame:
    """``out[t] = state[t+1]`` inside the episode; the last frame
    repeats its own state.  ``cols`` maps output -> state column.  ``keys``
    must name one episode; null keys are values like any other.

    The lead is taken inside each ``(keys, _blk)`` block; the last row of a
    block takes the first row of the next block from a table of one row per
    block that has one before it; that is at most one per ``block`` frames and is
    broadcast, so the frames are not shuffled for it.  If ``df`` already carries
    ``_blk`` (= index // block, e.g. from ``align_frames(keep_block=True)``, or
    blocks of another index that runs along, as ``cut_episodes`` keeps) its
    partitioning is reused; else ``partitions`` is the number of partitions of
    the one shuffle (default: the session's)."""
    d = df if BLK in df.columns else df.withColumn(BLK, block_of(index, block))
    if partitions and BLK not in df.columns:
        d = d.repartition(partitions, *keys, BLK)
    w = Window.partitionBy(*keys, BLK).orderBy(index)
    srcs = list(dict.fromkeys(cols.values()))
    here = F.struct(*[F.col(c).alias(c) for c in srcs])
    d = d.withColumn("_nx", F.lead(here, 1).over(w))
    heads = (d.where(F.col(BLK) > 0).groupBy(*keys, BLK).agg(F.min_by(here, F.col(index)).alias("_hd"), F.min(index).alias("_at"))
             .where(F.col("_at") > 0).drop("_at").withColumn(BLK, F.col(BLK) - 1))  # no row is before an episode's first
    d = null_safe_join(d, F.broadcast(heads), keys + [BLK])
    outs = [F.when(F.col("_nx").isNotNull(), F.col("_nx")[src])
            .when(F.col("_hd").isNotNull(), F.col("_hd")[src])
            .otherwise(F.col(src)).alias(out) for out, src in cols.items()]
    keep = [c for c in df.columns if c != BLK]
    return d.select(*keep, *outs)


def has_next_frame(df: DataFrame, keys: list[str], index: str, out: str = "has_next",
                   block: int = DEFAULT_BLOCK) -> DataFrame:
    h = halo_blocks(df, index, after=1, block=block)
    w = halo_window(keys, index)
    return drop_halo(h.withColumn(out, F.lead(F.lit(1), 1).over(w).isNotNull()))


def future_chunk(df: DataFrame, keys: list[str], index: str, state: str, k: int = 32,
                 out: str = "action", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Concatenation of the next ``k`` states.

    A null state inside the chunk repeats the last collected one (or the
    current state); past the end the chunk is padded with the last
    collected state; a null current state, and the last frame, give null.
    Nulls are forward-filled first (``collect_list`` would drop them)."""
    block = max(block, k)  # the halo must fit in a block
    filled = carry_scan(df, keys, index, [Scan("_ff_state", state, "ffill", True)], block=block)
    h = halo_blocks(filled, index, after=k, block=block)
    w = halo_window(keys, index)
    chunk = F.collect_list("_ff_state").over(w.rowsBetween(1, k))
    h = h.withColumn("_chunk", chunk)
    last = F.element_at(F.col("_chunk"), -1)
    padded = F.concat(F.col("_chunk"),
                      F.array_repeat(last, F.lit(k) - F.size("_chunk")))
    res = (F.when(F.col(state).isNull() | (F.size("_chunk") == 0), F.lit(None))
           .otherwise(F.flatten(padded)))
    return drop_halo(h.withColumn(out, res)).drop("_chunk", "_ff_state")


def drop_last_frame(df: DataFrame, keys: list[str], index: str, action: str | None = None,
                    block: int = DEFAULT_BLOCK) -> DataFrame:
    """Drop each episode's last frame (and frames whose action is null)."""
    r = has_next_frame(df, keys, index, "_has_next", block=block).where("_has_next")
    if action is not None:
        r = r.where(F.col(action).isNotNull())
    return r.drop("_has_next")


def vec_sub(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def relative_to_first(df: DataFrame, keys: list[str], index: str, cols: list[str]) -> DataFrame:
    """Subtract the episode's first non-null vector from every vector.

    The first vector per episode is a (map-side combined) aggregate joined
    back on the episode key, not a window."""
    firsts = df.groupBy(*keys).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(index))).alias(f"_first_{c}")
        for c in cols])
    j = df.join(firsts, keys, "left")
    for c in cols:
        j = j.withColumn(c, vec_sub(F.col(c), F.col(f"_first_{c}"))).drop(f"_first_{c}")
    return j


def delta_action(action: Column, state: Column) -> Column:
    """``action - state`` elementwise (uses the unshifted state)."""
    return vec_sub(action, state)
