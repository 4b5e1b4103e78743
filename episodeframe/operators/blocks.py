"""Skew-safe ordered scans.

A plain ``Window.partitionBy(recording)`` puts a whole recording into one
task.  One recording may hold a third of all rows, so every ordered scan in
this package runs over fixed-size *blocks* of a dense integer index instead:

* ``carry_scan`` -- unbounded scans (forward fill, backward fill, running
  sums).  Each block is scanned locally; a per-block summary (one row per
  block, so ``rows / block`` rows) is scanned across blocks and put ahead of
  the block's rows as the carried-in value.
* ``halo_blocks`` -- bounded frames (lead/lag up to ``k`` rows).  The first
  ``after`` rows of each block are copied into the previous block (and the
  last ``before`` rows into the next one) so a window over
  ``(keys, _blk)`` sees its neighbours; the copies are dropped afterwards.

Both need a dense ``0..n-1`` index per key (frame_index), which every
frame table here has.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows per block.  2^16 frames is about 36 minutes at 30 fps: large enough that
# the per-block summaries stay tiny, small enough that a block fits one task.
DEFAULT_BLOCK = 1 << 16

BLK = "_blk"
HALO = "_halo"
_POS = "_pos_in_block"  # 0: inherited from earlier blocks, 1: a row, 2: inherited from later ones


def block_of(index: str | Column, block: int) -> Column:
    from episodeframe.functions.timeunits import floor_div
    c = F.col(index) if isinstance(index, str) else index
    return floor_div(c.cast("long"), F.lit(block).cast("long"))


@dataclass(frozen=True)
class Scan:
    """One scan output.

    kind: ``ffill`` (last non-null value), ``bfill`` (first non-null value
    ahead), ``sum`` (running sum) or ``lead`` (next row's value within the
    block, for callers that keep related rows in one block).  ``inclusive`` decides whether the
    current row takes part.
    """

    out: str
    col: str
    kind: str = "ffill"
    inclusive: bool = True


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join in which null keys match each other; ``right`` has one row per
    key and gives its other columns."""
    names = {c: f"_r_{c}" for c in on}
    r = right.select(*[F.col(c).alias(names[c]) for c in on], *[c for c in right.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & left[c].eqNullSafe(r[names[c]])
    return left.join(r, cond, "left").drop(*names.values())


#: Rows of a frame-sized table that one task sorts or shuffles at a time.
ROWS_PER_TASK = 1 << 18


def tasks_for(spark: SparkSession, rows: int | None, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Partitions for so many rows, at least one per core.  Given to
    ``repartition`` as a number, so that AQE does not merge them by their
    compressed size: frame rows shrink to a small part of the memory that they
    take in a sort."""
    return max(spark.sparkContext.defaultParallelism, -(-int(rows or 0) // rows_per_task))


def ordered_scan(df: DataFrame, keys: list[str], block_col: str | Column, order,
                 scans: list[Scan], keep_block: bool = False, partitions: int | None = None, dealt: bool = False) -> DataFrame:
    """Run ``scans`` over rows ordered by ``order`` within ``keys``.

    ``block_col`` must be monotone in ``order`` (e.g. ``floor(index / B)`` or
    a time bucket).  A per-block summary (one row per block) is scanned across
    blocks; what a block inherits joins its rows as one row ahead of them (and
    one behind them for backward fills), so one window per block does the rest
    and the rows are shuffled once.  ``partitions`` is the number of partitions
    of that shuffle (default: the session's).  ``dealt`` says that ``df`` is a
    union of parts that each lie in ``partitions`` partitions by ``keys`` and
    ``_blk``, its block column: then only what blocks inherit is dealt."""
    if isinstance(block_col, str):
        d = df.withColumn(BLK, F.col(block_col))
    else:
        d = df.withColumn(BLK, block_col)
    order_cols = [order] if isinstance(order, (str, Column)) else list(order)
    ordc = [F.col(o) if isinstance(o, str) else o for o in order_cols]
    okey = ordc[0] if len(ordc) == 1 else F.struct(*ordc)
    part = keys + [BLK]
    w = Window.partitionBy(*part).orderBy(_POS, *ordc)
    # Backward scans run as forward scans over the reversed order: Spark
    # evaluates frames that end at UNBOUNDED FOLLOWING row by row (quadratic).
    wr = Window.partitionBy(*part).orderBy(F.col(_POS).desc(), *[o.desc() for o in ordc])
    up = Window.unboundedPreceding
    wb = Window.partitionBy(*keys).orderBy(BLK)
    wbr = Window.partitionBy(*keys).orderBy(F.col(BLK).desc())

    local, summary, carry, source = [], [], [], {}
    for s in scans:
        c = F.col(s.col)
        so, co = f"_s_{s.out}", f"_c_{s.out}"
        source[s.out] = f"_x_{s.out}" if s.kind == "sum" else s.col
        if s.kind == "ffill":
            summary.append(F.max_by(c, F.when(c.isNotNull(), okey)).alias(so))
            carry.append(F.last(so, ignorenulls=True).over(wb.rowsBetween(up, -1)).alias(co))
        elif s.kind == "bfill":
            summary.append(F.min_by(c, F.when(c.isNotNull(), okey)).alias(so))
            carry.append(F.last(so, ignorenulls=True).over(wbr.rowsBetween(up, -1)).alias(co))
        elif s.kind == "sum":
            summary.append(F.sum(c).alias(so))
            carry.append(F.sum(so).over(wb.rowsBetween(up, -1)).alias(co))
        elif s.kind != "lead":
            raise ValueError(f"unknown scan kind {s.kind!r}")

    out = d.withColumn(_POS, F.lit(1))
    if summary:
        # This branch reads only the scanned columns (column pruning); inputs
        # that are costly to recompute are materialised by the caller.
        held = d
        if any(s.kind in ("ffill", "bfill") for s in scans):
            # rows without a value only say that their block exists: those are
            # counted by hash, and the sort sees rows with values
            some = reduce(lambda a, b: a | b, [F.col(s.col).isNotNull() if s.kind != "sum" else F.col(s.col) != 0
                                               for s in scans if s.kind != "lead"])
            held = d.where(some).unionByName(d.select(*part).distinct(), allowMissingColumns=True)
        blocks = held.groupBy(*part).agg(*summary)
        for s in scans:
            if s.kind == "sum":
                out = out.withColumn(source[s.out], F.col(s.col).cast(blocks.schema[f"_s_{s.out}"].dataType))
        blocks = blocks.select(*part, *carry)
        for pos, kinds in ((0, ("ffill", "sum")), (2, ("bfill",))):
            got = {source[s.out]: F.col(f"_c_{s.out}") for s in scans if s.kind in kinds}
            if got:
                any_of = reduce(lambda a, b: a | b, [c.isNotNull() for c in got.values()])
                ahead = blocks.where(any_of).select(*part, F.lit(pos).alias(_POS), *[c.alias(n) for n, c in got.items()])
                out = out.unionByName(ahead.repartition(partitions, *part) if dealt else ahead, allowMissingColumns=True)
    if partitions and not dealt:
        out = out.repartition(partitions, *part)
    for s in scans:
        c, to = F.col(source[s.out]), 0 if s.inclusive else -1
        if s.kind == "ffill":
            got = F.last(c, ignorenulls=True).over(w.rowsBetween(up, to))
        elif s.kind == "bfill":
            got = F.last(c, ignorenulls=True).over(wr.rowsBetween(up, to))
        elif s.kind == "sum":
            got = F.coalesce(F.sum(c).over(w.rowsBetween(up, to)), F.lit(0))
        else:
            # Block-local: callers put a row and the row after it in one block.
            got = F.lead(c, 1).over(w)
        local.append(got.alias(s.out))
    extra = [F.col(BLK)] if keep_block and BLK not in df.columns else []
    return out.select(*df.columns, *extra, _POS, *local).where(F.col(_POS) == 1).drop(_POS)


def carry_scan(df: DataFrame, keys: list[str], index: str, scans: list[Scan],
               block: int = DEFAULT_BLOCK) -> DataFrame:
    """``ordered_scan`` over a dense integer ``index`` cut into blocks of
    ``block`` rows."""
    return ordered_scan(df, keys, block_of(index, block), index, scans)


def dense_index(df: DataFrame, keys: list[str], order: list[str], out: str,
                block_col: Column | None = None, attach: DataFrame | None = None,
                partitions: int | None = None, ranges: list[str] | None = None) -> DataFrame:
    """0-based position of each row within ``keys`` in ``order`` (ties must
    be broken by ``order`` itself).  Blocked running count; ``block_col``
    defaults to one-minute buckets of the first order column (ns).

    ``attach`` (one row per ``keys``) gives its other columns to the rows, which
    are then shuffled once for the count and the join; rows without one are
    dropped.  They lie in ``partitions`` partitions, with ``ranges`` (the keys
    in an order) in ranges of those and the block."""
    if block_col is None:
        block_col = block_of(order[0], 60_000_000_000)
    if attach is not None:
        return _attached_index(df.withColumn(BLK, block_col), keys, order, out, attach, partitions, ranges).drop(BLK)
    d = df.withColumn("_one_", F.lit(1).cast("long"))
    r = ordered_scan(d, keys, block_col, order, [Scan(out, "_one_", "sum", inclusive=False)])
    return r.drop("_one_")


def _attached_index(d: DataFrame, keys: list[str], order: list[str], out: str, attach: DataFrame,
                    partitions: int | None, ranges: list[str] | None) -> DataFrame:
    """``dense_index`` with one row ahead of each block that holds the count of
    the earlier blocks and the attached columns."""
    part, got, up = [*keys, BLK], [c for c in attach.columns if c not in keys], Window.unboundedPreceding
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy(BLK).rowsBetween(up, -1))
    heads = d.groupBy(*part).agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0)))
    heads = heads.join(attach, keys).select(*part, "_before", *got, F.lit(0).alias(_POS))
    u = d.withColumn(_POS, F.lit(1)).unionByName(heads, allowMissingColumns=True)
    n = [partitions] if partitions else []
    u = u.repartitionByRange(*n, *ranges, BLK) if ranges else u.repartition(*n, *part)
    w = Window.partitionBy(*part).orderBy(_POS, *order)
    first = w.rowsBetween(up, Window.currentRow)
    at = F.first("_before").over(first) + F.row_number().over(w) - 2  # the row ahead is number 1
    r = u.select(*d.columns, _POS, at.alias(out), *[F.first(c).over(first).alias(c) for c in got])
    return r.where((F.col(_POS) == 1) & F.col(out).isNotNull()).drop(_POS)


def range_blocks(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` stored in range partitions of ``order``, the partition number in
    ``_blk``: blocks for a scan over one global order that no single key value
    can crowd.  Rows equal in ``order`` share a block."""
    from episodeframe.session import cut_lineage
    return cut_lineage(df.repartitionByRange(*order).withColumn(BLK, F.spark_partition_id()))


#: Rows of a stored table up to which one sort scans it (a few narrow columns each).
SMALL_TABLE = 1 << 18


def global_scan(df: DataFrame, order: list[str], scans: list[Scan], small: int = SMALL_TABLE) -> DataFrame:
    """``scans`` over all rows in ``order``, by ``range_blocks``; only one
    summary row per block crosses partitions.

    The rows are stored once and counted; a table of at most ``small`` rows
    (tasks, files, a modest number of episodes) is one block, scanned by one sort
    with the same result, which saves the sampling of ranges."""
    from episodeframe.session import cut_lineage, release_tables, tables_written
    since = tables_written()
    d = cut_lineage(df.withColumn("_one", F.lit(1).cast("long")))
    if d.count() > small or any(s.kind != "sum" for s in scans):
        ranged = range_blocks(d, order)
        release_tables(df.sparkSession, since, keep=1)
        return ordered_scan(ranged, [], BLK, order, scans).drop("_one", BLK)
    w = Window.partitionBy(F.lit(0)).orderBy(*order)
    up = Window.unboundedPreceding
    sums = [F.coalesce(F.sum(s.col).over(w.rowsBetween(up, 0 if s.inclusive else -1)), F.lit(0)).alias(s.out) for s in scans]
    return d.select("*", *sums).drop("_one")


def halo_blocks(df: DataFrame, index: str, before: int = 0, after: int = 0,
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """Tag rows with ``_blk`` and add halo copies for bounded windows.

    Rows whose position in their block is ``< after`` are copied into the
    previous block; rows in the last ``before`` positions are copied into the
    next block.  Copies carry ``_halo = true`` and must be filtered out after
    the window (``drop_halo``).
    """
    if before > block or after > block:
        raise ValueError("halo wider than block")
    blk = block_of(index, block)
    pos = F.col(index) - blk * F.lit(block)
    base = df.withColumn(BLK, blk).withColumn(HALO, F.lit(False))
    parts = [base]
    if after > 0:
        parts.append(df.where(pos < after).withColumn(BLK, blk - 1).withColumn(HALO, F.lit(True)))
    if before > 0:
        parts.append(df.where(pos >= block - before).withColumn(BLK, blk + 1)
                     .withColumn(HALO, F.lit(True)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(HALO, BLK)


def halo_window(keys: list[str], index: str) -> Window:
    return Window.partitionBy(*keys, BLK).orderBy(index)
