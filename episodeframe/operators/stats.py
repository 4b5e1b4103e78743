"""Dataset statistics.

All statistics are plain aggregations with map-side combine: vectors are
exploded to ``(feature, pos, value)`` and grouped by ``(feature, pos)``.
Standard deviation is the population one, as published.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.session import cut_lineage

QUANTILES = {"q01": 0.01, "q10": 0.10, "q50": 0.50, "q90": 0.90, "q99": 0.99}


def long_vectors(df: DataFrame, features: list[str], keys: list[str] | None = None) -> DataFrame:
    """``(keys..., feature, pos, value)`` rows from array columns."""
    keys = keys or []

    def tagged(f):
        return F.transform(F.col(f"`{f}`"), lambda x, i: F.struct(
            F.lit(f).alias("feature"), i.alias("pos"), x.cast("double").alias("value")))

    # one pass: every feature's elements as (feature, pos, value) structs
    return df.select(*keys, F.inline(F.concat(*[tagged(f) for f in features])))


def vector_stats(df: DataFrame, features: list[str], keys: list[str] | None = None,
                 quantiles: bool = False, accuracy: int = 10_000, exact: bool = False, stored: bool = False) -> DataFrame:
    """A5: per (keys, feature, pos): count, min, max, mean, population std
    and, when asked, quantiles.

    Quantiles use ``percentile_approx`` (a mergeable sketch of bounded
    size), or with ``exact`` the passes of ``exact_quantiles``; Spark's own
    exact percentile would keep every value of a group in one task, and one
    source may hold a third of all frames.  ``stored`` says that ``df`` is a plain
    scan of stored vectors: its passes read them instead of a second copy."""
    keys = keys or []
    lv = long_vectors(df, features, keys)
    aggs = [F.count("value").alias("count"), F.min("value").alias("min"),
            F.max("value").alias("max"), F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std")]
    if quantiles and exact:
        by = [*keys, "feature", "pos"]
        lv = lv if stored else cut_lineage(lv)
        both = cut_lineage(lv.groupBy(*by).agg(*aggs, *_extremes("value")))  # one pass for both
        q = exact_quantiles(lv, by, stored=True, extremes=both.select(*by, "_n", "_low", "_high").where(F.col("_n") > 0))
        return both.drop("_n", "_low", "_high").join(q, by, "left")
    if quantiles:
        aggs += [F.percentile_approx("value", p, accuracy).alias(n) for n, p in QUANTILES.items()]
    return lv.groupBy(*keys, "feature", "pos").agg(*aggs)


#: Bins of a range and pass.  Every task of the first pass may send that many rows
#: per group; the later passes read only what lies in the few bins left.
QUANTILE_BINS = 128


def _finite(value: str) -> Column:
    """The value as double, null where it is not finite (-0.0 becomes 0.0)."""
    v = F.col(value)
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v.cast("double") + F.lit(0.0))


def _extremes(value: str) -> list[Column]:
    v = _finite(value)
    return [F.count(v).alias("_n"), F.min(v).alias("_low"), F.max(v).alias("_high")]


def exact_quantiles(values: DataFrame, keys: list[str], value: str = "value", quantiles: dict[str, float] | None = None,
                    bins: int = QUANTILE_BINS, stored: bool = False, extremes: DataFrame | None = None) -> DataFrame:
    """Exact interpolated quantiles of each group, one column per quantile.

    Quantile q of n values lies at rank ``q (n - 1)`` between two order
    statistics.  Each order statistic is found by rank refinement: a range that
    holds it is cut into ``bins`` bins, the values of every bin are counted (with
    their extremes), and the bin that holds the rank is the next range, until a
    range is a single value.  A pass is one aggregation with map-side combine
    over the values that still lie in a range (after the first pass those are
    stored apart); no group is ever in one task.  Values that are null or not
    finite are left out; a group of none has no row.  ``stored`` says that the
    values are a stored table already; ``extremes`` are their count, least and
    largest (``_n``, ``_low``, ``_high``) per group, if known."""
    quantiles = quantiles or QUANTILES
    data = values.select(*keys, _finite(value).alias("_v")).where(F.col("_v").isNotNull())
    if not stored:
        data = cut_lineage(data)
    ext = extremes if extremes is not None else cut_lineage(data.groupBy(*keys).agg(*_extremes("_v")))
    rank = [F.struct(F.lit(name).alias("_q"), F.lit(side).alias("_side"),
                     (F.floor(F.lit(q) * (F.col("_n") - 1)) + side).alias("_rank")) for name, q in quantiles.items() for side in (0, 1)]
    # wanted: rank within the range (from 0) and the range
    wanted = ext.select(*keys, "_n", "_low", "_high", F.inline(F.array(*rank))).withColumn(
        "_rank", F.least("_rank", F.col("_n") - 1)).drop("_n")
    done, edge, passes = [], F.col("_low") == F.col("_high"), 0
    while True:
        wanted = cut_lineage(wanted)
        done.append(wanted.where(edge).select(*keys, "_q", "_side", F.col("_low").alias("_x")))
        wanted = wanted.where(~edge)
        if wanted.isEmpty():
            break
        ranges = wanted.select(*keys, "_low", "_high").distinct()
        held = data.join(ranges, keys).where(F.col("_v").between(F.col("_low"), F.col("_high")))
        if passes == 1:  # the first pass left a few bins of each group; ranges of a group never overlap
            data = cut_lineage(held.select(*keys, "_v"))
            held = data.join(ranges, keys).where(F.col("_v").between(F.col("_low"), F.col("_high")))
        passes += 1
        share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        # extreme ranges overflow the difference; halves keep it finite
        half = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
        share = F.when(F.abs(F.col("_high") - F.col("_low")) < float("inf"), share).otherwise(half)
        hist = (held.groupBy(*keys, "_low", "_high", F.least(F.floor(share * bins), F.lit(bins - 1)).alias("_bin"))
                .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_bmin"), F.max("_v").alias("_bmax")))
        # at most ``bins`` rows a range: ranks at which the bins begin
        steps = hist.groupBy(*keys, "_low", "_high").agg(F.array_sort(F.collect_list(F.struct("_bin", "_c", "_bmin", "_bmax"))).alias("_h"))
        begun = F.aggregate("_h", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("b")),
                            lambda s, x: F.struct((s["at"] + x["_c"]).alias("at"), F.concat(s["b"], F.array(s["at"])).alias("b")))["b"]
        steps = steps.withColumn("_b", begun)
        # bins begun up to the rank; a column of its own, as a lambda beside a new
        # ``_rank`` would see the new one
        wanted = wanted.join(steps, [*keys, "_low", "_high"]).withColumn("_at", F.size(F.filter("_b", lambda b: b <= F.col("_rank"))))
        hit = F.element_at("_h", F.col("_at"))
        wanted = wanted.select(*keys, "_q", "_side", (F.col("_rank") - F.element_at("_b", F.col("_at"))).alias("_rank"),
                               hit["_bmin"].alias("_low"), hit["_bmax"].alias("_high"))
    found = done[0]
    for d in done[1:]:
        found = found.unionByName(d)
    out = []
    for name, q in quantiles.items():
        low, high = (F.max(F.when((F.col("_q") == name) & (F.col("_side") == side), F.col("_x"))) for side in (0, 1))
        part = F.lit(q) * (F.first("_n") - 1) - F.floor(F.lit(q) * (F.first("_n") - 1))
        out.append((low + (high - low) * part).alias(name))
    return found.join(ext.select(*keys, "_n"), keys).groupBy(*keys).agg(*out)


def merge_stats(partials: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A6 + A7: merge partial stats rows ``(source, feature, pos, count,
    mean, std, min, max[, q..])``.

    mean = count-weighted mean; std = sqrt(max(0, sum w(std^2 + mean^2) -
    mean^2)); min/max = extremes; each quantile = count-weighted mean of the
    partial quantiles, only when every partial has it."""
    keys = keys or []
    w = F.col("count").cast("double")
    tot = F.sum(w)
    aggs = [F.sum("count").alias("count"),
            (F.sum(w * F.col("mean")) / tot).alias("mean"),
            (F.sum(w * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean"))) / tot).alias("_m2"),
            F.min("min").alias("min"), F.max("max").alias("max")]
    qs = [q for q in QUANTILES if q in partials.columns]
    for q in qs:
        aggs.append(F.when(F.bool_and(F.col(q).isNotNull()),
                           F.sum(w * F.col(q)) / tot).alias(q))
    m = partials.groupBy(*keys, "feature", "pos").agg(*aggs)
    return (m.withColumn("std", F.sqrt(F.greatest(F.lit(0.0), F.col("_m2") - F.col("mean") * F.col("mean"))))
            .drop("_m2"))


def pack_stats(stats: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Stats rows -> one row per feature with arrays ordered by ``pos``
    (the stats.json shape)."""
    keys = keys or []
    names = [c for c in stats.columns if c not in set(keys) | {"feature", "pos"}]
    packed = stats.groupBy(*keys, "feature").agg(
        F.array_sort(F.collect_list(F.struct("pos", *names))).alias("_s"))
    def field_of(n):
        return lambda x: x[n]

    return packed.select(*keys, "feature", *[F.transform("_s", field_of(n)).alias(n) for n in names])


def dataset_totals(frames: DataFrame, episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """Totals for info.json."""
    e = episodes.agg(F.count(F.lit(1)).alias("total_episodes"))
    f = frames.agg(F.count(F.lit(1)).alias("total_frames"))
    t = tasks.agg(F.count(F.lit(1)).alias("total_tasks"))
    return e.crossJoin(f).crossJoin(t)  # three one-row aggregates


def episode_summary(frames: DataFrame, episode: str = "episode_index", index: str = "index",
                    ts: str = "timestamp") -> DataFrame:
    """Length, index range, first/last timestamp and duration."""
    return frames.groupBy(episode).agg(
        F.count(F.lit(1)).alias("length"),
        F.min(index).alias("dataset_from_index"),
        (F.max(index) + 1).alias("dataset_to_index"),
        F.min_by(ts, index).alias("from_timestamp"),
        F.max_by(ts, index).alias("to_timestamp")).withColumn(
        "duration", F.col("to_timestamp") - F.col("from_timestamp"))


def width_profile(df: DataFrame, vec: str, keys: list[str] | None = None) -> DataFrame:
    """Vector widths seen (min, max, distinct count); a mixed-width
    input has ``n_widths > 1``."""
    keys = keys or []
    return df.groupBy(*keys).agg(F.min(F.size(vec)).alias("min_width"),
                                 F.max(F.size(vec)).alias("max_width"),
                                 F.count_distinct(F.size(vec)).alias("n_widths"))


def valid_range(values: Column) -> Column:
    """struct(min, max) of the finite elements; null (N/A) if none."""
    ok = F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x) &
                  (F.abs(x) != F.lit(float("inf"))))
    return F.when(F.size(ok) > 0, F.struct(F.array_min(ok).alias("min"), F.array_max(ok).alias("max")))
