"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table hashes unit vectors by k Gaussian (2-stable) projections cut into
cells of one width.  A query visits, per table, its own cell and the perturbed
cells next to it in the estimated order of success (summed squared distances to
the crossed cell borders).  Candidates of all visited cells are ranked by exact
cosine.  Queries that find fewer than k are compared with all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage
from episodeframe.llm.vectors import matrix, same_vector, usable

_REACH = 2  # a projection is perturbed by at most so many cells


@dataclass(frozen=True)
class Index:
    """Parameters of the hash tables; nothing is fitted to the rows."""

    tables: int = 8
    projections: int = 4
    width: float = 1.0
    probes: int = 48
    seed: int = 6

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        rng = np.random.default_rng([self.seed, table, x.shape[1]])
        a = rng.normal(size=(x.shape[1], self.projections))
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return (unit @ a + rng.uniform(0, self.width, self.projections)) / self.width

    def keys(self, cells: np.ndarray, table: int, dim: int) -> np.ndarray:
        """64-bit key of integer cells, table and vector length."""
        key = np.full(cells.shape[0], (table + 1) * 1_000_003 + dim, np.uint64)
        for j in range(cells.shape[1]):
            key = (key ^ (cells[:, j].astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
            key *= np.uint64(0xFF51AFD7ED558CCD)
            key ^= key >> np.uint64(32)
        return key.view(np.int64)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Own bucket of each row in each table (rows x tables)."""
        return np.stack([self.keys(np.floor(self.cells(x, t)).astype(np.int64), t, x.shape[1])
                         for t in range(self.tables)], 1)

    def probed(self, x: np.ndarray) -> np.ndarray:
        """Buckets to visit for each row, best first within a table."""
        steps = np.arange(-_REACH, _REACH + 1)
        moves = np.stack(np.meshgrid(*[steps] * self.projections, indexing="ij"), -1).reshape(-1, self.projections)
        visits = min(self.probes, len(moves))
        out = []
        for t in range(self.tables):
            f = self.cells(x, t)
            low = np.floor(f)
            inside = f - low
            # squared distance to the border that a step crosses
            cost = np.where(steps < 0, inside[..., None] - steps - 1, np.where(steps > 0, steps - inside[..., None], 0.0)) ** 2
            total = np.zeros((len(x), len(moves)))
            for j in range(self.projections):
                total += cost[:, j, moves[:, j] + _REACH]
            order = np.argsort(total, 1, kind="stable")[:, :visits]
            for v in range(visits):
                out.append(self.keys((low + moves[order[:, v]]).astype(np.int64), t, x.shape[1]))
        return np.stack(out, 1) if out else np.zeros((len(x), 0), np.int64)


def _hashes(index: Index, vec: Column, probes: bool) -> Column:
    @F.pandas_udf("array<long>")
    def run(vectors: pd.Series) -> pd.Series:
        out: list = [None] * len(vectors)
        for rows, x in matrix(pa.array(vectors, pa.list_(pa.float64()))):
            for i in range(0, len(x), 256):  # probe costs take rows x moves
                part = x[i:i + 256]
                for r, h in zip(rows[i:i + 256], index.probed(part) if probes else index.buckets(part)):
                    out[r] = h
        return pd.Series(out)
    return run(vec)


def _best(scores: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` largest scores of each row, ties to smaller ids."""
    if scores.shape[1] > 4 * keep:
        # everything not below the keep-th largest, so that ties are not lost
        bound = np.partition(scores, -keep, 1)[:, -keep].min()
        some = np.flatnonzero((scores >= bound).any(0))
        scores, ids = scores[:, some], ids[:, some]
    order = np.lexsort((ids, -scores))[:, :keep]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _rank_buckets(batches: Iterator[pa.RecordBatch], keep: int, block: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, salt, side, id, vec) sorted by the first three: queries of a
    bucket (side 0) stand before its candidates (side 1).  Gives each query's
    ``keep`` best candidates of the bucket; candidates pass batch by batch."""
    key, queries, best = None, [], []

    def done():
        for (q, _), (s, i) in zip(queries, best):
            rows, cols = np.nonzero(np.isfinite(s))
            if len(rows):
                yield pa.RecordBatch.from_pydict({"qid": pa.array(q[rows], pa.int64()), "cid": pa.array(i[rows, cols], pa.int64()),
                                                  "score": pa.array(s[rows, cols], pa.float64())})

    for batch in batches:
        b, salt, side, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if not len(b):
            continue
        cut = np.flatnonzero((np.diff(b) != 0) | (np.diff(salt) != 0) | (np.diff(side) != 0)) + 1
        for s, e in zip([0, *cut], [*cut, len(b)]):
            if side[s] == 1 and (not queries or key != (b[s], salt[s])):
                continue  # no query visits this bucket
            here = matrix(batch.column(4).slice(s, e - s))
            if key != (b[s], salt[s]):
                yield from done()
                key, queries, best = (b[s], salt[s]), [], []
            for rows, x in here:
                for i in range(0, len(rows), block) if side[s] == 0 else ():
                    part = rows[i:i + block]
                    queries.append((ids[s:e][part], x[i:i + block]))
                    best.append((np.full((len(part), keep), -np.inf), np.zeros((len(part), keep), np.int64)))
                if side[s] == 1:
                    norm = np.linalg.norm(x, axis=1)
                    for k, (_, q) in enumerate(queries):
                        if q.shape[1] == x.shape[1]:
                            score = (q @ x.T) / (np.linalg.norm(q, axis=1)[:, None] * norm)
                            old, old_ids = best[k]
                            best[k] = _best(np.concatenate([old, score], 1),
                                            np.concatenate([old_ids, np.broadcast_to(ids[s:e][rows], score.shape)], 1), keep)
    yield from done()


def _all_pairs(asked: DataFrame, few: DataFrame, bucket: int, queries: int = 4096) -> DataFrame:
    """Rows for ``_rank_buckets`` in which every query meets every candidate of
    its length once: blocks of queries (``b``) x blocks of candidates (``salt``)."""
    dim = F.size("vec").alias("dim")
    parts = (asked.groupBy(dim).agg(F.ceil(F.count(F.lit(1)) / queries).cast("int").alias("nq"))
             .join(few.groupBy(dim).agg(F.ceil(F.count(F.lit(1)) / bucket).cast("int").alias("nc")), "dim"))
    parts = F.broadcast(cut_lineage(parts))  # one row per vector length

    def side(df: DataFrame, key: str, q: Column, c: Column, n: int) -> DataFrame:
        df = df.select(key, "vec", dim).join(parts, "dim").withColumn("qb", q).withColumn("salt", c)
        return df.select(F.xxhash64("dim", "qb").alias("b"), "salt", F.lit(n).alias("side"), F.col(key).alias("id"), "vec")

    return side(few, "cid", F.explode(F.expr("sequence(0, nq - 1)")), F.pmod(F.xxhash64("cid"), "nc").cast("int"), 1).unionByName(
        side(asked, "qid", F.pmod(F.xxhash64("qid"), "nq").cast("int"), F.explode(F.expr("sequence(0, nc - 1)")), 0))


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           index: Index = Index(), bucket: int = 8192, broadcast_rows: int = 200_000) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of the candidates found
    for every row with ``is_query`` among all other rows; cosine in double
    precision, ties to the smaller id.  A query whose buckets hold fewer than
    ``k`` is compared with all rows, block by block, so it gets fewer than ``k``
    only if there are no more; that work is such queries x rows.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part; so do null ids.  Vectors of different lengths never meet.  Equal
    vectors are one candidate with its k + 1 smallest ids and one query, so
    groups of copies make no pairs.  Rows that repeat an id count once per
    distinct vector, and no row with the query's id is its neighbour.  Buckets
    over ``bucket`` candidates are split by salt and searched part by part;
    nothing is capped.  Other columns are not read.
    """
    h1, h2 = same_vector(F.col("vec"))
    rows = cut_lineage(vectors.withColumn("_q", is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), "_q")
                       .where(usable(F.col("vec")) & F.col("id").isNotNull())
                       .select("id", "vec", h1.alias("h1"), h2.alias("h2"), F.coalesce("_q", F.lit(False)).alias("q")))
    # copies: the k + 1 smallest ids (limited before the shuffle), one vector
    first = Window.partitionBy("h1", "h2").orderBy("id")
    few = (rows.withColumn("r", F.dense_rank().over(first)).where(F.col("r") <= k + 1)
           .groupBy("h1", "h2").agg(F.sort_array(F.collect_set("id")).alias("ids"), F.first("vec").alias("vec"))
           .withColumn("cid", F.col("ids")[0]))
    few = cut_lineage(few)
    asked = rows.where("q").groupBy("h1", "h2").agg(F.min("id").alias("qid"), F.first("vec").alias("vec"))
    asked = cut_lineage(asked)
    own = few.select("cid", "vec", F.explode(_hashes(index, F.col("vec"), False)).alias("b"))
    hot = cut_lineage(own.groupBy("b").count().where(F.col("count") > bucket)
                      .select("b", F.ceil(F.col("count") / bucket).cast("int").alias("salts")))
    hot = F.broadcast(hot) if hot.count() <= broadcast_rows else hot
    salts = F.coalesce("salts", F.lit(1))
    own = own.join(hot, "b", "left").select("b", F.pmod(F.xxhash64("cid"), salts).cast("int").alias("salt"),
                                            F.lit(1).alias("side"), F.col("cid").alias("id"), "vec")
    visits = (asked.select("qid", "vec", F.explode(_hashes(index, F.col("vec"), True)).alias("b")).join(hot, "b", "left")
              .select("b", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("side"),
                      F.col("qid").alias("id"), "vec"))
    keep = k + 1

    def rank(batches):
        return _rank_buckets(batches, keep)

    def ranked(pairs: DataFrame) -> DataFrame:
        found = (pairs.repartition("b", "salt").sortWithinPartitions("b", "salt", "side")
                 .mapInArrow(rank, "qid long, cid long, score double"))
        # the same candidate comes from several tables with scores equal up to rounding
        found = found.groupBy("qid", "cid").agg(F.max("score").alias("score"))
        best = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
        found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= keep).drop("r")
        return cut_lineage(
            found.join(few.select("cid", "ids"), "cid")
            .groupBy("qid").agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("i")))))
                                .alias("near")).select("qid", F.array_sort("near").alias("near")))

    lists = ranked(own.unionByName(visits))
    per_row = rows.where("q").select("id", "h1", "h2").distinct().join(asked.select("h1", "h2", "qid"), ["h1", "h2"])
    others = F.size(F.filter(F.coalesce("near", F.array()), lambda n: n["i"] != F.col("id")))
    short = per_row.join(lists, "qid", "left").where(others < k).select("qid").distinct()
    short = cut_lineage(asked.select("qid", "vec").join(short, "qid", "left_semi"))
    if not short.isEmpty():
        lists = lists.join(short, "qid", "left_anti").unionByName(ranked(_all_pairs(short, few, bucket)))
    per_row = per_row.join(lists, "qid")
    near = F.slice(F.filter("near", lambda n: n["i"] != F.col("id")), 1, k)
    return per_row.select(F.col("id").alias("query_id"), F.posexplode(near).alias("p", "n")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("n")["i"].alias(id_col), (-F.col("n")["s"]).alias("score"))
