"""Embedding near-duplicates by dual traversal of cover trees.

Vectors of one label are dealt to the cells of nested top-level centres and cut
into blocks of bounded size.  A block's cover tree has nested levels of halving
radii.  Two trees are traversed together: a pair of nodes is dropped if even
its closest descendants are too far apart, linked as a whole if even its
farthest are near enough, and opened otherwise, so exactly the pairs above the
threshold remain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodeframe.llm.common import connected_components, cut_lineage
from episodeframe.llm.vectors import matrix, same_vector, usable

_LEAF = 16
_SLACK = 1e-6  # bounds decide only beyond rounding; the rest is compared exactly


@dataclass
class Node:
    """A centre (row number), its covering radius, rows below, children."""

    center: int
    radius: float
    rows: np.ndarray
    children: list

    @property
    def leaf(self) -> bool:
        return not self.children


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def build(unit: np.ndarray, rows: np.ndarray | None = None, radius: float = 2.0, center: int | None = None,
          floor: float = 1e-3) -> Node:
    """Cover tree of unit vectors (chord distance): the children's centres of a
    node lie farther than half its level's radius apart and cover its rows."""
    rows = np.arange(len(unit)) if rows is None else rows
    center = int(rows[0]) if center is None else center
    reach = float(_distances(unit[rows], unit[[center]]).max())
    if len(rows) <= _LEAF or reach <= floor:
        return Node(center, reach, rows, [])
    while radius / 2 >= reach:  # levels on which the node would be its only child
        radius /= 2
    near = _distances(unit[rows], unit[rows])
    left = np.ones(len(rows), bool)
    children = []
    order = [int(np.flatnonzero(rows == center)[0]), *range(len(rows))]
    for i in order:
        if left[i]:
            mine = left & (near[i] <= radius / 2)
            left &= ~mine
            children.append((int(rows[i]), rows[mine]))
    del near
    return Node(center, reach, rows, [build(unit, r, radius / 2, c, floor) for c, r in children])


class Links:
    """Link counts and a spanning forest gathered by a traversal."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes = ids, sizes
        self.counts = np.zeros(len(ids), np.int64)
        self.parent = np.arange(len(ids))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            low, high = (a, b) if self.ids[a] < self.ids[b] else (b, a)
            self.parent[high] = low

    def all(self, a: np.ndarray, b: np.ndarray) -> None:
        """Every row of ``a`` links to every row of ``b`` (disjoint)."""
        self.counts[a] += self.sizes[b].sum()
        self.counts[b] += self.sizes[a].sum()
        for x in (*a[1:], *b):
            self.join(int(a[0]), int(x))

    def within(self, a: np.ndarray) -> None:
        self.counts[a] += self.sizes[a].sum() - self.sizes[a]
        for x in a[1:]:
            self.join(int(a[0]), int(x))

    def some(self, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> None:
        """Links of a rows x rows table (``a`` and ``b`` disjoint)."""
        self.counts[a] += linked @ self.sizes[b]
        self.counts[b] += self.sizes[a] @ linked
        for i, j in zip(*np.nonzero(linked)):
            self.join(int(a[i]), int(b[j]))


def traverse(raw: np.ndarray, unit: np.ndarray, first: Node, second: Node | None, threshold: float, links: Links) -> None:
    """Link all rows of ``first`` and ``second`` (or within ``first``) with
    cosine >= threshold; cosines decide in double precision."""
    tau = math.sqrt(max(0.0, 2 - 2 * threshold))
    norm = np.linalg.norm(raw, axis=1)

    def exact(a: np.ndarray, b: np.ndarray, same: bool) -> None:
        linked = (raw[a] @ raw[b].T) / (norm[a][:, None] * norm[b]) >= threshold
        if same:
            linked = np.triu(linked, 1)
        if linked.any():
            if same:
                links.counts[a] += linked @ links.sizes[a] + links.sizes[a] @ linked
                for i, j in zip(*np.nonzero(linked)):
                    links.join(int(a[i]), int(a[j]))
            else:
                links.some(a, b, linked)

    todo: list[tuple[Node, Node | None]] = [(first, second)]
    while todo:
        p, q = todo.pop()
        if q is None:  # within one node
            if 2 * p.radius <= tau - _SLACK:
                links.within(p.rows)
            elif p.leaf:
                exact(p.rows, p.rows, True)
            else:
                kids = p.children
                todo += [(c, None) for c in kids if len(c.rows) > 1]
                _open(unit, kids, kids, tau, links, todo, True)
        elif p.leaf and q.leaf:
            exact(p.rows, q.rows, False)
        else:
            _open(unit, p.children or [p], q.children or [q], tau, links, todo, False)


def _open(unit, left: list[Node], right: list[Node], tau: float, links: Links, todo: list, same: bool) -> None:
    """Bound all pairs of children at once and queue those still open."""
    rl, rr = (np.array([n.radius for n in side]) for side in (left, right))
    cl, cr = ([n.center for n in side] for side in (left, right))
    for s in range(0, len(left), 1024):
        d = _distances(unit[cl[s:s + 1024]], unit[cr])
        reach = rl[s:s + 1024, None] + rr
        open_ = d - reach <= tau + _SLACK
        if same:
            open_ &= np.arange(len(right)) > np.arange(s, s + len(d))[:, None]
        whole = open_ & (d + reach <= tau - _SLACK)
        for i, j in zip(*np.nonzero(open_)):
            if whole[i, j]:
                links.all(left[s + i].rows, right[j].rows)
            else:
                todo.append((left[s + i], right[j]))


_LINKS = "id long, n long, root long"


def _link_blocks(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (x, y, side, id, size, vec) sorted by block pair -> per vector of a
    pair its weighted link count and its root in the pair's forest."""
    def solve(parts: list[pa.RecordBatch]):
        side, ids, sizes = (np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]) for i in (2, 3, 4))
        vec = pa.concat_arrays([p.column(5) for p in parts])
        for rows, raw in matrix(vec):
            unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
            links = Links(ids[rows], sizes[rows])
            here = [np.flatnonzero(side[rows] == s) for s in (0, 1)]
            trees = [build(unit, r) if len(r) else None for r in here]
            if trees[0] is not None and trees[1] is not None:
                traverse(raw, unit, trees[0], trees[1], threshold, links)
            elif trees[0] is not None and 1 not in side:
                traverse(raw, unit, trees[0], None, threshold, links)
            hit = np.flatnonzero(links.counts)
            if len(hit):
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(links.ids[hit], pa.int64()), "n": pa.array(links.counts[hit], pa.int64()),
                    "root": pa.array(links.ids[[links.root(i) for i in hit]], pa.int64())})

    key, held = None, []
    for batch in batches:
        x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(x):
            continue
        cut = np.flatnonzero((np.diff(x) != 0) | (np.diff(y) != 0)) + 1
        for s, e in zip([0, *cut], [*cut, len(x)]):
            if held and key != (x[s], y[s]):
                yield from solve(held)
                held = []
            key = (x[s], y[s])
            held.append(batch.slice(s, e - s))
    if held:
        yield from solve(held)


def _blocks(classes: DataFrame, block: int, per: int) -> tuple[DataFrame, list]:
    """Classes of large labels (``count`` classes) with ``cell``, ``sub`` and
    ``far`` (distance to the cell's centre), and the centres [(cell, label,
    vector)]: per label and ``per`` classes one, first in hash order."""
    order = Window.partitionBy("label", "dim").orderBy(F.xxhash64("id"), "id")
    picked = (classes.withColumn("r", F.row_number().over(order)).where(F.col("r") <= F.ceil(F.col("count") / per))
              .select("label", "dim", "vec").collect())
    by: dict[tuple, list] = {}
    centers = []
    for cell, (label, dim, vec) in enumerate(picked):
        v = np.array(vec, np.float64)
        centers.append((cell, label, v / np.linalg.norm(v)))
        by.setdefault((label, dim), []).append(cell)
    tables = {k: (np.array(c), np.stack([centers[i][2] for i in c])) for k, c in by.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), dtype=object)
            cell, far = np.zeros(len(labels), np.int32), np.zeros(len(labels))
            for rows, raw in matrix(batch.column(3)):
                unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
                for label in set(labels[rows]):
                    mine = np.flatnonzero(labels[rows] == label)
                    cells, c = tables[label, raw.shape[1]]
                    for i in range(0, len(mine), 1024):
                        d = _distances(unit[mine[i:i + 1024]], c)
                        k = d.argmin(1)
                        cell[rows[mine[i:i + 1024]]] = cells[k]
                        far[rows[mine[i:i + 1024]]] = d[np.arange(len(k)), k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)],
                                             names=["label", "id", "size", "vec", "cell", "far"])

    kind = f"label {classes.schema['label'].dataType.simpleString()}, id long, size long, vec {classes.schema['vec'].dataType.simpleString()}, cell int, far double"
    dealt = cut_lineage(classes.select("label", "id", "size", "vec").mapInArrow(assign, kind))
    # at most one row per centre; a crowded cell is cut into several blocks
    crowd = dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("subs"))
    dealt = dealt.join(F.broadcast(crowd), "cell").withColumn("sub", F.pmod(F.xxhash64("id"), F.col("subs")).cast("int"))
    return dealt, centers


def link(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label", block: int = 2048, most_centers: int = 20_000) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links`` (other rows of the same
    label with cosine >= threshold), ``component_id`` (smallest id reachable by
    links) and ``kept`` (id = component_id).

    Null, empty, zero and non-finite vectors, null labels and null ids link with
    nothing and are components of their own (a null id has a null component and
    is kept).  Copies (equal vectors of a label) are one tree entry with a
    weight, so they make no pairs; repeated ids are rows of their own.  All
    pairs are bounded or compared: the result is exact.  A task holds two
    blocks; centres on the driver and block summaries sent to tasks are bounded
    by ``most_centers``.  Other columns are not read.
    """
    h1, h2 = same_vector(F.col("vec"))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    ok = usable(F.col("vec")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    rows = cut_lineage(rows.select("id", "label", F.when(ok, F.col("vec")).alias("vec"), F.when(ok, h1).alias("h1"),
                                   F.when(ok, h2).alias("h2")))
    classes = cut_lineage(rows.where("vec is not null").groupBy("label", "h1", "h2")
                          .agg(F.min("id").cast("long").alias("id"), F.count(F.lit(1)).alias("size"), F.first("vec").alias("vec"))
                          .withColumn("dim", F.size("vec")))
    body = ["x", "y", "side", "id", "size", "vec"]
    # a label of at most ``per`` classes is one tree; fewer than most_centers have more
    per = max(block, math.ceil(classes.count() / most_centers))
    large = cut_lineage(classes.groupBy("label", "dim").count().where(F.col("count") > per))
    split = classes.join(F.broadcast(large), ["label", "dim"], "left")
    sides = split.where("count is null").select(F.xxhash64("label", "dim").alias("x"), F.lit(-1).cast("long").alias("y"),
                                                F.lit(0).alias("side"), "id", "size", "vec")
    if not large.isEmpty():
        tau = math.sqrt(max(0.0, 2 - 2 * threshold))
        dealt, centers = _blocks(split.where("count is not null"), block, per)
        dealt = cut_lineage(dealt.select("cell", "sub", "far", "id", "size", "vec"))
        # block pairs that may hold a link; summaries are one row per block
        blocks = [tuple(r) for r in dealt.groupBy("cell", "sub").agg(F.max("far")).collect()]
        pairs = _block_pairs(blocks, centers, tau, vectors.sparkSession)
        on = lambda c, s: (F.col(c) == F.col("cell")) & (F.col(s) == F.col("sub"))
        sides = (sides.union(dealt.join(pairs, on("c1", "s1")).withColumn("side", F.lit(0)).select(*body))
                 .union(dealt.join(pairs.where("x <> y"), on("c2", "s2")).withColumn("side", F.lit(1)).select(*body)))

    def solve(batches):
        return _link_blocks(batches, threshold)

    found = cut_lineage(sides.repartition("x", "y").sortWithinPartitions("x", "y", "side").mapInArrow(solve, _LINKS))
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    label = (classes.select("label", "h1", "h2", F.col("id").alias("first"), "size")
             .join(counts.withColumnRenamed("id", "first"), "first", "left")
             .join(roots.withColumnRenamed("node", "first"), "first", "left")
             .select("label", "h1", "h2", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("root", "first").alias("component_id")))
    out = rows.select("id", "label", "h1", "h2").join(cut_lineage(label), ["label", "h1", "h2"], "left")
    component = F.coalesce("component_id", F.col("id").cast("long"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _block_pairs(blocks: list, centers: list, tau: float, spark) -> DataFrame:
    """(x, y, c1, s1, c2, s2) of all block pairs of a label whose covering
    radii allow a link; x and y number the blocks."""
    label = {c: (name, len(v)) for c, name, v in centers}
    groups: dict = {}
    for n, (c, s, f) in enumerate(blocks):
        groups.setdefault(label[c], []).append((n, c, s, f))
    work = spark.createDataFrame([(n,) for n in range(len(blocks))], "x int").repartition(
        max(1, min(len(blocks), spark.sparkContext.defaultParallelism)))
    at = {c: v for c, _, v in centers}
    packed = {}
    for members in groups.values():
        table = (np.array([m[0] for m in members]), [m[1:3] for m in members], np.array([m[3] for m in members]),
                 np.stack([at[m[1]] for m in members]))
        for k, m in enumerate(members):
            packed[m[0]] = (k, table)

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(0).to_pylist():
                k, (number, where, far, c) = packed[x]
                d = _distances(c[[k]], c)[0]
                for j in np.flatnonzero((d <= far[k] + far + tau + _SLACK) & (np.arange(len(number)) >= k)):
                    out.append((x, int(number[j]), *where[k], *where[j]))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if i < 2 else pa.int32()) for i, v in enumerate(cols)],
                                             names=["x", "y", "c1", "s1", "c2", "s2"])

    return cut_lineage(work.mapInArrow(partners, "x long, y long, c1 int, s1 int, c2 int, s2 int"))
