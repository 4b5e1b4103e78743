"""SimHash near-duplicates found by covering locality-sensitive hashing.

Fingerprints are 64-bit majority votes over shingle hashes.  For radius r,
``2**(r+1) - 1`` bit masks are built from a map of bit positions to non-zero
(r+1)-bit vectors: mask v holds the positions whose vector has odd inner
product with v.  Up to r differing positions span at most r dimensions, so
some mask avoids them all and the pair collides there: no pair is missed.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.llm.common import connected_components, cut_lineage, fresh

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: A bucket with more fingerprints is dealt out again by deeper masks.
BUCKET = 2048
_LEVELS = 3


def fingerprint_of(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles (repeats included) of a text.

    Words are runs of bytes other than space, tab and LF..CR, A-Z lower-cased;
    fewer words than ``shingle`` make one shingle, none make fingerprint 0.
    A bit is set if over half the hashes have it.  The result is signed.
    """
    words = text.encode("utf-8", "replace").translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0] + [e + 1 for e in ends[:-1]]
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [h(joined, seed)]
    else:
        hashes = [h(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1:])]
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = np.array(hashes[i:i + 65536], np.uint64)
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "little", signed=True)


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """Fingerprint column (long); null and blank texts give 0."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")
    return fp(text)


def covering_masks(radius: int, level: int = 0) -> list[int]:
    """Masks (as signed longs) of which any pair within ``radius`` agrees on one."""
    dims = radius + 1
    vectors = [1 + i % (2 ** dims - 1) for i in range(64)]
    random.Random(level).shuffle(vectors)
    masks = []
    for v in range(1, 2 ** dims):
        m = sum(1 << i for i in range(64) if bin(vectors[i] & v).count("1") % 2)
        masks.append(m - 2 ** 64 if m >= 2 ** 63 else m)
    return masks


def _forest(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within one bucket (breadth first)."""
    left, a, b = fps, [], []
    while len(left) > 1:
        stack, left = [left[0]], left[1:]
        while stack and len(left):
            x = stack.pop()
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= bits
            if near.any():
                found, left = left[near], left[~near]
                a.append(np.full(len(found), x))
                b.append(found)
                stack.extend(found)
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _scan_buckets(batches: Iterator[pa.RecordBatch], bits: int, masks: list[int] | None,
                  bucket: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key -> links (a, b) with a null key, and the rows
    of buckets over ``bucket`` again under deeper keys (b null).  At most one
    bucket and one batch are held."""
    def links(a, b):
        return pa.RecordBatch.from_pydict({"key": pa.nulls(len(a), pa.int64()), "a": pa.array(a, pa.int64()),
                                           "b": pa.array(b, pa.int64())})

    def deeper(key, fps):
        with np.errstate(over="ignore"):  # keys only gather candidates; every link is checked
            parts = [(fps & np.int64(m)) * np.int64(-7046029254386353131) ^ np.int64(k + 1) * np.int64(-4417276706812531889)
                     ^ (np.int64(key) * np.int64(1609587929392839161)) for k, m in enumerate(masks)]
        return pa.RecordBatch.from_pydict({"key": pa.array(np.concatenate(parts)), "a": pa.array(np.tile(fps, len(masks))),
                                           "b": pa.nulls(len(fps) * len(masks), pa.int64())})

    def flush(key, parts, hot):
        fps = np.concatenate(parts)
        if masks is not None and (hot or len(fps) > bucket):
            for i in range(0, len(fps), bucket):
                yield deeper(key, fps[i:i + bucket])
        elif len(fps) > 1:
            a, b = _forest(fps, bits)
            if len(a):
                yield links(a, b)

    key, held, size, hot = None, [], 0, False
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        cuts = np.flatnonzero(np.diff(keys)) + 1
        bounds = np.concatenate([[0], cuts, [len(keys)]])
        lengths = np.diff(bounds)
        # runs wholly inside the batch: pairs at once, larger ones one by one
        inner = np.zeros(len(lengths), bool)
        inner[1:-1] = True
        two = bounds[:-1][inner & (lengths == 2)]
        near = np.bitwise_count((fps[two] ^ fps[two + 1]).view(np.uint64)) <= bits
        if near.any():
            yield links(fps[two][near], fps[two + 1][near])
        for r in sorted({0, len(lengths) - 1} | set(np.flatnonzero(inner & (lengths > 2)).tolist())):
            s, e = bounds[r], bounds[r + 1]
            if inner[r]:
                yield from flush(keys[s], [fps[s:e]], False)
                continue
            if held and keys[s] != key:
                yield from flush(key, held, hot)
                held, size, hot = [], 0, False
            key = keys[s]
            held.append(fps[s:e])
            size += e - s
            if masks is not None and size > bucket:  # too large to hold: on to deeper masks
                hot = True
                yield from flush(key, held, hot)
                held = []
    if held:
        yield from flush(key, held, hot)


def links(fingerprints: DataFrame, bits: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints (column
    ``fp``) within ``bits`` bits: a spanning forest per bucket, not all pairs.

    Buckets over ``bucket`` fingerprints are dealt out again by the masks of a
    second and third level, which leave few free bits, so no task holds a large
    group and nothing is dropped.
    """
    out = None
    keyed = fingerprints.select(F.posexplode(F.array([F.col("fp").bitwiseAND(F.lit(m)) for m in covering_masks(bits)]))
                                .alias("v", "part"), "fp").select(F.xxhash64("v", "part").alias("key"), "fp")
    for level in range(1, _LEVELS + 1):
        masks = covering_masks(bits, level) if level < _LEVELS else None

        def scan(batches, masks=masks):
            return _scan_buckets(batches, bits, masks, bucket)

        found = cut_lineage(keyed.repartition("key").sortWithinPartitions("key")
                            .mapInArrow(scan, "key long, a long, b long"))
        link = found.where("key is null").select("a", "b")
        out = link if out is None else out.union(link)
        keyed = found.where("key is not null").select("key", F.col("a").alias("fp"))
        if masks is None or keyed.isEmpty():
            return out.distinct()
    return out.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4,
                    bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``text_hash`` (xxhash64 of the
    text), ``fp`` (long), ``root`` (a key of its component) and
    ``component_id`` (smallest id of the component).

    Fingerprints of whole texts link at ``bits`` or fewer differing bits;
    components are taken over links.  Null and blank texts have fingerprint 0
    and link like any other; repeated rows and repeated ids are rows of their
    own; a component of null ids only has a null ``component_id``; an empty
    table gives an empty one.  Equal fingerprints are one node, so copies make
    no pairs.
    """
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                                   fingerprint(F.col(text_col), shingle).alias("fp")))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = connected_components(links(nodes.select("fp"), bits, bucket))
    nodes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    label = cut_lineage(nodes.join(least, "root").select("fp", "root", "component_id"))
    return rows.join(label, "fp").select(F.col("id").alias(id_col), "text_hash", "fp", "root", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4) -> DataFrame:
    """The rows of ``docs`` that carry the smallest id of their component, one
    row per component; columns as in ``docs``.  Of rows with equal id and text
    that differ in other columns any one stays."""
    i, h, k = (fresh(docs, s) for s in ("_id", "_hash", "_key"))
    rows = near_duplicates(docs, id_col, text_col, shingle, bits)
    kept = cut_lineage(rows.where(F.col(id_col).eqNullSafe(F.col("component_id")))
                       .groupBy("root", F.col(id_col).alias("id"), "text_hash").agg(F.count(F.lit(1)).alias("n"))
                       .groupBy("root").agg(F.min(F.struct("id", "text_hash", "n")).alias("w")).select("w.*"))
    out = docs.withColumn(h, F.xxhash64(F.col(text_col))).join(
        kept.select(F.col("id").alias(i), F.col("text_hash").alias(k)),
        F.col(id_col).eqNullSafe(F.col(i)) & (F.col(h) == F.col(k)), "left_semi")
    if not kept.where("n > 1").isEmpty():  # repeated rows of one id and text
        out = out.dropDuplicates([id_col, h])
    return out.drop(h)


def hex_digits(fp: Column) -> Column:
    """16 lower-case hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
