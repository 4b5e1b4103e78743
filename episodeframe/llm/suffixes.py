"""Removal of repeated byte strings by a multi-document suffix order.

A string of ``length`` bytes that starts earlier as well (in a smaller document,
or earlier in the same one) is removed; every byte that such a string covers goes.

1. The strings (windows) of a text are cut into segments: runs of windows with
   the same minimizer, the ``core`` bytes among them with the smallest hash.
   Equal windows have equal minimizers, so they meet in the segments of one
   group.  A segment is at most ``2 * length - core`` windows' bytes long.
2. Segments with equal bytes are counted once, at their earliest place; all
   windows of the others are removed.  Only groups with two different segments,
   or one that holds its minimizer twice, can hold further repeats.
3. Such groups are dealt to tasks, whole groups to a collection of bounded size.
   Its Burrows-Wheeler transform and common-prefix array are built column by
   column: each round inserts ``STEP`` more symbols of every segment, from the end,
   by one sequential pass that reads the arrays of the round before and writes
   them anew.  Runs of common prefixes of ``length`` or more are equal windows; all
   but the earliest are removed.
4. A group with more than ``most`` different segments is cut again by longer
   minimizers until the core is the whole window, where a group is one string.

The arrays of a round are the sequential files of the method: a collection is
bounded, so they fit a task, which may not keep files of its own on a cluster.

Defined results: null text is empty; texts shorter than ``length`` keep all;
rows without id come last; rows with one id and one text count as one document;
rows with one id and different texts are ordered by a hash of the text.  Lengths
are those of UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage

LENGTH = 100
CORE = 40
#: Different segments of one group that a collection takes; larger groups are cut again.
MOST_SEGMENTS = 4096
#: Segments of a collection (whole groups; one group may add ``MOST_SEGMENTS``).
COLLECTION = 12_000
#: Symbols of a text that one round inserts; with their number they fill 64 bits.
STEP = 7
#: Bytes hashed at once (their hashes stay in a core's cache); longer texts are hashed alone.
CHUNK = 1 << 17
NO_ID = (1 << 63) - 1

_MULT = 0x9E3779B97F4A7C15


# ---------------------------------------------------------------- segments

def _powers(base: int, n: int) -> np.ndarray:
    out, have = np.empty(n, np.uint64), 1
    out[0] = 1
    while have < n:
        step = min(have, n - have)
        out[have:have + step] = out[:step] * np.uint64(pow(base, have, 1 << 64))
        have += step
    return out


class Hashes:
    """64-bit hashes of byte ranges, by running sums of ``byte * base^i``."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = max(len(data) + 1, 2 * CHUNK)
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        out = np.zeros(len(data) + 1, np.uint64)
        out[1:] = data
        out[1:] += np.uint64(1)
        out[1:] *= self.up[:len(data)]
        np.cumsum(out[1:], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, low, high) -> np.ndarray:
        return _mixed((sums[high] - sums[low]) * self.down[low])

    def all_of(self, sums: np.ndarray, size: int) -> np.ndarray:
        out = sums[size:] - sums[:-size]
        out *= self.down[:len(out)]
        return _mixed(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    have = 1
    while have < width:
        more = min(have, width - have)
        h = np.minimum(h[:-more], h[more:])
        have += more
    return h


def _twice(h: np.ndarray, group: np.ndarray, start: np.ndarray, span: np.ndarray, width: int) -> np.ndarray:
    """Whether ``group[i]``, the least of ``h[start[i]:start[i] + span[i]]``, is there more than once."""
    out = np.zeros(len(start), bool)
    # nearly all minima are among the few values below a bound; the others are looked for among all values
    bound = np.uint64(min((1 << 64) - 1, (5 << 64) // width))
    for at, which in ((np.flatnonzero(h <= bound), np.flatnonzero(group <= bound)), (None, np.flatnonzero(group > bound))):
        if not len(which):
            continue
        low, high = start[which], start[which] + span[which]
        if at is not None:
            low, high = np.searchsorted(at, low), np.searchsorted(at, high)
        many = high - low
        begin = np.append(0, np.cumsum(many)[:-1])
        each = np.repeat(low - begin, many) + np.arange(many.sum())
        out[which] = np.add.reduceat(h[each if at is None else at[each]] == np.repeat(group[which], many), begin, dtype=np.int64) > 1
    return out


def segments(data: np.ndarray, ends: np.ndarray, core: int, length: int, hashes: Hashes) -> tuple[np.ndarray, ...]:
    """Segments of texts that lie end to end in ``data`` (text i ends before
    ``ends[i]``): group, hash of the bytes, text, start in ``data``, windows, and
    whether the minimizer occurs more than once."""
    empty = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, bool))
    if len(data) < length:
        return empty
    sums = hashes.sums(data)
    h = hashes.all_of(sums, core)
    width = length - core + 1
    least = _least(h, width)
    sizes = np.diff(ends, prepend=0)
    inside = np.zeros(len(least), bool)
    for low, high in zip(ends - sizes, ends):
        inside[low:max(low, high - length + 1)] = True
    new = np.append(True, (least[1:] != least[:-1]) | (inside[1:] != inside[:-1]))
    new[(ends - sizes)[(ends - sizes) < len(new)]] = True
    start = np.flatnonzero(new)
    run = np.diff(np.append(start, len(least)))
    keep = inside[start]
    start, run = start[keep], run[keep]
    # long runs (periodic text) in pieces of at most ``width`` windows
    pieces = -(-run // width)
    if (pieces > 1).any():
        first = np.repeat(start, pieces) + width * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        run = np.minimum(np.repeat(start + run, pieces) - first, width)
        start = first
    group = least[start]
    # minimizers within a segment: positions start .. start + run + width - 2
    twice = _twice(h, group, start, run + width - 1, width)
    bytes_hash = hashes.ranges(sums, start, start + run + length - 1)
    return group, bytes_hash, np.searchsorted(ends, start, side="right"), start, run, twice


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    low, held = 0, 0
    for i, s in enumerate(sizes):
        if held and held + s > CHUNK:
            yield low, i
            low, held = i, 0
        held += int(s)
    if low < len(sizes):
        yield low, len(sizes)


def _text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, ends) of a string or binary column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data, offsets


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int64) if x.dtype != np.uint64 else x.view(np.int64))


_SEGMENT = "g long, s long, doc long, tie long, at int, run short, twice boolean"


def cut(docs: DataFrame, core: int, length: int) -> DataFrame:
    """Segments of all texts: group, hash, document, start, windows, minimizer twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(_MULT)
        for batch in batches:
            data, offsets = _text_buffer(batch.column(2))
            doc, tie = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for low, high in _chunks(np.diff(offsets)):
                part = data[offsets[low]:offsets[high]]
                ends = offsets[low + 1:high + 1] - offsets[low]
                g, s, text, at, n, twice = segments(part, ends, core, length, hashes)
                begin = np.append(0, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [_long(g), _long(s), pa.array(doc[low + text]), pa.array(tie[low + text]), pa.array((at - begin[text]).astype(np.int32)),
                     pa.array(n.astype(np.int16)), pa.array(twice)], ["g", "s", "doc", "tie", "at", "run", "twice"])

    return docs.mapInArrow(run, _SEGMENT)


def recut(found: DataFrame, core: int, length: int) -> DataFrame:
    """Segments (with bytes) cut again by a longer core, within their groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(_MULT)
        names = ["g", "s", "doc", "tie", "at", "run", "twice", "bytes"]
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            data, offsets = _text_buffer(cols["bytes"])
            for low, high in _chunks(np.diff(offsets)):
                part = data[offsets[low]:offsets[high]]
                ends = offsets[low + 1:high + 1] - offsets[low]
                g, s, text, at, n, twice = segments(part, ends, core, length, hashes)
                row = low + text
                old = cols["g"].to_numpy().view(np.uint64)[row]
                begin = np.append(0, ends[:-1])
                blob = part.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [_long(_mixed(old * np.uint64(31) + g)), _long(s), pa.array(cols["doc"].to_numpy()[row]),
                     pa.array(cols["tie"].to_numpy()[row]), pa.array((cols["at"].to_numpy()[row] + at - begin[text]).astype(np.int32)),
                     pa.array(n.astype(np.int16)), pa.array(twice),
                     pa.array([blob[a:a + r + length - 1] for a, r in zip(at.tolist(), n.tolist())], pa.binary())], names)

    return found.select("g", "s", "doc", "tie", "at", "run", "twice", "bytes").mapInArrow(run, _SEGMENT + ", bytes binary")


# ---------------------------------------------------------------- column-wise construction

def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low..high]`` (inclusive) for many ranges, by blocks of 16."""
    size = 16
    rows = np.full(-(-len(values) // size) * size, 255, np.uint8)
    rows[:len(values)] = values
    rows = rows.reshape(-1, size)
    least = rows[:, 0].copy()
    for k in range(1, size):
        np.minimum(least, rows[:, k], out=least)
    levels = [least]
    while 2 << (len(levels) - 1) < len(rows):
        step, last = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(last, np.append(last[step:], last[len(last) - step:])))
    a, b = low >> 4, high >> 4
    column = np.arange(size, dtype=np.uint8)
    left, right = rows[a], rows[b]
    start, stop = (low & 15).astype(np.uint8)[:, None], (high & 15).astype(np.uint8)[:, None]
    same = (a == b)[:, None]
    left[(column < start) | same & (column > stop)] = 255
    right[(column > stop) | same] = 255
    out = np.minimum(left, right).min(axis=1)
    gap = b - a - 1
    far = np.flatnonzero(gap > 0)
    if len(far):
        level = np.frexp(gap[far].astype(float))[1] - 1
        table = np.stack(levels)
        out[far] = np.minimum(out[far], np.minimum(table[level, a[far] + 1], table[level, b[far] - (1 << level.astype(np.int64))]))
    return out


def _symbols(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending blocks of up to ``STEP`` bytes (with their number in the last byte),
    and the rank of the block that starts at each place of ``flat``; a block ends with its text."""
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(flat))
    held = np.minimum(left, STEP).astype(np.uint64)
    padded = np.append(flat, np.zeros(STEP, np.uint8))
    block = np.zeros(len(flat), np.uint64)
    for k in range(STEP):
        block <<= np.uint64(8)
        block |= padded[k:k + len(flat)]
    block <<= np.uint64(8)
    short = np.flatnonzero(left < STEP)                    # the next text's bytes go
    over = (STEP + 1 - left[short]).astype(np.uint64) * np.uint64(8)
    block[short] = block[short] >> over << over
    block |= held
    order = np.argsort(block)
    ascending = block[order]
    new = np.append(True, ascending[1:] != ascending[:-1]) if len(block) else np.zeros(0, bool)
    rank = np.empty(len(block), np.int64)
    rank[order] = np.cumsum(new) - 1
    return ascending[new], rank


def collection(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common-prefix array of a collection.

    Symbols are bytes + 1, 0 ends a text; the ends order by text.  A round inserts
    the suffixes of the next ``STEP`` lengths, each a block of bytes ``c`` before a
    suffix ``u`` of an earlier round (or before the end, then maybe a shorter block):
    ``c u`` goes to the place that the ``c`` in front of ``u`` has among all ``c``.
    Its common prefix with the suffix before it is that of their blocks, or one block
    more than the least common prefix between the two places of the round before;
    that with the suffix behind it likewise.  Common prefixes stop at 255.  ``key``
    holds block and place of ``u`` of each suffix, ``begin`` where it starts."""
    n = len(texts)
    size = np.fromiter(map(len, texts), np.int64, n)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(size)
    blocks, rank = _symbols(flat, ends)
    held = (blocks & np.uint64(255)).astype(np.uint8)
    steps = np.uint64(256) ** np.arange(1, STEP + 1, dtype=np.uint64)
    low = np.int64((1 << 32) - 1)
    lcp = np.zeros(n, np.uint8)
    key, begin = np.zeros(0, np.int64), np.zeros(0, np.int32)
    row = np.arange(n)[:, None]                            # of the suffixes inserted last; of the ends at first
    for done in range(0, int(size.max(initial=0)), STEP):
        # suffixes of done + 1 .. done + STEP bytes, each with the row of the one ``STEP`` bytes shorter
        start = ends[:, None] - np.arange(done + 1, done + STEP + 1)
        there = start >= (ends - size)[:, None]
        start = start[there]
        at = rank[start] << 32 | np.broadcast_to(row, there.shape)[there]
        order = np.argsort(at)
        at = at[order]
        to = np.searchsorted(key, at) + np.arange(len(at))
        is_old = np.ones(n + len(key) + len(at), bool)
        is_old[n + to] = False
        old = np.flatnonzero(is_old)                       # new rows of the old rows, which keep their order
        new_key, new_begin = np.empty(len(key) + len(at), np.int64), np.empty(len(key) + len(at), np.int32)
        new_key[to], new_begin[to] = at, start[order]
        rest = old[n:] - n
        new_key[rest], new_begin[rest] = key, begin
        # common prefixes of the new suffixes and of those right behind them
        mark = np.zeros(len(new_key) + 1, bool)
        mark[to] = True
        mark[to + 1] = True
        mark[0] = False                                    # the first shares nothing
        t = np.flatnonzero(mark[:-1])
        value = np.zeros(len(t), np.uint8)
        before, own = new_key[t - 1], new_key[t]
        c = own >> 32
        same = before >> 32 == c
        if same.any():
            one, two = (before[same] & low) + 1, own[same] & low
            least, wide = lcp[two], np.flatnonzero(one < two)
            if len(wide):
                least[wide] = _range_min(lcp, one[wide], two[wide])
            value[same] = np.minimum(least, 255 - STEP) + held[c[same]]
        c, d = c[~same], before[~same] >> 32
        equal = STEP - np.searchsorted(steps, blocks[c] ^ blocks[d], side="right")
        value[~same] = np.minimum(equal, np.minimum(held[c], held[d]))
        # the arrays of this round, written anew in one pass
        new_lcp = np.zeros(len(is_old), np.uint8)
        new_lcp[old] = lcp
        new_lcp[n + t] = value
        lcp, begin = new_lcp, new_begin
        key = new_key
        moved = old[key & low]
        key &= ~low
        key |= moved
        placed = np.empty(len(to), np.int64)
        placed[order] = n + to
        row = np.zeros(there.shape, np.int64)
        row[there] = placed
    # the symbol before a suffix, 0 before a whole text
    before = np.append(0, flat.astype(np.int16) + 1)
    ahead = before[ends]
    before[ends - size] = 0
    return np.append(np.where(size > 0, ahead, 0), before[begin]).astype(np.int16), lcp


def suffix_rows(bwt: np.ndarray, n: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, length of the suffix) of each row, by walking all texts backwards at once."""
    order = np.argsort(bwt, kind="stable")
    order = order[len(bwt) - np.count_nonzero(bwt):]
    back = np.full(len(bwt), -1, np.int64)
    back[order] = np.arange(len(order)) + n
    text, length = np.empty(len(bwt), np.int32), np.zeros(len(bwt), np.int32)
    at, who = np.arange(n), np.arange(n)
    for k in range(longest + 1):
        text[at], length[at] = who, k
        at = back[at]
        on = at >= 0
        at, who = at[on], who[on]
    return text, length


def later_windows(texts: list[bytes], where: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, offset) of the windows of a collection that also start earlier;
    ``where`` orders the texts' first bytes (document rank * 2^32 + start)."""
    bwt, lcp = collection(texts)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    text, suffix = suffix_rows(bwt, len(texts), int(size.max(initial=0)))
    long = lcp >= length
    long[:-1] |= long[1:].copy()  # the first of a run shares with the next
    at = np.flatnonzero(long)
    if not len(at):
        return np.zeros(0, int), np.zeros(0, int)
    group = np.flatnonzero(lcp[at] < length)
    text, offset = text[at], size[text[at]] - suffix[at]
    key = where[text] + offset
    first = np.minimum.reduceat(key, group)
    later = key > np.repeat(first, np.diff(np.append(group, len(at))))
    return text[later], offset[later]


_RANGE = "doc long, tie long, at int, run int"


def repeats(found: DataFrame, length: int) -> DataFrame:
    """Runs of windows that start earlier as well, out of groups of different
    segments at their earliest places (columns g, doc, tie, at, bytes)."""
    def solve(rows: pd.DataFrame) -> pa.RecordBatch:
        doc, tie, at = rows["doc"].to_numpy(), rows["tie"].to_numpy(), rows["at"].to_numpy().astype(np.int64)
        order = np.lexsort((tie, doc))
        new = np.append(False, (doc[order][1:] != doc[order][:-1]) | (tie[order][1:] != tie[order][:-1]))
        rank = np.empty(len(rows), np.int64)
        rank[order] = np.cumsum(new)
        text, offset = later_windows(rows["bytes"].to_list(), rank << 32 | at, length)
        order = np.lexsort((offset, text))
        text, offset = text[order], offset[order]
        begin = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (offset[1:] != offset[:-1] + 1))) if len(text) else np.zeros(0, int)
        run = np.diff(np.append(begin, len(text)))
        text, offset = text[begin], offset[begin]
        return pa.RecordBatch.from_arrays([pa.array(doc[text]), pa.array(tie[text]), pa.array((at[text] + offset).astype(np.int32)),
                                           pa.array(run.astype(np.int32))], ["doc", "tie", "at", "run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            part = batch.to_pandas()
            held.append(part)
            if sum(map(len, held)) >= COLLECTION:
                rows = pd.concat(held)
                whole = rows["g"].to_numpy() != rows["g"].iloc[-1]  # the last group may go on
                if whole.any():
                    yield solve(rows[whole])
                    rows = rows[~whole]
                held = [rows]
        if held and sum(map(len, held)):
            yield solve(pd.concat(held))

    rows = found.select("g", "doc", "tie", "at", "bytes").repartition("g").sortWithinPartitions("g")
    return rows.mapInArrow(run, _RANGE)


# ---------------------------------------------------------------- whole texts

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, tie, text): ``tie`` tells texts of one id apart, and is 0 if no id occurs twice."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    text = F.coalesce(F.col(text_col), F.lit(""))
    twice = docs.groupBy(doc.alias("d")).count().where("count > 1").limit(1).count() > 0
    return docs.select(doc.alias("doc"), (F.xxhash64(text) if twice else F.lit(0).cast("long")).alias("tie"), text.alias("text"))


def _packed(keyed: DataFrame) -> DataFrame:
    """Texts compressed for a shuffle."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            small = pa.array([pack(t.as_buffer()) for t in batch.column(2).cast(pa.large_binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), small], ["doc", "tie", "z"])

    return keyed.mapInArrow(run, "doc long, tie long, z binary")


def _firsts_and_others(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Earliest place of each different segment (with its group's number of
    different segments), and the windows of all other places."""
    extra = [F.first("bytes").alias("bytes")] if "bytes" in rows.columns else []
    place = F.struct("doc", "tie", "at")
    firsts = rows.groupBy("g", "s").agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("places"), F.first("run").alias("run"),
                                        F.first("twice").alias("twice"), *extra)
    firsts = cut_lineage(firsts)
    copied = firsts.where("places > 1").select("g", "s", "f")
    others = rows.join(copied, ["g", "s"]).where(place != F.col("f")).select("doc", "tie", "at", F.col("run").cast("int").alias("run"))
    counts = firsts.groupBy("g").agg(F.count(F.lit(1)).alias("different"), F.max("twice").alias("any_twice")).where(
        "different > 1 or any_twice")
    multi = firsts.join(counts.select("g", "different"), "g").select("g", "s", "f.*", "run", "twice", "different",
                                                                    *(["bytes"] if extra else []))
    return multi, others


def repeated_ranges(keyed: DataFrame, length: int = LENGTH, core: int = CORE,
                    most: int = MOST_SEGMENTS) -> DataFrame:
    """Runs of removed windows: doc, tie, at, run (windows at at .. at + run - 1)."""
    rows = cut(keyed, core, length)
    shared = rows.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.max("twice").alias("t")).where("c > 1 or t").select("g")
    rows = cut_lineage(rows.join(cut_lineage(shared), "g"))  # written: a hot group of the join can be split
    multi, others = _firsts_and_others(rows)
    wanted = multi.groupBy("doc", "tie").agg(F.collect_list(F.struct("g", "s", "at", "run", "twice", "different")).alias("cuts"))

    def fetch(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        names = ["g", "s", "doc", "tie", "at", "run", "twice", "different", "bytes"]

        def taken(batch, low, high, first, cut_out):
            cuts = batch.column(3).flatten().slice(first, len(cut_out))
            row = np.repeat(np.arange(low, high), np.asarray(pc.list_value_length(batch.column(3).slice(low, high - low))))
            return pa.RecordBatch.from_arrays(
                [*(cuts.field(f) for f in ("g", "s")), *(batch.column(k).take(pa.array(row)) for k in (0, 1)),
                 *(cuts.field(f) for f in ("at", "run", "twice", "different")), pa.array(cut_out, pa.binary())], names)

        for batch in batches:
            places = batch.column(3).flatten()
            at, run = (places.field(f).to_numpy().astype(np.int64) for f in ("at", "run"))
            low = first = held = 0
            cut_out, stop = [], (at + run + length - 1).tolist()
            ends = np.cumsum(np.asarray(pc.list_value_length(batch.column(3)))).tolist()
            at = at.tolist()
            for i, z in enumerate(batch.column(2)):
                data, done = unpack(z.as_buffer()), first + len(cut_out)
                cut_out += [data[a:b] for a, b in zip(at[done:ends[i]], stop[done:ends[i]])]
                held += sum(stop[done:ends[i]]) - sum(at[done:ends[i]])
                if held > CHUNK or i + 1 == len(batch):
                    yield taken(batch, low, i + 1, first, cut_out)
                    low, first, held, cut_out = i + 1, ends[i], 0, []

    found = cut_lineage(_packed(keyed).join(wanted, ["doc", "tie"]).select("doc", "tie", "z", "cuts").mapInArrow(
        fetch, "g long, s long, doc long, tie long, at int, run short, twice boolean, different long, bytes binary"))
    out = [others]
    while True:
        out.append(repeats(found.where(F.col("different") <= most), length))
        large = found.where(F.col("different") > most)
        if core >= length or large.limit(1).count() == 0:
            if core >= length:  # a core as long as a window: a group is one string, but for equal hashes
                out.append(repeats(large, length))
            break
        core = min(length, core + (length - core + 1) // 2 + 4)
        found, others = _firsts_and_others(cut_lineage(recut(large, core, length)))
        found = cut_lineage(found)
        out.append(others)
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, core: int = CORE,
          most: int = MOST_SEGMENTS) -> DataFrame:
    """Per document: id, n_bytes, spans (removed byte ranges: start, end), kept (remaining bytes)."""
    keyed = _keyed(docs, id_col, text_col)
    ranges = repeated_ranges(keyed, length, core, most).groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "run")).alias("runs"))

    def remove(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            n_bytes, spans, kept = [], [], []
            for z, runs in zip(batch.column(2), batch.column(3)):
                data = unpack(z.as_py())
                found = []
                if runs.is_valid:
                    at, run = (runs.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                    order = np.argsort(at, kind="stable")
                    begin, end = at[order], np.maximum.accumulate((at + run + length - 1)[order])
                    new = np.append(True, begin[1:] > end[:-1])
                    found = list(zip(begin[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist()))
                n_bytes.append(len(data)), spans.append([{"start": a, "end": b} for a, b in found])
                edges = [0, *(x for pair in found for x in pair), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(spans, span),
                                              pa.array(kept, pa.binary())], ["doc", "n_bytes", "spans", "kept"])

    out = _packed(keyed).join(ranges, ["doc", "tie"], "left").select("doc", "tie", "z", "runs").mapInArrow(
        remove, "doc long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
    kind = docs.schema[id_col].dataType
    return out.select(F.nullif(F.col("doc"), F.lit(NO_ID)).cast(kind).alias(id_col), "n_bytes", "spans", "kept")
