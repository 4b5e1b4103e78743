"""Phrase collocations by weighted acyclic automata.

1. Tasks cut their texts into shards of one language: a sorted word table and
   the text as word numbers, pieces apart.  Shards are written once.
2. Words, then pairs of words, that occur often enough are marked in two bit
   tables of fixed size.  A bit may be set by another word too: the tables only
   spare work, no phrase that is frequent enough is lost.
3. Each shard's word paths (up to four words, as far as the marks reach) are
   sorted and built into an acyclic automaton, cut by prefix ranges; equal
   sub-automata are stored once.  An arc weighs the count of its prefix.
4. A task reads the automata of one range after another and unions them, summing
   the weights of equal paths.  Phrases that are frequent enough come out;
   prefixes that lie across a range's bound are summed over ranges.
5. The parts of all candidates (sorted) are composed with the united automata,
   which gives each part's count.

Defined results: null text counts as empty, null language as ``und``; a word may
have any length; repeated rows count each; ties follow the phrase's bytes; empty
tables give no row.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage

#: Fixed values of the contract: bytes that end a piece; blanks between words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
LONGEST = 4

SHARD_TOKENS = 500_000
HELD_TOKENS = 1_000_000     # of all open shards of a task
PATHS_PER_RANGE = 500_000
MOST_RANGES = 20_000
SAMPLED_SHARDS, SAMPLED_PATHS = 64, 512
PENDING_PATHS = 1_000_000   # union: paths gathered before they are consolidated

_BREAK = b"\xff"            # never part of UTF-8
_TABLE = bytes(0xFF if b in PIECE_ENDS else 0x20 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Words of a text; ``_BREAK`` ends each piece."""
    return (text.translate(_TABLE).replace(_BREAK, b" \xff ") + b" \xff").split()


# ---------------------------------------------------------------- shards

class _Open:
    """A shard under construction."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        numbers = self.numbers
        for w in set(words).difference(numbers):
            numbers[w] = len(numbers)
        self.parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, lang: str) -> dict:
        ids = np.concatenate(self.parts)
        numbers = self.numbers
        words = sorted(w for w in numbers if w != _BREAK)
        rank = np.full(len(numbers), -1, np.int32)
        rank[np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
        pack = zstandard.ZstdCompressor(level=1).compress
        return {"lang": lang, "words": pack(b" ".join(words)), "ids": pack(rank[ids].tobytes())}


def _unpack(row) -> tuple[list[bytes], np.ndarray]:
    open_ = zstandard.ZstdDecompressor().decompress
    blob = open_(row["words"])
    return blob.split(b" ") if blob else [], np.frombuffer(open_(row["ids"]), np.int32)


def shards(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (lang, words, ids): word tables in byte order and texts as numbers in it, -1 between pieces."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.binary()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Open] = {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = tokens(value.as_py() or b"")
                if len(words) > 1:
                    shard = held.setdefault(name, _Open())
                    shard.add(words)
                    if shard.size >= SHARD_TOKENS:
                        yield pa.RecordBatch.from_pylist([held.pop(name).row(name)], schema)
                    elif sum(s.size for s in held.values()) >= HELD_TOKENS:
                        most = max(held, key=lambda k: held[k].size)
                        yield pa.RecordBatch.from_pylist([held.pop(most).row(most)], schema)
        for name, shard in held.items():
            yield pa.RecordBatch.from_pylist([shard.row(name)], schema)

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("_l"), F.col(text).alias("_t"))
    return rows.mapInArrow(cut, "lang string, words binary, ids binary")


# ---------------------------------------------------------------- marks of frequent words and pairs

def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * np.uint64(3) + second)


@dataclass
class Marks:
    """Bit table of hashes; ``bits`` slots, a power of two."""

    table: np.ndarray
    bits: int

    def test(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for k in range(2):
            at = _mixed(h + np.uint64(k)) >> np.uint64(64 - self.bits)
            out &= (self.table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def _marks(counts: DataFrame, bits: int) -> Marks:
    """Bit table of the longs in column ``h``: tasks set bits, the 2^(bits - 6) longs at most that result are collected."""
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            at = np.concatenate([_mixed(h + np.uint64(k)) >> np.uint64(64 - bits) for k in range(2)])
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["slot", "bit"])

    rows = counts.select("h").mapInArrow(slots, "slot long, bit long").groupBy("slot").agg(F.bit_or("bit").alias("bit"))
    table, found = np.zeros(1 << (bits - 6), np.uint64), rows.toPandas()
    table[found["slot"].to_numpy(np.int64)] = found["bit"].to_numpy(np.int64).view(np.uint64)
    return Marks(table.view(np.uint8), bits)


def _counted(parts: DataFrame, run, least: int) -> DataFrame:
    return parts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least)


def frequent_words(parts: DataFrame, least: int, bits: int) -> Marks:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, ids = _unpack(row)
                count = np.bincount(ids[ids >= 0], minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.array(_word_hashes(row["lang"], words).view(np.int64)),
                                                  pa.array(count.astype(np.int64))], ["h", "c"])

    return _marks(_counted(parts, run, least), bits)


def frequent_pairs(parts: DataFrame, words_marked, least: int, bits: int) -> Marks:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, ids = _unpack(row)
                h = _word_hashes(row["lang"], words)
                good = np.append(words_marked.value.test(h), False)  # the last answers for -1
                at = np.flatnonzero(good[ids[:-1]] & good[ids[1:]])
                pairs, count = np.unique(ids[at].astype(np.int64) << 32 | ids[at + 1], return_counts=True)
                hashes = _pair_hash(h[pairs >> 32], h[pairs & 0xFFFFFFFF])
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(count.astype(np.int64))], ["h", "c"])

    return _marks(_counted(parts, run, least), bits)


# ---------------------------------------------------------------- automata

def sorted_paths(ids: np.ndarray, word_ok: np.ndarray, pair_ok) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths (rows of ``LONGEST`` word numbers, -1 at the end) in
    order, with counts: at each marked word the longest run of marked pairs."""
    good = np.append(word_ok, False)[ids]  # the last answers for -1
    pairs = np.flatnonzero(good[:-1] & good[1:])
    linked = np.zeros(len(ids), bool)      # whether a marked pair begins here
    linked[pairs] = pair_ok(ids[pairs], ids[pairs + 1])
    start = np.flatnonzero(good)
    path = np.full((len(start), LONGEST), -1, np.int32)
    path[:, 0] = ids[start]
    alive = np.arange(len(start))
    for k in range(1, LONGEST):
        alive = alive[linked[start[alive] + k - 1]]
        path[alive, k] = ids[start[alive] + k]
    return summed(path, np.ones(len(path), np.int64))


def summed(path: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Paths in order, the weights of equal ones summed."""
    if not len(path):
        return path, weight
    high, low = ((path[:, k].astype(np.int64) + 1) << 32 | (path[:, k + 1] + 1) for k in (0, 2))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
    return path[order[first]], np.add.reduceat(weight[order], first)


@dataclass
class Automaton:
    """Acyclic weighted automaton over a sorted word table.

    The arcs of state s are ``offset[s]:offset[s + 1]``, in the order of their
    labels; an arc's weight is the count of the prefix that ends with it.  State
    0 has no arcs, the last state is the start."""

    words: list[bytes]
    offset: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    @classmethod
    def build(cls, words: list[bytes], path: np.ndarray, weight: np.ndarray) -> Automaton:
        """From sorted distinct paths, deepest arcs first: states with the same
        arcs (labels, weights, targets) become one before their parents are made."""
        used, path = _renumbered(path)
        words = [words[i] for i in used]
        if not len(path):
            return cls([], np.zeros(2, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        total = np.append(0, np.cumsum(weight))
        offset, label, wt, target = [0, 0], [], [], []
        below_start, below_state = np.zeros(0, int), np.zeros(0, np.int64)
        for k in range(LONGEST - 1, -1, -1):
            # rows where another prefix of this length, or a shorter path, begins
            change = np.flatnonzero(np.append(True, np.any(path[1:, :k + 1] != path[:-1, :k + 1], axis=1)))
            at = change[path[change, k] >= 0]
            if not len(at):
                continue
            end = np.append(change, len(path))[np.searchsorted(change, at, side="right")]
            w = total[end] - total[at]
            child = np.zeros(len(at), np.int64)
            child[np.searchsorted(at, below_start, side="right") - 1] = below_state
            lab = path[at, k]
            # arcs of one parent lie together
            parent = np.append(True, np.any(path[at[1:], :k] != path[at[:-1], :k], axis=1)) if k else np.arange(len(at)) == 0
            group = np.flatnonzero(parent)
            size = np.diff(np.append(group, len(at)))
            place = np.arange(len(at)) - np.repeat(group, size)
            sig = np.zeros((2, len(group)), np.uint64)
            for s in range(2):
                x = _mixed(_mixed(_mixed(lab.astype(np.uint64) + np.uint64(17 + s)) + w.astype(np.uint64)) + child.astype(np.uint64))
                sig[s] = np.add.reduceat(_mixed(x + _mixed(place.astype(np.uint64) + np.uint64(s))), group) + size.astype(np.uint64)
            order = np.lexsort(sig)
            fresh = np.append(True, np.any(sig[:, order[1:]] != sig[:, order[:-1]], axis=0))
            keep, which = order[fresh], np.empty(len(order), np.int64)
            which[order] = np.cumsum(fresh) - 1
            first_state = len(offset) - 1
            take = np.repeat(group[keep] - np.append(0, np.cumsum(size[keep])[:-1]), size[keep]) + np.arange(size[keep].sum())
            label.append(lab[take]), wt.append(w[take]), target.append(child[take])
            offset.extend((offset[-1] + np.cumsum(size[keep])).tolist())
            below_start, below_state = at[group], first_state + which
        return cls(words, np.array(offset, np.int64), np.concatenate(label).astype(np.int32), np.concatenate(wt),
                   np.concatenate(target))

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All prefixes in order of depth: (words of the path, depth, weight)."""
        state = np.array([len(self.offset) - 2], np.int64)
        so_far = np.zeros((1, 0), np.int32)
        out, depths, weights = [], [], []
        for k in range(LONGEST):
            size = self.offset[state + 1] - self.offset[state]
            row = np.repeat(np.arange(len(state)), size)
            arc = np.repeat(self.offset[state] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
            so_far = np.column_stack([so_far[row], self.label[arc]])
            out.append(np.column_stack([so_far, np.full((len(row), LONGEST - k - 1), -1, np.int32)]))
            depths.append(np.full(len(row), k + 1))
            weights.append(self.weight[arc])
            state = self.target[arc]
        return np.concatenate(out), np.concatenate(depths), np.concatenate(weights)

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct paths in order, with the weight that ends there (the prefix's
        weight less that of its continuations)."""
        path, depth, weight = self.paths()
        path, weight = path.astype(np.int32), weight.copy()
        whole, inner = path, np.full_like(path, -1)
        keep = np.arange(LONGEST)[None, :] < (depth - 1)[:, None]
        inner[keep] = whole[keep]
        deep = depth > 1
        both, total = summed(np.concatenate([path, inner[deep]]), np.concatenate([weight, -weight[deep]]))
        return both[total > 0], total[total > 0]

    def compose(self, requests: list[tuple[bytes, ...]]) -> np.ndarray:
        """Counts of the requested phrases; 0 where there is no such path."""
        number = {w: i for i, w in enumerate(self.words)}
        want = np.array([[number.get(w, -2) for w in r] + [-1] * (LONGEST - len(r)) for r in requests], np.int64).reshape(-1, LONGEST)
        length = np.array([len(r) for r in requests])
        arc_state = np.repeat(np.arange(len(self.offset) - 1), np.diff(self.offset))
        key = arc_state.astype(np.int64) << 32 | self.label
        state, found = np.full(len(want), len(self.offset) - 2, np.int64), np.zeros(len(want), np.int64)
        alive = np.arange(len(want)) if len(key) else np.zeros(0, int)
        for k in range(LONGEST):
            alive = alive[want[alive, k] >= 0]
            look = state[alive] << 32 | want[alive, k]
            at = np.minimum(np.searchsorted(key, look), len(key) - 1)
            hit = key[at] == look
            alive, at = alive[hit], at[hit]
            last = length[alive] == k + 1
            found[alive[last]] = self.weight[at[last]]
            state[alive] = self.target[at]
        return found

    def to_bytes(self) -> bytes:
        words = b" ".join(self.words)
        head = struct.pack("<qqqq", len(words), len(self.offset), len(self.label), 0)
        body = b"".join(a.tobytes() for a in (self.offset, self.label, self.weight, self.target))
        return zstandard.ZstdCompressor(level=1).compress(head + words + body)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Automaton:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, states, arcs, _ = struct.unpack_from("<qqqq", raw)
        words, at, got = raw[32:32 + n], 32 + n, []
        for count, kind in ((states, np.int64), (arcs, np.int32), (arcs, np.int64), (arcs, np.int64)):
            got.append(np.frombuffer(raw, kind, count, at))
            at += count * np.dtype(kind).itemsize
        return cls(words.split(b" ") if words else [], *got)


def _renumbered(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that occur (ascending) and the paths over their ranks."""
    used = np.unique(path[path >= 0])
    return used, np.where(path >= 0, np.searchsorted(used, path), -1).astype(np.int32)


class Union:
    """Automata of one range, united path by path."""

    def __init__(self):
        self.words: list[bytes] = []
        self.path, self.weight = np.zeros((0, LONGEST), np.int32), np.zeros(0, np.int64)
        self.pending: list[Automaton] = []
        self.waiting = 0

    def add(self, other: Automaton) -> None:
        self.pending.append(other)
        self.waiting += len(other.label)
        if self.waiting > PENDING_PATHS:
            self.consolidate()

    def consolidate(self) -> None:
        tables = [self.words, *(a.words for a in self.pending)]
        words = sorted(set().union(*tables))
        number = {w: i for i, w in enumerate(words)}
        paths, weights = [], []
        for table, (path, weight) in zip(tables, [(self.path, self.weight), *(a.ends() for a in self.pending)]):
            to = np.fromiter((*map(number.__getitem__, table), -1), np.int32, len(table) + 1)  # -1 stays -1
            paths.append(to[path]), weights.append(weight)
        self.words = words
        self.path, self.weight = summed(np.concatenate(paths), np.concatenate(weights))
        self.pending, self.waiting = [], 0

    def automaton(self) -> Automaton:
        if self.pending:
            self.consolidate()
        return Automaton.build(self.words, self.path, self.weight)


# ---------------------------------------------------------------- counting

def _shard_paths(row, word_marks: Marks, pair_marks: Marks) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    words, ids = _unpack(row)
    h = _word_hashes(row["lang"], words)
    path, weight = sorted_paths(ids, word_marks.test(h), lambda a, b: pair_marks.test(_pair_hash(h[a], h[b])))
    return words, path, weight


def _named(words: list[bytes], path) -> tuple[bytes, ...]:
    return tuple(words[i] for i in path if i >= 0)


def _bounds(parts: DataFrame, marks) -> dict[str, list[tuple[bytes, ...]]]:
    """Lower bounds of the prefix ranges after the first, per language: evenly
    spaced paths of a bounded sample of shards.  They share out the work only."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, path, _ = _shard_paths(row, *marks.value)
                pick = np.linspace(0, len(path) - 1, min(SAMPLED_PATHS, len(path))).astype(int)
                for i in pick:
                    yield pa.RecordBatch.from_pylist([{"lang": row["lang"], "path": b" ".join(_named(words, path[i])),
                                                       "paths": len(path) / len(pick)}])

    n = parts.count()
    some = parts.orderBy(F.xxhash64("words", "ids")).limit(SAMPLED_SHARDS)
    spread: dict[str, list] = {}
    for r in some.mapInArrow(run, "lang string, path binary, paths double").collect():
        spread.setdefault(r["lang"], []).append((tuple(bytes(r["path"]).split(b" ")), r["paths"] * max(1.0, n / SAMPLED_SHARDS)))
    out = {}
    for lang, rows in spread.items():
        rows.sort()
        total = np.cumsum([w for _, w in rows])
        ranges = int(min(max(total[-1] // PATHS_PER_RANGE, 1), MOST_RANGES))
        at = np.searchsorted(total, total[-1] * np.arange(1, ranges) / ranges)
        out[lang] = sorted({rows[i][0] for i in at})
    return out


def united(parts: DataFrame, least: int, bits: int) -> tuple[DataFrame, dict]:
    """Rows (lang, part, automaton): the united automaton of each prefix range,
    written to the shared checkpoint folder; and the ranges' bounds."""
    sc = parts.sparkSession.sparkContext
    word_marks = frequent_words(parts, least, bits)
    shipped = sc.broadcast(word_marks)
    pair_marks = frequent_pairs(parts, shipped, least, bits)
    marks = sc.broadcast((word_marks, pair_marks))
    bounds = _bounds(parts, marks)

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, path, weight = _shard_paths(row, *marks.value)
                edges = [0, *(_position(words, path, b) for b in bounds.get(row["lang"], ())), len(path)]
                for k, (low, high) in enumerate(zip(edges, edges[1:])):
                    if high > low:
                        yield _range_row((row["lang"], k), Automaton.build(words, path[low:high], weight[low:high]))

    def unite(batches):
        key, union = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["lang"], row["part"]) != key:
                    if key is not None:
                        yield _range_row(key, union.automaton())
                    key, union = (row["lang"], row["part"]), Union()
                union.add(Automaton.from_bytes(row["automaton"]))
        if key is not None:
            yield _range_row(key, union.automaton())

    kind = "lang string, part int, automaton binary"
    pieces = parts.mapInArrow(cut, kind).repartition("lang", "part").sortWithinPartitions("lang", "part")
    return cut_lineage(pieces.mapInArrow(unite, kind)), bounds


def _range_row(key, automaton: Automaton) -> pa.RecordBatch:
    schema = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("automaton", pa.binary())])
    return pa.RecordBatch.from_pylist([{"lang": key[0], "part": key[1], "automaton": automaton.to_bytes()}], schema)


def _position(words: list[bytes], path: np.ndarray, bound: tuple[bytes, ...]) -> int:
    """First row of sorted ``path`` that is not below ``bound``."""
    low, high = 0, len(path)
    for k, word in enumerate(bound):
        i = bisect_left(words, word)
        column = path[low:high, k]
        left = low + int(np.searchsorted(column, i))
        if i == len(words) or words[i] != word:
            return left
        low, high = left, low + int(np.searchsorted(column, i, side="right"))
    return low


def _frequent(automata: DataFrame, bounds: dict, least: int) -> DataFrame:
    """Rows (lang, words, f) of the phrases of one to four words that occur at least ``least`` times."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a = Automaton.from_bytes(row["automaton"])
                path, depth, weight = a.paths()
                keep = weight >= least
                mine = bounds.get(row["lang"], [])
                number = {w: i for i, w in enumerate(a.words)}
                for edge in mine[max(row["part"] - 1, 0):row["part"] + 1]:  # prefixes that may lie in two ranges
                    ids = [number.get(w, -2) for w in edge]
                    same = np.ones(len(path), bool)
                    for k, i in enumerate(ids):
                        same &= path[:, k] == i
                        keep |= same & (depth == k + 1)
                rows = [[w.decode() for w in _named(a.words, p)] for p in path[keep]]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(rows)), pa.array(rows, pa.list_(pa.string())),
                                                      pa.array(weight[keep])], ["lang", "words", "f"])

    return (automata.mapInArrow(run, "lang string, words array<string>, f long").groupBy("lang", "words")
            .agg(F.sum("f").alias("f")).where(F.col("f") >= least))


def part_counts(parts: DataFrame, automata: DataFrame, bounds: dict) -> DataFrame:
    """Rows (lang, words, f): distinct phrases of ``parts`` composed with the automata of the ranges they may lie in."""
    def span(lang: pd.Series, words: pd.Series) -> pd.Series:
        out = []
        for name, phrase in zip(lang, words):
            edges, p = bounds.get(name, []), tuple(w.encode() for w in phrase)
            low = bisect_right(edges, p)
            high = bisect_left(edges, (*p[:-1], p[-1] + b"\x00"))  # the first phrase past the prefix
            out.append(list(range(low, max(low, high) + 1)))
        return pd.Series(out)

    def compose(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"lang": pd.Series([], dtype=object), "words": pd.Series([], dtype=object), "f": pd.Series([], dtype="int64")})
        a = Automaton.from_bytes(right["automaton"].iloc[0])
        requests = [tuple(w.encode() for w in p) for p in left["words"]]
        return pd.DataFrame({"lang": left["lang"], "words": left["words"], "f": a.compose(requests)})

    asked = parts.withColumn("part", F.explode(F.pandas_udf(span, "array<int>")("lang", "words")))
    found = asked.groupBy("lang", "part").cogroup(automata.groupBy("lang", "part")).applyInPandas(
        compose, "lang string, words array<string>, f long")
    return found.groupBy("lang", "words").agg(F.sum("f").alias("f"))


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, cover: int = 80,
            scale: int = 2_000_000, bits: int = 25) -> DataFrame:
    """All collocations: lang, words, phrase, a, l, r, n, score (of the cut with the lowest score).

    Candidates whose words lie within a longer candidate that has at least
    ``cover`` percent of their count are dropped.  ``bits``: slots of a table of
    marks (2^25: 4 MB)."""
    parts = cut_lineage(shards(docs, text, lang))
    automata, bounds = united(parts, least, bits)
    known = cut_lineage(_frequent(automata, bounds, least))
    total = known_words(parts)
    size = F.size("words")
    candidates = known.where(size >= 2).select("lang", "words", F.col("f").alias("a"))

    # cuts: after each word but the last
    cuts = candidates.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "words", "a", "k", F.slice("words", 1, F.col("k")).alias("left"),
        F.slice("words", F.col("k") + 1, size - F.col("k")).alias("right"))
    asked = cuts.select("lang", F.col("left").alias("words")).union(cuts.select("lang", F.col("right").alias("words"))).distinct()
    counts = cut_lineage(part_counts(asked, automata, bounds))
    scored = (cuts.join(counts.select("lang", F.col("words").alias("left"), F.col("f").alias("l")), ["lang", "left"])
              .join(counts.select("lang", F.col("words").alias("right"), F.col("f").alias("r")), ["lang", "right"])
              .withColumn("score", F.expr(f"cast(a as decimal(19,0)) * cast({scale} as decimal(10,0)) div cast(l + r as decimal(19,0))")))
    best = scored.groupBy("lang", "words").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("m"))

    # the largest count of a longer candidate around each phrase
    inner = candidates.where(size >= 3).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("w")).select(
        "lang", "a", "words", "w", F.explode(F.sequence(F.lit(1), size - F.col("w") + 1)).alias("s")).select(
        "lang", F.slice("words", F.col("s"), F.col("w")).alias("words"), "a").groupBy("lang", "words").agg(F.max("a").alias("longer"))
    kept = best.join(inner, ["lang", "words"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * cover))
    return kept.join(total, "lang").select(
        "lang", "words", F.array_join("words", " ").alias("phrase"), "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), "n",
        F.col("m.score").cast("long").alias("score"))


def known_words(parts: DataFrame) -> DataFrame:
    """Rows (lang, n): all word occurrences."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([{"lang": row["lang"], "n": int((_unpack(row)[1] >= 0).sum())}])

    return parts.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def top(found: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` phrases of each language, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
