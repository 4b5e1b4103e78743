"""Packing documents into fixed-length sequences by cutting-stock column generation.

Documents are cut at multiples of the sequence length; the remainders are the
items.  A linear program over patterns (how many items of each length class a
sequence holds) is solved by column generation: knapsack dynamic programming
prices new patterns from the class prices.  Rounded patterns get documents by
rank within their class; what rounding leaves is laid end to end and cut.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage

END_ID = 2


def fast_words(path: str):
    """Encoder of plain lower-case words by the merges of a word-level BPE file:
    a function from words to (flat ids, end of each word's ids).

    A merge of two symbols is known by the bytes it makes, and its rank is its
    place in the file; a word's end is a byte 0 after it, which joins the last
    byte before any other merge.  So byte-pair merging by ranks gives the file's
    own ids (the tests compare them with the tokenizer's)."""
    import json

    import tiktoken
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    end = model["end_of_word_suffix"]

    def raw(token: str) -> bytes:
        body = token.removesuffix(end)
        return bytes(byte_of[c] for c in body) + (b"\x00" if body != token else b"")

    ranks = {bytes([b, 0]): b for b in range(1, 256)} | {bytes([b]): 1 << 20 | b for b in range(256)}
    for k, pair in enumerate(model["merges"], 256):
        ranks.setdefault(b"".join(map(raw, pair.split(" ") if isinstance(pair, str) else pair)), k)
    ids, last = np.zeros((1 << 20) + 256, "<u4"), np.zeros((1 << 20) + 256, bool)
    for token, i in model["vocab"].items():
        if all(c in byte_of for c in token.removesuffix(end)):
            k = ranks.get(raw(token))
            if k is not None:
                ids[k], last[k] = i, token.endswith(end)
    core = tiktoken.Encoding("words", pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = np.array(core.encode_ordinary("\x00 ".join(words) + "\x00"), np.int64)
        return ids[found], np.flatnonzero(last[found]) + 1

    return encode


class WordTokenizer:
    """Whole-text ids of a word-level BPE through a bounded word cache.

    The tokenizer drops white space and never merges across it, so ids of a
    text are the ids of its blank-separated chunks in turn.  Unknown plain
    words of many texts are encoded in one call.
    """

    def __init__(self, path: str, room: int = 400_000):
        from tokenizers import Tokenizer
        self.raw = Tokenizer.from_file(path)
        self.plain = fast_words(path)
        self.known: dict[str, bytes] = {"": b""}
        self.room = room
        self.tails = {t: self._bytes(self.raw.encode(t, add_special_tokens=False).ids) for t in ".,"}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def _together(self, chunks: list[str], into: dict[str, bytes]) -> None:
        """Encode Latin-1 chunks without special tokens in joint calls; an id
        belongs to the chunk in which its characters start."""
        for at in range(0, len(chunks), 8192):
            part = chunks[at:at + 8192]
            enc = self.raw.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(enc.ids, "<u4")
            starts = np.fromiter((s for s, _ in enc.offsets), np.int64, len(ids))
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            cuts = [0, *np.searchsorted(starts, ends, "left").tolist()]
            for c, s, e in zip(part, cuts, cuts[1:]):
                into[c] = ids[s:e].tobytes()

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of unknown chunks.  A word in any case, alone or before a full
        stop or comma, is encoded once."""
        into: dict[str, bytes] = {}
        words, joint = [], []  # (chunk, word, bytes of the mark behind it)
        tails = self.tails
        for chunk in missing:
            tail = tails.get(chunk[-1], b"")
            stem = chunk[:-1] if tail else chunk
            if stem.isalpha() and (stem.isascii() or max(stem) < "Ā"):
                words.append((chunk, stem.lower(), tail))
            elif max(chunk) < "Ā" and "<|" not in chunk:
                joint.append(chunk)
            else:
                into[chunk] = self._bytes(self.raw.encode(chunk, add_special_tokens=False).ids)
        self._together(joint, into)
        known, new = self.known, list({w for _, w, _ in words}.difference(self.known))
        for at in range(0, len(new), 65_536):
            part = new[at:at + 65_536]
            ids, ends = self.plain(part)
            flat, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            into.update(zip(part, [flat[s:e] for s, e in zip(cuts, cuts[1:])], strict=True))
        for chunk, w, tail in words:
            into[chunk] = (into[w] if w in into else known[w]) + tail
        return into

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        chunks = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        known, before = self.known, len(self.known)
        late = self._learn(set(chain.from_iterable(chunks)).difference(known))
        known.update(late)
        out = [b"".join(map(known.__getitem__, t)) for t in chunks]
        if before >= self.room:
            for c in late:
                known.pop(c, None)
        return out


def tokenize(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096,
             end_id: int = END_ID, chars_at_once: int = 2_000_000) -> DataFrame:
    """One stored row per row of ``docs``: ``uid`` (unique), ``id``,
    ``doc_tokens`` (with the closing id), ``full`` (CRC-32 of each full piece),
    ``rest`` and ``rest_crc`` (the remainder, 0 if none) and ``rest_ids``
    (its ids, little-endian 32-bit)."""
    kind = "id {}, doc_tokens long, full array<long>, rest int, rest_crc long, rest_ids binary".format(
        docs.schema[id_col].dataType.simpleString())
    step = 4 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = WordTokenizer(vocab_path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                low, size = at, 0
                while at < len(texts) and (at == low or size < chars_at_once):
                    size += len(texts[at] or "")
                    at += 1
                cols: tuple[list, ...] = ([], [], [], [], [])
                for ids in coder.encode(texts[low:at]):
                    ids += end
                    whole = len(ids) // step
                    rest = ids[whole * step:]
                    for c, v in zip(cols, (len(ids) // 4, [zlib.crc32(ids[k * step:(k + 1) * step]) for k in range(whole)],
                                           len(rest) // 4, zlib.crc32(rest), rest)):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, at - low), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.int64())),
                     pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary())],
                    names=["id", "doc_tokens", "full", "rest", "rest_crc", "rest_ids"])

    return cut_lineage(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
                       .mapInArrow(run, kind).withColumn("uid", F.monotonically_increasing_id()))


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Linear cutting stock by column generation: patterns and how often each.

    Revised simplex on the basis inverse; an entering pattern is the best of an
    unbounded knapsack over ``capacity`` units under the current prices.
    """
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)  # one column per pattern
    inverse, x = np.diag(1 / np.diag(basis)), demand / np.diag(basis)
    for step in range(40 * m + 200):  # ends by optimality; the bound only guards against cycling
        price = np.ones(m) @ inverse
        best, item = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for w in range(1, capacity + 1):
            fits = sizes <= w
            if fits.any():
                v = np.where(fits, best[np.maximum(w - sizes, 0)] + price, -1.0)
                k = int(v.argmax())
                if v[k] > best[w - 1] + 1e-12:
                    best[w], item[w] = v[k], k
                    continue
            best[w] = best[w - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, w = np.zeros(m), capacity
        while w > 0:
            if item[w] < 0:
                w -= 1
                continue
            column[item[w]] += 1
            w -= sizes[item[w]]
        u = inverse @ column
        ratio = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1), np.inf)
        r = int(ratio.argmin())
        theta = ratio[r]
        x = x - theta * u
        x[r] = theta
        basis[:, r] = column
        if step % 100 == 99:
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ demand, 0)
        else:
            inverse[r] /= u[r]
            for_rows = u.copy()
            for_rows[r] = 0
            inverse -= np.outer(for_rows, inverse[r])
            x = np.maximum(x, 0)
    return [(basis[:, j].astype(int), float(x[j])) for j in range(m) if x[j] > 1e-9]


def plan_patterns(histogram: dict[int, int], capacity: int, least_fill: float = 0.97) -> list[tuple[np.ndarray, int]]:
    """Whole patterns over length classes 1..capacity (units) that never use
    more items than ``histogram`` has.  Patterns are rounded down, then used
    once more where items remain; the rest is filled first-fit by decreasing
    length, of which sequences under ``least_fill`` are given up."""
    have = {s: n for s, n in sorted(histogram.items()) if n > 0}
    if not have:
        return []
    sizes, demand = np.array(list(have)), np.array(list(have.values()))
    solved = sorted(solve(sizes, demand.astype(float), capacity), key=lambda p: -p[1])
    left, out = demand.copy(), []
    for pattern, times in solved:
        n = int(times)
        n = min(n, int((left[pattern > 0] // pattern[pattern > 0]).min())) if n else 0
        left = left - n * pattern
        out.append((pattern, n))
    bins: list[list] = []  # [room, pattern]
    for pattern, _ in solved:
        if sizes @ pattern >= least_fill * capacity and (left >= pattern).all():
            left = left - pattern
            out.append((pattern, 1))
    for k in range(len(sizes) - 1, -1, -1):
        for _ in range(int(left[k])):
            spot = next((b for b in bins if b[0] >= sizes[k]), None)
            if spot is None:
                bins.append(spot := [capacity, np.zeros(len(sizes), int)])
            spot[0] -= sizes[k]
            spot[1][k] += 1
    out += [(p, 1) for room, p in bins if capacity - room >= least_fill * capacity]
    merged: Counter = Counter()
    for p, n in out:
        if sizes @ p >= least_fill * capacity:
            merged[tuple(p)] += n
    full = []
    for p, n in sorted(merged.items()):
        if n:
            v = np.zeros(capacity + 1, int)
            v[sizes] = p
            full.append((v, n))
    return full


def _slots(patterns: list[tuple[np.ndarray, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per class: first ranks, items per sequence, first sequences and first
    slots of the runs of ranks that its patterns take."""
    out: dict[int, list] = {}
    rank, base = Counter(), 0
    for p, n in patterns:
        slot = 0
        for c in np.flatnonzero(p)[::-1]:
            out.setdefault(int(c), []).append((rank[c], p[c], base, slot, rank[c] + n * p[c]))
            rank[c] += n * p[c]
            slot += p[c]
        base += n
    return {c: tuple(np.array(x, np.int64) for x in zip(*runs)) for c, runs in out.items()}


def _running(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows of the group before this one, by uid, in
    two levels: within the part of the table, then over the parts."""
    df = df.withColumn("_part", F.shiftrightunsigned("uid", 33))
    parts = (df.groupBy(*groups, "_part").agg(F.sum(value).alias("_n"))
             .withColumn("_before", F.sum("_n").over(Window.partitionBy(*groups).orderBy("_part")) - F.col("_n")).drop("_n"))
    inside = Window.partitionBy(*groups, "_part").orderBy("uid")
    return (df.withColumn("_in", F.sum(value).over(inside) - F.col(value)).join(parts, [*groups, "_part"])
            .withColumn(name, F.col("_in") + F.col("_before")).drop("_in", "_before", "_part"))


def pack(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096,
         grid: int = 16, end_id: int = END_ID) -> tuple[DataFrame, DataFrame]:
    """(pieces, tokens) of all rows of ``docs``.

    pieces: ``uid``, ``id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``; pieces of a sequence are
    gapless from 0 and hold at most ``length`` ids.  tokens: see ``tokenize``.

    Null and empty texts are the closing id alone; each repeated row is a
    document of its own (``uid``); an empty table gives no pieces.  Remainders
    count in classes of ``grid`` ids, so the histogram and the program have at
    most ``length / grid`` classes, the only thing the driver holds.  Rows that
    the rounded patterns leave (a few per class, and items that no pattern fills
    well) are laid end to end and cut; the very last stretch becomes sequences
    of powers of two, which need no padding.
    """
    capacity = length // grid
    tokens = tokenize(docs, vocab_path, id_col, text_col, length, end_id)
    rows = tokens.drop("rest_ids").withColumn("class", F.ceil(F.col("rest") / grid).cast("int"))
    histogram = {r[0]: r[1] for r in rows.where("rest > 0").groupBy("class").count().collect()}
    patterns = plan_patterns(histogram, capacity)
    count = sum(n for _, n in patterns)
    slots = _slots(patterns)

    @F.pandas_udf("seq long, slot long")
    def place(cls: pd.Series, rank: pd.Series) -> pd.DataFrame:
        c, r = cls.to_numpy(), rank.to_numpy()
        seq, slot = np.full(len(c), -1, np.int64), np.zeros(len(c), np.int64)
        for k in np.unique(c):
            if k in slots:
                first, per, base, at, end = slots[k]
                here = np.flatnonzero(c == k)
                i = np.searchsorted(first, r[here], "right") - 1
                ok = r[here] < end[i]
                here, i = here[ok], i[ok]
                seq[here] = base[i] + (r[here] - first[i]) // per[i]
                slot[here] = at[i] + (r[here] - first[i]) % per[i]
        return pd.DataFrame({"seq": seq, "slot": slot})

    ranked = _running(rows.where("rest > 0").withColumn("one", F.lit(1).cast("long")), ["class"], "one", "rank")
    placed = cut_lineage(ranked.withColumn("p", place("class", "rank"))
                         .select("uid", "id", "doc_tokens", "rest", "rest_crc", "p.seq", "p.slot"))
    start = (F.col("doc_tokens") - F.col("rest")).alias("start")
    fitted = placed.where("seq >= 0").select(
        "uid", "id", start, F.col("rest").cast("long").alias("length"), F.col("rest_crc").alias("ids_crc32"), "doc_tokens",
        F.col("seq").alias("sequence_id"),
        (F.sum("rest").over(Window.partitionBy("seq").orderBy("slot")) - F.col("rest")).cast("long").alias("offset"))
    over = placed.where("seq < 0")
    n_over, total = over.agg(F.count(F.lit(1)), F.coalesce(F.sum("rest"), F.lit(0))).first()
    pieces = fitted.union(_end_to_end(over, tokens, length, count, n_over, total))
    # full pieces are sequences of their own, numbered after the others
    whole = _running(rows.where(F.size("full") > 0).withColumn("k", F.size("full").cast("long"))
                     .withColumn("all", F.lit(1)), ["all"], "k", "before")
    base = count + total // length + length.bit_length()
    whole = whole.select("uid", "id", "doc_tokens", "before", F.posexplode("full").alias("at", "crc")).select(
        "uid", "id", (F.col("at") * F.lit(length).cast("long")).alias("start"), F.lit(length).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"), "doc_tokens", (F.lit(base) + F.col("before") + F.col("at")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return pieces.union(whole), tokens


def _end_to_end(rest: DataFrame, tokens: DataFrame, length: int, first: int, n_rows: int, total: int,
                broadcast_rows: int = 100_000) -> DataFrame:
    """Cut ``n_rows`` leftover remainders (``total`` ids), laid end to end by
    uid, into sequences from number ``first`` on.  Places come from a two-level
    running sum; up to ``broadcast_rows`` of them are broadcast to the stored
    ids, more are joined."""
    line = _running(rest.withColumn("all", F.lit(1)), ["all"], "rest", "at").select("uid", "at")
    if n_rows <= broadcast_rows:
        line = F.broadcast(line)
    whole = total // length
    ends, at = [], whole * length
    for bit in range(length.bit_length(), -1, -1):
        if (total - whole * length) >> bit & 1:
            at += 1 << bit
            ends.append(at)

    def sequence_at(at: int) -> tuple[int, int, int]:
        """Number, start and end of the sequence that holds place ``at``."""
        if at < whole * length:
            k = at // length
            return k, k * length, (k + 1) * length
        k = next(i for i, e in enumerate(ends) if at < e)
        return whole + k, ends[k - 1] if k else whole * length, ends[k]

    kind = ("uid long, id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
            .format(tokens.schema["id"].dataType.simpleString()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for uid, name, n, rest_n, at, ids in zip(*(batch.column(i).to_pylist() for i in range(6))):
                here = at
                while here < at + rest_n:
                    k, low, high = sequence_at(here)
                    stop = min(high, at + rest_n)
                    out.append((uid, name, n - rest_n + here - at, stop - here, zlib.crc32(ids[4 * (here - at):4 * (stop - at)]),
                                n, first + k, here - low))
                    here = stop
            cols = list(zip(*out)) or [()] * 8
            kinds = [pa.int64(), batch.schema.field(1).type] + [pa.int64()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["uid", "id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return (tokens.join(line, "uid").select("uid", "id", "doc_tokens", F.col("rest").cast("long"), "at", "rest_ids")
            .mapInArrow(cut, kind))


def sequences(pieces: DataFrame, docs_ids: DataFrame, length: int = 4096, pad_id: int = 0) -> DataFrame:
    """Training rows: ``sequence_id``, ``ids`` (array, padded to ``length``
    except at a power of two) from pieces and (``uid``, ``ids``) of documents."""
    part = pieces.join(docs_ids, "uid").select("sequence_id", "offset", F.expr("slice(ids, int(start) + 1, int(length))").alias("ids"))
    whole = part.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
        "sequence_id", F.flatten(F.transform("p", lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    pad = F.when(F.bit_count(n) == 1, F.lit(0)).otherwise(F.lit(length) - n)
    return whole.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), pad)).alias("ids"))
