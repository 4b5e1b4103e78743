"""Toxicity by compression distance under two zstandard dictionaries.

A text is cut into windows (white-space words, long ones into overlapping
slices).  Every window is compressed with a dictionary of ordinary text and
with the same dictionary extended by toxic text; the difference of the two
compressed lengths is the window's gain.  Thresholds on the gain are
calibrated per window length against ordinary documents, and a document's
score is a logistic function of its windows' calibrated gains.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.llm.common import bounded_sample, cut_lineage, fresh

WINDOW, STEP = 64, 48  # slices of words longer than WINDOW characters
ORDINARY_DOCS, TOXIC_DOCS = 4000, 1500  # most labelled documents that a model is fitted on
_GRAMS = (4, 5, 6, 7)
_FEW = 30  # texts of fewer windows count as having so many
_LONGEST = 3 * WINDOW  # bytes; window lengths above count as this
#: Stands at the end of both dictionaries and around each window, so that a
#: window is always stored as a compressed block and lengths differ by bytes.
_FRAME = b"|0123456789abcdefghijklmnop|"


def windows_of(text: str | None) -> list[str]:
    out = []
    for w in text.lower().split() if text else ():
        if len(w) <= WINDOW:
            out.append(w)
        else:
            out += [w[i:i + WINDOW] for i in range(0, len(w) - WINDOW + STEP, STEP)]
    return out


def _grams(word: str) -> set[str]:
    w = f" {word} "
    return {w[i:i + n] for n in _GRAMS for i in range(len(w) - n + 1)}


def _segments(word: str, marked: set[str]) -> list[str]:
    """Longest stretches of a framed word that marked grams cover."""
    w = f" {word} "
    cover = [False] * len(w)
    for n in _GRAMS:
        for i in range(len(w) - n + 1):
            if w[i:i + n] in marked:
                cover[i:i + n] = [True] * n
    out, i = [], 0
    while i < len(w):
        j = i
        while j < len(w) and cover[j]:
            j += 1
        if j > i:
            out.append(w[i:j])
        i = j + 1
    return out


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        level, source_size=128, dict_size=len(content), format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False, min_match=3)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


@dataclass
class ToxicModel:
    """Both dictionaries, the calibrated surprise of (window length, gain) and
    the logistic weights."""

    ordinary: bytes
    toxic: bytes
    level: int
    surprise: dict = field(default_factory=dict)  # window bytes -> surprise by gain
    weights: tuple = (-3.0, 0.0, 0.0, 0.0)

    def gain_fn(self):
        a, b = _compressor(self.ordinary + _FRAME, self.level), _compressor(self.ordinary + self.toxic + _FRAME, self.level)

        def gain(window: str) -> tuple[int, int]:
            raw = f" {window} ".encode("utf-8", "replace")
            q = _FRAME + raw + _FRAME
            return min(len(raw), _LONGEST), max(0, len(a.compress(q)) - len(b.compress(q)))
        return gain

    def surprise_of(self, length: int, gain: int) -> float:
        row = self.surprise.get(length)
        return row[min(gain, len(row) - 1)] if row and gain > 0 else 0.0


def _toxic_part(words: DataFrame, n: dict[int, int], room: int, min_share: float, contrast: float) -> bytes:
    """Dictionary content of toxic text: the stretches of its windows whose
    grams are frequent in toxic and next to absent in ordinary documents,
    the most frequent last (nearest to the data)."""
    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = Counter(), Counter()
            for w, t, o in zip(pdf["word"], pdf["df1"], pdf["df0"]):
                for g in _grams(w):
                    a[g] += t
                    b[g] += o
            yield pd.DataFrame([(g, a[g], b[g]) for g in a], columns=["gram", "a", "b"])

    # often enough, far above the ordinary share, and above chance in a small sample
    usual = n[1] * (F.col("b") + 0.5) / n[0]
    marked = {r[0] for r in words.mapInPandas(grams, "gram string, a long, b long").groupBy("gram")
              .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
              .where((F.col("a") >= max(3, min_share * n[1])) & (F.col("a") > min(contrast, n[0] / 20) * usual)
                     & (F.col("a") >= usual + 4 * F.sqrt(usual) + 2)).select("gram").collect()}
    if not marked:
        return b""

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(s, t) for w, t in zip(pdf["word"], pdf["df1"]) for s in _segments(w, marked)],
                               columns=["s", "t"])

    found = (words.where("df1 > 0").mapInPandas(stretches, "s string, t long").groupBy("s").agg(F.sum("t").alias("t"))
             .where("t >= 3").orderBy(F.desc("t"), "s").limit(room // 4).collect())
    kept: list[tuple[int, str]] = []
    for s, t in sorted(found, key=lambda r: (-len(r[0]), r[0])):
        if not any(s in k for _, k in kept):
            kept.append((t, s))
    text = "\x01".join(s for _, s in sorted(kept))
    return text.encode()[-room:]


def _ordinary_part(words: DataFrame, room: int, samples: int = 40_000) -> bytes:
    """Content of a zstandard dictionary trained on ordinary windows."""
    rows = words.where("df0 > 0").orderBy(F.desc("df0"), "word").limit(samples).select("word", "df0").collect()
    got = [f" {w} ".encode() for w, n in rows for _ in range(min(5, n))]
    random.Random(7).shuffle(got)
    try:
        trained = zstandard.train_dictionary(room, got).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"".join(dict.fromkeys(got))[-room:]
    start = next((i for i in range(8, len(trained) - 40) if all(32 <= c for c in trained[i:i + 40])), 8)
    return trained[start:]  # without header and entropy tables


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        ordinary_docs: int = ORDINARY_DOCS, toxic_docs: int = TOXIC_DOCS, room: int = 4096, level: int = 19,
        min_share: float = 0.02, contrast: float = 200.0) -> ToxicModel | None:
    """Train dictionaries, thresholds and weights; ``None`` unless both
    classes have a text.

    ``labelled`` must hold only rows that may be learned from (label 0 or 1,
    others are ignored).  The sample is bounded by ``ordinary_docs`` and
    ``toxic_docs`` whole documents; the driver gets dictionary material of at
    most ``room`` and ``samples`` rows and tables of sample size.
    """
    spark = labelled.sparkSession
    sample = cut_lineage(bounded_sample(labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                                        F.col(label_col).cast("int").alias("toxic"))
                                        .where("toxic in (0, 1) and text is not null"), "toxic",
                                        {0: ordinary_docs, 1: toxic_docs})
                         .repartition(4 * spark.sparkContext.defaultParallelism))
    n = {0: 0, 1: 0} | dict(sample.groupBy("toxic").count().collect())
    if not (n[0] and n[1]):
        return None

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = Counter(), Counter()
            for t, x in zip(pdf["toxic"], pdf["text"]):
                (a if t == 1 else b).update(set(windows_of(x)))
            yield pd.DataFrame([(w, a[w], b[w]) for w in a.keys() | b.keys()], columns=["word", "df1", "df0"])

    words = cut_lineage(sample.select("toxic", "text").mapInPandas(distinct, "word string, df1 long, df0 long")
                        .groupBy("word").agg(F.sum("df1").alias("df1"), F.sum("df0").alias("df0")))
    model = ToxicModel(_ordinary_part(words, room), _toxic_part(words, n, room, min_share, contrast), level)
    _calibrate(model, words, sample, n)
    return model


def _calibrate(model: ToxicModel, words: DataFrame, sample: DataFrame, n: dict[int, int]) -> None:
    """Set the surprise table from ordinary windows, then the weights."""
    def gains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gain = model.gain_fn()
        for pdf in batches:
            rows = [(*gain(w), c) for w, c in zip(pdf["word"], pdf["df0"])]
            yield pd.DataFrame(rows, columns=["length", "gain", "docs"])

    table = (words.where("df0 > 0").repartition(4 * words.sparkSession.sparkContext.defaultParallelism)
             .mapInPandas(gains, "length int, gain int, docs long")
             .groupBy("length", "gain").agg(F.sum("docs").alias("docs")).collect())
    # Share of ordinary documents with a window of about this length and at
    # least this gain; neighbouring lengths are pooled until they hold a
    # twentieth of all windows, so that a rare length is no surprise by itself.
    most = max((g for _, g, _ in table), default=0) + 2
    counts = np.zeros((_LONGEST + 1, most))
    for length, gain, docs in table:
        counts[length, gain] += docs
    held = counts.sum(1).cumsum()
    for length in range(_LONGEST + 1):
        low, high = max(0, length - 1), min(_LONGEST, length + 1)
        while held[high] - (held[low - 1] if low else 0) < held[-1] / 20 and (low or high < _LONGEST):
            low, high = max(0, low - 1), min(_LONGEST, high + 1)
        near = counts[low:high + 1].sum(0)
        above = near[::-1].cumsum()[::-1]
        share = (above + 0.3) / n[0]
        model.surprise[length] = [max(0.0, -math.log10(min(1.0, s))) for s in share]
    features = _features(model)
    got = sample.select("toxic", features(F.col("text")).alias("f")).select("toxic", "f.*").toPandas()
    x, y = got[["top", "rest", "size"]].to_numpy(), got["toxic"].to_numpy(float)
    # Newton steps of a ridge logistic regression, toxic rows at their own rate.
    z, w = np.column_stack([np.ones(len(x)), x]), np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(4)
        step = np.linalg.solve(h, z.T @ (y - p) - 0.05 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = tuple(map(float, w))


def _features(model: ToxicModel, cache_words: int = 150_000, chars: int = 1_500_000):
    """UDF text -> struct(top, rest, size): the largest surprise of a window, the
    summed surprise of the next four, and the log of the number of windows (a
    long text has more chances), which short texts share.

    A window is compressed once per worker, or, when the cache is full, once per
    ``chars`` characters."""
    @F.pandas_udf("top double, rest double, size double")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gain, known = model.gain_fn(), {}

        def score(texts: list) -> list[tuple]:
            bags = [windows_of(t) for t in texts]
            full = len(known) >= cache_words
            late = {w: model.surprise_of(*gain(w)) for w in set(chain.from_iterable(bags)).difference(known)}
            known.update(late)
            out = []
            for b in bags:
                top = np.sort(np.fromiter(map(known.__getitem__, b), np.float64, len(b)))[:-6:-1] if b else np.zeros(1)
                out.append((top[0], top[1:].sum(), math.log(max(len(b), _FEW))))
            if full:
                for w in late:
                    del known[w]
            return out

        for texts in batches:
            out, low, size = [], 0, 0
            for k, t in enumerate(texts):
                size += len(t or "")
                if size >= chars or k == len(texts) - 1:
                    out += score(texts.iloc[low:k + 1].tolist())
                    low, size = k + 1, 0
            yield pd.DataFrame(out, columns=["top", "rest", "size"])
    return features


def probability_of(model: ToxicModel | None, text: Column) -> Column:
    """Probability that a text is toxic (0 without a model)."""
    if model is None:
        return F.lit(0.0)
    f, (w0, w1, w2, w3) = _features(model)(text), model.weights
    return F.lit(1.0) / (1.0 + F.exp(-(w0 + w1 * f["top"] + w2 * f["rest"] + w3 * f["size"])))


def score(docs: DataFrame, model: ToxicModel | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold).

    Whole texts are scored.  Null and empty texts have no window and get the
    score of a text without any gain; repeated rows score alike; without a
    model (one class missing in the labels) all scores are 0.  Existing
    columns of these names are replaced, all others pass through.
    """
    s = fresh(docs, "_tox")
    return (docs.withColumn(s, probability_of(model, F.col(text_col)))
            .withColumn("score", F.col(s)).withColumn("predicted", (F.col(s) >= threshold).cast("int")).drop(s))
