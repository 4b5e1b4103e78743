"""Language identification by segmentation-marginalised unigrams.

A text is a bag of letter words.  For a language, a word's probability is the
sum over *all* its segmentations into pieces of a fixed public vocabulary of
the product of the piece probabilities (forward algorithm); piece
probabilities are learned per language by expectation-maximisation over the
same lattice.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.llm.common import bounded_sample, cut_lineage, fresh

UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = "▁"
_TINY = 1e-200


def vocabulary(path: str) -> list[str]:
    """All ordinary pieces of a SentencePiece model."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    return sorted({p for i in range(sp.get_piece_size())
                   if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and (p := sp.id_to_piece(i))})


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


class Lattice:
    """Piece probabilities of every language, with forward and backward sums.

    ``unknown`` is the probability of a character that is no piece by itself;
    it is the same for all languages, so such characters favour none.
    """

    def __init__(self, langs: list[str], pieces: list[str], probs: np.ndarray, unknown: float):
        self.langs, self.unknown = langs, unknown
        self.table = dict(zip(pieces, map(tuple, probs.tolist())))
        self.longest = max(map(len, pieces), default=1)

    def edges(self, s: str) -> list[list[tuple[int, str | None, tuple]]]:
        """For each end position: (start, piece, probabilities)."""
        get, unk = self.table.get, (self.unknown,) * len(self.langs)
        out: list[list] = [[]]
        for j in range(1, len(s) + 1):
            here = [(i, s[i:j], p) for i in range(max(0, j - self.longest), j) if (p := get(s[i:j])) is not None]
            if not here or here[-1][0] != j - 1:
                here.append((j - 1, None, unk))
            out.append(here)
        return out

    def log_likelihood(self, word: str) -> list[float]:
        """log P(word | language), all segmentations summed, per language."""
        s, n = _MARK + word, len(self.langs)
        alpha, shift = [[1.0] * n], 0.0
        for j, here in enumerate(self.edges(s)[1:], 1):
            acc = [0.0] * n
            for i, _, p in here:
                acc = [x + a * b for x, a, b in zip(acc, alpha[i], p)]
            alpha.append(acc)
            if max(acc) < _TINY:  # rescale what later positions can still reach
                for i in range(max(0, j - self.longest), j + 1):
                    alpha[i] = [a / _TINY for a in alpha[i]]
                shift += math.log(_TINY)
        return [math.log(a) + shift if a > 0 else shift - 1e3 for a in alpha[-1]]

    def expected(self, word: str, lang: int, times: float, counts: dict) -> None:
        """Add the expected piece counts of a word (posterior over segmentations).

        The forward sum of each position is scaled to 1 by a factor of its own,
        so words of any length neither underflow nor need logarithms: an edge
        weighs its probability over the factors of the positions it spans."""
        edges = self.edges(_MARK + word)
        n, spans, weights = len(edges) - 1, [1.0], []  # spans[d]: product of the last d factors
        for here in edges[1:]:
            end = len(weights)
            w = [p[lang] / spans[end - i] for i, _, p in here]
            factor = sum(w)
            if not factor:
                return
            weights.append([x / factor for x in w])
            spans = [1.0] + [x * factor for x in spans[:self.longest - 1]]
        behind = [0.0] * n + [1.0]
        for j in range(n, 0, -1):
            for (i, piece, _), w in zip(edges[j], weights[j - 1]):
                c = w * behind[j]
                behind[i] += c
                if piece is not None and c > 1e-9:
                    counts[lang, piece] += times * c


def training_words(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int) -> DataFrame:
    """(lang, word, times) of at most ``docs_per_lang`` whole documents a
    language, chosen by a hash of the id; the bound of the fitted sample."""
    sample = bounded_sample(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
                            .where("lang is not null and text is not null"), "lang", docs_per_lang)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts: dict = defaultdict(int)
            for lang, text in zip(pdf["lang"], pdf["text"]):
                for w in words_of(text):
                    counts[lang, w] += 1
            yield pd.DataFrame([(a, w, n) for (a, w), n in counts.items()], columns=["lang", "word", "times"])

    return (sample.select("lang", "text").repartition(2 * docs.sparkSession.sparkContext.defaultParallelism).mapInPandas(count, "lang string, word string, times long")
            .groupBy("lang", "word").agg(F.sum("times").alias("times")))


def fit(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        docs_per_lang: int = 300, rounds: int = 2, smoothing: float = 0.02) -> Lattice | None:
    """Learn piece probabilities by EM; ``None`` without a labelled text.

    ``docs`` must hold only rows that may be learned from.  The sample is
    bounded by ``docs_per_lang`` documents a language; what reaches the driver
    is bounded by vocabulary x languages.
    """
    spark = docs.sparkSession
    words = cut_lineage(training_words(docs, id_col, text_col, lang_col, docs_per_lang))
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    if not langs:
        return None
    pieces = vocabulary(vocab_path)
    at, place = {a: k for k, a in enumerate(langs)}, {p: k for k, p in enumerate(pieces)}
    lattice = Lattice(langs, pieces, np.full((len(pieces), len(langs)), 1 / len(pieces)), 1e-9)
    for _ in range(rounds):
        def expect(batches: Iterator[pd.DataFrame], lattice=lattice) -> Iterator[pd.DataFrame]:
            counts: dict = defaultdict(float)
            for pdf in batches:
                for lang, word, times in zip(pdf["lang"], pdf["word"], pdf["times"]):
                    lattice.expected(word, at[lang], times, counts)
            yield pd.DataFrame([(k, p, c) for (k, p), c in counts.items()], columns=["k", "piece", "c"])

        got = (words.repartition(2 * spark.sparkContext.defaultParallelism).mapInPandas(expect, "k int, piece string, c double")
               .groupBy("k", "piece").agg(F.sum("c").alias("c")).toPandas())
        c = np.zeros((len(pieces), len(langs)))
        c[got["piece"].map(place).to_numpy(int), got["k"].to_numpy(int)] = got["c"]
        c += smoothing
        lattice = Lattice(langs, pieces, c / c.sum(0), 1e-9)
    return lattice


class Scorer:
    """Text scores with a bounded cache of word scores (per Python worker).

    Unknown words of many texts are scored together, all words of one length
    at once: pieces are found by a rolling 64-bit hash of every stretch of up
    to ``longest`` characters, and the forward sums run over arrays.
    """

    BASE, SPREAD, BITS = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(44)

    def __init__(self, lattice: Lattice, cache_words: int = 120_000, long_word: int = 48):
        self.lattice, self.room, self.long_word = lattice, cache_words, long_word
        self.at: dict[str, int] = {}
        n = len(lattice.langs)
        self.rows = np.zeros((0, n))
        pieces = list(lattice.table)
        codes = [self._hash(np.array([list(map(ord, p))], np.uint64))[-1][0, 0] for p in pieces]
        order = np.argsort(np.array(codes, np.uint64))
        self.keys = np.array(codes, np.uint64)[order]
        self.probs = np.vstack([np.array([lattice.table[p] for p in pieces]).reshape(-1, n)[order], np.zeros(n),
                                np.full(n, lattice.unknown)])
        self.maybe = np.zeros(1 << 20, bool)  # slots that hold a piece
        self.maybe[(self.keys * self.SPREAD) >> self.BITS] = True

    def _hash(self, codes: np.ndarray) -> list[np.ndarray]:
        """Hashes of all stretches of 1, 2, .. characters, by start."""
        out, h = [], np.zeros_like(codes)
        for size in range(1, min(codes.shape[1], self.lattice.longest) + 1):
            h = h[:, :codes.shape[1] - size + 1] * self.BASE + codes[:, size - 1:]
            out.append(h)
        return out

    def _pieces(self, h: np.ndarray, size: int) -> np.ndarray:
        """Rows of ``probs`` for hashes; no piece: zeros, but an unknown character
        has its own row."""
        found = np.full(h.shape, len(self.keys) + (size == 1))
        some = np.flatnonzero(self.maybe[(h.ravel() * self.SPREAD) >> self.BITS])
        k = h.ravel()[some]
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        hit = self.keys[at] == k
        found.ravel()[some[hit]] = at[hit]
        return found

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """log P(word | language), words x languages."""
        out = np.zeros((len(words), self.probs.shape[1]))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lengths):
            mine = np.flatnonzero(lengths == n)
            if n > self.long_word:
                out[mine] = [self.lattice.log_likelihood(words[i]) for i in mine]
                continue
            text = "".join([_MARK + words[i] for i in mine])
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(mine), n + 1).astype(np.uint64)
            rows = [self._pieces(h, size) for size, h in enumerate(self._hash(codes), 1)]
            alpha = [np.ones((len(mine), out.shape[1]))]
            for j in range(1, n + 2):
                alpha.append(sum(alpha[j - s] * self.probs[rows[s - 1][:, j - s]] for s in range(1, min(j, len(rows)) + 1)))
            last = alpha[-1]
            with np.errstate(divide="ignore"):
                out[mine] = np.log(last)
            for i in mine[(last < _TINY).any(1)]:  # so unlikely that the sums need rescaling
                out[i] = self.lattice.log_likelihood(words[i])
        return out

    def batch(self, texts: list[str | None]) -> list[tuple[str, float]]:
        bags = [words_of(t) for t in texts]
        new = [w for w in dict.fromkeys(w for b in bags for w in b) if w not in self.at]
        known, rows, late = len(self.at), self.rows, {}
        if new:
            rows = np.concatenate([rows, self.likelihoods(new)])
            late = {w: known + k for k, w in enumerate(new)}
            if known < self.room:
                self.at, self.rows = self.at | late, rows
        out = []
        for b in bags:
            if not b:
                out.append((UNDETERMINED, 0.0))
                continue
            at = list(map(self.at.get, b))
            if None in at:
                at = [late[w] if k is None else k for w, k in zip(b, at)]
            t = rows[at].sum(0)
            p = np.exp(t - t.max())
            p /= p.sum()
            k = int(p.argmax())
            out.append((self.lattice.langs[k], float(p[k])))
        return out

    def __call__(self, texts: list[str | None], chars: int = 1_500_000) -> list[tuple[str, float]]:
        """(language, posterior) of each text; about ``chars`` at once."""
        out, low, size = [], 0, 0
        for k, t in enumerate(texts):
            size += len(t or "")
            if size >= chars or k == len(texts) - 1:
                out += self.batch(texts[low:k + 1])
                low, size = k + 1, 0
        return out


def language_of(lattice: Lattice | None, text: Column) -> Column:
    """struct(lang_pred, score) of a text column."""
    if lattice is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    @F.pandas_udf("lang_pred string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(lattice)
        for texts in batches:
            yield pd.DataFrame(scorer(list(texts)), columns=["lang_pred", "score"])

    return score(text)


def identify(docs: DataFrame, lattice: Lattice | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (posterior over the learned
    languages, equal priors).

    Null, empty and letterless texts give ``und`` with score 0, as does every
    text when nothing could be learned.  Texts are scored whole; repeated rows
    score alike; an existing column of either name is replaced; all other
    columns pass through.
    """
    s = fresh(docs, "_lang")
    return (docs.withColumn(s, language_of(lattice, F.col(text_col)))
            .withColumns({"lang_pred": F.col(s)["lang_pred"], "score": F.col(s)["score"]}).drop(s))
