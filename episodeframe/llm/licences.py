"""Licence scan with a positional rare-token index (DataFrame operations only).

Licence templates are word sequences.  Words get an inverse document frequency
over the scanned files; each template is posted under its two highest-IDF
words with their positions.  A file's words that have postings are looked up,
postings are intersected by relative position, and the template's mandatory
key phrase is verified at every place that is left.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words of a licence text; ``key`` is the (first, length) stretch that must
    stand word for word, the others count towards the score."""

    label: str
    words: tuple[str, ...]
    key: tuple[int, int]
    base: bool = False


def template(label: str, text: str, key: str | None = None, base: bool = False) -> Template:
    words = tuple(text.split())
    part = tuple((key or text).split())
    at = next(i for i in range(len(words)) if words[i:i + len(part)] == part)
    return Template(label, words, (at, len(part)), base)


#: The base phrases, then templates of the method's own labels.
TEMPLATES = (
    template("gpl", "gnu general public license", base=True),
    template("apache", "apache license", base=True),
    template("cc-by", "cc by", base=True),
    template("mit", "mit license", base=True),
    template("gpl-3", "gnu general public license version 3"),
    template("gpl-2", "gnu general public license version 2"),
    template("lgpl", "gnu lesser general public license"),
    template("agpl", "gnu affero general public license"),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    template("cc-by-nc", "cc by nc"),
    template("cc-by-sa", "cc by sa"),
    template("cc-by-nd", "cc by nd"),
    template("cc-by-4.0", "cc by 4 0"),
    template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    template("all-rights-reserved", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    """Words of a text (null: none), A-Z lower-cased."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))


_CODES = 1 << 10  # a code is place * _CODES + number of the word


def template_words(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """``_id``, ``n_words`` and ``_v``: the words of the text that are template
    words, as codes of their place and number (from 1), ascending.  Texts are cut
    into words once; all that follows reads this stored table."""
    listed = F.array(*map(F.lit, vocabulary))
    rows = docs.select(F.col(id_col).alias("_id"), words_of(F.col(text_col)).alias("_w"))
    at = F.filter(F.transform("_w", lambda x, i: F.when(x.isin(*vocabulary), i)), lambda i: i.isNotNull())
    codes = F.transform(at, lambda i: i.cast("long") * _CODES + F.array_position(listed, F.get("_w", i)))
    return cut_lineage(rows.select("_id", F.size("_w").cast("long").alias("n_words"), codes.alias("_v")))


def idf(found: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """IDF of each vocabulary word over all files; at most one row per word of
    the templates reaches the driver."""
    numbers = F.array_distinct(F.transform("_v", lambda c: c % _CODES))
    n = found.count()
    df = dict(found.select(F.explode(numbers).alias("w")).groupBy("w").count().collect())
    return {w: math.log((n + 1) / (df.get(k, 0) + 0.5)) for k, w in enumerate(vocabulary, 1)}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[Template, ...] = TEMPLATES, least_share: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_base`` (places of base
    phrases), ``first_word``, ``last_word`` (their smallest and largest start),
    ``base_labels``, ``labels``, ``score`` (largest IDF-weighted share of a
    template's words standing in place), ``found`` (label, start, score).

    A template counts at a place if its key phrase stands there and the share
    is at least ``least_share``.  Null, empty and wordless texts have no words,
    no labels (empty strings) and score 0; repeated rows and ties are scanned
    alike; whole texts are scanned; other columns are not read.  No shuffle but
    the word counts.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    rows = template_words(docs, id_col, text_col, vocabulary)
    weight = idf(rows, vocabulary)
    number = {w: k for k, w in enumerate(vocabulary, 1)}
    postings = {t: sorted(range(*_span(t)), key=lambda i, t=t: (-weight[t.words[i]], i))[:2] for t in templates}

    def stands(word: str, i: int, start: Column) -> Column:
        return F.array_contains("_v", (start + i) * _CODES + number[word])

    def holds(word: str, i: int):
        return lambda start: stands(word, i, start)

    def starts(t: Template) -> Column:
        def posted(at: int) -> Column:  # starts that a posting of the word at ``at`` implies
            mine = F.filter("_v", lambda c: c % _CODES == number[t.words[at]])
            return F.transform(mine, lambda c: F.call_function("div", c, F.lit(_CODES).cast("long")) - at)

        out = posted(postings[t][0])
        for at in postings[t][1:]:
            out = F.array_intersect(out, posted(at))
        first, n = t.key
        for i in range(first, first + n):
            if i not in postings[t]:
                out = F.filter(out, holds(t.words[i], i))
        return F.filter(out, lambda s: s + first >= 0)

    def share(t: Template, s: Column) -> Column:
        total = sum(weight[x] for x in t.words)
        if t.key[1] == len(t.words) or not total:
            return F.lit(1.0)
        first, n = t.key
        fixed = sum(weight[x] for x in t.words[first:first + n])
        rest = F.lit(fixed)
        for i, x in enumerate(t.words):
            if not first <= i < first + n:
                rest = rest + F.when(stands(x, i, s), weight[x]).otherwise(0.0)
        return F.round(F.least(rest / total, F.lit(1.0)), 6)

    def places(t: Template) -> Column:
        return F.transform(starts(t), lambda s: F.struct(F.lit(t.label).alias("label"), s.cast("int").alias("start"),
                                                         share(t, s).alias("score"), F.lit(t.base).alias("base")))

    none = "array<struct<label:string,start:int,score:double,base:boolean>>"
    found = F.when(F.size("_v") > 0, F.filter(F.concat(*map(places, templates)), lambda f: f["score"] >= least_share)).otherwise(
        F.array().cast(none))
    rows = rows.select("_id", "n_words", found.alias("found"))
    base = F.filter("found", lambda f: f["base"])

    def joined(a: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda f: f["label"]))), ",")

    begin = F.transform(base, lambda f: f["start"])
    return rows.select(
        F.col("_id").alias(id_col), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(begin).cast("long").alias("first_word"), F.array_max(begin).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0)).alias("score"), "found")


def _span(t: Template) -> tuple[int, int]:
    return t.key[0], t.key[0] + t.key[1]
