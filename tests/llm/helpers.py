"""Small fixtures shared by the tests of the training-data operators."""

from pyspark.sql import Row

#: A column of every table below that clashes with names the operators use.
EXTRA = ["score", "fp", "root", "size", "block", "_key", "id", "lang_pred", "predicted", "_d", "_s", "shard", "_draws",
         "key", "_found"]


def documents(spark, rows, extra=()):
    """documents(doc_id, text, lang, source, n_chars) from (id, text[, lang[, source]])."""
    full = []
    for r in rows:
        r = tuple(r) + (None,) * (4 - len(r))
        full.append((*r[:4], len(r[1]) if r[1] is not None else None, *(["x"] * len(extra))))
    kind = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {e} string" for e in extra)
    return spark.createDataFrame(full, kind)


def pairs(df, a, b):
    return {r[a]: r[b] for r in df.collect()}


__all__ = ["EXTRA", "Row", "documents", "pairs"]
