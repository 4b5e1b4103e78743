"""Corpus pipeline: language ID, toxicity, near-duplicates, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row that the
stage before it kept; ``run`` writes a stage's rows to the shared checkpoint
folder and rereads them as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodeframe.llm import langid, mixing, packing, queries, simhash, toxicity
from episodeframe.llm.common import cut_lineage, fresh

#: A document stays if its language is certain at least to this degree.
LEAST_LANGUAGE_SCORE = 0.5
MOST_TOXICITY = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a determined language; ``und`` and doubtful ones go."""
    found = langid.language_of(queries.language_model(docs), F.col("text"))
    c = fresh(docs, "_found")
    return docs.withColumn(c, found).where((F.col(c)["lang_pred"] != langid.UNDETERMINED)
                                           & (F.col(c)["score"] >= LEAST_LANGUAGE_SCORE)).drop(c)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = queries.toxic_model(docs, queries.table(spark, sf_dir, "labels"))
    return docs.where(toxicity.probability_of(model, F.col("text")) < MOST_TOXICITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them, shuffled."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences (the columns of op5)."""
    pieces, _ = packing.pack(docs, queries._vocabulary("word_bpe_49k.json"))
    return pieces.select(F.col("id").alias("doc_id"), "uid", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         "offset")


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("mixing", mix),
          ("packing", pack)]

#: The stages fit models and hash with functions that DuckDB lacks; tests hold
#: the result against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
