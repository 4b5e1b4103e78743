"""Registered queries of the training-data operators: thin digests over their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodeframe.llm import (ann, collocations, covertree, hostrep, langid, licences, mixing, oracles, packing, simhash,
                               suffixes, toxicity, warc, whitening)
from episodeframe.llm.common import bounded_sample, cut_lineage, id_crc


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learnable(docs: DataFrame, mod: int, held: int) -> DataFrame:
    """Rows that may be learned from: crc32(doc_id) mod ``mod`` is not ``held``."""
    return docs.where(id_crc("doc_id", mod) != held)


def held_out(mod: int, held: int):
    return F.coalesce(id_crc("doc_id", mod) == held, F.lit(False)).alias("held_out")


def toxic_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicModel | None:
    """Fit on labelled documents.  The sample is drawn from ids alone and then
    broadcast to the texts (twice the fitted bound), so no text is shuffled."""
    # one label per document: repeated label rows must not weigh more
    known = learnable(labels, 4, 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic in (0, 1)")
    here = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    ids = cut_lineage(bounded_sample(here.select(F.col("doc_id").alias("id"), F.lit("").alias("text"), F.col("toxic").cast("int").alias("toxic")),
                                     "toxic", {0: 2 * toxicity.ORDINARY_DOCS, 1: 2 * toxicity.TOXIC_DOCS}))
    texts = docs.select("doc_id", "text").join(F.broadcast(ids.select(F.col("id").alias("doc_id"), "toxic")), "doc_id")
    return toxicity.fit(cut_lineage(texts))


def language_model(docs: DataFrame) -> langid.Lattice | None:
    return langid.fit(learnable(docs, 5, 0), _vocabulary("piece_bpe_32k.model"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxic_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", held_out(4, 2), "score", "predicted")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs.select("doc_id", "text"), language_model(docs)).select(
        "doc_id", held_out(5, 0), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, _ = packing.pack(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: Fixed values of the url contract.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of a page: bad if the labels call the document of its number
    toxic or of low quality."""
    bad = F.greatest("toxic", 1 - F.col("quality")).cast("int")
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return hostrep.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).drop("found")


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.link(table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.archive(table(spark, sf_dir, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def whitened_rows(vectors: DataFrame, model: whitening.Whitening | None) -> DataFrame:
    """One row per remaining vector and component."""
    if model is None:
        kind = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, {kind}")
    done = whitening.whiten(vectors.select("vec_id", "embedding"), model).select("vec_id", "whitening.*")
    parts = F.array(*[F.lit(e).cast("double") for e in model.explained]).cast("array<double>")
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("_pos", "whitened")).select(
        "vec_id", (F.col("_pos") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(parts, F.col("_pos")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitened_rows(vectors, whitening.fit(vectors))


def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top(collocations.phrases(table(spark, sf_dir, "documents"))).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {"op1_toxicity": op1_toxicity, "op2_language": op2_language, "op3_urls": op3_urls, "op4_simhash": op4_simhash,
           "op5_packing": op5_packing, "op6_neighbours": op6_neighbours, "op7_licences": op7_licences,
           "op8_mixing": op8_mixing, "op9_cover_tree": op9_cover_tree, "op10_warc": op10_warc,
           "op11_whitening": op11_whitening, "op12_suffixes": op12_suffixes,
           "op13_collocations": op13_collocations}
ORACLES = {"op3_urls": oracles.urls(URL_RULES), "op7_licences": oracles.licences(), "op9_cover_tree": oracles.COVER_TREE, "op10_warc": oracles.WARC,
           "op13_collocations": oracles.collocations()}
