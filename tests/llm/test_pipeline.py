import corpus_pipeline
from episodeframe.llm import queries
from tests.llm.helpers import documents


def test_stages_in_order_and_their_decisions_hold(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents")
    junk = documents(spark, [(10_001, None), (10_002, "123 456"), (10_003, docs.first().text)]).select(docs.columns)
    docs = docs.union(junk)
    seen = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.cut_lineage(stage(spark, seen, sf))
        if k < 4:
            assert out.columns == docs.columns
        if name == "language":
            assert {r.doc_id for r in seen.select("doc_id").subtract(out.select("doc_id")).collect()} == {10_001, 10_002}
        if name == "near_duplicates":
            ids = {r.doc_id for r in out.collect()}
            assert 10_003 not in ids and len(ids) == out.count()
        seen = out
    mixed = seen.groupBy("uid").sum("length", "doc_tokens").count()
    assert mixed > 0 and seen.where("length > 4096 or offset < 0").count() == 0


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() > 0 and len(corpus_pipeline.STAGES) == 5
