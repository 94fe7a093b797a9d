import corpus_pipeline

from quarry.llm import op2_near, op3_mix, op6_shards, op8_decon, op10_lang
from quarry.session import stage

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    """Each stage against its operator's own decisions on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "near-dedup", "benchmark decontamination", "mixing", "sharding"]
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = stage(step(spark, docs, SF), "test")
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        if name == "near-dedup":
            assert ids == {r.doc_id for r in op2_near.components(docs, 80, 100).where("kept").collect()}
        if name == "benchmark decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            hit = {r.doc_id for r in op8_decon.search(docs, bench).collect()}
            assert hit and ids == {r.doc_id for r in docs.select("doc_id").collect()} - hit
        if name == "mixing":
            assert ids == {r.doc_id for r in op3_mix.sample(docs).where("kept").collect()}
        assert kept.columns == columns and 0 < kept.count() <= before
        docs, before = kept, kept.count()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == before and out.columns == op6_shards.assign(docs).columns


def test_a_document_of_no_language_goes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(-1, "123 456 !!", "en", "s", 10)], docs.schema)
    kept = corpus_pipeline.STAGES[0][1](spark, docs.union(extra), SF)
    assert kept.where("doc_id = -1").count() == 0 and kept.count() >= 0.99 * docs.count()
    assert op10_lang.SLOTS * 8 <= 64 << 20
