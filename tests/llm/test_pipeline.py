from pyspark.sql import functions as F

import corpus_pipeline
from linernotes.llm.common import table
from linernotes.llm.decontaminate import contaminated
from linernotes.llm.simhash import simhash_groups

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == columns
            assert docs.select(columns).exceptAll(before).count() == 0 or name == "source_mixing"
    before, after = seen["simhash_near_dedup"]
    firsts = {r["component_id"] for r in simhash_groups(before).collect()}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(firsts)
    before, after = seen["benchmark_decontamination"]
    bad = {r["doc_id"] for r in contaminated(before, table(spark, SF, "benchmark")).collect()}
    assert bad and {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - bad
    before, after = seen["source_mixing"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}
    before, after = seen["sharding"]
    assert after.count() == before.count() and after.columns == [*columns, "shard", "slot"]


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "shard", "slot"} <= set(got.columns) and got.count() > 0


def test_empty_and_odd_documents(spark, odd_docs, no_docs):
    strange = odd_docs.withColumns({"a.b": F.lit(1), "slot": F.lit("own"), "`c d`": F.lit(2)})
    for docs in (odd_docs, no_docs, strange):
        names = docs.columns
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() <= 2 * n
        assert docs.columns == [*[c for c in names if c not in ("shard", "slot")], "shard", "slot"]
