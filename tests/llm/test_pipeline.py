from __future__ import annotations

import corpus_pipeline


def test_stages(spark, small_dir, stored):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, small_dir), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small_dir)
    assert packed.select("doc_id").distinct().count() == before


def test_stages_of_odd_documents(spark, odd_docs, no_docs, stored, tmp_path):
    spark.createDataFrame([(1, 0), (3, 0)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "document three")], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    for start in (stored(odd_docs, "odd"), stored(no_docs, "none")):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), name)
            if name != "packing":
                assert docs.columns == start.columns
        assert docs.count() == 0 or docs.filter("doc_id = 3").count() == 0
