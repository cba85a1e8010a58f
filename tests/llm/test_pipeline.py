"""The pipeline's stages against the operators' own decisions, and on odd tables."""

from __future__ import annotations

from helpers import BENCH, ITEM, LABELS, documents

import corpus_pipeline
from cardlake.llm import decontaminate, quality, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    left = ids(docs)
    q = {r.doc_id for r in quality.scores(docs, quality.trained(docs, labels)).where("predicted = 1").collect()}
    t = {r.doc_id for r in toxicity.scores(docs, toxicity.trained(docs, labels)).where("predicted = 0").collect()}
    left &= q & t
    part = docs.where(docs.doc_id.isin(sorted(left)))
    left = {r.component_id for r in simhash.near_duplicates(part).collect()}
    part = docs.where(docs.doc_id.isin(sorted(left)))
    left = {r.doc_id for r in decontaminate.contamination(part, spark.read.parquet(f"{SF}/benchmark.parquet")).where("n_hit = 0").collect()}
    assert ids(corpus_pipeline.run(spark, SF)) == left
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_keep_the_columns_on_odd_tables(spark, tmp_path):
    sf = str(tmp_path)
    documents(spark).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (5, 0, 1), (7, 1, 0)], LABELS).write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, ITEM, "w", 1)], BENCH).write.parquet(f"{sf}/benchmark.parquet")
    for docs in (documents(spark), documents(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.schema == docs.schema or out.columns == docs.columns
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
    spark.createDataFrame([], LABELS).write.mode("overwrite").parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() >= 0
