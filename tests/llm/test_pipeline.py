"""The pipeline's stages over the smallest tables."""

import corpus_pipeline
from pyspark.sql import functions as F

from rainfold.llm import decontamination, quality_rules
from rainfold.llm.common import Scratch, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, scratch, ids = docs.columns, Scratch(spark, "t"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = scratch.write(stage(spark, docs, SF))
        assert docs.columns == columns, name
        ids.append({r[0] for r in docs.select("doc_id").collect()})
        assert ids[-1] <= {r[0] for r in before.select("doc_id").collect()}
    want = quality_rules.judge(table(spark, SF, "documents"), table(spark, SF, "labels")).where("kept")
    assert ids[0] == {r[0] for r in want.select("doc_id").collect()}
    assert docs.join(decontamination.leaks(docs, table(spark, SF, "benchmark")), "doc_id").count() == 0
    assert docs.where(F.col("text").rlike("[0-9a-f]{16,}")).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == ids[-1]
    assert corpus_pipeline.run(spark, SF).agg(F.sum("length")).first()[0] == packed.agg(F.sum("length")).first()[0]


def test_empty_input(spark):
    docs = table(spark, SF, "documents").limit(0)
    scratch = Scratch(spark, "t")
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, SF))
        assert docs.count() == 0
