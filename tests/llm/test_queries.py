"""The registered text queries and the pipeline, against SQL where there is some."""

import pytest

import corpus_pipeline
from delaykit.llm.common import table
from delaykit.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_per_row(spark, name):
    found = QUERIES[name](spark, SMALL)
    whole = table(spark, SMALL, "conversations" if name.startswith("op5_") else "documents")
    assert found.count() >= whole.count() if name.startswith("op9_") else found.count() == whole.count()


def test_native_operator_runs_no_python(spark):
    plan = QUERIES["op1_quality_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages(spark):
    docs = table(spark, SMALL, "documents")
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == first and 0 < kept.count() <= docs.count(), name
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SMALL).count() == packed.count()
    labels = table(spark, SMALL, "labels").filter("quality = 0")
    assert docs.join(labels, "doc_id").count() <= labels.count() // 5
