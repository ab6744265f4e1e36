import pytest

from checks.compare import differences, duck
from larder.llm import registry

GIVEN = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(registry.all_sql()))
def test_equal_to_sql(spark, key):
    assert differences(registry.all_queries()[key](spark, GIVEN), duck(GIVEN), registry.all_sql()[key]) == []


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{GIVEN}/documents.parquet").limit(60)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, GIVEN)
        assert found.columns == docs.columns, name
        rows = found.cache().count()
        assert 0 < rows <= before and (rows == before or name != "secret_scans")
        before, docs = rows, found
    assert corpus_pipeline.STAGES[-1][1](spark, docs, GIVEN).select("doc_id").distinct().count() == before


def test_stages_take_empty_tables(spark):
    import corpus_pipeline

    empty = spark.read.parquet(f"{GIVEN}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, GIVEN).count() == 0, name
