"""Physical plans: what is read, pushed down, shuffled and compiled."""

import re

import pytest

from checks.catalog import all_queries as queries
from checks import workspace as ws
from larder.operators import raw_queries as rq
from larder.operators.nested import pivot
from larder.plans.labelling import DOCUMENT_PATH, SPARK_PATH, label_foods

GIVEN = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fields_read(df):
    return re.search(r"ReadSchema: (\S+)", plan(df)).group(1)


@pytest.fixture(scope="module")
def raw(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield ws.raw_table(spark, GIVEN)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_counting_reads_the_category_of_one_partition(raw):
    df = rq.count_foods_by_category(rq.of_source(raw, "legacy"))
    assert fields_read(df) == "struct<foodCategory:string>"
    assert "(sourceCollection" in re.search(r"PartitionFilters: (.*?), PushedFilters", plan(df)).group(1)


def test_category_filter_is_pushed_to_the_scan(raw):
    assert "EqualTo(foodCategory,ECONOMY)" in plan(rq.foods_by_category(raw, "ECONOMY"))


@pytest.mark.parametrize("options", [DOCUMENT_PATH, SPARK_PATH])
def test_labelling_reads_two_fields_of_a_measurement(raw, options):
    assert "array<struct<nutrientId:int,value:double>>" in fields_read(label_foods(raw, options))


def test_labelling_per_document_does_not_shuffle(raw):
    assert "Exchange" not in plan(label_foods(raw, SPARK_PATH))


def test_labelling_per_id_shuffles_once_after_combining(raw):
    text = plan(label_foods(raw, DOCUMENT_PATH))
    assert text.count("Exchange") == 1
    assert "partial_max" in text
    assert "Generate" not in text


@pytest.mark.parametrize("key", ["top_foods_by_nutrient", "healthy_foods", "sql_top10_calories"])
def test_limits_keep_the_top_rows_per_task(spark, key):
    assert "TakeOrderedAndProject" in plan(queries()[key](spark, GIVEN))


def test_labelled_scans_prune_partitions(spark):
    text = plan(queries()["healthy_foods"](spark, GIVEN))
    assert re.search(r"PartitionFilters: \[[^]]*isHealthy", text)


def test_summary_finds_the_first_measurement_before_unnesting(raw):
    text = plan(rq.nutrition_summary(raw))
    assert text.index("Generate posexplode") < text.index("array_position")


def test_generated_code_stays_small_enough_to_be_compiled(spark, raw):
    for df in (label_foods(raw, SPARK_PATH), pivot(raw), rq.nutrition_summary(raw)):
        stages = df._jdf.queryExecution().debug().codegenToSeq().iterator()
        while stages.hasNext():
            assert stages.next()._3().maxMethodCodeSize() < 8000


def test_no_python_and_no_cross_join_anywhere(spark):
    skip = ("rf_", "gbt_", "model_", "query_timing")
    for key, query in queries().items():
        if not key.startswith(skip):
            text = plan(query(spark, GIVEN))
            for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
                assert unwanted not in text, key


def test_a_hot_part_key_is_split_in_the_document_join(spark, tmp_path):
    from pyspark.sql import functions as F

    from checks.food_tables import food_documents, measurement_arrays, table

    part = table(spark, GIVEN, "part").where("p_partkey = 43")
    many = part.crossJoin(spark.range(0, 60000, 1, 6)).withColumn("p_name", F.sha2(F.col("id").cast("string"), 256))
    table(spark, GIVEN, "part").unionByName(many.drop("id")).write.parquet(f"{tmp_path}/part.parquet")
    table(spark, GIVEN, "lineitem").write.parquet(f"{tmp_path}/lineitem.parquet")
    arrays = measurement_arrays(spark, str(tmp_path))
    arrays.write.parquet(f"{tmp_path}/arrays")
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for name, value in low.items():
        spark.conf.set(name, value)
    try:
        docs = food_documents(spark, str(tmp_path), spark.read.parquet(f"{tmp_path}/arrays"))
        docs.write.format("noop").mode("overwrite").save()
        docs.collect()
        assert "SortMergeJoin(skew=true)" in plan(docs)
    finally:
        for name in low:
            spark.conf.unset(name)


@pytest.mark.parametrize("make", [rq.nutrition_summary, rq.avg_nutrients_long, rq.avg_nutrients_by_category, rq.cross_source_comparison])
def test_summaries_read_three_fields_of_a_measurement(raw, make):
    assert "array<struct<nutrientId:int,nutrientName:string,value:double>>" in fields_read(make(raw))
