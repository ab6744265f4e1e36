"""The points where the two paths differ, one hand-written case each."""

import pytest
from pyspark.sql import functions as F

from larder.config import HEALTH_RULES, NUTRIENT_IDS, Rule
from larder.functions.rounding import rounded
from larder.functions.scoring import point
from larder.operators.labeling import label, label_counts
from larder.operators.nested import pivot
from larder.plans.labelling import DOCUMENT_PATH, SPARK_PATH, label_foods, wide_frames, widen

FULL = [(1008, 100.0), (1003, 6.0), (1004, 1.0)]


def row(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_repeated_measure_takes_max_or_last(foods):
    docs = foods((1, "A", "survey", [(1003, 5.0), (1003, 3.0)]))
    assert row(widen(docs, DOCUMENT_PATH))["protein"] == 5.0
    assert row(widen(docs, SPARK_PATH))["protein"] == 3.0


def test_entry_without_value(foods):
    docs = foods((1, "A", "survey", [(1003, None)]))
    assert row(widen(docs, DOCUMENT_PATH))["protein"] is None
    assert row(widen(docs, SPARK_PATH))["protein"] == 0.0
    assert row(widen(docs, SPARK_PATH))["calories"] is None


def test_max_ignores_a_missing_value_among_repeats(foods):
    docs = foods((1, "A", "survey", [(1003, 2.0), (1003, None), (1003, 1.0)]))
    assert row(widen(docs, DOCUMENT_PATH))["protein"] == 2.0
    filled = pivot(foods((1, "A", "survey", [(1003, -2.0), (1003, None)])), missing_value=0.0)
    assert row(filled)["protein"] == 0.0


def test_absent_sugars_score_one_point_only_when_null_is_lowest(foods):
    docs = foods((1, "A", "survey", FULL))
    low, sql = row(label_foods(docs, DOCUMENT_PATH)), row(label_foods(docs, SPARK_PATH))
    # calories, sodium, saturated fat, protein pass in both; fiber fails.
    assert (low["healthScore"], sql["healthScore"]) == (5, 4)


def test_absent_value_fails_a_high_is_good_rule_in_both_modes(spark):
    df = spark.createDataFrame([(None,)], "fiber double")
    rule = Rule("fiber", ">", 3)
    assert row(df.select(point(rule, "lowest").alias("p")))["p"] == 0
    assert row(df.select(point(rule, "sql").alias("p")))["p"] == 0


def test_documents_of_one_id_merge_within_a_source(foods):
    docs = foods(
        (1, "A", "survey", FULL),
        (1, "A", "survey", [(1003, 9.0)]),
        (1, "A", "legacy", FULL),
    )
    merged = {r["sourceCollection"]: r["protein"] for r in widen(docs, DOCUMENT_PATH).collect()}
    assert merged == {"survey": 9.0, "legacy": 6.0}
    assert widen(docs, SPARK_PATH).count() == 3


def test_first_document_gives_all_attributes(spark, foods):
    docs = (
        foods((1, "late", "survey", FULL))
        .withColumn("copy", F.lit(2))
        .unionByName(foods((1, None, "survey", FULL)).withColumn("copy", F.lit(1)))
        .unionByName(foods((1, "no key measure", "survey", [(1, 1.0)])).withColumn("copy", F.lit(0)))
    )
    assert row(pivot(docs, order_by=("copy",)))["foodCategory"] is None
    latest = docs.withColumn("copy", -F.col("copy"))
    assert row(pivot(latest, order_by=("copy",)))["foodCategory"] == "late"


def test_missing_category(foods):
    docs = foods((1, None, "survey", FULL))
    assert row(widen(docs, DOCUMENT_PATH))["foodCategory"] is None
    assert row(widen(docs, SPARK_PATH))["foodCategory"] == "Unknown"


def test_empty_and_missing_arrays(foods):
    docs = foods(
        (1, "A", "survey", []), (2, "A", "survey", None), (3, "A", "survey", [(1051, 1.0)])
    )
    assert widen(docs, DOCUMENT_PATH).count() == 0
    kept = widen(docs, SPARK_PATH).collect()
    assert len(kept) == 3
    assert all(r[name] is None for r in kept for name in NUTRIENT_IDS)
    assert label_foods(docs, SPARK_PATH).count() == 0


def test_rounding_modes(spark):
    df = spark.createDataFrame([(0.125, 2.5)], "a double, b double")
    got = row(
        df.select(
            rounded(F.col("a"), 2, "even").alias("ae"),
            rounded(F.col("a"), 2, "up").alias("au"),
            rounded(F.col("b"), 0, "even").alias("be"),
            rounded(F.col("b"), 0, "up").alias("bu"),
        )
    )
    assert tuple(got) == (0.12, 0.13, 2.0, 3.0)


def test_rules_are_strict_at_their_bounds(foods):
    at = [(1008, 300.0), (2000, 10.0), (1093, 400.0), (1258, 5.0), (1079, 3.0), (1003, 5.0), (1004, 1.0)]
    docs = foods((1, "A", "survey", at))
    assert row(label_foods(docs, SPARK_PATH))["healthScore"] == 0
    inside = [(1008, 299.9), (2000, 9.9), (1093, 399.9), (1258, 4.9), (1079, 3.1), (1003, 5.1), (1004, 1.0)]
    assert row(label_foods(foods((1, "A", "survey", inside)), SPARK_PATH))["healthScore"] == 6


@pytest.mark.parametrize("missing", [1008, 1003, 1004])
def test_required_measures(foods, missing):
    docs = foods((1, "A", "survey", [e for e in FULL if e[0] != missing]))
    assert label_foods(docs, DOCUMENT_PATH).count() == 0
    assert label_foods(docs, SPARK_PATH).count() == 0


def test_healthy_from_four_points(foods):
    four = [*FULL, (2000, 50.0)]
    three = [*four, (1093, 900.0)]
    docs = foods((1, "A", "survey", four), (2, "A", "survey", three))
    got = {r["fdcId"]: (r["healthScore"], r["isHealthy"], r["label"]) for r in label_foods(docs, SPARK_PATH).collect()}
    assert got == {1: (4, True, 1.0), 2: (3, False, 0.0)}
    assert tuple(row(label_counts(label_foods(docs, SPARK_PATH)))) == (2, 1, 1)


def test_null_modes_differ_by_one_point_at_most(spark):
    wide = spark.range(2**6).select(
        *[
            F.when(F.col("id").bitwiseAND(2**i) > 0, F.lit(1.0)).alias(rule.column)
            for i, rule in enumerate(HEALTH_RULES)
        ]
    )
    low = label(wide, required=(), null_compare="lowest").select(F.col("healthScore").alias("low"), *wide.columns)
    both = label(low, required=(), null_compare="sql").withColumn("gap", F.col("low") - F.col("healthScore"))
    got = both.agg(F.min("gap"), F.max("gap"), F.min("healthScore"), F.max("low")).first()
    # Both of calories and sugars lack a stand-in value.
    assert got[0] >= 0 and got[1] <= 2 and got[2] >= 0 and got[3] <= 6
    required = both.where("calories IS NOT NULL").agg(F.max("gap")).first()
    assert required[0] == 1


def test_result_does_not_depend_on_partitioning(foods):
    docs = foods(*[(i % 7, "A", "survey", [*FULL, (1003, float(i))]) for i in range(40)])
    one = label_foods(docs.coalesce(1), DOCUMENT_PATH)
    many = label_foods(docs.repartition(9), DOCUMENT_PATH)
    assert sorted(one.collect()) == sorted(many.collect())


def test_frames_per_source_and_union(foods):
    docs = foods((1, "A", "survey", FULL), (2, "B", "legacy", FULL), (3, "C", "foundation", FULL))
    frames = wide_frames(docs)
    assert list(frames) == ["survey_food", "legacy_food", "foundation_food", "all_foods"]
    assert frames["all_foods"].count() == 3
    assert row(frames["legacy_food"])["fdcId"] == 2


def test_bad_options_are_refused(foods):
    docs = foods((1, "A", "survey", FULL))
    with pytest.raises(ValueError):
        pivot(docs, dup="first")
    with pytest.raises(ValueError):
        pivot(docs, grain="row")
    with pytest.raises(ValueError):
        point(HEALTH_RULES[0], "highest")
    with pytest.raises(ValueError):
        Rule("calories", "<=", 1)
    with pytest.raises(ValueError):
        rounded(F.lit(1.0), 2, "down")


def test_documents_of_one_id_merge_by_the_last_that_has_the_measure(spark, foods):
    docs = foods(
        (1, "A", "survey", [(1008, 1.0), (1003, 5.0), (1008, 9.0)]),
        (1, "B", "survey", [(1008, 4.0)]),
        (1, "C", "survey", [(1004, 2.0)]),
    )
    got = row(pivot(docs, dup="last", grain="id", order_by=("foodCategory",)))
    assert (got["calories"], got["protein"], got["total_fat"], got["foodCategory"]) == (4.0, 5.0, 2.0, "A")


def test_arrays_of_any_length(foods):
    """The bound of 84 entries belongs to the test tables, not to the library."""
    entries = [(1051, float(k)) for k in range(5000)] + [(1008, 3.0), (1003, 2.0), (1004, 1.0), (1008, 7.0)]
    docs = foods((1, "A", "survey", entries))
    assert row(pivot(docs))["calories"] == 7.0 and row(label_foods(docs, SPARK_PATH))["calories"] == 7.0


def test_other_required_columns_and_minimum(foods):
    docs = foods((1, "A", "survey", [(1051, 50.0)]), (2, "A", "survey", [(1079, 1.0)]))
    options = {"measures": {"water": 1051, "fiber": 1079}, "rules": (Rule("water", ">", 40.0),), "required": ("water",)}
    got = label_foods(docs, DOCUMENT_PATH, minimum=1, **options)
    assert [(r["fdcId"], r["isHealthy"]) for r in got.collect()] == [(1, True)]
    assert not row(label_foods(docs, DOCUMENT_PATH, minimum=2, **options))["isHealthy"]
