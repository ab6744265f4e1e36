import pytest

from larder.operators import labeled_queries as lq
from larder.plans.sql_catalog import CATALOG, run_catalog, time_queries


@pytest.fixture(scope="module")
def labeled(spark):
    rows = [
        # id, category, source, calories, protein, fat, sugars, score, healthy
        (1, "A", "survey", 100.0, 30.0, 1.0, 1.0, 6, True),
        (2, "A", "survey", 200.0, 25.0, 2.0, None, 4, True),
        (3, None, "legacy", 900.0, 21.0, 9.0, 3.0, 0, False),
        (4, "B", "legacy", 800.0, 40.0, 4.0, 4.0, 3, False),
        (5, "B", "legacy", 800.0, 2.0, 4.0, 4.0, 4, True),
    ]
    return spark.createDataFrame(
        [(f"food {r[0]}", *r) for r in rows],
        "description string, fdcId long, foodCategory string, sourceCollection string, calories double,"
        "protein double, total_fat double, total_sugars double, healthScore int, isHealthy boolean",
    )


def ids(df):
    return [r["fdcId"] for r in df.collect()]


def test_best_and_worst(labeled):
    assert ids(lq.healthy_foods(labeled)) == [1, 2, 5]
    assert ids(lq.healthy_foods(labeled, 2)) == [1, 2]
    assert ids(lq.unhealthy_foods(labeled)) == [3, 4]
    ends = [(r["side"], r["fdcId"]) for r in lq.healthiest_and_least(labeled, 1).collect()]
    assert ends == [("healthiest", 1), ("least_healthy", 3)]


def test_breakdowns(labeled):
    assert [tuple(r) for r in lq.healthy_by_category_long(labeled).collect()] == [
        ("A", "healthy", 2),
        ("B", "healthy", 1),
        (None, "unhealthy", 1),
        ("B", "unhealthy", 1),
    ]
    assert [tuple(r) for r in lq.avg_score_by_source(labeled).collect()] == [
        ("healthy", "survey", 5.0, 2),
        ("healthy", "legacy", 4.0, 1),
        ("unhealthy", "legacy", 1.5, 2),
    ]


def test_catalog(spark, labeled):
    got = {name: [tuple(r) for r in df.collect()] for name, df in run_catalog(spark, labeled).items()}
    assert list(got) == list(CATALOG)
    assert got["count_by_category"] == [("A", 2), ("B", 2), (None, 1)]
    assert got["avg_nutrients_by_category"][1] == ("B", 800.0, 21.0, 4.0, 4.0)
    assert [r[0] for r in got["top_10_highest_calorie"]] == ["food 3", "food 4", "food 5", "food 2", "food 1"]
    assert got["healthy_vs_unhealthy_by_category"][0] == ("A", 2, 0, 5.0)
    assert sorted(got["cross_collection_comparison"])[1] == ("survey", 2, 150.0, 27.5, 1.0, 5.0)
    assert [r[0] for r in got["high_protein_low_fat"]] == ["food 4", "food 1", "food 2"]


def test_own_queries_can_be_added_and_timed(spark, labeled):
    own = {"rows": "SELECT count(*) AS n FROM {foods}"}
    results = run_catalog(spark, labeled, own)
    assert results["rows"].first()["n"] == 5
    timing = time_queries(spark, results).collect()
    assert [r["query"] for r in timing] == ["rows"] and timing[0]["elapsed_s"] >= 0


def test_two_labelled_sets_side_by_side(spark, labeled):
    few = run_catalog(spark, labeled.limit(0), {"rows": "SELECT count(*) AS n FROM {foods} WHERE protein > :least_protein"})
    all_rows = run_catalog(spark, labeled, {"rows": "SELECT count(*) AS n FROM {foods} WHERE protein > :least_protein"}, {"least_protein": 24})
    assert (few["rows"].first()["n"], all_rows["rows"].first()["n"]) == (0, 3)
    top = run_catalog(spark, labeled, bounds={"limit": 1, "least_protein": 20, "most_fat": 2})
    assert ids(labeled.join(top["high_protein_low_fat"], "description")) == [1]
    assert run_catalog(spark, labeled.limit(0))["count_by_category"].count() == 0
    assert not spark.catalog.tableExists("foods")
