"""Label cube, first rows of every group, summaries by date."""

import json
import random

import pytest
from pyspark.sql import functions as F

from checks import workspace as ws
from larder.operators import incremental, labeled_queries, raw_queries
from larder.operators.label_cube import cube_results, label_cube
from larder.operators.labeling import label_counts
from larder.operators.top_groups import top_foods_by_every_nutrient, top_per_group
from larder.plans import sql_catalog
from larder.sources import versions

GIVEN = "/root/testdata/sf0.001"


def plain(df):
    rows = [{k: round(v, 6) if isinstance(v, float) else v for k, v in r.asDict(True).items()} for r in df.collect()]
    return sorted(json.dumps(r, sort_keys=True) for r in rows)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_five_answers_from_one_scan(spark):
    labeled = ws.labeled_by_spark(spark, GIVEN).withColumn("foodCategory", F.when(F.col("fdcId") % 5 > 0, F.col("foodCategory")))
    cube = label_cube(labeled)
    assert plan(cube).count("FileScan") == 1
    found = cube_results(cube)
    catalog = sql_catalog.run_catalog(spark, labeled)
    want = {
        "healthy_by_category_long": labeled_queries.healthy_by_category_long(labeled),
        "avg_score_by_source": labeled_queries.avg_score_by_source(labeled),
        "healthy_vs_unhealthy_by_category": catalog["healthy_vs_unhealthy_by_category"],
        "cross_collection_comparison": catalog["cross_collection_comparison"],
        "label_counts": label_counts(labeled),
    }
    assert set(found) == set(want)
    for name in want:
        assert plain(found[name]) == plain(want[name].select(*found[name].columns)), name
    assert cube.where("level = 'category' AND category IS NULL").count() == 1


def test_cube_of_no_rows(spark):
    cube = label_cube(ws.labeled_by_spark(spark, GIVEN).limit(0))
    assert [(r.level, r.total, r.healthy, r.avg_calories) for r in cube.collect()] in ([], [("all", 0, 0, None)])


def test_first_rows_of_every_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice(("hot",) * 8 + ("a", None)), rng.choice((None, 1, 2, 3)), k) for k in range(2000)] + [("one", 5, 1), ("same", 1, 1), ("same", 1, 1)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(5)
    order = [F.desc_nulls_last("v"), F.col("k")]
    for salts in (1, 7):
        got = top_per_group(df, ["g"], order, 4, salts=salts)
        want = []
        for g in {r[0] for r in rows}:
            own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
            want += [(*r, i + 1) for i, r in enumerate(own[:4])]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_every_group_equals_its_own_query_and_is_limited_before_the_shuffle(spark):
    raw = ws.raw_table(spark, GIVEN)
    top = top_foods_by_every_nutrient(raw, (1008, 1003), 5)
    text = plan(top)
    assert text.count("FileScan") == 1 and "WindowGroupLimit" in text
    assert text.rindex("WindowGroupLimit") > text.rindex("Exchange hashpartitioning")  # printed below: it runs before
    for source in ("survey", "legacy"):
        for key in (1008, 1003):
            alone = raw_queries.top_foods_by_nutrient(raw_queries.of_source(raw, source), key, 5)
            own = top.where((F.col("sourceCollection") == source) & (F.col("nutrientId") == key))
            assert plain(own.select(*alone.columns)) == plain(alone)


@pytest.fixture
def dated(foods):
    rng = random.Random(3)
    rows = [(k, rng.choice(("A", "B", None)), rng.choice(("survey", "legacy")), [(rng.choice((1008, 1003, 5)), rng.choice((None, rng.random() * 90))) for _ in range(rng.randint(0, 5))]) for k in range(120)]
    return foods(*rows)


def test_dates_added_replaced_and_dropped_equal_the_full_answer(spark, dated, tmp_path):
    path = str(tmp_path)
    days = [dated.where(F.col("fdcId") % 3 == day) for day in range(3)]
    for day, docs in enumerate(days):
        incremental.put_date(docs, path, f"day{day}")
    before = versions.version(spark, path)
    days[1] = dated.where("fdcId % 5 = 0")
    incremental.put_date(days[1], path, "day1")
    after = versions.version(spark, path)
    assert {p for p in before.parts if p.value != "day1"} == {p for p in after.parts if p.value != "day1"}  # not touched
    held = days
    for _ in range(2):
        docs = held[0]
        for more in held[1:]:
            docs = docs.unionByName(more)
        states = incremental.scan_states(spark, path)
        assert plain(incremental.nutrition_summary(states)) == plain(raw_queries.nutrition_summary(docs))
        assert plain(incremental.avg_nutrients_long(states)) == plain(raw_queries.avg_nutrients_long(docs))
        assert plain(incremental.cross_source_comparison(states)) == plain(raw_queries.cross_source_comparison(docs))
        incremental.drop_date(spark, path, "day2")
        held = days[:2]
    incremental.put_date(dated.limit(0), path, "day0")
    incremental.drop_date(spark, path, "day1")
    assert incremental.nutrition_summary(incremental.scan_states(spark, path)).count() == 0
