"""Vectors of measurements and rules on them against the columns that they replace."""

import math
import random

import pytest
from pyspark.sql import functions as F

from checks import workspace as ws
from larder.config import HEALTH_RULES, NUTRIENT_IDS, Rule
from larder.operators.labeling import label
from larder.operators.measure_vector import label_vectors, measure_vector
from larder.operators.nested import pivot

GIVEN = "/root/testdata/sf0.001"
NAMES, IDS = list(NUTRIENT_IDS), list(NUTRIENT_IDS.values())
MANY = [*range(1, 493), *IDS]


def rows_of(df):
    return sorted((tuple(map(repr, r)) for r in df.collect()))


def columns_of(vectors, width=len(MANY)):
    """The vector's last eight places as columns."""
    others = [c for c in vectors.columns if c != "measures"]
    assert vectors.where(F.size("measures") != width).count() == 0
    return vectors.select(*others, *[F.element_at("measures", k - len(NAMES)).alias(n) for k, n in enumerate(NAMES)])


@pytest.fixture(scope="module")
def odd(foods):
    rng = random.Random(8)
    values = (None, math.nan, 0.0, -3.5, math.inf, 250.0, 12.0, 7.0)
    rows = []
    for k in range(300):
        entries = [(rng.choice((*IDS, *IDS, 7, 9999, None)), rng.choice(values)) for _ in range(rng.randint(0, 12))]
        rows.append((rng.choice((None, 1, 2, k)), rng.choice(("A", None)), rng.choice(("survey", "legacy")), rng.choice((entries, entries, entries, None))))
    hot = [(5, "A", "survey", [(1008, float(k)), (1003, 1.0), (7, None)]) for k in range(150)]
    return foods(*rows, *hot, (6, "A", "survey", [(1008, 1.0)] * 5000)).repartition(7)


@pytest.mark.parametrize("dup", ["max", "last"])
@pytest.mark.parametrize("missing", [None, 0.0])
@pytest.mark.parametrize("keep_empty", [False, True])
@pytest.mark.parametrize("grain", ["id", "document"])
def test_equal_to_the_columns(odd, dup, missing, keep_empty, grain):
    options = {"dup": dup, "missing_value": missing, "keep_empty": keep_empty, "grain": grain}
    want = pivot(odd, NUTRIENT_IDS, **options)
    alone = columns_of(measure_vector(odd, IDS, **options), len(IDS))
    assert rows_of(alone.select(*want.columns)) == rows_of(want)
    # Not asked for by pivot(), so documents with id 7 only are left out here.
    vectors = columns_of(measure_vector(odd, MANY, **{**options, "keep_empty": True}))
    if keep_empty:
        assert rows_of(vectors.select(*want.columns)) == rows_of(want)


def test_one_pass_without_a_shuffle_and_one_row_a_measurement_with_it(odd):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    by_document = plan(measure_vector(odd.coalesce(1), MANY, grain="document"))
    assert by_document.count("MapInArrow") == 1
    by_id = plan(measure_vector(odd, MANY))
    assert "partial_max" in by_id and "partial_collect_list" in by_id


def test_ids_asked_for_twice_in_any_order(foods):
    docs = foods((1, "A", "survey", [(5, 1.0), (3, 2.0), (5, 4.0)]), (2, "A", "survey", []))
    for grain in ("id", "document"):
        got = measure_vector(docs, [9, 5, 3, 5], grain=grain, keep_empty=True).select("fdcId", "measures")
        assert sorted(map(tuple, got.collect())) == [(1, [None, 4.0, 2.0, 4.0]), (2, [None] * 4)]


def test_no_rows_and_clashing_names(foods):
    docs = foods((1, "A", "survey", [(5, 1.0)])).withColumn("_ids", F.lit("x")).withColumn("_values", F.lit(3))
    row = measure_vector(docs, [5], grain="document").first()
    assert (row["_ids"], row["_values"], row.measures) == ("x", 3, [1.0])
    assert measure_vector(docs.limit(0), [5]).count() == measure_vector(docs.limit(0), [5], grain="document").count() == 0
    assert measure_vector(docs, [8]).count() == 0
    for wrong in ({"dup": "first"}, {"grain": "food"}, {"measures": []}):
        with pytest.raises(ValueError):
            measure_vector(docs, **{"measures": [5], **wrong})


def test_batches_larger_than_a_table(odd, monkeypatch):
    want = rows_of(measure_vector(odd, IDS, grain="document"))
    monkeypatch.setattr("larder.operators.measure_vector.CELLS", 20)
    assert rows_of(measure_vector(odd, IDS, grain="document")) == want


@pytest.mark.parametrize("null_compare", ["sql", "lowest"])
@pytest.mark.parametrize("required", [("calories", "protein"), ()])
def test_the_same_points_as_columns(odd, null_compare, required):
    wide = pivot(odd, NUTRIENT_IDS, keep_empty=True, grain="document")
    rules = [*HEALTH_RULES, Rule("total_fat", ">", 1, null_as=3), Rule("cholesterol", ">", 250), Rule("calories", "<", 1, null_as=0)]
    want = label(wide, rules, required=required, minimum=5, null_compare=null_compare).drop(*NAMES)
    vectors = measure_vector(odd, IDS, keep_empty=True, grain="document")
    got = label_vectors(vectors, NAMES, rules, required=required, minimum=5, null_compare=null_compare).drop("measures")
    assert rows_of(got.select(*want.columns)) == rows_of(want)


def test_a_null_vector_has_no_value(foods):
    rows = measure_vector(foods((1, "A", "survey", [(1008, 1.0)])), IDS).withColumn("measures", F.lit(None).cast("array<double>"))
    assert label_vectors(rows, NAMES).count() == 0
    assert label_vectors(rows, NAMES, required=()).first().healthScore == 2  # sodium and saturated fat count as 0
    assert label_vectors(rows, NAMES, [], required=(), minimum=0).first().isHealthy
    with pytest.raises(ValueError):
        label_vectors(rows, NAMES, null_compare="highest")


def test_on_the_raw_table(spark):
    raw = ws.raw_table(spark, GIVEN)
    want = pivot(raw, NUTRIENT_IDS)
    assert rows_of(columns_of(measure_vector(raw, IDS), len(IDS)).select(*want.columns)) == rows_of(want)
