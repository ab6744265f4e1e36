import csv
import json

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from larder.config import DATASETS, FEATURES
from larder.operators import models
from larder.operators.evaluation import classification_metrics, confusion_metrics
from larder.plans.labelling import SPARK_PATH
from larder.plans.pipeline import STEPS, Job, ingest, run_pipeline
from larder.sources import snapshots
from larder.sources.results import OUTPUTS, check_outputs, write_predictions

DATE = "2026-03-05"


@pytest.fixture(scope="module")
def raw(spark):
    """Documents with measurements derived from the id, three sources."""
    number = F.col("id")
    names = F.element_at(F.array(*[F.lit(d) for d in DATASETS]), (number % 3 + 1).cast("int"))

    def entry(key, value):
        return F.struct(
            F.lit(key).alias("nutrientId"),
            F.concat(F.lit("n"), F.lit(key)).alias("nutrientName"),
            F.lit("G").alias("unitName"),
            value.cast("double").alias("value"),
        )

    keys = {1008: 700, 1003: 30, 1004: 40, 2000: 25, 1093: 900, 1079: 8, 1258: 12, 1253: 90}
    entries = [entry(k, (F.abs(F.xxhash64(number, F.lit(k))) % 1000) / 1000 * top) for k, top in keys.items()]
    return spark.range(400).select(
        number.alias("fdcId"),
        F.concat(F.lit("food "), number).alias("description"),
        F.lit("t").alias("dataType"),
        F.concat(F.lit("c"), number % 5).alias("foodCategory"),
        F.array(*entries).alias("foodNutrients"),
        names.alias("sourceCollection"),
    )


@pytest.fixture(scope="module")
def labeled(raw):
    from larder.plans.labelling import label_foods

    return label_foods(raw, SPARK_PATH).cache()


@pytest.fixture(scope="module")
def forest(labeled):
    return models.train_random_forest(labeled, num_trees=10, max_depth=5)


def values(metrics):
    return {r["metric"]: r["value"] for r in metrics.collect()}


def test_features_have_no_gaps(spark):
    gaps = spark.createDataFrame([(None, 1.0), (2.0, None)], "x double, label double")
    assert [tuple(r) for r in models.model_features(gaps, ("x",)).collect()] == [(0.0, 1.0)]


def test_split_is_complete_and_independent_of_partitioning(labeled):
    sizes = {r["part"]: r["rows"] for r in models.split_sizes(labeled).collect()}
    assert sum(sizes.values()) == labeled.count()
    assert 0.7 < sizes["train"] / labeled.count() < 0.9
    again = {r["part"]: r["rows"] for r in models.split_sizes(labeled.repartition(7)).collect()}
    assert again == sizes


def test_copies_of_one_food_stay_on_one_side(labeled):
    twice = labeled.unionByName(labeled).withColumn("train", models.in_training())
    sides = twice.groupBy("fdcId").agg(F.count_distinct("train").alias("n"))
    assert sides.where("n > 1").count() == 0


def test_rows_without_an_id_are_on_one_side(spark):
    df = spark.createDataFrame([(None,)], "fdcId long").select(models.in_training().alias("t"))
    assert df.first()["t"] is not None


@pytest.mark.parametrize("predicted", ["label", "1.0 - label", "1.0D", "cast(label * n > 2 as double)", "cast(n as double)"])
def test_metrics_equal_the_library_evaluators(spark, predicted):
    scored = spark.range(60).selectExpr(
        "cast(id % 3 = 0 as double) AS label", "id % 5 AS n", "cast(id * 7 % 11 as double) AS rawPrediction"
    ).withColumn("prediction", F.expr(predicted))
    got = values(classification_metrics(scored))
    for name, library in {
        "accuracy": "accuracy",
        "precision": "weightedPrecision",
        "recall": "weightedRecall",
        "f1": "f1",
    }.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=library)
        assert got[name] == pytest.approx(evaluator.evaluate(scored), abs=1e-4)
    area = BinaryClassificationEvaluator(labelCol="label").evaluate(scored)
    assert got["auc"] == pytest.approx(area, abs=1e-4)


def test_many_rows_train_and_score_on_all_cores(spark, labeled, monkeypatch):
    monkeypatch.setattr(models, "ROWS_A_TASK", 40)
    assert models.spread(labeled, 39).rdd.getNumPartitions() == labeled.rdd.getNumPartitions()
    seen = []

    def fit(train, features, **settings):
        seen.append([n for n in train.rdd.glom().map(len).collect()])
        return models.fit_random_forest(train, features, **settings)

    trained = models.train_and_evaluate(labeled.coalesce(1), fit, {"num_trees": 3, "max_depth": 3})
    (tasks,) = seen
    sizes = values(trained.metrics)
    assert len(tasks) == spark.sparkContext.defaultParallelism and max(tasks) - min(tasks) <= 1 and sum(tasks) == sizes["train_size"]
    assert trained.predictions.rdd.getNumPartitions() > 1 and trained.predictions.count() == sizes["test_size"]
    monkeypatch.setattr(models, "MOST_ROWS_A_TASK", 50)
    assert models.spread(labeled, 400).rdd.getNumPartitions() == 8


def test_confusion_metrics_are_one_row(forest):
    assert confusion_metrics(forest.predictions).count() == 1


def test_forest_beats_the_majority(labeled, forest):
    got = values(forest.metrics)
    assert got["train_size"] + got["test_size"] == labeled.count()
    assert (got["num_trees"], got["max_depth"]) == (10, 5)
    test = labeled.where(~models.in_training())
    healthy = test.agg(F.avg("label")).first()[0]
    assert got["accuracy"] > max(healthy, 1 - healthy)
    assert all(0 <= got[m] <= 1 for m in ("accuracy", "precision", "recall", "f1", "auc"))


def test_importances_sum_to_one_and_descend(forest):
    weights = [r["importance"] for r in forest.importances.collect()]
    assert len(weights) == len(FEATURES)
    assert sum(weights) == pytest.approx(1)
    assert weights == sorted(weights, reverse=True)


def test_training_again_predicts_the_same(labeled, forest):
    again = models.train_random_forest(labeled, num_trees=10, max_depth=5)
    fields = ("description", "prediction")
    assert sorted(again.predictions.select(*fields).collect()) == sorted(
        forest.predictions.select(*fields).collect()
    )
    again.release()


def test_comparison_leaves_gaps_where_a_model_has_no_value(spark):
    a = spark.createDataFrame([("auc", 0.5), ("num_trees", 3.0)], "metric string, value double")
    b = spark.createDataFrame([("auc", 0.7), ("max_iter", 2.0)], "metric string, value double")
    assert [tuple(r) for r in models.compare_models(a, b).collect()] == [
        ("auc", 0.5, 0.7),
        ("max_iter", None, 2.0),
        ("num_trees", 3.0, None),
    ]


def read_object(folder):
    (part,) = [p for p in folder.iterdir() if p.name.startswith("part-") and p.stat().st_size]
    return json.loads(part.read_text())


def test_whole_job(spark, raw, tmp_path):
    landing, warehouse, output = (tmp_path / n for n in ("landing", "warehouse", "output"))
    for dataset in DATASETS.values():
        snapshots.land_snapshot(raw, str(landing), dataset, DATE)
    job = Job(str(landing), str(warehouse), str(output), DATE, num_trees=5, max_iter=2)
    found = {}
    for step in STEPS:  # each by itself, from what the ones before wrote
        found |= run_pipeline(spark, job, step, step)
    assert found["publish"] == [f"{output}/{name}" for name in OUTPUTS]
    assert [tuple(r)[1:] for r in found["ingest"]] and all(r["landed"] == r["loaded"] > 0 for r in found["ingest"])
    assert all(spark.read.parquet(path).columns for path in found["label"] + found["query"])

    forest = read_object(output / "rf_model_metrics.json")
    comparison = read_object(output / "model_comparison.json")
    assert comparison["random_forest"] == forest
    assert "num_trees" not in comparison["gradient_boosted_trees"]
    assert comparison["gradient_boosted_trees"]["max_iter"] == 2
    timing = read_object(output / "query_timing.json")
    assert timing["count_by_category"]["elapsed_s"] >= 0 and len(timing) == 6
    predictions = spark.read.option("header", True).csv(str(output / "rf_predictions.csv"))
    assert predictions.columns == ["description", "foodCategory", "label", "prediction", *FEATURES]
    assert predictions.count() == forest["test_size"]


def test_prediction_files_double_quotes_inside_a_field(spark, tmp_path):
    rows = spark.createDataFrame(
        [('12" pie, "plain"', None, 1.0, 0.0)],
        "description string, foodCategory string, label double, prediction double",
    ).coalesce(1)
    write_predictions(rows.select("*", *[F.lit(1.0).alias(f) for f in FEATURES]), str(tmp_path / "p"))
    (part,) = (tmp_path / "p").glob("part-*")
    with part.open(newline="") as lines:
        (read,) = csv.DictReader(lines)
    assert (read["description"], read["foodCategory"], read["label"]) == ('12" pie, "plain"', "", "1.0")


def test_ingest_reads_one_array_a_source(spark, raw, tmp_path):
    for dataset in DATASETS.values():
        folder = tmp_path / "landing" / dataset.landing
        folder.mkdir(parents=True)
        rows = raw.where(F.col("sourceCollection") == dataset.name).drop("sourceCollection").toJSON().collect()
        (folder / f"{DATE}.json").write_text(f"[{','.join(rows)}]")
    job = Job(str(tmp_path / "landing"), str(tmp_path / "warehouse"), str(tmp_path / "output"), DATE, one_array=True)
    assert sum(r["loaded"] for r in ingest(spark, job)) == raw.count()


@pytest.mark.parametrize("mark", [False, True])
def test_empty_or_uncommitted_outputs_are_errors(spark, tmp_path, mark):
    for name in OUTPUTS:
        (tmp_path / name).mkdir()
        if mark:
            (tmp_path / name / "_SUCCESS").touch()
        else:
            (tmp_path / name / "part-0").write_text("{}")
    with pytest.raises(FileNotFoundError):
        check_outputs(spark, str(tmp_path))


def test_area_is_exact_above_two_thousand_scores(spark):
    rows = spark.range(5000).selectExpr("CAST(hash(id) % 2 = 0 AS DOUBLE) AS label", "CAST(pmod(hash(id, 1), 4000) AS DOUBLE) AS rawPrediction", "1.0D AS prediction")
    pairs = rows.collect()
    scores = {1.0: sorted(r.rawPrediction for r in pairs if r.label), 0.0: sorted(r.rawPrediction for r in pairs if not r.label)}
    from bisect import bisect_left, bisect_right

    wins = sum(bisect_left(scores[0.0], s) + bisect_right(scores[0.0], s) for s in scores[1.0]) / 2
    expected = wins / len(scores[0.0]) / len(scores[1.0])
    found = {r["metric"]: r["value"] for r in classification_metrics(rows, places=12).collect()}
    assert found["auc"] == pytest.approx(expected, abs=1e-9)


def test_missing_output_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        check_outputs(spark, str(tmp_path))
