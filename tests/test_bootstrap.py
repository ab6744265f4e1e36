"""Poisson bootstrap of the metrics against a plain one, and its distribution."""

import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from larder.operators import bootstrap
from larder.operators.evaluation import classification_metrics

SCHEMA = "model string, key string, label double, prediction double, score double"


def drawn(key, replicate):
    """The weight of a key, from its digest."""
    digest = md5(f"{key or ''}:{replicate // 8}".encode()).hexdigest()
    half = int(digest[:15] if replicate % 8 < 4 else digest[15:30], 16)
    number = half >> 15 * (replicate % 4) & 32767
    return sum(number >= c for c in bootstrap.poisson_cuts())


def measured(rows):
    """The five metrics of (weight, label, prediction, bin)."""
    total = sum(w for w, *_ in rows)
    out = dict.fromkeys(("accuracy", "precision", "recall", "f1"), 0.0)
    for c in {r[1] for r in rows if r[0]}:
        truth = sum(w for w, y, *_ in rows if y == c)
        said = sum(w for w, _, p, _ in rows if p == c)
        hits = sum(w for w, y, p, _ in rows if y == p == c)
        p, r = (hits / said if said else 0.0), hits / truth
        out["accuracy"] += hits / total
        out["precision"] += p * truth / total
        out["recall"] += r * truth / total
        out["f1"] += (2 * p * r / (p + r) if p + r else 0.0) * truth / total
    pos, neg = ([(w, b) for w, y, _, b in rows if (y == 1) is side and w] for side in (True, False))
    pairs = sum(w * v * (1.0 if b > c else 0.5 if b == c else 0.0) for w, b in pos for v, c in neg)
    size = sum(w for w, _ in pos) * sum(w for w, _ in neg)
    out["auc"] = pairs / size if size else None
    return out


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = []
    for k in range(90):
        label = float(rng.random() < 0.4)
        for model, noise in (("a", 0.5), ("b", 1.5)):
            score = min(1.0, max(0.0, 0.5 + (label - 0.5) * 0.5 + rng.uniform(-noise, noise) / 2))
            rows += [(model, None if k == 7 else str(k), label, float(score >= 0.5), score)] * (3 if k == 5 else 1)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_every_replicate_equals_a_plain_one(scored):
    rows, df = scored
    cells = bootstrap.histogram(df, 20, 30)
    got = {(r.model, r.replicate, r.metric): r.value for r in bootstrap.replicate_metrics(cells, 20).collect()}
    assert len(got) == 2 * 21 * 5
    for model in "ab":
        for replicate in range(-1, 20):
            own = [(1 if replicate < 0 else drawn(key, replicate), y, p, min(29, int(s * 30))) for m, key, y, p, s in rows if m == model]
            for metric, value in measured(own).items():
                assert got[model, replicate, metric] == pytest.approx(value, abs=1e-12), (model, replicate, metric)


def test_estimates_are_the_metrics_and_differences_are_paired(scored):
    _, df = scored
    found = {(r.model, r.metric): r for r in bootstrap.metric_intervals(df, ("a", "b"), replicates=100, bins=10**6).collect()}
    for model in "ab":
        one = df.where(F.col("model") == model).withColumn("rawPrediction", F.col("score"))
        for r in classification_metrics(one).collect():
            row = found[model, r.metric]
            assert row.value == pytest.approx(r.value, abs=1.1e-4)
            assert row.low <= row.value <= row.high
            assert found["a - b", r.metric].value == pytest.approx(found["a", r.metric].value - found["b", r.metric].value, abs=2e-4)
    twice = df.where("model = 'a'").unionByName(df.where("model = 'a'").withColumn("model", F.lit("same")))
    same = bootstrap.metric_intervals(twice, ("a", "same"), replicates=16).where("model = 'a - same'").collect()
    assert len(same) == 5 and all((r.value, r.low, r.high) == (0, 0, 0) for r in same)


def test_parts_add_up_and_partitions_are_no_matter(scored):
    _, df = scored
    whole = bootstrap.histogram(df, 16, 10)
    parts = bootstrap.merged(*[bootstrap.histogram(df.where(c), 16, 10) for c in ("score < 0.4", "score >= 0.4", "FALSE")])
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.select(*whole.columns).collect()))
    assert sorted(map(str, whole.collect())) == sorted(map(str, bootstrap.histogram(df.repartition(3), 16, 10).collect()))


def test_weights_are_poisson(spark):
    df = spark.range(4000).selectExpr("'m' AS model", "CAST(id AS STRING) AS key", "1D AS label", "1D AS prediction", "0.5D AS score")
    row = bootstrap.histogram(df, 8, 1).first()
    sums = [row[f"w{i}"] for i in range(8)]
    assert all(abs(s - 4000) < 4 * 4000**0.5 for s in sums) and len(set(sums)) > 4
    cuts = bootstrap.poisson_cuts()
    assert cuts == sorted(cuts) and abs(sum(32768 - c for c in cuts) / 32768 - 1) < 1e-3  # the mean


def test_rows_that_cannot_be_judged_one_label_and_no_rows(spark):
    rows = [("a", "1", None, 1.0, 0.5), ("a", "2", 1.0, None, 0.5), ("a", "3", 1.0, 1.0, None), ("a", "4", 1.0, 1.0, 7.0), ("a", "5", 1.0, 0.0, -1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.metric: r for r in bootstrap.metric_intervals(df, replicates=24).collect()}
    assert found["accuracy"].value == 0.5 and found["auc"].value is None and found["auc"].low is None
    assert bootstrap.metric_intervals(df.limit(0), ("a", "b")).count() == 0
    for wrong in ({"replicates": 0}, {"bins": 0}, {"level": 1.0}):
        with pytest.raises(ValueError):
            bootstrap.metric_intervals(df, **wrong)


def test_models_below_each_other(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, 1.0, 1.0, Vectors.dense(0.25, 0.75))], ["fdcId", "label", "prediction", "probability"])
    rows = bootstrap.stacked({"forest": df, "boosted": df}).orderBy("model").collect()
    assert [(r.model, r.key, r.score) for r in rows] == [("boosted", 1, 0.75), ("forest", 1, 0.75)]
    with pytest.raises(ValueError):
        bootstrap.stacked({})


def test_added_up_before_the_shuffle(scored):
    text = bootstrap.histogram(scored[1])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text
