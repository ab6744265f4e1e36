"""Saved models, the ledger and restarts."""

from dataclasses import replace

import pytest

from checks import workspace as ws
from larder.config import DATASETS, Rule
from larder.operators import models, saved_models
from larder.operators.saved_models import Basis, ModelMismatch
from larder.plans import ledger, pipeline
from larder.plans.pipeline import Job, run_pipeline
from larder.sources import snapshots

GIVEN = "/root/testdata/sf0.001"
DATE = "2026-03-05"
BASIS = Basis("random_forest", {"num_trees": 5, "max_depth": 4}, "data-1")


@pytest.fixture(scope="module")
def labeled(spark):
    return ws.labeled_by_spark(spark, GIVEN)


@pytest.fixture(scope="module")
def fitted(labeled):
    return models.fit_model(labeled, models.fit_random_forest, BASIS.settings)


def predicted(df):
    return sorted((r.fdcId, r.prediction, tuple(r.rawPrediction)) for r in df.collect())


def test_scoring_a_reloaded_model_equals_scoring_in_memory(spark, labeled, fitted, tmp_path):
    saved_models.save(spark, fitted, BASIS, str(tmp_path))
    saved = saved_models.load(spark, str(tmp_path), BASIS)
    again, before = saved_models.evaluate_saved(saved, labeled), models.evaluate(fitted, labeled)
    assert predicted(again.predictions) == predicted(before.predictions)
    assert sorted(map(tuple, again.metrics.collect())) == sorted(map(tuple, before.metrics.collect()))
    assert predicted(saved_models.score(saved, labeled)) == predicted(fitted.model.transform(labeled.fillna(0.0)))


@pytest.mark.parametrize(
    "change",
    [{"data": "data-2"}, {"percent": 70}, {"settings": {"num_trees": 6, "max_depth": 4}}, {"rules": (Rule("calories", "<", 1),)}, {"features": ("calories",)}, {"minimum": 3}],
)
def test_a_model_of_another_basis_is_refused(spark, fitted, tmp_path, change):
    saved_models.save(spark, fitted, BASIS, str(tmp_path))
    other = replace(BASIS, **change)
    assert not saved_models.is_saved(spark, str(tmp_path), other)
    with pytest.raises(ModelMismatch, match=next(iter(change))):
        saved_models.load(spark, str(tmp_path), other)


def test_rows_without_the_features_are_refused(spark, labeled, fitted, tmp_path):
    with pytest.raises(FileNotFoundError):
        saved_models.load(spark, str(tmp_path), BASIS)
    saved_models.save(spark, fitted, BASIS, str(tmp_path))
    saved = saved_models.load(spark, str(tmp_path))
    with pytest.raises(ModelMismatch, match="sodium"):
        saved_models.score(saved, labeled.drop("sodium"))
    with pytest.raises(ModelMismatch):
        saved_models.score(saved, labeled, ["calories"])


def test_a_model_saved_anew_leaves_the_one_before(spark, fitted, tmp_path):
    saved_models.save(spark, fitted, BASIS, str(tmp_path))
    saved_models.save(spark, fitted, replace(BASIS, data="data-2"), str(tmp_path))
    assert saved_models.load(spark, str(tmp_path)).basis.data == "data-2"
    assert saved_models.load(spark, str(tmp_path), BASIS, number=1).basis == BASIS


def test_digests_do_not_depend_on_order_but_on_every_line(spark, tmp_path):
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS value")
    rows.repartition(3).write.text(f"{tmp_path}/a")
    rows.orderBy("value").coalesce(1).write.text(f"{tmp_path}/b")
    rows.where("value <> '7'").write.text(f"{tmp_path}/c")
    rows.selectExpr("IF(value = '7', '8', value) AS value").write.text(f"{tmp_path}/d")
    a, b, c, d = (ledger.content(spark, f"{tmp_path}/{x}") for x in "abcd")
    assert a == b and a[0] == 100 and len({a, c, d}) == 3 and ledger.content(spark, f"{tmp_path}/none") == (-1, "")


def test_restart_and_publish_know_what_is_there(spark, tmp_path, monkeypatch):
    docs = ws.raw_table(spark, GIVEN).drop("copy")
    for dataset in DATASETS.values():
        snapshots.land_snapshot(docs, f"{tmp_path}/landing", dataset, DATE)
    job = Job(f"{tmp_path}/landing", f"{tmp_path}/warehouse", f"{tmp_path}/output", DATE, num_trees=3, max_iter=1)

    def broken(*_, **__):
        raise RuntimeError("boosting failed")

    monkeypatch.setitem(pipeline.FITS, "boosted_trees", broken)
    with pytest.raises(RuntimeError, match="boosting"):
        run_pipeline(spark, job)
    monkeypatch.undo()
    forest = next(iter(pipeline.model_bases(spark, job).items()))
    assert saved_models.is_saved(spark, *forest)  # it is not lost

    monkeypatch.setitem(pipeline.FITS, "random_forest", broken)  # and not fitted again
    found = run_pipeline(spark, job, resume=True)
    assert [k for k, v in found.items() if not v] == ["ingest", "label", "query"] and len(found["publish"]) == 6
    assert not any(v for k, v in run_pipeline(spark, job, resume=True).items() if k != "publish")

    (part,) = [p for p in (tmp_path / "output" / "model_comparison.json").iterdir() if p.name.startswith("part-") and p.stat().st_size]
    whole = part.read_bytes()
    for crc in part.parent.glob(".*.crc"):
        crc.unlink()
    part.write_bytes(whole[:-20])
    with pytest.raises(ledger.OutputChanged, match="model_comparison"):
        run_pipeline(spark, job, "publish")
    again = run_pipeline(spark, job, resume=True)
    assert [k for k, v in again.items() if v] == ["score", "publish"]
