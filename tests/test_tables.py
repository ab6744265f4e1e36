import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larder.config import DATASETS
from larder.plans.labelling import SPARK_PATH, label_foods
from larder.sources import snapshots, tables

DATE = "2026-03-05"
FULL = [(1008, 100.0), (1003, 6.0), (1004, 1.0)]


@pytest.fixture
def docs(foods):
    return foods(
        (1, "A", "survey", FULL),
        (2, None, "survey", []),
        (3, "B", "legacy", [(1008, None)]),
        (4, "C", "foundation", None),
    )


def plain(df):
    return sorted(json.dumps(r.asDict(True), sort_keys=True) for r in df.collect())


def land_all(docs, root):
    for dataset in DATASETS.values():
        snapshots.land_snapshot(docs, root, dataset, DATE)


def test_snapshot_round_trip(spark, docs, tmp_path):
    land_all(docs, str(tmp_path))
    assert (tmp_path / "legacy_all" / f"snapshot_date={DATE}").is_dir()
    back = snapshots.read_sources(spark, str(tmp_path), DATE)
    assert plain(back) == plain(docs)


def test_landing_again_replaces_that_date(spark, docs, foods, tmp_path):
    land_all(docs, str(tmp_path))
    land_all(foods((9, "Z", "survey", [])), str(tmp_path))
    assert [r["fdcId"] for r in snapshots.read_sources(spark, str(tmp_path), DATE).collect()] == [9]


def test_landed_lines_are_compressed_in_files_of_bounded_size(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "LANDED_ROWS", 1)
    land_all(docs.coalesce(1), str(tmp_path))
    for dataset in DATASETS.values():
        path = snapshots.snapshot_path(str(tmp_path), dataset, DATE)
        own = docs.where(F.col("sourceCollection") == dataset.name).count()
        files = [f for f in Path(path).iterdir() if f.name.startswith("part-") and spark.read.text(str(f)).count()]
        assert len(files) == own and all(f.name.endswith(".json.gz") for f in files)
    assert snapshots.read_sources(spark, str(tmp_path), DATE).count() == docs.count()


def test_one_array_file_with_full_empty_and_missing_measurements(spark, tmp_path):
    path = tmp_path / "snapshot.json"
    measure = {"nutrientId": 1008, "nutrientName": "Energy", "unitName": "KCAL", "value": 5}
    path.write_text(
        json.dumps(
            [
                {"fdcId": 1, "description": "a", "foodNutrients": [measure], "unknown": {"x": 1}},
                {"fdcId": 2, "description": "b", "foodNutrients": []},
                {"fdcId": 3, "description": "c"},
            ],
            indent=1,
        )
    )
    read = snapshots.read_snapshot(spark, str(path), one_array=True).orderBy("fdcId").collect()
    assert [r["foodNutrients"] and len(r["foodNutrients"]) for r in read] == [1, [], None]
    assert read[0]["foodNutrients"][0]["value"] == 5.0


def test_malformed_snapshots_fail(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('{"fdcId": 1}\n{"fdcId": \n')
    with pytest.raises(Exception, match="MALFORMED"):
        snapshots.read_snapshot(spark, str(path)).collect()


def test_replace_touches_only_the_sources_loaded(spark, docs, foods, tmp_path):
    path = str(tmp_path / "raw")
    tables.load_raw(docs, path)
    tables.load_raw(docs, path)
    assert tables.scan_raw(spark, path).count() == 4
    tables.load_raw(foods((7, "Z", "survey", FULL)), path, sources=["survey"])
    counts = {r[0]: r[1] for r in tables.count_by_source(tables.scan_raw(spark, path)).collect()}
    assert counts == {"survey": 1, "legacy": 1, "foundation": 1}


def test_append_keeps_duplicates(spark, docs, tmp_path):
    path = str(tmp_path / "raw")
    tables.load_raw(docs, path)
    tables.load_raw(docs.where("fdcId = 4"), path, replace=False)
    counts = {r[0]: r[1] for r in tables.count_by_source(tables.scan_raw(spark, path)).collect()}
    assert counts == {"survey": 2, "legacy": 1, "foundation": 2}


def test_empty_input_is_refused_and_leaves_the_table(spark, docs, tmp_path):
    path = str(tmp_path / "raw")
    tables.load_raw(docs, path)
    with pytest.raises(ValueError):
        tables.load_raw(docs.limit(0), path)
    with pytest.raises(ValueError, match="legacy"):
        tables.load_raw(docs.where("sourceCollection <> 'legacy'"), path)
    assert tables.scan_raw(spark, path).count() == 4
    tables.load_raw(docs.limit(0), path, sources=["legacy"], allow_empty=True)
    counts = {r[0]: r[1] for r in tables.count_by_source(tables.scan_raw(spark, path)).collect()}
    assert counts == {"survey": 2, "foundation": 1}
    tables.load_raw(docs.limit(0), path, allow_empty=True)
    assert tables.scan_raw(spark, path).count() == 0


def test_counts_that_disagree_show(docs):
    loaded = docs.where("fdcId <> 2")
    landed = tables.count_by_source(docs, "landed")
    got = {r["sourceCollection"]: tuple(r)[1:] for r in tables.verify_counts(landed, loaded).collect()}
    assert got == {"survey": (2, 1, False), "legacy": (1, 1, True), "foundation": (1, 1, True)}


@pytest.mark.parametrize("rebalance", [False, True])
def test_labelled_table_keeps_its_boolean_partition(spark, docs, tmp_path, rebalance):
    path = str(tmp_path / "labeled")
    labeled = label_foods(docs, SPARK_PATH)
    back = tables.write_labeled(labeled, path, rebalance=rebalance)
    assert dict(back.dtypes)["isHealthy"] == "boolean"
    assert plain(back) == plain(labeled)
    assert tables.scan_labeled(spark, path).where("isHealthy").count() == 1


def test_result_table(spark, tmp_path):
    result = spark.createDataFrame([(1, [("a", 2.0)])], "id long, entries array<struct<name string, v double>>")
    assert tables.write_table(result, str(tmp_path / "t")).collect() == result.collect()
