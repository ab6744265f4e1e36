import json

import pytest
from pyspark.sql import functions as F

from larder.sources import tables, versions

FULL = [(1008, 100.0), (1003, 6.0), (1004, 1.0)]


@pytest.fixture
def docs(foods):
    return foods((1, "A", "survey", FULL), (2, None, "survey", []), (3, "B", "legacy", [(1008, None)]), (4, "C", "foundation", None))


def ids(df):
    return sorted(r["fdcId"] for r in df.collect())


def commits(path):
    return sorted(p.name for p in (path / "data").iterdir() if p.name.startswith("commit="))


def test_a_load_that_fails_half_way_leaves_all_old_rows(spark, docs, foods, tmp_path):
    path = str(tmp_path)
    tables.load_raw(docs, path)
    new = foods((7, "Z", "survey", FULL), (8, "Z", "legacy", FULL), (9, "Z", "foundation", FULL))
    broken = new.withColumn("fdcId", F.when(F.col("sourceCollection") == "legacy", F.raise_error(F.lit("broken"))).otherwise(F.col("fdcId")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        tables.load_raw(broken, path)
    assert ids(tables.scan_raw(spark, path)) == [1, 2, 3, 4]
    assert len(commits(tmp_path)) == 1 and versions.numbers(spark, path) == [1]


def test_a_reader_that_started_before_keeps_its_version(spark, docs, foods, tmp_path):
    path = str(tmp_path)
    tables.load_raw(docs, path)
    before = tables.scan_raw(spark, path)
    tables.load_raw(foods((7, "Z", "survey", FULL)), path, sources=["survey"])
    assert ids(before) == [1, 2, 3, 4]
    assert ids(tables.scan_raw(spark, path)) == [3, 4, 7]
    assert ids(tables.scan_raw(spark, path, version=1)) == [1, 2, 3, 4]
    with pytest.raises(FileNotFoundError):
        tables.scan_raw(spark, path, version=9)


def test_unknown_sources_are_refused_or_kept_apart(spark, docs, foods, tmp_path):
    path = str(tmp_path)
    strange = docs.unionByName(foods((5, "D", "branded", FULL), (6, "E", None, []), (7, "F", "a/b=c", FULL)))
    with pytest.raises(ValueError, match="3 documents are of no known source, 1 of them of none; 0 have dirty values"):
        tables.load_raw(strange, path)
    assert versions.numbers(spark, path) == [] and commits(tmp_path) == []
    landed = tables.load_raw(strange, path, unknown="quarantine")
    assert {tuple(r) for r in landed.collect()} == {("survey", "loaded", 2), ("legacy", "loaded", 1), ("foundation", "loaded", 1), (None, "rejected", 3)}
    assert ids(tables.scan_raw(spark, path)) == [1, 2, 3, 4]
    assert {(r.fdcId, r.sourceCollection) for r in tables.scan_rejected(spark, path).collect()} == {(5, "branded"), (6, None), (7, "a/b=c")}
    checked = {r.sourceCollection: (r.landed, r.loaded, r.matches) for r in tables.verify_counts(landed, tables.scan_raw(spark, path)).collect()}
    assert checked == {"survey": (2, 2, True), "legacy": (1, 1, True), "foundation": (1, 1, True), None: (3, 0, False)}
    tables.load_raw(docs, path)
    assert tables.scan_rejected(spark, path).count() == 0
    with pytest.raises(ValueError, match="quarantine"):
        tables.load_raw(docs, path, unknown="drop")


def test_source_names_that_are_no_folder_names(spark, foods, tmp_path):
    names = ["a/b", "x=y", "with blank", "ünï", "q'uote", "a.b%2F"]
    rows = foods(*[(k, "A", name, FULL) for k, name in enumerate(names)])
    tables.load_raw(rows, str(tmp_path), sources=names)
    tables.load_raw(rows.where("fdcId = 1"), str(tmp_path), sources=["x=y"], replace=False)
    got = {(r.fdcId, r.sourceCollection) for r in tables.scan_raw(spark, str(tmp_path)).collect()}
    assert got == set(enumerate(names)) and tables.scan_raw(spark, str(tmp_path)).count() == len(names) + 1


def test_one_pass_over_the_landing(spark, docs, tmp_path):
    docs.coalesce(1).write.parquet(f"{tmp_path}/in")
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    landed = spark.read.parquet(f"{tmp_path}/in").mapInArrow(counting, docs.schema)
    tables.load_raw(landed, f"{tmp_path}/raw")
    assert seen.value == 4


def test_of_two_writers_from_one_version_the_second_fails(spark, docs, tmp_path):
    path = str(tmp_path)
    tables.load_raw(docs, path)
    base = versions.version(spark, path)
    commit, seen = versions.stage(docs, path, ["sourceCollection"])
    assert seen == {"rows": 4}
    tables.load_raw(docs, path)
    with pytest.raises(versions.ConcurrentWrite):
        versions.publish(spark, path, base, [versions.Part(commit, "survey", 2)], "sourceCollection")
    assert versions.numbers(spark, path) == [1, 2] and ids(tables.scan_raw(spark, path)) == [1, 2, 3, 4]
    assert not [n for n in (tmp_path / "_manifests").iterdir() if n.name.startswith("_")]


def test_vacuum_deletes_what_the_last_versions_do_not_name(spark, docs, foods, tmp_path):
    path = str(tmp_path)
    tables.load_raw(docs, path)
    tables.load_raw(foods((7, "Z", "survey", FULL)), path, sources=["survey"])
    tables.load_raw(docs, path)
    tables.load_raw(docs.limit(1), path, replace=False, sources=["survey"])
    assert len(commits(tmp_path)) == 4
    dead = versions.vacuum(spark, path, keep=2)
    assert len(dead) == 2 and len(commits(tmp_path)) == 2 and versions.numbers(spark, path) == [3, 4]
    assert ids(tables.scan_raw(spark, path)) == [1, 1, 2, 3, 4]
    assert ids(tables.scan_raw(spark, path, version=3)) == [1, 2, 3, 4]


def test_labelled_and_result_tables_are_replaced_whole(spark, tmp_path):
    first = spark.createDataFrame([(1, True), (2, False), (3, None)], "n int, isHealthy boolean")
    read = tables.write_labeled(first, f"{tmp_path}/l")
    again = tables.write_labeled(first.where("n > 1"), f"{tmp_path}/l")
    assert {tuple(r) for r in read.collect()} == {(1, True), (2, False), (3, None)} and {tuple(r) for r in again.collect()} == {(2, False), (3, None)}
    assert {json.dumps(r.asDict()) for r in tables.write_table(first, f"{tmp_path}/t").collect()} == {json.dumps(r.asDict()) for r in first.collect()}
    assert tables.write_table(first.limit(0), f"{tmp_path}/t").count() == 0
    assert tables.scan_table(spark, f"{tmp_path}/none", first.schema).count() == 0


def test_replacing_a_table_from_itself(spark, docs, tmp_path):
    path = str(tmp_path)
    tables.load_raw(docs, path)
    tables.load_raw(tables.scan_raw(spark, path).where("fdcId <> 2"), path)
    assert ids(tables.scan_raw(spark, path)) == [1, 3, 4]


def test_models_can_still_be_evaluated_in_the_session(spark, docs, tmp_path):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    tables.load_raw(docs, str(tmp_path))
    scored = spark.createDataFrame([(0.0, 0.2), (1.0, 0.7)], "label double, rawPrediction double")
    assert BinaryClassificationEvaluator().evaluate(scored) == 1.0
