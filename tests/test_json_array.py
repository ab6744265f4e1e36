import json
import random
from pathlib import Path

import pyarrow as pa
import pytest

from larder.sources import json_array, snapshots
from larder.sources.schemas import document_schema

STRINGS = ['a "quoted" {brace', "back\\slash", "}\\", '\\"}', "[{,]}", "", "ünïcode 日本 \U0001f600", "line\nbreak\ttab", '"', "\\\\\"}{", "x" * 5000, "}" * 300, '{"a": [1, "}"]}']


def documents(n, seed=1):
    rng = random.Random(seed)
    for k in range(n):
        measures = [{"nutrientId": rng.randint(1, 9), "nutrientName": rng.choice(STRINGS), "unitName": "}", "value": rng.random()} for _ in range(rng.randint(0, 4))]
        doc = {"fdcId": k, "description": rng.choice(STRINGS), "foodCategory": rng.choice(STRINGS), "foodNutrients": measures, "other": {"deep": [[{}], {"x": "]"}]}}
        if k % 7 == 0:
            del doc["foodNutrients"]
        yield doc


@pytest.fixture
def small_stretches(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows(df):
    return sorted(json.dumps(r.asDict(True), sort_keys=True) for r in df.collect())


@pytest.mark.parametrize("form", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": 1}])
def test_equal_to_the_one_task_reader(spark, small_stretches, tmp_path, form):
    path = tmp_path / "a.json"
    path.write_text(json.dumps(list(documents(400)), **form), encoding="utf-8")
    schema = document_schema()
    found = json_array.read_array(spark, str(path), schema)
    whole = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(str(path))
    assert whole.rdd.getNumPartitions() == 1 and spark.read.text(str(path), lineSep="}").rdd.getNumPartitions() > 10
    assert rows(found) == rows(whole) and found.count() == 400


def test_batches_and_elements_longer_than_a_stretch(spark, small_stretches, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    docs = [{"fdcId": 1, "description": "}{\\\"" * 30_000}, {"fdcId": 2, "foodNutrients": [{"nutrientId": k, "unitName": "}"} for k in range(3000)]}, {"fdcId": 3}]
    try:
        (tmp_path / "a.json").write_text(json.dumps(docs))
        (tmp_path / "b.json").write_text("﻿ \n" + json.dumps(list(documents(60, 5)), indent=1) + " \n\n", encoding="utf-8")
        (tmp_path / "c.json").write_text(" [ ] ")
        schema = document_schema()
        found = json_array.read_array(spark, str(tmp_path), schema)
        want = [json.loads(json.dumps(d)) for d in docs] + list(documents(60, 5))
        got = {(r.fdcId, r.description, None if r.foodNutrients is None else len(r.foodNutrients)) for r in found.collect()}
        assert got == {(d["fdcId"], d.get("description"), len(d["foodNutrients"]) if "foodNutrients" in d else None) for d in want}
        assert found.count() == 63
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize(
    "text",
    ['[{"fdcId": 1}', '{"fdcId": 1}', '[{"fdcId": 1} {"fdcId": 2}]', '[{"fdcId": 1},]', '[1]', '[{"fdcId": 1}] x', '[{"fdcId": "x}]', '[{"fdcId": 1},, {}]', '[[{"fdcId": 1}]]', '[{"fdcId": 1}]]', '[{"fdcId": tru}]', ""],
)
def test_what_is_no_array_of_objects_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    if text:
        with pytest.raises(Exception, match="MALFORMED"):
            json_array.read_array(spark, str(tmp_path / "a.json"), document_schema()).collect()
    else:
        assert json_array.read_array(spark, str(tmp_path / "a.json"), document_schema()).collect() == []


def test_arrays_landed_and_read_again(spark, foods, tmp_path):
    from larder.config import DATASETS

    docs = foods((1, "A", "survey", [(1008, 5.0)]), (2, None, "survey", []), (3, "B", "legacy", None))
    for dataset in DATASETS.values():
        snapshots.land_array(docs, str(tmp_path), dataset, "2026-03-05")
    assert rows(snapshots.read_sources(spark, str(tmp_path), "2026-03-05", one_array=True)) == rows(docs)


def test_a_landed_array_is_written_line_by_line(spark, foods, tmp_path):
    """A sort that put the end last held the whole source in one task's memory."""
    from larder.config import DATASETS

    survey, legacy, foundation = DATASETS.values()
    docs = foods(*[(k, "A\u00e9", "survey", [(1008, float(k))]) for k in range(60)], (99, "B", "legacy", None)).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for dataset, size in ((survey, 60), (legacy, 1), (foundation, 0)):
            path = snapshots.land_array(docs, str(tmp_path), dataset, "2026-03-05")
            (part,) = [p for p in Path(path).iterdir() if p.name.startswith("part-")]
            text = part.read_text(encoding="utf-8")
            assert len(json.loads(text)) == size and len(text.splitlines()) == size + 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    one = iter([pa.record_batch([pa.array([str(k)])], names=["value"]) for k in range(3)])
    lines = snapshots._array_lines(one)
    assert next(lines).column(0).to_pylist() == ["[0"] and next(one).column(0).to_pylist() == ["1"]
    assert [x.column(0).to_pylist() for x in lines] == [[",2"], ["]"]]
