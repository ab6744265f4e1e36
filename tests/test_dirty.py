import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from larder.sources import dirty, snapshots, tables

LINES = [
    '{"fdcId": 1, "description": "good", "foodNutrients": [{"nutrientId": 1008, "value": 5}, {"nutrientId": 7}], "brand": {"name": "x"}}',
    '{"fdcId": "2", "description": 12, "foodNutrients": [{"nutrientId": "1008", "value": "12.5"}]}',
    '{"fdcId": 3, "foodNutrients": [{"nutrientId": 1008, "value": "n/a"}, {"nutrientId": 1, "value": "n/a"}]}',
    '{"fdcId": "x4", "foodNutrients": "none"}',
    '{"fdcId": 5, "foodNutrients": null, "foodCategory": null}',
    '{"fdcId": 6, ',
    "[1, 2]",
    "   ",
    '{"fdcId": 7, "foodNutrients": []}',
    '{"fdcId": 99999999999999999999}',
    '{"fdcId": 8, "foodNutrients": [null, {"value": null}]}',
]


@pytest.fixture
def parsed(spark):
    return dirty.parse_documents(spark.createDataFrame([(line, "survey") for line in LINES], "value string, sourceCollection string"))


def test_problems_are_named_and_texts_kept(parsed):
    wrong = {(r.text, tuple(r.problems)) for r in parsed.where(F.size("problems") > 0).collect()}
    assert wrong == {
        (LINES[2], ("foodNutrients.value",)), (LINES[3], ("fdcId", "foodNutrients")), (LINES[5], (dirty.NOT_JSON,)), (LINES[6], (dirty.NOT_JSON,)),
        (LINES[9], ("fdcId",)),
    }


def test_good_documents_are_typed(parsed):
    good = {r.fdcId: r for r in parsed.where(F.size("problems") == 0).collect()}
    assert set(good) == {1, 2, 5, 7, 8}
    assert [(m.nutrientId, m.value) for m in good[1].foodNutrients] == [(1008, 5.0), (7, None)]
    assert good[2].description == "12" and good[2].foodNutrients[0].value == 12.5
    assert good[5].foodNutrients is None and good[7].foodNutrients == [] and good[5].text is None


def test_fields_outside_the_schema_stay_within_reach(parsed):
    rows = parsed.select("fdcId", dirty.field(F.col("raw"), "brand", "struct<name string>").alias("brand")).where("brand IS NOT NULL").collect()
    assert [(r.fdcId, r.brand.name) for r in rows] == [(1, "x")]


def test_loaded_and_set_aside_in_one_commit(spark, parsed, tmp_path):
    path = str(tmp_path)
    with pytest.raises(ValueError, match="5 have dirty values"):
        tables.load_raw(parsed, path, sources=["survey"])
    landed = tables.load_raw(parsed, path, sources=["survey"], unknown="quarantine")
    assert {tuple(r) for r in landed.collect()} == {("survey", "loaded", 5), (None, "rejected", 5)}
    assert sorted(r.fdcId for r in tables.scan_raw(spark, path).collect()) == [1, 2, 5, 7, 8]
    apart = tables.scan_rejected(spark, path, details=True).collect()
    assert {r.text for r in apart} == {LINES[k] for k in (2, 3, 5, 6, 9)} and {r.sourceCollection for r in apart} == {"survey"}


def test_a_clean_snapshot_reads_as_the_strict_reader_does(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(LINES[k] for k in (0, 4, 8)))
    strict = snapshots.read_snapshot(spark, str(tmp_path / "a.json"))
    found = dirty.read_dirty(spark, str(tmp_path / "a.json")).select(*strict.columns)
    assert found.schema.simpleString() == strict.schema.simpleString()
    plain = lambda df: sorted(json.dumps(r.asDict(True), sort_keys=True) for r in df.collect())
    assert plain(found) == plain(strict)


def test_no_shuffle_and_no_python(parsed):
    text = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Arrow" not in text and "BatchEval" not in text


def test_entries_that_are_no_objects_count_and_have_no_problems(spark):
    entries = '[null, 7, "x", [1], {}, {"nutrientId": null, "value": "n/a"}, {"nutrientId": [1], "unitName": {"a": 1}}]'
    (row,) = dirty.parse_documents(spark.createDataFrame([('{"fdcId": 1, "foodNutrients": %s}' % entries,)], "value string")).collect()
    assert len(row.foodNutrients) == 7 and all(m is not None and set(m.asDict().values()) <= {None, '{"a":1}'} for m in row.foodNutrients)
    assert set(row.problems) >= {"foodNutrients.value", "foodNutrients.nutrientId"}


def test_an_array_is_cast_as_a_whole_and_nested_ones_too(spark):
    """A look-up for each field of each entry, four times over, took 0.65 ms a document."""
    inner = StructType([StructField("a b", IntegerType()), StructField("c", StringType())])
    outer = StructType([StructField("n", IntegerType()), StructField("inner", ArrayType(inner))])
    extra = (StructField("more", ArrayType(outer)),)
    lines = [
        '{"more": [{"n": "1", "inner": [{"a b": 2, "c": "x"}, {"a b": "?"}]}, {"n": "?", "inner": 3}, {"inner": null}], "foodNutrients": []}',
        '{"more": [{"n": 1, "inner": [4, {"a b": 5}]}]}',
    ]
    docs = dirty.parse_documents(spark.createDataFrame([(x,) for x in lines], "value string"), extra=extra)
    bad, good = sorted(docs.collect(), key=lambda r: -len(r.problems))
    assert set(bad.problems) == {"more.n", "more.inner", "more.inner.a b"} and bad.text == lines[0]
    assert [(m.n, m.inner and [tuple(i) for i in m.inner]) for m in bad.more] == [(1, [(2, "x"), (None, None)]), (None, None), (None, None)]
    assert good.problems == [] and [tuple(i) for i in good.more[0].inner] == [(None, None), (5, None)]
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") <= 2 * len(docs.columns) + 6
