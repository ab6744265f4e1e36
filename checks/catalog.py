"""The checked queries, one function per key, each ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import workspace as ws
from larder.config import COMPARED_IDS, DATASETS, FEATURES, HEALTH_RULES, HEALTHY_MIN, NUTRIENT_IDS, Rule
from larder.functions.scoring import score
from larder.operators import bootstrap, incremental, label_cube, labeled_queries, measure_vector, models, raw_queries, top_groups
from larder.operators.evaluation import classification_metrics
from larder.operators.labeling import label_counts
from larder.operators.nested import pivot, unnest
from larder.plans import sql_catalog
from larder.plans.labelling import DOCUMENT_PATH, SPARK_PATH, label_foods, wide_frames, widen
from larder.sources import dirty, snapshots, tables
from larder.sources.results import prediction_rows, write_predictions

Query = Callable[[SparkSession, str], DataFrame]

KEY_IDS = tuple(NUTRIENT_IDS.values())
WIDE = ("fdcId", "description", "foodCategory", "dataType", "sourceCollection", *FEATURES)
LABELED = ("healthScore", "isHealthy")

_queries: dict[str, Query] = {}


def _query(function: Query, key: str | None = None) -> Query:
    _queries[key or function.__name__] = function
    return function


def _named(key: str) -> Callable[[Query], Query]:
    return lambda function: _query(function, key)


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _measured() -> list:
    """Sums that change if an id, a value or its place is lost: whole numbers, so the order of adding is no matter."""
    entry = F.col("foodNutrients")
    cents = F.transform(entry, lambda m, k: F.round(F.coalesce(m["value"], F.lit(-1.0)) * 100).cast("long") * (k + 1))
    return [
        F.aggregate(F.transform(entry, lambda m, k: m["nutrientId"] * (k + 1).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"),
        F.aggregate(cents, F.lit(0).cast("long"), lambda a, x: a + x).alias("value_sum"),
        F.size(F.filter(entry, lambda m: m["value"].isNull())).alias("n_unread"),
    ]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        "fdcId", "description", "dataType", "foodCategory", "sourceCollection",
        F.size("foodNutrients").alias("n_nutrients"), *_measured(),
    )


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return raw_queries.of_source(ws.raw_table(spark, sf_dir), name)


# Sources and sinks


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as landed JSON snapshots, one folder per source."""

    def land() -> str:
        root = f"{ws.folder(spark, sf_dir)}/landing"
        for dataset in DATASETS.values():
            snapshots.land_snapshot(ws.raw_table(spark, sf_dir), root, dataset, ws.SNAPSHOT_DATE)
        return root

    root = ws.once(spark, sf_dir, "landing", land)
    return snapshots.read_sources(spark, root, ws.SNAPSHOT_DATE, extra=ws.COPY)


@_query
def read_snapshot(spark, sf_dir):
    return _documents(_landed(spark, sf_dir))


@_query
def read_array(spark, sf_dir):
    """The documents as one JSON array a source, each read by many tasks."""

    def land() -> str:
        root = f"{ws.folder(spark, sf_dir)}/arrays"
        for dataset in DATASETS.values():
            snapshots.land_array(ws.raw_table(spark, sf_dir), root, dataset, ws.SNAPSHOT_DATE)
        return root

    root = ws.once(spark, sf_dir, "arrays", land)
    return _documents(snapshots.read_sources(spark, root, ws.SNAPSHOT_DATE, one_array=True, extra=ws.COPY))


@_query
def scan_raw(spark, sf_dir):
    return _documents(ws.raw_table(spark, sf_dir))


@_query
def load_replace(spark, sf_dir):
    """Loads twice; the second load replaces the first."""
    path = ws.new_folder(spark)
    landed = _landed(spark, sf_dir)
    tables.load_raw(landed, path, allow_empty=True)
    tables.load_raw(landed, path, allow_empty=True)
    return _documents(tables.scan_raw(spark, path, ws.RAW_SCHEMA))


@_query
def load_append(spark, sf_dir):
    """Loads everything, then adds the foundation documents once more."""
    path = ws.new_folder(spark)
    tables.load_raw(ws.raw_table(spark, sf_dir), path, allow_empty=True)
    added = _source(spark, sf_dir, "foundation")
    tables.load_raw(added, path, replace=False, sources=["foundation"], allow_empty=True)
    return tables.count_by_source(tables.scan_raw(spark, path, ws.RAW_SCHEMA))


@_query
def verify_counts(spark, sf_dir):
    landed = tables.load_raw(_landed(spark, sf_dir), path := ws.new_folder(spark), allow_empty=True)
    return tables.verify_counts(landed, tables.scan_raw(spark, path, ws.RAW_SCHEMA))


@_query
def load_replace_empty(spark, sf_dir):
    """One source is emptied by a second load; the others stay."""
    path = ws.new_folder(spark)
    raw = ws.raw_table(spark, sf_dir)
    tables.load_raw(raw, path, allow_empty=True)
    tables.load_raw(raw.limit(0), path, sources=["legacy"], allow_empty=True)
    return _documents(tables.scan_raw(spark, path, ws.RAW_SCHEMA))


@_query
def load_rejects(spark, sf_dir):
    """Rows by source and state after a load that knows two sources; every tenth document has lost its source."""
    path = ws.new_folder(spark)
    lost = F.when(F.col("fdcId") % 10 == 0, None).otherwise(F.col("sourceCollection"))
    docs = ws.raw_table(spark, sf_dir).withColumn("sourceCollection", lost)
    tables.load_raw(docs, path, sources=["survey", "legacy"], unknown="quarantine", allow_empty=True)
    loaded = tables.scan_raw(spark, path, ws.RAW_SCHEMA).withColumn("state", F.lit("loaded"))
    rejected = tables.scan_rejected(spark, path, ws.RAW_SCHEMA).withColumn("state", F.lit("rejected"))
    return loaded.unionByName(rejected).groupBy("sourceCollection", "state").agg(F.count("*").alias("row_count"), F.sum("fdcId").alias("id_sum"))


def _dirty(spark: SparkSession, sf_dir: str) -> str:
    """A table loaded from texts: some values are text, some are none at all, some documents end early."""

    def load() -> str:
        docs = ws.raw_table(spark, sf_dir)
        fields = [c for c in docs.columns if c != "sourceCollection"]
        text, key = F.to_json(F.struct(*fields)), F.col("fdcId")
        value = r'"value":(-?[0-9.E-]+)'
        text = F.when(key % 13 == 0, F.regexp_replace(text, value, '"value":"n/a"')).when(key % 11 == 0, F.regexp_replace(text, value, '"value":"$1"')).otherwise(text)
        cut = F.when(key % 17 == 0, F.expr("left(value, length(value) - 5)")).otherwise(F.col("value"))
        lines = docs.select("fdcId", text.alias("value"), "sourceCollection").select(cut.alias("value"), "sourceCollection")
        path = ws.new_folder(spark)
        tables.load_raw(dirty.parse_documents(lines, extra=ws.COPY), path, unknown="quarantine", allow_empty=True)
        return path

    return ws.once(spark, sf_dir, "dirty", load)


@_query
def load_dirty(spark, sf_dir):
    """The documents whose values all fit the schema."""
    return _documents(tables.scan_raw(spark, _dirty(spark, sf_dir), ws.RAW_SCHEMA))


@_query
def load_dirty_rejects(spark, sf_dir):
    """The others by source and problem."""
    apart = tables.scan_rejected(spark, _dirty(spark, sf_dir), ws.RAW_SCHEMA, details=True)
    problem = F.explode("problems").alias("problem")
    return apart.select("sourceCollection", problem).groupBy("sourceCollection", "problem").agg(F.count("*").alias("row_count"))


@_query
def load_refused(spark, sf_dir):
    """A load that is refused after its rows were staged leaves the table as it was."""
    path = ws.new_folder(spark)
    raw = ws.raw_table(spark, sf_dir)
    tables.load_raw(raw, path, allow_empty=True)
    try:
        tables.load_raw(raw.withColumn("sourceCollection", F.lit("elsewhere")), path, allow_empty=True)
    except ValueError:
        return _documents(tables.scan_raw(spark, path, ws.RAW_SCHEMA))
    raise AssertionError("documents of no known source were loaded")


@_query
def load_versions(spark, sf_dir):
    """Rows by source in each of three versions: loaded, one source replaced by half of it, one added once more."""
    path = ws.new_folder(spark)
    raw = ws.raw_table(spark, sf_dir)
    tables.load_raw(raw, path, allow_empty=True)
    tables.load_raw(raw.where("sourceCollection = 'survey' AND fdcId % 2 = 0"), path, sources=["survey"], allow_empty=True)
    tables.load_raw(raw.where("sourceCollection = 'legacy'"), path, replace=False, sources=["legacy"], allow_empty=True)
    counts = [
        tables.count_by_source(tables.scan_raw(spark, path, ws.RAW_SCHEMA, version=n)).withColumn("version", F.lit(n)) for n in (1, 2, 3)
    ]
    return reduce(DataFrame.unionByName, counts)


@_query
def write_labeled(spark, sf_dir):
    labeled = ws.label_now(spark, sf_dir, DOCUMENT_PATH)
    path = ws.new_folder(spark)
    return tables.write_labeled(labeled, path).select(
        "sourceCollection", "fdcId", *FEATURES, *LABELED
    )


@_query
def summary_to_table(spark, sf_dir):
    path = ws.new_folder(spark)
    summary = raw_queries.nutrition_summary(_source(spark, sf_dir, "legacy"))
    return raw_queries.nutrition_summary_long(tables.write_table(summary, path))


# Unnest and pivot


@_named("unnest")
def unnest_measurements(spark, sf_dir):
    docs = ws.raw_table(spark, sf_dir).select("fdcId", "copy", "sourceCollection", "foodNutrients")
    return unnest(docs, KEY_IDS)


@_query
def pivot_max(spark, sf_dir):
    return pivot(ws.raw_table(spark, sf_dir), dup="max", grain="id", order_by=("copy",))


@_query
def load_wide_last(spark, sf_dir):
    return widen(ws.raw_table(spark, sf_dir), SPARK_PATH).select(*WIDE)


@_query
def all_foods_union(spark, sf_dir):
    return wide_frames(ws.raw_table(spark, sf_dir))["all_foods"].select(*WIDE)


# Queries over raw documents


@_query
def all_foods_limit(spark, sf_dir):
    return raw_queries.all_foods(_source(spark, sf_dir, "survey"), limit=5)


@_query
def foods_by_category(spark, sf_dir):
    return raw_queries.foods_by_category(_source(spark, sf_dir, "legacy"), "ECONOMY")


@_query
def count_foods_by_category(spark, sf_dir):
    return raw_queries.count_foods_by_category(_source(spark, sf_dir, "legacy"))


@_query
def nutrition_summary(spark, sf_dir):
    return raw_queries.nutrition_summary_long(_summary(_source(spark, sf_dir, "legacy")))


def _summary(docs: DataFrame) -> DataFrame:
    return raw_queries.nutrition_summary(docs, KEY_IDS)


def _as_text(nested: DataFrame, form: str, *fields: str) -> DataFrame:
    """The nested list entry by entry as text with fixed decimals."""
    values = ", ".join(f"n.{field}" for field in fields)
    return nested.withColumn("nutrients", F.expr(f"array_join(transform(nutrients, n -> format_string('{form}', {values})), '; ')"))


@_query
def nutrition_summary_nested(spark, sf_dir):
    return _as_text(_summary(_source(spark, sf_dir, "legacy")), "%s=%.2f/%d", "nutrient", "avg_value", "count")


def _of_all_sources(spark, sf_dir, make):
    """A per-source query over each source in turn."""
    raw = ws.raw_table(spark, sf_dir)
    parts = [
        make(raw_queries.of_source(raw, d.name)).withColumn("sourceCollection", F.lit(d.name)) for d in DATASETS.values()
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def nutrition_summary_all_sources(spark, sf_dir):
    return _of_all_sources(spark, sf_dir, lambda docs: raw_queries.nutrition_summary_long(_summary(docs)))


@_query
def count_foods_all_sources(spark, sf_dir):
    return _of_all_sources(spark, sf_dir, raw_queries.count_foods_by_category)


@_query
def avg_nutrients_all_sources(spark, sf_dir):
    return _of_all_sources(spark, sf_dir, lambda docs: raw_queries.avg_nutrients_long(docs, COMPARED_IDS))


@_query
def avg_nutrients_long(spark, sf_dir):
    return raw_queries.avg_nutrients_long(_source(spark, sf_dir, "foundation"), COMPARED_IDS)


@_query
def avg_nutrients_by_category(spark, sf_dir):
    nested = raw_queries.avg_nutrients_by_category(_source(spark, sf_dir, "foundation"), COMPARED_IDS)
    return _as_text(nested, "%s=%.2f", "nutrient", "avg_value")


@_query
def cross_source_nutrients(spark, sf_dir):
    """Means rounded to four places, since engines add doubles in any order."""
    compared = raw_queries.cross_source_comparison(ws.raw_table(spark, sf_dir), COMPARED_IDS)
    return compared.withColumn("avg_value", F.round("avg_value", 4))


@_query
def top_foods_by_nutrient(spark, sf_dir):
    return raw_queries.top_foods_by_nutrient(_source(spark, sf_dir, "survey"), 1008, 5)


@_query
def top_protein_foods(spark, sf_dir):
    return raw_queries.top_foods_by_nutrient(_source(spark, sf_dir, "legacy"), 1003, 5)


# Labelling


@_query
def label_document(spark, sf_dir):
    return ws.label_now(spark, sf_dir, DOCUMENT_PATH).select(
        "sourceCollection", "fdcId", *FEATURES, *LABELED
    )


@_query
def label_sql(spark, sf_dir):
    return ws.label_now(spark, sf_dir, SPARK_PATH).select(
        "fdcId", "copy", "sourceCollection", *FEATURES, *LABELED, "label"
    )


@_query
def label_other_rules(spark, sf_dir):
    """Other measures, rules, required columns and minimum than the defaults."""
    labeled = label_foods(
        ws.raw_table(spark, sf_dir),
        DOCUMENT_PATH,
        measures={"water": 1051, "fiber": 1079},
        rules=(Rule("water", ">", 40.0), Rule("fiber", "<", 3.0, null_as=9.0)),
        required=("water",),
        minimum=2,
        order_by=("copy",),
    )
    return labeled.select("sourceCollection", "fdcId", "water", "fiber", "healthScore", "isHealthy")


@_named("label_counts")
def label_counts_by_path(spark, sf_dir):
    paths = {
        "document": ws.labeled_by_document(spark, sf_dir),
        "spark": ws.labeled_by_spark(spark, sf_dir),
    }
    counts = [
        label_counts(labeled).select(F.lit(path).alias("path"), "total", "healthy", "unhealthy")
        for path, labeled in paths.items()
    ]
    return counts[0].unionByName(counts[1])


# Queries over labelled rows


@_query
def healthy_foods(spark, sf_dir):
    return labeled_queries.healthy_foods(ws.labeled_by_document(spark, sf_dir), 10)


@_query
def unhealthy_foods(spark, sf_dir):
    return labeled_queries.unhealthy_foods(ws.labeled_by_document(spark, sf_dir), 10)


@_query
def healthiest_and_least(spark, sf_dir):
    return labeled_queries.healthiest_and_least(ws.labeled_by_document(spark, sf_dir))


@_query
def healthy_by_category_long(spark, sf_dir):
    return labeled_queries.healthy_by_category_long(ws.labeled_by_document(spark, sf_dir))


@_query
def avg_score_by_source(spark, sf_dir):
    scores = labeled_queries.avg_score_by_source(ws.labeled_by_document(spark, sf_dir))
    return scores.withColumn("avg_health_score", F.round("avg_health_score", 4))


def _cube(labeled: DataFrame) -> DataFrame:
    cube = label_cube.label_cube(labeled)
    return cube.select("level", "category", "source", "isHealthy", "total", "healthy", "unhealthy", *[F.round(c, 4).alias(c) for c in cube.columns[7:]])


@_named("label_cube")
def cube_by_document(spark, sf_dir):
    return _cube(ws.labeled_by_document(spark, sf_dir))


@_named("label_cube_spark")
def cube_by_spark(spark, sf_dir):
    return _cube(ws.labeled_by_spark(spark, sf_dir))


@_query
def best_and_worst_by_category(spark, sf_dir):
    return top_groups.best_and_worst_by_group(ws.labeled_by_document(spark, sf_dir), n=5)


@_query
def top_foods_every_nutrient(spark, sf_dir):
    return top_groups.top_foods_by_every_nutrient(ws.raw_table(spark, sf_dir), KEY_IDS, 10)


# Measurements by the hundred

# The eight with names, and 492 other ids, most of which no document has.
MANY = {**{f"m{i}": i for i in range(1001, 1500) if i not in KEY_IDS}, **NUTRIENT_IDS}


def _held(vectors: DataFrame, *keys: str) -> DataFrame:
    """The places of a vector that hold a value, a row each."""
    ids = F.array(*[F.lit(i) for i in MANY.values()])
    rows = vectors.select(*keys, F.posexplode("measures").alias("place", "value")).where("value IS NOT NULL")
    return rows.select(*keys, F.get(ids, F.col("place")).alias("nutrientId"), "value")


@_named("measure_vector")
def vector_by_document(spark, sf_dir):
    raw = ws.raw_table(spark, sf_dir)
    vectors = measure_vector.measure_vector(raw, list(MANY.values()), grain="document")
    return _held(vectors, "sourceCollection", "fdcId", "copy")


@_query
def measure_vector_by_id(spark, sf_dir):
    return _held(measure_vector.measure_vector(ws.raw_table(spark, sf_dir), list(MANY.values())), "sourceCollection", "fdcId")


@_query
def label_many_rules(spark, sf_dir):
    """The six rules, and one for each other measurement: absent or below 60."""
    rules = [*HEALTH_RULES, *[Rule(name, "<", 60, null_as=0) for name, key in MANY.items() if key not in KEY_IDS]]
    vectors = measure_vector.measure_vector(ws.raw_table(spark, sf_dir), list(MANY.values()), order_by=("copy",))
    labeled = measure_vector.label_vectors(vectors, list(MANY), rules, minimum=len(rules) - 2, null_compare="lowest")
    return labeled.select("sourceCollection", "fdcId", "foodCategory", "healthScore", "isHealthy", "label")


# Summaries by snapshot date


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four dates; the second is replaced by the half of its documents, the last one is taken out."""

    def make() -> str:
        path = ws.new_folder(spark)
        raw = ws.raw_table(spark, sf_dir)
        for day in range(4):
            incremental.put_date(raw.where(F.col("fdcId") % 4 == day), path, f"2026-03-0{day + 1}", KEY_IDS)
        incremental.put_date(raw.where("fdcId % 8 = 1"), path, "2026-03-02", KEY_IDS)
        incremental.drop_date(spark, path, "2026-03-04")
        return path

    return incremental.scan_states(spark, ws.once(spark, sf_dir, "states", make))


@_query
def incremental_summary(spark, sf_dir):
    return raw_queries.nutrition_summary_long(incremental.nutrition_summary(_states(spark, sf_dir)))


@_query
def incremental_means(spark, sf_dir):
    return incremental.avg_nutrients_long(_states(spark, sf_dir), COMPARED_IDS)


@_query
def incremental_cross_source(spark, sf_dir):
    compared = incremental.cross_source_comparison(_states(spark, sf_dir), COMPARED_IDS)
    return compared.withColumn("avg_value", F.round("avg_value", 4))


# SQL catalogue


def _catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return sql_catalog.run_catalog(spark, ws.labeled_by_spark(spark, sf_dir))


@_query
def sql_count_by_category(spark, sf_dir):
    return _catalog(spark, sf_dir)["count_by_category"]


@_query
def sql_avg_nutrients(spark, sf_dir):
    return _catalog(spark, sf_dir)["avg_nutrients_by_category"]


@_query
def sql_top10_calories(spark, sf_dir):
    return _catalog(spark, sf_dir)["top_10_highest_calorie"]


@_query
def sql_healthy_by_category(spark, sf_dir):
    return _catalog(spark, sf_dir)["healthy_vs_unhealthy_by_category"]


@_query
def sql_cross_source(spark, sf_dir):
    return _catalog(spark, sf_dir)["cross_collection_comparison"]


@_query
def high_protein_low_fat(spark, sf_dir):
    return _catalog(spark, sf_dir)["high_protein_low_fat"]


@_query
def query_timing(spark, sf_dir):
    """The timed queries; the seconds themselves are tested elsewhere."""
    timed = sql_catalog.time_queries(spark, _catalog(spark, sf_dir))
    return timed.select("query", (F.col("elapsed_s") >= 0).alias("was_timed"))


# Models


@_query
def ml_features(spark, sf_dir):
    return models.model_features(ws.labeled_by_spark(spark, sf_dir), keep=("fdcId", "copy"))


@_query
def ml_split(spark, sf_dir):
    return models.split_sizes(ws.labeled_by_spark(spark, sf_dir))


@_named("classification_metrics")
def classification_quality(spark, sf_dir):
    """Scores the other null mode's labels against this path's labels."""
    other = score(null_compare="lowest")
    scored = ws.labeled_by_spark(spark, sf_dir).select(
        "label",
        (other >= HEALTHY_MIN).cast("double").alias("prediction"),
        other.cast("double").alias("rawPrediction"),
    )
    return classification_metrics(scored)


@_query
def metric_intervals(spark, sf_dir):
    """Two simple judges of this path's labels: the other null mode's score, and the calories alone."""
    labeled = ws.labeled_by_spark(spark, sf_dir)
    other = score(null_compare="lowest")
    judges = {
        "other_nulls": ((other >= HEALTHY_MIN).cast("double"), other / 6),
        "calories": ((F.col("calories") < 300).cast("double"), 1 - F.least(F.col("calories"), F.lit(1000.0)) / 1000),
    }
    rows = [
        labeled.select(F.lit(name).alias("model"), F.col("fdcId").alias("key"), "label", said.alias("prediction"), sure.alias("score"))
        for name, (said, sure) in judges.items()
    ]
    return bootstrap.metric_intervals(rows[0].unionByName(rows[1]), tuple(judges), replicates=60, bins=50)


@_query
def rf_metrics(spark, sf_dir):
    return ws.random_forest(spark, sf_dir).metrics


@_query
def rf_predictions(spark, sf_dir):
    return prediction_rows(ws.random_forest(spark, sf_dir).predictions)


@_query
def predictions_csv(spark, sf_dir):
    """Written CSV read back: the columns that do not depend on the model."""
    path = ws.new_folder(spark)
    write_predictions(ws.random_forest(spark, sf_dir).predictions, path)
    read = spark.read.csv(path, header=True, escape='"', nullValue="")
    numbers = [F.col(name).cast("double").alias(name) for name in ("label", *FEATURES)]
    return read.select("description", F.col("foodCategory"), *numbers)


@_query
def rf_importances(spark, sf_dir):
    return ws.random_forest(spark, sf_dir).importances


@_query
def gbt_metrics(spark, sf_dir):
    return ws.boosted_trees(spark, sf_dir).metrics


@_query
def gbt_predictions(spark, sf_dir):
    return prediction_rows(ws.boosted_trees(spark, sf_dir).predictions)


@_query
def gbt_importances(spark, sf_dir):
    return ws.boosted_trees(spark, sf_dir).importances


@_query
def model_comparison(spark, sf_dir):
    return models.compare_models(
        ws.random_forest(spark, sf_dir).metrics, ws.boosted_trees(spark, sf_dir).metrics
    )
