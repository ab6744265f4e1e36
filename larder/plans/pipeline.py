"""The batch in steps: each starts from the tables that the ones before have written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from larder.config import DATASETS
from larder.operators import labeled_queries, raw_queries
from larder.operators.models import (
    compare_models,
    fit_gradient_boosted_trees,
    fit_model,
    fit_random_forest,
)
from larder.operators.saved_models import Basis, evaluate_saved, is_saved, load, save
from larder.plans import ledger
from larder.plans.labelling import DOCUMENT_PATH, SPARK_PATH, label_foods
from larder.plans.sql_catalog import run_catalog, time_queries
from larder.sources.results import (
    OUTPUTS,
    check_outputs,
    write_comparison,
    write_metrics,
    write_predictions,
    write_timing,
)
from larder.sources.snapshots import read_sources
from larder.sources.tables import (
    load_raw,
    scan_labeled,
    scan_raw,
    verify_counts,
    write_labeled,
    write_table,
)


@dataclass(frozen=True)
class Job:
    """Where a run reads and writes, and its settings."""

    landing: str
    warehouse: str
    output: str
    snapshot_date: str
    one_array: bool = False
    num_trees: int = 100
    max_iter: int = 100

    @property
    def ledger(self) -> str:
        return f"{self.warehouse}/ledger"

    @property
    def raw(self) -> str:
        return f"{self.warehouse}/raw_foods"

    @property
    def by_document(self) -> str:
        return f"{self.warehouse}/labeled_by_document"

    @property
    def by_spark(self) -> str:
        return f"{self.warehouse}/labeled_foods"


def ingest(spark: SparkSession, job: Job) -> list[Row]:
    """Load one date's snapshots; landed and loaded rows of each source."""
    landed = read_sources(spark, job.landing, job.snapshot_date, one_array=job.one_array)
    counts = verify_counts(load_raw(landed, job.raw), scan_raw(spark, job.raw)).collect()
    if not all(row["matches"] for row in counts):
        raise RuntimeError("the raw table does not hold what was landed")
    return counts


def label(spark: SparkSession, job: Job) -> list[str]:
    """Label the raw table on both paths."""
    for options, path in ((DOCUMENT_PATH, job.by_document), (SPARK_PATH, job.by_spark)):
        write_labeled(label_foods(scan_raw(spark, job.raw), options), path, rebalance=not options.shuffles)
    return [job.by_document, job.by_spark]


def query(spark: SparkSession, job: Job) -> list[str]:
    """Write the answers over raw documents and labelled rows, and time the catalogue."""
    raw = scan_raw(spark, job.raw)
    results: dict[str, DataFrame] = {"cross_source": raw_queries.cross_source_comparison(raw)}
    for name in (d.name for d in DATASETS.values()):
        own = raw_queries.of_source(raw, name)
        results[f"count_{name}"] = raw_queries.count_foods_by_category(own)
        results[f"summary_{name}"] = raw_queries.nutrition_summary(own)
        results[f"means_{name}"] = raw_queries.avg_nutrients_by_category(own)
    labeled = scan_labeled(spark, job.by_document)
    results["healthy_by_category"] = labeled_queries.healthy_by_category_long(labeled)
    results["score_by_source"] = labeled_queries.avg_score_by_source(labeled)
    results["healthiest_and_least"] = labeled_queries.healthiest_and_least(labeled)
    paths = []
    for name, result in results.items():
        paths.append(f"{job.warehouse}/queries/{name}")
        write_table(result, paths[-1])
    timing = time_queries(spark, run_catalog(spark, scan_labeled(spark, job.by_spark)))
    write_timing(timing, f"{job.output}/query_timing.json")
    return paths


def model_bases(spark: SparkSession, job: Job) -> dict[str, Basis]:
    """What each model of the job is fitted on, by its folder."""
    data = ledger.table_digest(spark, job.by_spark)
    return {
        f"{job.warehouse}/models/random_forest": Basis("random_forest", {"num_trees": job.num_trees, "max_depth": 8}, data),
        f"{job.warehouse}/models/boosted_trees": Basis("boosted_trees", {"max_iter": job.max_iter, "max_depth": 8, "step_size": 0.1}, data),
    }


FITS = {"random_forest": fit_random_forest, "boosted_trees": fit_gradient_boosted_trees}


def train(spark: SparkSession, job: Job) -> list[str]:
    """Fit and save both models, but for those already saved of the same data and settings."""
    labeled, bases = scan_labeled(spark, job.by_spark), model_bases(spark, job)
    for path, basis in bases.items():
        if not is_saved(spark, path, basis):
            fitted = fit_model(labeled, FITS[basis.kind], basis.settings, features=basis.features, key=basis.key, percent=basis.percent)
            save(spark, fitted, basis, path)
    return list(bases)


def score(spark: SparkSession, job: Job) -> list[str]:
    """Score the test part with the saved models, write their predictions and metrics, and compare them."""
    labeled = scan_labeled(spark, job.by_spark)
    scored = [evaluate_saved(load(spark, path, basis), labeled) for path, basis in model_bases(spark, job).items()]
    for prefix, trained in zip(("rf", "gbt"), scored):
        write_metrics(trained.metrics, f"{job.output}/{prefix}_model_metrics.json")
        write_predictions(trained.predictions, f"{job.output}/{prefix}_predictions.csv")
    write_comparison(compare_models(*[trained.metrics for trained in scored]), f"{job.output}/model_comparison.json")
    for trained in scored:
        trained.release()
    return [f"{job.output}/{name}" for name in OUTPUTS if name != "query_timing.json"]


def publish(spark: SparkSession, job: Job) -> list[str]:
    """The published outputs, all committed, none empty, and each what its step has left."""
    return ledger.check(spark, job.ledger, check_outputs(spark, job.output))


STEPS: dict[str, Callable[[SparkSession, Job], list]] = {
    "ingest": ingest,
    "label": label,
    "query": query,
    "train": train,
    "score": score,
    "publish": publish,
}


def inputs_of(spark: SparkSession, job: Job, step: str) -> dict[str, object]:
    """What a step depends on: settings, and the versions of the tables it reads."""
    read = {"label": [job.raw], "query": [job.raw, job.by_document, job.by_spark], "train": [job.by_spark]}
    read["score"] = [job.by_spark, *model_bases(spark, job)] if step == "score" else []
    settings = {"train": [job.num_trees, job.max_iter], "score": [job.num_trees, job.max_iter]}
    settings["ingest"] = [job.landing, job.snapshot_date, job.one_array]
    return {"settings": settings.get(step, []), "tables": {path: ledger.table_digest(spark, path) for path in read.get(step, [])}}


def outputs_of(job: Job, step: str, found: list) -> list[str]:
    """The tables, models and files that a step has left."""
    if step == "ingest":
        return [job.raw]
    return [*found, f"{job.output}/query_timing.json"] if step == "query" else list(found)


def run_pipeline(
    spark: SparkSession, job: Job, first: str = "ingest", last: str = "publish", *, resume: bool = False
) -> dict[str, list]:
    """Run the steps from the first to the last; what each returned.

    Every finished step is noted in the job's ledger. With ``resume`` a step that ran
    on the same inputs is skipped if all it left is unchanged. A date that was landed
    anew needs ``ingest`` again: its files are not compared.
    """
    names = list(STEPS)
    results = {}
    for name in names[names.index(first) : names.index(last) + 1]:
        inputs = inputs_of(spark, job, name) if name != "publish" else {}
        if resume and name != "publish" and ledger.finished(spark, job.ledger, name, inputs):
            results[name] = []
            continue
        results[name] = STEPS[name](spark, job)
        if name != "publish":
            ledger.record(spark, job.ledger, name, inputs, outputs_of(job, name, results[name]))
    return results
