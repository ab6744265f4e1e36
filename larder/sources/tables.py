"""Parquet tables in versions: raw documents, labelled rows, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from larder.config import DATASETS, FOODS, Layout
from larder.sources import versions
from larder.sources.dirty import PROBLEMS, RAW, TEXT
from larder.sources.schemas import labeled_schema, raw_schema


REJECTED = "rejected"
STATE, ORIGIN = "_state", "_origin"
DETAILS = {PROBLEMS: "array<string>", TEXT: "string"}


def load_raw(
    docs: DataFrame,
    path: str,
    *,
    replace: bool = True,
    allow_empty: bool = False,
    sources: Sequence[str] | None = None,
    unknown: str = "refuse",
    layout: Layout = FOODS,
) -> DataFrame:
    """Load tagged documents into the raw table in one pass; rows by source and state.

    ``replace`` swaps the rows of ``sources``, those of the registry if not given,
    and leaves other sources alone; an empty one is refused, or with
    ``allow_empty`` its old rows go. Otherwise rows are added, and refused only
    if there are none. Rows of any other source, or of none, are counted as well:
    they are refused with the whole load, or with ``unknown="quarantine"`` kept
    apart for :func:`scan_rejected`, those of the last load only. So are rows with
    ``problems``, if :func:`~larder.sources.dirty.parse_documents` made the documents.

    All sources change in one commit (``versions.py``), after the rows counted
    while they were written are known. Malformed input and refusals change nothing.
    """
    if unknown not in ("refuse", "quarantine"):
        raise ValueError(f"unknown is 'refuse' or 'quarantine', not {unknown!r}")
    spark, source = docs.sparkSession, F.col(layout.source)
    named = tuple(dict.fromkeys(d.name for d in DATASETS.values())) if sources is None else tuple(dict.fromkeys(sources))
    known = F.coalesce(source.isin(*named), F.lit(False)) if named else F.lit(False)
    clean = F.coalesce(F.size(PROBLEMS), F.lit(0)) <= 0 if PROBLEMS in docs.columns else F.lit(True)
    details = {c: F.col(c) if c in docs.columns else F.lit(None).cast(kind) for c, kind in DETAILS.items()}
    rejected = F.col(STATE) == REJECTED
    counts = {f"n{i}": F.count_if(~rejected & (source == name)) for i, name in enumerate(named)}
    counts["rejected"] = F.count_if(rejected)
    counts["dirty"] = F.count_if(rejected & (F.size(PROBLEMS) > 0))
    counts["sourceless"] = F.count_if(rejected & F.col(ORIGIN).isNull())

    base = versions.version(spark, path)
    # Rejected rows carry no source as their partition, so that no name can become a folder.
    good = known & clean
    rows = docs.drop(RAW).withColumns(
        {ORIGIN: F.when(~good, source), layout.source: F.when(good, source), STATE: F.when(good, "loaded").otherwise(REJECTED), **details}
    )
    commit, seen = versions.stage(rows, path, [STATE, layout.source], counts)
    loaded = {name: seen[f"n{i}"] for i, name in enumerate(named)}
    try:
        if unknown == "refuse" and seen["rejected"]:
            strange = seen["rejected"] - seen["dirty"]
            raise ValueError(f"{strange} documents are of no known source, {seen['sourceless']} of them of none; {seen['dirty']} have dirty values")
        empty = [name for name, n in loaded.items() if not n]
        if not allow_empty and empty and (replace or len(empty) == len(named)):
            raise ValueError(f"no documents to load of {', '.join(empty)}")
        old = [p for p in base.of() if not (replace and p.value in named)]
        new = [versions.Part(commit, name, n) for name, n in loaded.items() if n]
        if seen["rejected"]:
            new.append(versions.Part(commit, None, seen["rejected"], REJECTED))
        versions.publish(spark, path, base, [*old, *new], layout.source)
    except BaseException:
        versions.discard(spark, path, commit)
        raise
    result = [(name, "loaded", n) for name, n in loaded.items()]
    apart = [(None, REJECTED, seen["rejected"])] if seen["rejected"] else []
    return spark.createDataFrame(result + apart, f"{layout.source} string, state string, landed long")


def scan_raw(
    spark: SparkSession, path: str, schema: StructType | None = None, version: int | None = None
) -> DataFrame:
    """The raw table, the newest version if none is given."""
    return versions.read(spark, path, schema or raw_schema(), versions.version(spark, path, version))


def scan_rejected(
    spark: SparkSession, path: str, schema: StructType | None = None, *, details: bool = False, layout: Layout = FOODS
) -> DataFrame:
    """Documents that the last load kept apart, with the source they came with; ``details`` adds their problems and text."""
    schema = schema or raw_schema()
    more = [StructField(ORIGIN, StringType()), *_parse_datatype_string(", ".join(f"{c} {k}" for c, k in DETAILS.items())).fields]
    rows = versions.read(spark, path, StructType([*schema.fields, *more]), state=REJECTED)
    return rows.withColumn(layout.source, F.col(ORIGIN)).drop(ORIGIN, *(() if details else DETAILS))


def count_by_source(docs: DataFrame, name: str = "row_count", layout: Layout = FOODS) -> DataFrame:
    return docs.groupBy(layout.source).agg(F.count("*").alias(name))


def verify_counts(landed: DataFrame, loaded: DataFrame, layout: Layout = FOODS) -> DataFrame:
    """Rows counted before loading, rows in the table, and whether they agree.

    ``landed`` is what :func:`load_raw` returned, counted as it wrote, so the landing
    is not read again; rows it rejected show as a row without source that does not match.
    """
    return (
        landed.drop("state")
        .join(F.broadcast(count_by_source(loaded, "loaded", layout)), layout.source, "left")
        .withColumn("loaded", F.coalesce("loaded", F.lit(0)))
        .withColumn("matches", F.col("landed") == F.col("loaded"))
    )


def write_labeled(labeled: DataFrame, path: str, *, rebalance: bool = False) -> DataFrame:
    """Replace the labelled table and return it as read back.

    ``rebalance`` evens out the files. Rows labelled per document were never
    shuffled, and a labelled row is far smaller than its document, so every
    scan task would leave two small files; with it a task writes one partition,
    and adaptive execution splits the larger one.
    """
    rows = labeled.hint("rebalance", "isHealthy") if rebalance else labeled
    versions.replace(rows, path, "isHealthy", (True, False, None))
    return scan_labeled(labeled.sparkSession, path, labeled.schema)


def scan_labeled(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """The labelled table. The schema keeps the partition column boolean; discovery would make it a string."""
    return versions.read(spark, path, schema or labeled_schema())


def write_table(result: DataFrame, path: str) -> DataFrame:
    """Replace a result table and return it as read back."""
    versions.replace(result, path)
    return scan_table(result.sparkSession, path, result.schema)


def scan_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return versions.read(spark, path, schema)
