"""Dated JSON snapshots, one folder per source and date."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.config import DATASETS, FOODS, Dataset, Layout
from larder.sources.json_array import read_array
from larder.sources.schemas import Extra, document_schema

# Documents in one file of a landed snapshot.
LANDED_ROWS = 50_000


def snapshot_path(root: str, dataset: Dataset, snapshot_date: str) -> str:
    return f"{root}/{dataset.landing}/snapshot_date={snapshot_date}"


def array_path(root: str, dataset: Dataset, snapshot_date: str) -> str:
    """Where a source lands one JSON array a date."""
    return f"{root}/{dataset.landing}/{snapshot_date}.json"


def land_snapshot(
    docs: DataFrame, root: str, dataset: Dataset, snapshot_date: str, layout: Layout = FOODS
) -> str:
    """Write one source's documents as JSON Lines, replacing that date.

    Measured names and units repeat in every line, so the files are compressed. Such a file is read by
    one task; ``LANDED_ROWS`` keeps it small, so that many tasks read a snapshot.
    """
    path = snapshot_path(root, dataset, snapshot_date)
    own = docs.where(F.col(layout.source) == dataset.name).drop(layout.source)
    own.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", LANDED_ROWS).json(path)
    return path


def land_array(
    docs: DataFrame, root: str, dataset: Dataset, snapshot_date: str, layout: Layout = FOODS
) -> str:
    """Write one source's documents as one JSON array in one file, as the sources themselves publish them.

    One task writes the file, line by line; :func:`land_snapshot` is the form for large ones.
    """
    path = array_path(root, dataset, snapshot_date)
    own = docs.where(F.col(layout.source) == dataset.name).drop(layout.source)
    rows = own.select(F.to_json(F.struct(*own.columns)).alias("value"))
    # Without any row no function is called; a null one, wherever it comes, makes an empty array.
    some = rows.unionByName(docs.sparkSession.range(1).select(F.lit(None).cast("string").alias("value")))
    some.coalesce(1).mapInArrow(_array_lines, "value string").write.mode("overwrite").text(path)
    return path


def _array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of one array: each element behind what separates it from the one before, and the end."""
    opener = "["
    for batch in batches:
        texts = batch.column(0).drop_null()
        if len(texts):
            openers = pa.array([opener] + [","] * (len(texts) - 1), texts.type)
            yield pa.record_batch([pc.binary_join_element_wise(openers, texts, "")], names=["value"])
            opener = ","
    yield pa.record_batch([pa.array(["[]" if opener == "[" else "]"])], names=["value"])


def read_snapshot(
    spark: SparkSession,
    path: str,
    *,
    one_array: bool = False,
    extra: Extra = (),
    layout: Layout = FOODS,
) -> DataFrame:
    """Read one snapshot; ``one_array`` is for files that are one JSON array each, read by many tasks.

    Malformed input fails the read instead of turning into nulls.
    """
    schema = document_schema(extra, layout)
    if one_array:
        return read_array(spark, path, schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_sources(
    spark: SparkSession,
    root: str,
    snapshot_date: str,
    datasets: Iterable[Dataset] = tuple(DATASETS.values()),
    *,
    one_array: bool = False,
    extra: Extra = (),
    layout: Layout = FOODS,
) -> DataFrame:
    """The snapshots of one date, each tagged with its source; ``one_array`` reads one JSON array a source."""
    place = array_path if one_array else snapshot_path
    tagged = [
        read_snapshot(spark, place(root, d, snapshot_date), one_array=one_array, extra=extra, layout=layout)
        .withColumn(layout.source, F.lit(d.name))
        for d in datasets
    ]
    return reduce(DataFrame.unionByName, tagged)
