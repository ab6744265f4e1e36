"""What a run has finished: a step's inputs and what each of its outputs holds.

A table is known by the commits of its version, which never change. Files are known by
their number of lines and a digest that does not depend on their order or on how they
are cut: the sum of the lines' hashes. A step counts as finished if it ran on the same
inputs and all it left is still what it left.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources import versions

SCHEMA = "inputs string, output string, lines long, digest string, step string"


class OutputChanged(RuntimeError):
    """An output is not what the step that wrote it has left."""


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def table_digest(spark: SparkSession, path: str) -> str:
    """A digest of the commits that make up a table, which only another version changes."""
    parts = sorted((p.commit, str(p.value), p.rows, p.state) for p in versions.version(spark, path).parts)
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def content(spark: SparkSession, path: str) -> tuple[int, str]:
    """Lines or rows of an output, and a digest of what it holds; -1 and nothing if it is not there."""
    if versions.numbers(spark, path):
        return sum(p.rows for p in versions.version(spark, path).of()), table_digest(spark, path)
    if not exists(spark, path):
        return -1, ""
    hashes = F.sum(F.xxhash64("value").cast("decimal(38,0)"))
    row = spark.read.text(path).agg(F.count("*").alias("n"), F.coalesce(hashes, F.lit(0)).cast("string").alias("digest")).first()
    return row.n, row.digest


def entries(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, spark.createDataFrame([], SCHEMA).schema)


def record(spark: SparkSession, path: str, step: str, inputs: Mapping[str, object], outputs: Iterable[str]) -> None:
    """Note that a step is finished, in place of what was noted of it before."""
    noted = json.dumps(inputs, sort_keys=True)
    rows = [(noted, output, *content(spark, output), step) for output in outputs] or [(noted, None, 0, "", step)]
    base = versions.version(spark, path)
    commit, seen = versions.stage(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, ["step"])
    try:
        others = [p for p in base.of() if p.value != step]
        versions.publish(spark, path, base, [*others, versions.Part(commit, step, seen["rows"])], "step")
    except BaseException:
        versions.discard(spark, path, commit)
        raise


def changes(spark: SparkSession, path: str, step: str | None = None) -> list[str]:
    """Outputs noted in the ledger, or by one of its steps, that are missing or hold something else now."""
    noted = entries(spark, path).where("output IS NOT NULL")
    rows = (noted if step is None else noted.where(F.col("step") == step)).collect()  # a row an output
    return sorted(r.output for r in rows if content(spark, r.output) != (r.lines, r.digest))


def finished(spark: SparkSession, path: str, step: str, inputs: Mapping[str, object]) -> bool:
    """Did the step run on the same inputs, and is all it left still there?"""
    rows = entries(spark, path).where(F.col("step") == step).select("inputs").distinct().collect()
    return [r.inputs for r in rows] == [json.dumps(inputs, sort_keys=True)] and not changes(spark, path, step)


def check(spark: SparkSession, path: str, outputs: Iterable[str]) -> list[str]:
    """The outputs, if each is noted and unchanged."""
    outputs = list(outputs)
    noted = {r.output for r in entries(spark, path).select("output").collect()}
    changed = set(changes(spark, path))
    for output in outputs:
        if output not in noted:
            raise FileNotFoundError(f"no finished step has left {output}")
        if output in changed:
            raise OutputChanged(f"{output} is missing or is not what the run has left")
    return outputs
