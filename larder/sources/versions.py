"""Tables in versions: data folders that never change, and manifests that say which of them count.

Below a table's folder, ``data/commit=<id>`` holds what one write left, and
``_manifests/<number>.json`` names the commits and partition values that make up a
version, with their rows. A write stages its rows in a new commit, and one rename
of a finished manifest to the next free number makes them the table. Whatever
fails before that leaves the table as it was, and a reader that began earlier goes
on with the files of its version. Two writers that start from one version cannot both
take its next number: the second one fails and leaves nothing.

The rename must not replace a file, which HDFS and local file systems grant; on an
object store use a file system layer that does. :func:`vacuum` deletes what the
last versions do not name.

Rows are counted while they are written, in the write's own tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import or_

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT = "commit"


class ConcurrentWrite(RuntimeError):
    """Another write has taken the version number."""


@dataclass(frozen=True)
class Part:
    """Rows of one commit with one value of the partition column; ``state`` tells rejected rows apart."""

    commit: str
    value: str | bool | None = None
    rows: int = 0
    state: str = "loaded"


@dataclass(frozen=True)
class Version:
    number: int = 0
    parts: tuple[Part, ...] = ()
    partition: str | None = None

    def of(self, state: str = "loaded") -> tuple[Part, ...]:
        return tuple(p for p in self.parts if p.state == state)


def _place(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, files = _place(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table, oldest first; empty if there is no such table."""
    names = _names(spark, f"{path}/_manifests")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version of a table, the newest if not given; one without parts and number 0 if there is none."""
    known = numbers(spark, path)
    if not known and number is None:
        return Version()
    number = known[-1] if number is None else number
    place, files = _place(spark, f"{path}/_manifests/{number:012d}.json")
    if not files.exists(place):
        raise FileNotFoundError(f"{path} has no version {number}")
    stream = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    content = json.loads(text)
    return Version(number, tuple(Part(**p) for p in content["parts"]), content["partition"])


def _counting_session(spark: SparkSession) -> SparkSession:
    """A session of its own for what is observed, with the same settings.

    A session that has observed anything cannot be serialised any more, and the library's
    evaluators of models do that to theirs.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def stage(df: DataFrame, path: str, partition: Sequence[str] = (), metrics: Mapping[str, Column] | None = None) -> tuple[str, dict[str, int]]:
    """Write rows as a new commit that no version names yet; its id and the metrics of exactly these rows."""
    commit, spark, name = uuid.uuid4().hex, df.sparkSession, f"staged_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        seen = Observation()
        rows = _counting_session(spark).table(f"global_temp.{name}")
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()])
        counted.write.partitionBy(*partition).parquet(f"{path}/data/{COMMIT}={commit}")
    except BaseException:
        discard(spark, path, commit)
        raise
    finally:
        spark.catalog.dropGlobalTempView(name)
    return commit, seen.get


def discard(spark: SparkSession, path: str, commit: str) -> None:
    """Delete a commit that no version names."""
    place, files = _place(spark, f"{path}/data/{COMMIT}={commit}")
    files.delete(place, True)


def publish(spark: SparkSession, path: str, base: Version, parts: Sequence[Part], partition: str | None = None) -> Version:
    """Make parts the table's next version after ``base``, by one rename."""
    new = Version(base.number + 1, tuple(parts), partition)
    staged, files = _place(spark, f"{path}/_manifests/_{uuid.uuid4().hex}")
    stream = files.create(staged, False)
    try:
        stream.write(bytearray(json.dumps({"partition": partition, "parts": [asdict(p) for p in new.parts]}).encode()))
    finally:
        stream.close()
    target, _ = _place(spark, f"{path}/_manifests/{new.number:012d}.json")
    jvm = spark._jvm
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(staged), files.makeQualified(target), no_options)
    except Exception as e:
        files.delete(staged, False)
        if files.exists(target):
            raise ConcurrentWrite(f"version {new.number} of {path} was written meanwhile") from e
        raise
    return new


def read(spark: SparkSession, path: str, schema: StructType, of: Version | None = None, state: str = "loaded") -> DataFrame:
    """Rows of a version, the newest if not given."""
    chosen = of or version(spark, path)
    parts = chosen.of(state)
    if not parts:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{COMMIT}={c}" for c in sorted({p.commit for p in parts})])
    if chosen.partition:
        # Partition filters: folders of other values are not listed among the files to scan.
        named = [(F.col(COMMIT) == p.commit) & F.col(chosen.partition).eqNullSafe(F.lit(p.value)) for p in parts]
        rows = rows.where(reduce(or_, named))
    return rows.select(*schema.fieldNames())


def replace(df: DataFrame, path: str, partition: str | None = None, values: Sequence[str | bool | None] = ()) -> Version:
    """Replace a whole table; ``values`` are all that the partition column may have."""
    spark, base = df.sparkSession, version(df.sparkSession, path)
    counts = {f"v{i}": F.count_if(F.col(partition).eqNullSafe(F.lit(v))) for i, v in enumerate(values)} if partition else {}
    commit, seen = stage(df, path, [partition] if partition else [], counts)
    if partition:
        parts = [Part(commit, v, seen[f"v{i}"]) for i, v in enumerate(values) if seen[f"v{i}"]]
    else:
        parts = [Part(commit, None, seen["rows"])]
    try:
        if partition and sum(p.rows for p in parts) != seen["rows"]:
            raise ValueError(f"{partition} has other values than {list(values)}")
        return publish(spark, path, base, parts, partition)
    except BaseException:
        discard(spark, path, commit)
        raise


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the manifests before the last ``keep`` and all commits that the others do not name; the commits deleted.

    Not while a write is under way: its commit is not named yet.
    """
    known = numbers(spark, path)
    live = {p.commit for n in known[-keep:] for p in version(spark, path, n).parts}
    for n in known[:-keep]:
        place, files = _place(spark, f"{path}/_manifests/{n:012d}.json")
        files.delete(place, False)
    dead = [c for n in _names(spark, f"{path}/data") if n.startswith(f"{COMMIT}=") and (c := n.removeprefix(f"{COMMIT}=")) not in live]
    for commit in dead:
        discard(spark, path, commit)
    return dead
