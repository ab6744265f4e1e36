"""One large JSON array read by many tasks.

Spark's text reader cuts a file at closing braces, so tasks start just behind one,
wherever their range of bytes begins. What such a stretch means depends on all before
it: is its start inside a string, and how deep? Both follow from sums. A quote that no
backslash escapes flips "inside a string", so a stretch's start is inside one if
an odd number of quotes comes before it. Each stretch reports its quotes and how far
its brackets go down or up in either case; running sums over the stretches of a
file, one row each, then give every stretch's true start. A second reading
cuts out the array's elements. An element ends with a brace, hence with a
piece, so only what is left at a stretch's two ends is put together across
stretches.

Anything but an array of objects fails the read, as does a file that ends early. (One
closing brace after the array looks like the end of the file and passes.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.sources.workspace import shared_folder

# Stretches whose starts are broadcast: a row of some 100 bytes each.
MAX_STRETCHES = 1_000_000
BLANK = b" \t\r\n"
ELEMENT = r"(?s)^[ \t\r\n]*[\[,][ \t\r\n]*(\{.*)$"
MARK = b"\xef\xbb\xbf"
SUMMARY = "path string, at long, quotes long, out_depth long, in_depth long"
PIECES = "path string, at long, kind int, text string"
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3

_SIGN = np.zeros(256, np.int8)
_SIGN[[ord("{"), ord("[")]] = 1
_SIGN[[ord("}"), ord("]")]] = -1


class MalformedArray(ValueError):
    """MALFORMED: the text is no JSON array of objects."""


def inside_strings(raw: np.ndarray) -> tuple[np.ndarray, int]:
    """For each byte whether an odd number of quotes comes before it; number of quotes. No backslash comes before the first byte."""
    place = np.arange(len(raw))
    quotes = np.flatnonzero(raw == ord('"'))
    plain = np.maximum.accumulate(np.where(raw != ord("\\"), place, -1)) if len(raw) else place
    before = np.where(quotes > 0, plain[quotes - 1], -1)
    quotes = quotes[(quotes - 1 - before) % 2 == 0]
    flips = np.zeros(len(raw) + 1, np.int64)
    flips[quotes + 1] = 1
    return np.cumsum(flips)[:-1] % 2 == 1, len(quotes)


def joined(batch: pa.RecordBatch) -> Iterator[tuple[str, int, bytes, np.ndarray]]:
    """Consecutive rows of one stretch: file, its first byte, their text with the braces, and where each piece ends."""
    paths, starts = batch.column("path"), batch.column("at").to_numpy()
    texts = batch.column("value").cast(pa.binary()).to_pylist()
    names = paths.to_pylist()
    first = 0
    for k in range(1, len(texts) + 1):
        if k == len(texts) or names[k] != names[first] or starts[k] != starts[first]:
            own = texts[first:k]
            ends = np.cumsum([len(t) + 1 for t in own]) - 1
            yield names[first], int(starts[first]), b"}".join(own) + b"}", ends
            first = k


def summaries_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each stretch, or for each part of it that a batch holds: sums, so parts add up."""
    for batch in batches:
        out = []
        for path, at, text, _ in joined(batch):
            raw = np.frombuffer(text, np.uint8)
            inside, quotes = inside_strings(raw)
            sign = _SIGN[raw].astype(np.int64)
            # A part may itself begin inside a string of its stretch; both cases are carried.
            out.append((path, at, quotes, int(sign[~inside].sum()), int(sign[inside].sum())))
        kinds = (pa.string(), *[pa.int64()] * 4)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], names=[x.split()[0] for x in SUMMARY.split(", ")])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The summaries of whole stretches: parts of one follow one another in a task."""
    now: list | None = None
    for batch in summaries_of_parts(batches):
        for row in batch.to_pylist():
            if now and (now[0], now[1]) == (row["path"], row["at"]):
                turned = now[2] % 2 == 1
                own = (row["in_depth"], row["out_depth"]) if turned else (row["out_depth"], row["in_depth"])
                now[2:] = [now[2] + row["quotes"], now[3] + own[0], now[4] + own[1]]
            else:
                if now:
                    yield pa.RecordBatch.from_pylist([dict(zip(("path", "at", "quotes", "out_depth", "in_depth"), now))])
                now = list(row.values())
    if now:
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "at", "quotes", "out_depth", "in_depth"), now))])


def starts_of(stretches: DataFrame) -> DataFrame:
    """Where each stretch starts: inside a string or not, and how deep; and where the file ends."""
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    placed = stretches.withColumn("inside", quotes % 2 == 1)
    own = placed.withColumn("own", F.when(F.col("inside"), F.col("in_depth")).otherwise(F.col("out_depth")))
    return own.select(
        "path", "at", "inside", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("depth"),
        F.sum("own").over(Window.partitionBy("path")).alias("end_depth"), (F.sum("quotes").over(Window.partitionBy("path")) % 2).alias("end_inside"),
    )


def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of whole elements with what separates them from those before, and of the parts at a stretch's two ends."""
    key: tuple[str, int] | None = None
    held: list[bytes] = []
    inside, depth, kind, over = False, 0, WHOLE, False
    for batch in batches:
        out: list[tuple] = []
        states = {(r["path"], r["at"]): (r["inside"], r["depth"]) for r in batch.select(["path", "at", "inside", "depth"]).to_pylist()}
        for path, at, text, ends in joined(batch):
            if (path, at) != key:
                if held:
                    out.append((*key, MIDDLE if kind == HEAD else TAIL, b"".join(held)))
                key, held = (path, at), []
                inside, depth = states[key]
                kind = HEAD if inside or depth > 1 else WHOLE
                over = at > 0 and depth <= 0 and not inside
                if not at and text.startswith(MARK):
                    text, ends = text[len(MARK) :], ends - len(MARK)
            if over:
                _ended(text)
                continue
            raw = np.frombuffer(text, np.uint8)
            within, quotes = inside_strings(raw)
            sign = np.where(within ^ inside, 0, _SIGN[raw]).astype(np.int64)
            level = depth + np.cumsum(sign)
            done = ends[(sign[ends] < 0) & (level[ends] == 1)]
            closed = np.flatnonzero((level <= 0) & (sign < 0))[:1].tolist()
            if closed:
                done, over = done[done < closed[0]], True
            start = 0
            for end in done.tolist():
                out.append((*key, kind, b"".join([*held, text[start : end + 1]])))
                held, start, kind = [], end + 1, WHOLE
            if over:
                last = text[start : closed[0]].strip(BLANK)
                if held or last not in (b"", b"[") or (last and (at or start)):
                    raise MalformedArray(f"MALFORMED array: {last[:60]!r} before its end")
                _ended(text[closed[0] + 1 :])
            elif start < len(text):
                held.append(text[start:])
            inside, depth = bool(inside ^ (quotes % 2 == 1)), int(level[-1])
        yield _rows(out)
    if held:
        yield _rows([(*key, MIDDLE if kind == HEAD else TAIL, b"".join(held))])


def _ended(text: bytes) -> None:
    if text.strip(BLANK + b"}") or text.count(b"}") > 1:
        raise MalformedArray(f"MALFORMED array: {text[:40]!r} after its end")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary())
    path, at, kind, text = (pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds))
    return pa.record_batch([path, at, kind, text.cast(pa.string())], names=["path", "at", "kind", "text"])


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of the arrays in some files, each as JSON text: one column ``value``."""
    pieces = spark.read.text(path, lineSep="}").select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at")
    )
    folder = shared_folder(spark)
    starts_of(pieces.mapInArrow(_summed, SUMMARY)).write.parquet(folder)
    starts = spark.read.parquet(folder)
    # The brace that stands for the end of the file takes the depth one below the array.
    bad = (F.col("end_depth") != -1) | (F.col("end_inside") != 0)
    n, broken = starts.agg(F.count("*"), F.min(F.when(bad, F.col("path")))).first()
    if n > MAX_STRETCHES:
        raise ValueError(f"{n} stretches; read longer ones with spark.sql.files.maxPartitionBytes")
    if broken:
        raise MalformedArray(f"MALFORMED array: {broken} ends early or is no array")
    known = F.broadcast(starts.select("path", "at", "inside", "depth"))
    found = pieces.join(known, ["path", "at"]).mapInArrow(elements, PIECES)
    # Parts of elements: two a stretch at most.
    parts_folder = shared_folder(spark)
    found.write.partitionBy("kind").parquet(parts_folder)
    found = spark.read.schema("path string, at long, text string, kind int").parquet(parts_folder)
    order = Window.partitionBy("path").orderBy("at", "kind")
    ends = found.where(F.col("kind") != WHOLE).select("path", "at", "kind")
    numbered = ends.withColumn("element", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
    parts = found.where(F.col("kind") != WHOLE).join(numbered, ["path", "at", "kind"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "kind", "text"))), lambda p: p["text"]), "")
    torn = parts.groupBy("path", "element").agg(text.alias("text")).select("text")
    texts = found.where(F.col("kind") == WHOLE).select("text").unionByName(torn)
    value = F.regexp_extract("text", ELEMENT, 1)
    wrong = F.raise_error(F.concat(F.lit("MALFORMED array: no object follows a separator in "), F.substring("text", 1, 60)))
    return texts.select(F.when(value == "", wrong).otherwise(value).alias("value"))


def read_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Documents of one or more files that are one JSON array each."""
    return array_elements(spark, path).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("d")).select("d.*")
