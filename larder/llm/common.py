"""Helpers that the operators share: tables, folders, batches of whole texts."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from functools import wraps
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from larder.sources.workspace import shared_folder

# Texts are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
# Where arrays of some tens of bytes for each byte are made.
SMALL_SLICE = 1 << 18
# What Spark hands to a worker at once. JVM and worker hold several copies of it, and its own bound of 64 MB a task is a lot beside two cores' heap.
BATCH_BYTES = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Longer words are hashed by a digest of their bytes.
SUMMED_BYTES = 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a new folder that all executors share, and read again.

    The shuffles behind them are not needed any more. Spark's cleaner drops their
    files when the driver collects its garbage, which a small driver rarely does
    by itself while the disks fill.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def fold(column: str, folds: int) -> F.Column:
    """crc32 of an id as text, modulo a number of folds; a null id falls in no fold."""
    return F.crc32(F.col(column).cast("string")) % folds


def lowest_of_each(rows: DataFrame, label: str, totals: dict, most: int) -> DataFrame:
    """At most so many rows of each label, those with the lowest hash ``place`` first.

    Of a label with many rows only about twice as many get to the window, by their hash.
    """
    shares = [min(2**63 - 1, int(2**64 * 2 * most / n) - 2**63) for n in totals.values()]
    schema = rows.select(label).schema.add("limit", "long")
    # A list would go through workers of another kind, which stay in the executors beside those that run the rows.
    limits = rows.sparkSession.createDataFrame(pa.Table.from_arrays([pa.array(totals), pa.array(shares)], names=schema.names).cast(to_arrow_schema(schema)), schema)
    first = Window.partitionBy(label).orderBy("place", "doc_id")
    near = rows.join(F.broadcast(limits), label).filter("place <= limit").drop("limit")
    return near.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= most).drop("_n")


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A worker's function that in the end hands back what Arrow holds free: a worker waits for its next task in the same executor as others."""

    @wraps(run)
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return own


def small_batches(spark: SparkSession) -> None:
    """From now on batches of at most about BATCH_BYTES, if the session does not name a bound of its own; one longer row is a batch."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def usual_batches(spark: SparkSession) -> None:
    """The session's bound again, for what follows the batches in its last digits."""
    if spark.conf.get(BATCH_SETTING, None) == str(BATCH_BYTES):
        spark.conf.unset(BATCH_SETTING)


def mapped(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """mapInArrow by small batches, in workers that hand back what Arrow holds free."""
    small_batches(rows.sparkSession)
    return rows.mapInArrow(frugal(run), schema)


def text_slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of a batch with the UTF-8 bytes of their texts and the texts' offsets; null is empty."""
    array = batch.column(column)
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(array):
        end = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
        end = min(end, len(array))
        yield batch.slice(start, end - start), raw[at[start] : at[end]], at[start : end + 1] - at[start]
        start = end


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start+1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


# White space of the words `[^\\x20\\x09-\\x0D]+`.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SYMBOLS = np.random.default_rng(17).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the powers 0 to n-1, modulo 2 to the 64th."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        _powers[int(base)] = known = np.multiply.accumulate(known)
    return known[:n]


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Sums from which span_hash() takes the hash of any run of 64-bit symbols."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(_BASE, len(symbols)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs from starts to ends."""
    sums = (prefix[ends] - prefix[starts]) * powers(_INVERSE, len(prefix))[starts]
    return mixed(sums + (ends - starts).astype(np.uint64))


def run_hashes(prefix: np.ndarray, length: int) -> np.ndarray:
    """span_hash() of all runs of one length."""
    sums = prefix[length:] - prefix[:-length]
    sums *= powers(_INVERSE, len(sums))
    sums += np.uint64(length)
    return mixed(sums)


def byte_prefix(raw: np.ndarray) -> np.ndarray:
    return prefix_hash(_SYMBOLS[raw])


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words; the number of the first word of each text, and at the end of all."""
    n = len(raw)
    inside = ~IS_SPACE[raw]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[at] = True
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:] = ~inside[:-1]
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:n]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_digests(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word.

    Sums of powers modulo 2 to the 64th collide for some long words whatever the base
    (those of Thue and Morse, the more bits the longer they are), so words of more
    than ``SUMMED_BYTES`` are digested one by one.
    """
    out = span_hash(byte_prefix(raw), starts, ends)
    long = np.flatnonzero(ends - starts > SUMMED_BYTES)
    if len(long):
        data = memoryview(raw)
        digests = [blake2b(data[a:b], digest_size=8).digest() for a, b in zip(starts[long].tolist(), ends[long].tolist())]
        out[long] = np.frombuffer(b"".join(digests), np.uint64)
    return out


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word; the number of the first word of each text, and at the end of all."""
    starts, ends, first = word_spans(raw, at)
    return word_digests(raw, starts, ends), first
