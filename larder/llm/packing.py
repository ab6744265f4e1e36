"""Best-fit packing of encoded documents into sequences, from the histogram of piece lengths.

Pieces of one length are interchangeable, so the plan needs only how many there
are of each: a table bounded by the capacity, whatever the corpus. The driver
matches those counts: pieces above a third of the capacity pair at most twice
per sequence, the largest with the largest that fits; the smaller ones go,
largest first, into the tightest gap that takes them. A piece then finds its
place from its rank among the pieces of its length.

A null or empty text is the end id alone. Repeated rows are packed as often as
they occur. A null id is kept. Other columns are not read. An empty table gives
no row. Longer documents are cut into whole sequences and one rest.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import SMALL_SLICE, documents, kept, mapped, text_slices
from larder.llm.tokens import WordEncoder, vocabulary_path

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, rank long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_pieces(docs: DataFrame, capacity: int, vocabulary: str) -> DataFrame:
    """Pieces of every document with their rank among those of their length in the same task."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = WordEncoder(vocabulary), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            for part, raw, at in text_slices(batch, size=SMALL_SLICE):
                ids, counts = encoder.ids(raw, at)
                out, end = [], 0
                for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                    own = np.append(ids[end : end + n], np.uint32(END_ID)).astype("<u4").tobytes()
                    end += n
                    for k, start in enumerate(range(0, n + 1, capacity)):
                        length = min(capacity, n + 1 - start)
                        out.append((doc_id, k, start, length, zlib.crc32(own[4 * start : 4 * (start + length)]), task, seen[length]))
                        seen[length] += 1
                kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in PIECES.split(", ")])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(columns, pieces, PIECES)


class Plan:
    """Where pieces go: slots by length, each for a run of ranks."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.slots: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # first rank, items a sequence, first sequence, offset
        self.given: dict[int, int] = defaultdict(int)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: runs of sequences (first, number)
        self.widths: list[int] = []
        left = {k: n for k, n in counts.items() if n > 0}
        if full := left.pop(capacity, 0):
            self._put(capacity, full, 1, self._open(full), 0)
        self._match(left)
        for length in sorted((k for k in left if left[k]), reverse=True):
            self._fill(length, left[length])

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _put(self, length: int, items: int, each: int, first: int, offset: int) -> None:
        self.slots[length].append((self.given[length], each, first, offset))
        self.given[length] += items

    def _gap(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if not self.gaps[gap]:
                insort(self.widths, gap)
            self.gaps[gap].append((first, n))

    def _match(self, left: dict[int, int]) -> None:
        """Greedy matching of the pieces above a third: optimal for them, as none of their sequences takes three."""
        large = sorted(k for k in left if 3 * k > self.capacity)
        while large:
            a = large[-1]
            fits = bisect_left(large, self.capacity - a + 1) - 1
            if fits < 0:
                n, first = left[a], self._open(left[a])
                self._put(a, n, 1, first, 0)
                self._gap(self.capacity - a, first, n)
                left[a] = 0
            else:
                b = large[fits]
                n = left[a] // 2 if a == b else min(left[a], left[b])
                if n:
                    first = self._open(n)
                    self._put(a, n, 1, first, 0)
                    self._put(b, n, 1, first, a)
                    self._gap(self.capacity - a - b, first, n)
                    left[a] -= n
                    left[b] -= n
                if a == b and left[a] == 1:  # the odd one of its length: the next shorter one joins it
                    first = self._open(1)
                    self._put(a, 1, 1, first, 0)
                    left[a] = 0
                    gap = self.capacity - a
                    if fits:
                        c = large[fits - 1]
                        self._put(c, 1, 1, first, a)
                        left[c] -= 1
                        gap -= c
                    self._gap(gap, first, 1)
            large = [k for k in large if left[k]]

    def _fill(self, length: int, n: int) -> None:
        """Best fit: the tightest gap first, as many in it as it takes."""
        while n:
            at = bisect_left(self.widths, length)
            if at == len(self.widths):
                each = self.capacity // length
                opened = -(-n // each)
                self._gap(self.capacity, self._open(opened), opened)
                continue
            gap = self.widths[at]
            first, run = self.gaps[gap].pop()
            if not self.gaps[gap]:
                self.widths.pop(at)
            each = min(gap // length, n)
            used = min(run, n // each)
            self._put(length, used * each, each, first, self.capacity - gap)
            self._gap(gap - each * length, first, used)
            self._gap(gap, first + used, run - used)
            n -= used * each

    def table(self) -> dict[int, np.ndarray]:
        return {k: np.array(v, np.int64) for k, v in self.slots.items()}


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Each piece's sequence and offset."""
    pieces = kept(cut_pieces(docs, capacity, vocabulary or vocabulary_path()), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {x.length: x.n for x in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = Plan(counts, capacity).table()
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            kinds, starts = np.unique(length[order], return_index=True)
            for kind, rows in zip(kinds.tolist(), np.split(order, starts[1:])):
                slots = table[kind]
                own = slots[np.searchsorted(slots[:, 0], rank[rows], "right") - 1]
                past = rank[rows] - own[:, 0]
                sequence[rows] = own[:, 2] + past // own[:, 1]
                offset[rows] = own[:, 3] + past % own[:, 1] * kind
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch([*columns, pa.array(sequence), pa.array(offset)], names=[x.split()[0] for x in PLACED.split(", ")])

    ranked = pieces.join(offsets, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "task")
    return mapped(ranked, place, PLACED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
