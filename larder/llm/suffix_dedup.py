"""Suffix-array dedup: maximal repeats of bytes from the common-prefix interval tree.

Suffixes are sampled and dealt out by their anchors (``segments.py``): every
50-byte string has an anchor, so equal strings meet in one bucket. Segments that
are alike are one leaf with its first document. The others' suffixes are sorted
with their longest common prefixes, an enhanced suffix array for each bucket. A
stack scan finds its intervals; those whose occurrences differ in the byte to
their left are maximal repeats, each with all its occurrences. An occurrence
outside the repeat's first document is removed.

A bucket holds the distinct segments of its anchors only. Anchors with more
segments than ``segments.HOT_GROUP`` send their strings one by one, each once a
block, so that no group is gathered whole.

A null or empty text has no bytes. Rows with one id are no sources for each
other. A null id counts as larger than all others. Other columns are not read;
an empty table gives no row. Matches never cross documents.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from larder.llm.common import byte_prefix, documents, flat_ranges
from larder.llm.segments import (
    COVERED, HOT, MESSAGE, MIXED, Answers, Block, Segments, Symbols, Windows, answered, blocked, bucket_of, exchange, judged,
    marked, messages, planes, runs, sent, stretches, unplaned,
)

WINDOW = 50
GRAM = 20
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
SPANS = "doc_id long, start long, n_bytes long"
ANCHORS, SUFFIXES, STRINGS = 1, 2, 3
DIVERSE = -1


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """Stack scan of an enhanced suffix array.

    ``lcp[i]`` is the common prefix of suffixes i and i+1, ``left`` codes the
    symbol before each. Returns first and last suffix, length and smallest
    document of each interval of at least ``least`` that differs to the left.
    """
    out = []
    for first, last in zip(*(x.tolist() for x in runs(lcp >= least))):
        lengths = [*lcp[first:last].tolist(), 0]
        stack: list[list[int]] = []
        for i, (length, before, smallest) in enumerate(zip(lengths, left[first : last + 1].tolist(), doc[first : last + 1].tolist())):
            begin = first + i
            while stack and stack[-1][0] > length:
                node = stack.pop()
                before = before if before == node[2] else DIVERSE
                smallest = min(smallest, node[3])
                begin = node[1]
                if before == DIVERSE:
                    out.append((begin, first + i, node[0], smallest))
            if stack and stack[-1][0] == length:
                top = stack[-1]
                top[2] = before if before == top[2] else DIVERSE
                top[3] = min(smallest, top[3])
            elif length >= least:
                stack.append([length, begin, before, smallest])
    return out


class SuffixArray:
    """Suffixes of at least ``least`` bytes of some strings, sorted, with common prefixes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, doc: np.ndarray, least: int) -> None:
        counts = np.maximum(lengths - least + 1, 0)
        own = np.repeat(np.arange(len(lengths)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        rest = lengths[own] - within
        width = int(lengths.max()) if len(lengths) else 1
        rows = np.zeros((len(own), width), np.uint8)
        flat = flat_ranges(np.arange(len(own)) * width, rest)
        rows.ravel()[flat] = data[flat_ranges(starts[own] + within, rest)]
        order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
        rows = rows[order]
        differ = rows[1:] != rows[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), width) if len(rows) > 1 else np.zeros(0, np.int64)
        self.string, self.within, rest = own[order], within[order], rest[order]
        self.lcp = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
        self.doc = doc[self.string]
        before = data[np.maximum(starts[self.string] + self.within - 1, 0)].astype(np.int64)
        # A string's first byte has nothing before it: unlike all others.
        self.left = np.where(self.within > 0, before, -2 - np.arange(len(order)))
        self.least = least
        self.counts = counts

    def repeats(self) -> list[tuple[int, int, int, int]]:
        return maximal_repeats(self.lcp, self.left, self.doc, self.least)

    def covered(self) -> np.ndarray:
        """For all windows, string by string: does it also start in a string of a smaller document?"""
        before = np.cumsum(self.counts) - self.counts
        at = before[self.string] + self.within
        steps = np.zeros(int(self.counts.sum()) + 1, np.int64)
        for first, last, length, smallest in self.repeats():
            later = at[first : last + 1][self.doc[first : last + 1] > smallest]
            np.add.at(steps, later, 1)
            np.add.at(steps, later + (length - self.least + 1), -1)
        return np.cumsum(steps[:-1]) > 0


class Bytes:
    def __init__(self, block: Block, window: int, gram: int) -> None:
        symbols = [Symbols(byte_prefix(raw), at, texts) for raw, at, texts in stretches(block)]
        self.segments = Segments(symbols, block.ids, window, min(gram, window))


def first_rows(s: Segments, states: np.ndarray, state: int) -> np.ndarray:
    """Rows of the segments with a state that are in the first document."""
    return np.flatnonzero((s.doc == s.doc[s.chosen][s.entry]) & (states[s.entry] == state))


def suffix_messages(block: Block, s: Segments, states: np.ndarray, key: int, buckets: int) -> list[tuple]:
    """The mixed segments' bytes by bucket of their anchors, in the order of the entries."""
    rows = s.chosen[states == MIXED]
    starts, lengths = s.start[rows], s.stop[rows] - s.start[rows] + s.window - 1
    found, begin = np.unique(bucket_of(s.coarse[rows], buckets), return_index=True)
    out = []
    for bucket, a, b in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(rows)]):
        text = block.raw[flat_ranges(starts[a:b], lengths[a:b])].tobytes()
        head = np.array([b - a], np.int64).tobytes()
        out.append((bucket, key, SUFFIXES, head + planes(lengths[a:b].astype(np.uint32)) + planes(s.doc[rows[a:b]]) + text))
    return out


def judged_suffixes(table: pa.Table, window: int) -> pa.Table:
    """Answer a bucket's segments: for each window whether it is in a smaller document."""
    rows = table.to_pylist()
    lengths, docs, texts = [], [], []
    for r in rows:
        blob = memoryview(r["entries"])
        n = int(np.frombuffer(blob[:8], np.int64)[0])
        lengths.append(unplaned(blob[8 : 8 + 4 * n], np.uint32).astype(np.int64))
        docs.append(unplaned(blob[8 + 4 * n : 8 + 12 * n], np.int64))
        texts.append(np.frombuffer(blob[8 + 12 * n :], np.uint8))
    length = np.concatenate(lengths)
    found = SuffixArray(np.concatenate(texts), np.cumsum(length) - length, length, np.concatenate(docs), window).covered()
    out, at = [], 0
    for r, own in zip(rows, lengths):
        n = int((own - window + 1).sum())
        out.append((r["bucket"], r["block"], r["level"], found[at : at + n].astype(np.uint8).tobytes()))
        at += n
    return messages(out)


def removed(block: Block, s: Segments, answers: Answers, buckets: int) -> np.ndarray:
    """Which bytes of a block are removed."""
    states, _ = s.answered(answers, ANCHORS, buckets)
    least = s.doc[s.chosen][s.entry]
    covered = (states[s.entry] == COVERED) | (s.doc > least)
    flags = np.frombuffer(b"".join(answers.raw(SUFFIXES)), np.uint8)
    sizes = np.where(states == MIXED, (s.stop - s.start)[s.chosen], 0)
    at = np.cumsum(sizes) - sizes
    mixed_rows = first_rows(s, states, MIXED)
    starts, own = s.windows(mixed_rows)
    found = starts[flags[flat_ranges(at[s.entry[mixed_rows]], (s.stop - s.start)[mixed_rows])] > 0]
    strings = Windows(s, first_rows(s, states, HOT))
    hot = strings.start[strings.covered(answers.states(STRINGS, strings.entries(), buckets)[0])]
    return marked(
        len(block.raw),
        np.concatenate([s.start[covered], found, hot]),
        np.concatenate([s.stop[covered] + s.window - 1, found + s.window, hot + s.window]),
    )


def _answers(docs: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame, int]:
    blocks, buckets = blocked(docs)

    def anchors_of(block: Block, key: int) -> list[tuple]:
        return sent(Bytes(block, window, gram).segments.entries(), key, ANCHORS, buckets)

    first = exchange(blocks, anchors_of)

    def suffixes_of(block: Block, key: int, answers: Answers) -> pa.Table:
        s = Bytes(block, window, gram).segments
        states, _ = s.answered(answers, ANCHORS, buckets)
        strings = Windows(s, first_rows(s, states, HOT))
        return messages(suffix_messages(block, s, states, key, buckets) + sent(strings.entries(), key, STRINGS, buckets))

    def judge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return judged_suffixes(table, window) if key[1].as_py() == SUFFIXES else judged(table)

    second = answered(blocks, first, suffixes_of, MESSAGE).groupBy("bucket", "level").applyInArrow(judge, MESSAGE)
    return blocks, first.union(second), buckets


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document the bytes and spans removed and a digest of the bytes kept."""
    blocks, answers, buckets = _answers(docs, window, gram)

    def result(block: Block, key: int, got: Answers) -> pa.Table:
        gone = removed(block, Bytes(block, window, gram).segments, got, buckets)
        fresh = gone.copy()
        fresh[1:] &= ~gone[:-1]
        inner = block.at[(block.at > 0) & (block.at < len(gone))]
        fresh[inner] = gone[inner]
        spans, total = (np.concatenate([[0], np.cumsum(x)])[block.at] for x in (fresh, gone))
        out = []
        for k, doc_id in enumerate(block.rows):
            a, b = block.at[k], block.at[k + 1]
            n = int(total[k + 1] - total[k])
            own = block.raw[a:b][~gone[a:b]] if n else block.raw[a:b]
            out.append((doc_id, int(b - a), n, int(spans[k + 1] - spans[k]), sha256(own.tobytes()).hexdigest()))
        kinds = (*[pa.int64()] * 4, pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], names=[x.split()[0] for x in RESULT.split(", ")])

    return answered(blocks, answers, result, RESULT)


def repeat_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The removed spans themselves: one row for each maximal run of bytes."""
    blocks, answers, buckets = _answers(docs, window, gram)

    def result(block: Block, key: int, got: Answers) -> pa.Table:
        gone = removed(block, Bytes(block, window, gram).segments, got, buckets)
        out = []
        for k, doc_id in enumerate(block.rows):
            for a, b in zip(*(x.tolist() for x in runs(gone[block.at[k] : block.at[k + 1]]))):
                out.append((doc_id, a, b - a))
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)], names=[x.split()[0] for x in SPANS.split(", ")])

    return answered(blocks, answers, result, SPANS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir))
