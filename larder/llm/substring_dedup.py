"""Substring dedup by relative Lempel-Ziv parsing against all earlier documents.

Documents are parsed against an index of the segments of every block of
documents (``segments.py``). A factor starts at an indexed segment and grows
greedily while the next segment is indexed under the same source document; a
factor of at least ``window`` words is a duplicate. Where a factor ends, the
windows that reach over its boundary may still be in some earlier document: they
are looked up one by one. A word goes if any window over it also starts in a
document with a smaller id, judged on the input.

A null or empty text has no words. Rows with one id are no sources for each
other. A null id counts as larger than all others. Other columns are not read;
an empty table gives no row. Words are runs of bytes without white space.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from larder.llm.common import documents, prefix_hash, word_hashes
from larder.llm.segments import COVERED, HOT, MESSAGE, MIXED, Answers, Block, Segments, Symbols, Windows, answered, blocked, exchange, judged, marked, messages, sent, stretches

WINDOW = 13
GRAM = 6
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors long"
FACTORS = "doc_id long, start long, n_words long, source_id long"


class Words:
    def __init__(self, block: Block, window: int, gram: int) -> None:
        symbols, first, base = [], [np.zeros(1, np.int64)], 0
        for raw, at, texts in stretches(block):
            hashes, own = word_hashes(raw, at)
            symbols.append(Symbols(prefix_hash(hashes), own, texts))
            first.append(own[1:] + base)
            base += len(hashes)
        self.first, self.number = np.concatenate(first), base
        self.segments = Segments(symbols, block.ids, window, min(gram, window))


def boundary_windows(segments: Segments, states: np.ndarray) -> Windows:
    """Windows of the segments that no source has whole, in their first document."""
    first = segments.doc == segments.doc[segments.chosen][segments.entry]
    return Windows(segments, np.flatnonzero(first & np.isin(states[segments.entry], (MIXED, HOT))))


class Parsed:
    """Which words of a block are duplicates, and its factors."""

    def __init__(self, words: Words, answers: Answers, buckets: int) -> None:
        s = words.segments
        states, source = s.answered(answers, 1, buckets)
        least = s.doc[s.chosen][s.entry]
        covered = (states[s.entry] == COVERED) | (s.doc > least)
        self.source = np.where(covered, np.minimum(source[s.entry], least), -1)
        windows = boundary_windows(s, states)
        found = windows.start[windows.covered(answers.states(2, windows.entries(), buckets)[0])]
        self.removed = marked(
            words.number,
            np.concatenate([s.start[covered], found]),
            np.concatenate([s.stop[covered] + s.window - 1, found + s.window]),
        )
        new = np.ones(len(s.start), bool)  # a factor starts here
        new[1:] = (self.source[1:] != self.source[:-1]) | (s.start[1:] != s.stop[:-1])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(new))[: len(begin)] - 1
        own = covered[begin]
        self.factor_start, self.factor_end = s.start[begin[own]], s.stop[last[own]] + s.window - 1
        self.factor_text, self.factor_source = s.text[begin[own]], self.source[begin[own]]


def _answers(docs: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame, int]:
    blocks, buckets = blocked(docs)

    def segments_of(block: Block, key: int) -> list[tuple]:
        return sent(Words(block, window, gram).segments.entries(), key, 1, buckets)

    first = exchange(blocks, segments_of)

    def windows_of(block: Block, key: int, answers: Answers) -> pa.Table:
        s = Words(block, window, gram).segments
        states, _ = s.answered(answers, 1, buckets)
        return messages(sent(boundary_windows(s, states).entries(), key, 2, buckets))

    second = answered(blocks, first, windows_of, MESSAGE).groupBy("bucket").applyInArrow(judged, MESSAGE)
    return blocks, first.union(second), buckets


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document the words removed and a digest of the words kept."""
    blocks, answers, buckets = _answers(docs, window, gram)

    def result(block: Block, key: int, got: Answers) -> pa.Table:
        words = Words(block, window, gram)
        parsed = Parsed(words, got, buckets)
        data, out = block.raw.tobytes(), []
        factors = np.bincount(parsed.factor_text, minlength=len(block.rows))
        for k, doc_id in enumerate(block.rows):
            a, b = words.first[k], words.first[k + 1]
            own = data[block.at[k] : block.at[k + 1]].split()
            gone = parsed.removed[a:b]
            if n := int(gone.sum()):
                own = [w for w, x in zip(own, gone.tolist()) if not x]
            out.append((doc_id, int(b - a), n, sha256(b" ".join(own)).hexdigest(), int(factors[k])))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], names=[x.split()[0] for x in RESULT.split(", ")])

    return answered(blocks, answers, result, RESULT)


def factors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The factors: a run of words and the first document that has its segments."""
    blocks, answers, buckets = _answers(docs, window, gram)

    def result(block: Block, key: int, got: Answers) -> pa.Table:
        words = Words(block, window, gram)
        p = Parsed(words, got, buckets)
        columns = [
            pa.array([block.rows[k] for k in p.factor_text.tolist()], pa.int64()),
            pa.array(p.factor_start - words.first[p.factor_text], pa.int64()),
            pa.array(p.factor_end - p.factor_start, pa.int64()),
            pa.array(p.factor_source, pa.int64()),
        ]
        return pa.table(columns, names=[x.split()[0] for x in FACTORS.split(", ")])

    return answered(blocks, answers, result, FACTORS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir)).drop("n_factors")
