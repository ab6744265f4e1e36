"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

A test item is a set of five-word shingles (fewer words: the whole item is one).
Its signature holds its shingles of lowest hash, the more the larger its size
class: one more than may be missing at the asked containment, and some spare.
So an item contained in a document has at least ``needed`` signature shingles in
it, however long the document: none is lost. Documents stream past the
signatures of a block of items; candidates are verified on their words.

Items are taken in blocks of bounded bytes, so what a task holds does not grow
with the benchmark. Words are runs without white space, A to Z in lower case.
Null or empty texts and items match nothing; repeated items and rows each get
their rows; other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import SMALL_SLICE, documents, mapped, mixed, prefix_hash, span_hash, text_slices, word_digests, word_spans

WORDS = 5
CONTAINMENT = 0.8
SPARE = 8
BLOCK_BYTES = 8 << 20
MATCHES = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
ASCII_LOWER = bytes(_LOWER.tolist())


def shingle_hashes(raw: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of so many words; the number of the first of each text, and at the end of all."""
    raw = _LOWER[raw]
    starts, ends, first = word_spans(raw, at)
    prefix = prefix_hash(word_digests(raw, starts, ends))
    counts = np.maximum(np.diff(first) - words + 1, 0)
    before = np.concatenate([[0], np.cumsum(counts)])
    begin = np.repeat(first[:-1] - before[:-1], counts) + np.arange(before[-1])
    return span_hash(prefix, begin, begin + words), before


def shingles(text: bytes, words: int) -> set[bytes]:
    own = text.translate(ASCII_LOWER).split()
    return {b" ".join(own[i : i + words]) for i in range(len(own) - words + 1)}


class Items:
    """Signatures of a block of items and the search with them."""

    def __init__(self, rows: list[tuple[int, str]], words: int, containment: float) -> None:
        self.containment, self.items = containment, []
        by_length: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in rows:
            data = (text or "").encode()
            length = min(words, len(data.split()))
            if not length:
                continue
            raw, own = np.frombuffer(data, np.uint8), shingles(data, length)
            hashes = np.unique(shingle_hashes(raw, np.array([0, len(raw)]), length)[0])
            n = len(own)
            missing = floor((1 - containment) * n + 1e-9)
            largest = (1 << n.bit_length()) - 1  # of its size class
            size = min(n, floor((1 - containment) * largest + 1e-9) + SPARE)
            signature = hashes[np.argsort(mixed(hashes))[:size]]
            for h in signature.tolist():
                by_length[length][h].append(len(self.items))
            self.items.append((item_id, own, length, max(1, len(signature) - missing)))
        self.signatures = []
        for length, owners in by_length.items():
            keys = np.array(sorted(owners), np.uint64)
            coarse = np.zeros(1 << 20, bool)
            coarse[keys >> np.uint64(44)] = True
            self.signatures.append((length, keys, coarse, [owners[k] for k in keys.tolist()]))

    def matches(self, raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Number of a text, of an item in it, and the shingles they share."""
        candidates = []
        for length, keys, coarse, owners in self.signatures:
            hashes, before = shingle_hashes(raw, at, length)
            near = np.flatnonzero(coarse[hashes >> np.uint64(44)])
            spot = np.minimum(np.searchsorted(keys, hashes[near]), len(keys) - 1)
            hit = keys[spot] == hashes[near]
            text = np.searchsorted(before, near[hit], "right") - 1
            hits: dict[tuple[int, int], int] = defaultdict(int)
            for t, key in set(zip(text.tolist(), spot[hit].tolist())):
                for item in owners[key]:
                    hits[t, item] += 1
            candidates += [pair for pair, n in hits.items() if n >= self.items[pair[1]][3]]
        found: dict[tuple[int, int], set[bytes]] = {}
        for t, item in sorted(candidates):
            _, own, length, _ = self.items[item]
            if (t, length) not in found:
                found = {k: v for k, v in found.items() if k[0] == t}
                found[t, length] = shingles(raw[at[t] : at[t + 1]].tobytes(), length)
            shared = len(own & found[t, length])
            if shared >= self.containment * len(own) - 1e-9:
                yield t, item, shared


def item_blocks(items: DataFrame, words: int = WORDS, containment: float = CONTAINMENT) -> Iterator[Items]:
    """The items in blocks of about BLOCK_BYTES."""
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = own.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    for k in range(blocks):
        part = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Items([(r.item_id, r.text) for r in part.collect()], words, containment)


def search(docs: DataFrame, items: DataFrame, words: int = WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """One row for each document and item contained in it."""
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = columns.sparkSession.createDataFrame([], MATCHES)
    for block in item_blocks(items, words, containment):

        def run(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, raw, at in text_slices(batch, size=SMALL_SLICE):
                    ids, out = part.column("doc_id").to_pylist(), []
                    for t, item, shared in block.matches(raw, at):
                        item_id, own = block.items[item][:2]
                        out.append((ids[t], item_id, shared, len(own), shared / len(own)))
                    if out:
                        kinds = (*[pa.int64()] * 4, pa.float64())
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in MATCHES.split(", ")])

        found = found.union(mapped(columns, run, MATCHES))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, words: int = WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """The documents that contain no item, with their own columns."""
    names, kept = docs.columns, docs
    for block in item_blocks(items, words, containment):

        def run(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, raw, at in text_slices(batch, size=SMALL_SLICE):
                    clean = np.ones(part.num_rows, bool)
                    clean[[t for t, _, _ in block.matches(raw, at)]] = False
                    yield part.filter(pa.array(clean))

        kept = mapped(kept, run, kept.schema)
    return kept.select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL
), b AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL
), bs AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(w[i : i + least(5, len(w)) - 1], ' '))) AS s
  FROM b WHERE len(w) > 0
), sizes AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY 1
), lengths AS (SELECT DISTINCT n FROM bs
), ds AS (
  SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS s
  FROM d, lengths WHERE len(w) >= n
)
SELECT doc_id, item_id, count(*)::BIGINT AS n_shared, any_value(n_shingles)::BIGINT AS n_shingles, count(*)::DOUBLE / any_value(n_shingles) AS containment
FROM ds JOIN bs USING (n, s) JOIN sizes USING (item_id)
GROUP BY 1, 2 HAVING count(*) >= 0.8 * any_value(n_shingles) - 1e-9
"""
