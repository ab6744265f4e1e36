"""Windows of symbols that also start in a document with a smaller id, found by exchanging fingerprints.

Documents are dealt into blocks of bounded bytes. Every window of ``window``
symbols has an anchor: its run of ``gram`` symbols of lowest hash. Neighbouring
windows with one anchor form a segment, about two for ``window - gram`` symbols.
A block sends each distinct segment once, with the smallest of its ids, as the
fingerprints of anchor and segment; so a passage in a third of all documents
costs one entry a block. Buckets of anchors answer every entry:

- COVERED: the same segment is in a document with a smaller id, which is named;
- MIXED: this is a segment's first document, but other segments with the anchor
  agree with it on one side, so single windows may be shared; HOT: very many do,
  in a bucket or in any one block;
- ALONE: none of its windows is anywhere else.

Fingerprints have 96 bits at least, besides the equality of bucket and side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import SLICE_BYTES, flat_ranges, mixed, run_hashes, span_hash

# A block's texts together; one longer text is a block's too. Larger blocks make fewer, longer messages.
BLOCK_BYTES = 4 << 20
LEAST_BLOCKS = 64
ALONE, COVERED, MIXED, HOT = 0, 1, 2, 3
# A group of more distinct segments than this sends single windows instead of segments.
HOT_GROUP = 2048
# An anchor with more distinct segments than this in one block sends one mark instead: all blocks then send its windows.
BLOCK_GROUP = 16
MARK = np.uint32(2**32 - 1)
NO_ID = np.iinfo(np.int64).max
MESSAGE = "bucket long, block long, level int, entries binary"


def blocked(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text and the block of each document; number of blocks."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(LEAST_BLOCKS, -(-total // BLOCK_BYTES))
    return own.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))), blocks


class Block:
    """The rows of one block in a fixed order, with the bytes of all texts."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        text = table.column("text").cast(pa.large_string()).combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        _, offsets, data = text.buffers()
        at = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.raw, self.at = raw[at[0] : at[-1]], at - at[0]
        ids = table.column("doc_id").combine_chunks()
        self.rows = ids.to_pylist()
        self.ids = np.array([NO_ID if x is None else x for x in self.rows], np.int64)


class Symbols:
    """A stretch of a block's texts as symbols: sums to hash runs of them, and the first symbol of each text and at the end of all."""

    def __init__(self, prefix: np.ndarray, first: np.ndarray, texts: slice) -> None:
        self.prefix, self.first, self.texts = prefix, first, texts


def stretches(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """Bytes, offsets and numbers of the block's texts, in stretches of about SLICE_BYTES to bound memory."""
    start, at = 0, block.at
    while start < len(at) - 1:
        end = min(max(start + 1, int(np.searchsorted(at, at[start] + SLICE_BYTES, "right")) - 1), len(at) - 1)
        yield block.raw[at[start] : at[end]], at[start : end + 1] - at[start], slice(start, end)
        start = end


class Segments:
    """Segments of a block; ``start`` and ``stop`` are of their windows, in symbols of the block."""

    def __init__(self, symbols: list[Symbols], ids: np.ndarray, window: int, gram: int) -> None:
        self.window = window
        self.bases = np.cumsum([0, *[len(x.prefix) - 1 for x in symbols]])
        self.prefixes = [x.prefix for x in symbols]
        parts = [_segments(x.prefix, x.first, window, gram) for x in symbols] or [_segments(np.zeros(1, np.uint64), np.zeros(1, np.int64), window, gram)]
        start, stop, text, self.coarse, self.fine, self.sides = (np.concatenate(x) for x in zip(*parts))
        sizes = [len(x[0]) for x in parts]
        base = np.repeat(self.bases[: len(parts)], sizes)
        self.start, self.stop = start + base, stop + base
        self.text = text + np.repeat([x.texts.start for x in symbols] or [0], sizes)
        self.doc = ids[self.text] if len(text) else np.zeros(0, np.int64)
        self._unique()

    def string_hashes(self, starts: np.ndarray) -> np.ndarray:
        """Hashes of the windows that start here."""
        out = np.empty(len(starts), np.uint64)
        own = np.searchsorted(self.bases, starts, "right") - 1
        for k in np.unique(own):
            some = own == k
            local = starts[some] - self.bases[k]
            out[some] = span_hash(self.prefixes[k], local, local + self.window)
        return out

    def _unique(self) -> None:
        """Entries: the distinct segments, ordered by anchor, each with the smallest id.

        ``slot`` is the place of an entry in what is sent: an anchor with more
        than BLOCK_GROUP segments sends one mark for all of them.
        """
        self.entry, self.chosen = distinct(self.coarse, self.fine, self.doc)
        _, first, size = np.unique(self.coarse[self.chosen], return_index=True, return_counts=True)
        many = np.repeat(size > BLOCK_GROUP, size)
        begins = np.zeros(len(self.chosen), bool)
        begins[first] = True
        leaves = ~many | begins
        self.slot = np.cumsum(leaves) - 1
        self.sent, self.marks = self.chosen[leaves], many[leaves]

    def entries(self) -> tuple[np.ndarray, ...]:
        c = self.sent
        return self.coarse[c], np.where(self.marks, MARK, self.fine[c]), self.doc[c], self.sides[c]

    def answered(self, answers: Answers, level: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """State of each entry; the covering id, NO_ID without one."""
        states, source = answers.states(level, self.entries(), buckets)
        return states[self.slot], source[self.slot]

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of the chosen segments, and the segment of each."""
        n = self.stop[chosen] - self.start[chosen]
        own = np.repeat(chosen, n)
        return self.start[own] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), own


def _segments(prefix: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Start and stop of the windows of each segment, its text, anchor, content, and the symbols on both sides of the anchor."""
    n = len(prefix) - 1
    counts = np.maximum(np.diff(first) - window + 1, 0)
    starts = flat_ranges(first[:-1], counts)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros((0, 2), np.uint8)
    grams = run_hashes(prefix, gram)
    bits = np.uint64(int(n).bit_length())
    low = (grams >> bits) << bits
    low |= np.arange(len(grams), dtype=np.uint64)
    reach, width = 1, window - gram + 1
    while 2 * reach <= width:  # the least over twice as many
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    anchor = (low[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    start, anchor = starts[begin], anchor[begin]
    stop = starts[np.append(begin[1:], len(starts)) - 1] + 1
    text = np.searchsorted(first, start, "right") - 1
    content = span_hash(prefix, start, stop + window - 1) + (anchor - start).astype(np.uint64)
    fine = np.minimum(mixed(content) >> np.uint64(32), np.uint64(2**32 - 2)).astype(np.uint32)
    half = (window - gram + 1) // 2  # a shared window reaches so far beyond the anchor on one side
    sides = [
        span_hash(prefix, np.maximum(anchor - half, first[:-1][text]), anchor) >> np.uint64(56),
        span_hash(prefix, anchor + gram, np.minimum(anchor + gram + half, first[1:][text])) >> np.uint64(56),
    ]
    # Anchors have low hashes; scrambled again, they fill all buckets alike.
    return start, stop, text, mixed(grams[anchor]), fine, np.stack(sides, axis=1).astype(np.uint8)


class Windows:
    """Single windows of some segments as entries of their own."""

    def __init__(self, segments: Segments, chosen: np.ndarray) -> None:
        self.start, own = segments.windows(chosen)
        self.doc = segments.doc[own]
        self.coarse = segments.string_hashes(self.start)
        self.fine = np.minimum((segments.coarse[own] >> np.uint64(8)).astype(np.uint32), np.uint32(2**32 - 2))
        self.entry, self.chosen = distinct(self.coarse, self.fine, self.doc)

    def entries(self) -> tuple[np.ndarray, ...]:
        c = self.chosen
        return self.coarse[c], self.fine[c], self.doc[c], np.zeros((len(c), 2), np.uint8)

    def covered(self, states: np.ndarray) -> np.ndarray:
        """Which windows are in a document with a smaller id, here or elsewhere."""
        return (states[self.entry] == COVERED) | (self.doc > self.doc[self.chosen][self.entry])


def distinct(coarse: np.ndarray, fine: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of each row; the row of each entry, which has its smallest id. Entries are in order."""
    order = np.lexsort((doc, fine, coarse))
    new = np.ones(len(order), bool)
    new[1:] = (coarse[order[1:]] != coarse[order[:-1]]) | (fine[order[1:]] != fine[order[:-1]])
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    return entry, order[new]


def bucket_of(coarse: np.ndarray, buckets: int) -> np.ndarray:
    """Grows with the fingerprint, so that sorted entries are sorted by bucket."""
    return ((coarse >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def planes(a: np.ndarray) -> bytes:
    """All first bytes, all second ones, ...: alike high bytes then compress."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.nbytes // max(1, len(a))).T.tobytes()


def unplaned(data: memoryview, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


ENTRY_BYTES = 8 + 4 + 8 + 2


def sent(entries: tuple[np.ndarray, ...], block: int, level: int, buckets: int) -> list[tuple]:
    """Messages of a block: its entries by bucket."""
    coarse, fine, doc, sides = entries
    to = bucket_of(coarse, buckets)
    found, begin = np.unique(to, return_index=True)
    out = []
    for bucket, a, b in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(to)]):
        out.append((bucket, block, level, planes(coarse[a:b]) + planes(fine[a:b]) + planes(doc[a:b]) + planes(sides[a:b])))
    return out


def messages(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "block", "level", "entries"])


def received(blob: bytes) -> tuple[np.ndarray, ...]:
    data, n = memoryview(blob), len(blob) // ENTRY_BYTES
    return (
        unplaned(data[: 8 * n], np.uint64),
        unplaned(data[8 * n : 12 * n], np.uint32),
        unplaned(data[12 * n : 20 * n], np.int64),
        np.frombuffer(data[20 * n :], np.uint8).reshape(2, n).T,
    )


def judged(table: pa.Table) -> pa.Table:
    """Answer a bucket's entries: a state for each, and the id that covers it."""
    rows = table.to_pylist()
    got = [received(r["entries"]) for r in rows]
    coarse, fine, doc, sides = (np.concatenate(x) for x in zip(*got))
    entry, chosen = distinct(coarse, fine, doc)
    least = doc[chosen]
    anchors = coarse[chosen]
    alike = np.zeros(len(chosen), bool)
    for side in (0, 1):  # another segment of the anchor has the same symbols on this side
        code = sides[chosen, side]
        order = np.lexsort((code, anchors))
        same = (anchors[order[1:]] == anchors[order[:-1]]) & (code[order[1:]] == code[order[:-1]])
        alike[order[1:][same]] = True
        alike[order[:-1][same]] = True
    _, group, size = np.unique(anchors, return_inverse=True, return_counts=True)
    verdict = np.where(alike, np.where(size[group] > HOT_GROUP, HOT, MIXED), ALONE).astype(np.uint8)
    source = least[entry]
    marked_groups = np.zeros(len(size), bool)
    marked_groups[group[fine[chosen] == MARK]] = True
    states = np.where(source < doc, np.uint8(COVERED), verdict[entry])
    states = np.where(marked_groups[group[entry]], HOT, states).astype(np.uint8)
    out, at = [], 0
    for r, g in zip(rows, got):
        own = slice(at, at + len(g[0]))
        at += len(g[0])
        by = source[own][states[own] == COVERED]
        out.append((r["bucket"], r["block"], r["level"], states[own].tobytes() + planes(by)))
    return messages(out)


class Answers:
    """What buckets answered a block, in the order of its entries."""

    def __init__(self, table: pa.Table) -> None:
        self.by_level: dict[int, list[tuple[int, bytes]]] = {}
        for bucket, level, blob in zip(*(table.column(c).to_pylist() for c in ("bucket", "level", "entries"))):
            self.by_level.setdefault(level, []).append((bucket, blob))

    def raw(self, level: int) -> list[bytes]:
        return [blob for _, blob in sorted(self.by_level.get(level, []))]

    def states(self, level: int, entries: tuple[np.ndarray, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """State of each entry; the covering id, NO_ID without one."""
        counts = np.unique(bucket_of(entries[0], buckets), return_counts=True)[1]
        states, source = np.zeros(len(entries[0]), np.uint8), np.full(len(entries[0]), NO_ID)
        at = 0
        for n, blob in zip(counts.tolist(), self.raw(level), strict=True):
            states[at : at + n] = np.frombuffer(blob, np.uint8, n)
            source[at : at + n][states[at : at + n] == COVERED] = unplaned(memoryview(blob)[n:], np.int64)
            at += n
        return states, source


def exchange(blocks: DataFrame, send: Callable[[Block, int], list[tuple]]) -> DataFrame:
    """Each block's entries, answered."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return messages(send(Block(table), key[0].as_py()))

    return blocks.groupBy("block").applyInArrow(run, MESSAGE).groupBy("bucket").applyInArrow(judged, MESSAGE)


def answered(blocks: DataFrame, answers: DataFrame, work: Callable[[Block, int, Answers], pa.Table], schema: str) -> DataFrame:
    """Work on each block with the answers it has got."""

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, got: pa.Table) -> pa.Table:
        return work(Block(docs), key[0].as_py(), Answers(got))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def marked(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of n symbols lie in one of the ranges."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, stops, -1)
    return np.cumsum(steps[:-1]) > 0


