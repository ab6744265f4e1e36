"""N-gram Jaccard join: groups of tokens counted as points in an R-tree, overlap bounded by summed minima.

A document is its set of distinct shingles, in lower case. Two link at a Jaccard
likeness of ``near`` in a hundred. Shingles are hashed into groups twice:

- Into more groups than a linked pair may differ in, by size class: then some
  group is equal in both, so its fingerprint is a key that both have, and no link
  is lost. Empty groups give no key: a set with more filled groups than differences
  shares a filled one with each partner. The few other sets are grouped again, by
  other hashes, and only after ``ROUNDS`` groupings their empty groups are keys too.
  Keys are exchanged in messages, each key once a message.
- Into at least twice as many groups as it has shingles, whose counts are the document's point,
  two bits each, and into ``COORDINATES`` ones, a sum of these. The summed coordinate minima of two
  points bound the overlap; pairs whose bound is too small are not looked at again.

First every document is held against the one that is first for most of its keys;
what survives the bound is verified on whole texts, and links make components. Then, only for
keys whose documents are in several components, each set of documents once however many
keys have it, an R-tree of the points finds the pairs across them, and the finer points prune these where they are found. A cell gives one
pair for each two of its components that any survivor joins, and the documents of the pairs left out for
it. Where one of them turns out to be no link, the cells of these documents give the next one; after ``TURNS`` times, all that are left. So a
group of copies costs a row for each copy and not for each pair, a family that does
not link costs comparisons but no rows, and every link between components is still found.

A null or empty text or one without words has no shingles and links with nothing.
Equal ids count as one document with the larger set's figures; a null id is kept
and links with nothing. Other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import SMALL_SLICE, documents, flat_ranges, kept, mapped, mixed, small_batches, text_slices
from larder.llm.decontamination import ASCII_LOWER, shingle_hashes
from larder.llm.segments import BLOCK_BYTES, LEAST_BLOCKS, bucket_of, planes, unplaned

WORDS = 3
NEAR = 90
COORDINATES = 256
# Sets of up to so many shingles have finer points of two coordinates a shingle, two bits each; larger ones so many bytes.
FINEST = 4096
QUARTERS = np.array([[b >> s & 3 for s in (0, 2, 4, 6)] for b in range(256)], np.uint8)
GROWTH = 1.6
MESSAGE_KEYS = 500_000
# Rows that a bucket returns at once.
BATCH_ROWS = 1 << 15
# Documents of one key in a task's R-tree, and held against it; more are dealt into cells of so many on both sides.
TREE_ROWS = 2048
# Groupings of sets that have no more filled groups than differences.
ROUNDS = 4
LEAF = 16
SKETCH = "doc_id long, n long, digest long, fine binary"
CELL_LINK = "key long, hub long, doc_id long, left array<long>"
# Times that cells give one pair for each two components before they give all that are left.
TURNS = 4
MESSAGE = "bucket long, keys binary, pairs binary"


def size_classes(largest: int) -> np.ndarray:
    """First size of each class; neighbours in a link are in one class or in two neighbouring ones."""
    first = [1]
    while first[-1] <= largest:
        first.append(max(first[-1] + 1, int(first[-1] * GROWTH)))
    return np.array(first)


def distinct_shingles(raw: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text; number of the first of each, and at the end of all."""
    hashes, before = shingle_hashes(raw, at, words)
    counts = np.diff(before)
    text = np.repeat(np.arange(len(counts)), counts)
    for n in range(1, words):  # texts of fewer words: the whole sequence
        short, own = shingle_hashes(raw, at, n)
        fit = np.flatnonzero(np.diff(own) == 1)
        fit = fit[counts[fit] == 0]
        hashes, text = np.concatenate([hashes, short[own[fit]] + np.uint64(n)]), np.concatenate([text, fit])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(counts) + 1))


def link_keys(hashes: np.ndarray, first: np.ndarray, near: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all texts and the text of each."""
    n = np.diff(first)
    classes = size_classes(int(n.max(initial=1)))
    own = np.searchsorted(classes, n, "right") - 1
    keys, texts = [], []
    for lower in (0, 1):
        size_class = own - lower
        # The class below too, if a smaller one in a link can be in it.
        use = (n > 0) & (size_class >= 0) & ((lower == 0) | (-(-near * n // 100) < classes[np.maximum(own, 0)]))
        some = np.flatnonzero(use)
        if not len(some):
            continue
        differ = (classes[size_class[some] + 1] - 1) * (100 - near) // near
        # Some groups stay empty, about this share; so many more let the filled ones still outnumber the differences.
        empty = 3 * np.exp(-near / max(1, 100 - near))
        groups = differ + 1 + np.where(differ > 0, np.ceil(empty * (differ + 1)).astype(np.int64), 0)
        own_differ = np.minimum(differ, n[some] * (100 - near) // near)
        for turn in range(ROUNDS):
            counts = n[some]
            rows = flat_ranges(first[some], counts)
            slot_first = np.cumsum(groups) - groups
            scrambled = mixed(hashes[rows] + np.uint64(0x51ED27 + turn))
            slot = np.repeat(slot_first, counts) + (scrambled >> np.uint64(8)).astype(np.int64) % np.repeat(groups, counts)
            order = np.argsort(slot, kind="stable")
            used, begin = np.unique(slot[order], return_index=True)
            sums = np.zeros(int(groups.sum()), np.uint64)
            sums[used] = np.add.reduceat(scrambled[order], begin)
            filled = np.zeros(len(sums), bool)
            filled[used] = True
            text = np.repeat(np.arange(len(some)), groups)
            place = np.arange(len(sums)) - slot_first[text]
            again = np.add.reduceat(filled, slot_first, dtype=np.int64) <= own_differ
            give = filled | again[text] if turn == ROUNDS - 1 else filled
            salt = mixed((size_class[some][text].astype(np.uint64) << np.uint64(40)) + (np.uint64(turn) << np.uint64(32)) + place.astype(np.uint64) + np.uint64(1))
            keys.append(mixed(sums ^ salt)[give])
            texts.append(some[text[give]])
            some, groups, own_differ = some[again], groups[again], own_differ[again]
            if not len(some):
                break
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(texts)


def fine_points(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Counts in more groups than shingles; what their bits cannot hold is summed up in front."""
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        few = b - a <= FINEST
        size = max(COORDINATES, 1 << max(0, 2 * (b - a) - 1).bit_length()) if few else FINEST
        counts = np.bincount((hashes[a:b] & np.uint64(size - 1)).astype(np.int64), minlength=size)
        held = np.minimum(counts, 3 if few else 255).astype(np.uint8)
        beyond = np.int64(counts.sum() - held.sum(dtype=np.int64))
        if few:
            held = np.bitwise_or.reduce(held.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8), axis=1)
        out.append(beyond.tobytes() + held.tobytes())
    return out


def folded(points: np.ndarray, size: int) -> np.ndarray:
    """Counts by fewer groups, half as many at a time."""
    while points.shape[1] > size:
        half = points.shape[1] // 2
        points = points[:, :half] + points[:, half:]
    return points


def cell_points(fine: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Points in the groups of the coarsest one; what their bits cannot hold, summed up."""
    lengths = np.array([len(f) - 8 for f in fine])
    size = int(np.where(lengths == FINEST, FINEST, 4 * lengths).min())
    # Two bits folded as often as these can be stay below 256.
    point = np.empty((len(fine), size), np.uint16 if (lengths == FINEST).any() else np.uint8)
    beyond = np.empty(len(fine), np.int64)
    for length in np.unique(lengths):
        some = np.flatnonzero(lengths == length)
        rows = np.frombuffer(b"".join([fine[k] for k in some.tolist()]), np.uint8).reshape(len(some), -1)
        beyond[some] = rows[:, :8].copy().view(np.int64)[:, 0]
        held = rows[:, 8:].astype(np.uint16) if length == FINEST else QUARTERS[rows[:, 8:]].reshape(len(some), -1)
        point[some] = folded(held, size)
    return point, beyond


def fine_overlap(a: bytes, b: bytes) -> int:
    """Most shingles that two sets can share: summed minima over the groups of the coarser point."""
    point, beyond = cell_points([a, b])
    return int(point.min(axis=0).sum(dtype=np.int64) + beyond.min())


def near_bound(overlap: np.ndarray, n1: np.ndarray, n2: np.ndarray, near: int) -> np.ndarray:
    """Whether an overlap of so many makes a link of sets of these sizes."""
    return (100 + near) * overlap >= near * (n1 + n2)


def _table(schema: str, **columns: object) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in schema.split(", ")]
    n = max(len(c) for c in columns.values())
    return pa.record_batch([pa.array(columns[f] if f in columns else [None] * n, kinds[k]) for f, k in fields], names=[f for f, _ in fields])


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Set size, digest of the words in order, and point of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in text_slices(batch, size=SMALL_SLICE):
                hashes, first = distinct_shingles(raw, at, words)
                data = raw.tobytes()
                words_of = (data[a:b].translate(ASCII_LOWER).split() for a, b in zip(at[:-1].tolist(), at[1:].tolist()))
                digest = [int.from_bytes(blake2b(b" ".join(w), digest_size=8).digest(), "little", signed=True) for w in words_of]
                yield _table(SKETCH, doc_id=part.column("doc_id"), n=np.diff(first), digest=digest, fine=fine_points(hashes, first))

    return mapped(docs, run, SKETCH)


def key_messages(docs: DataFrame, words: int, near: int, buckets: int) -> DataFrame:
    """Keys by bucket, each once a message with its first document there; the others follow as pairs with that one."""

    def flushed(keys: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        key, doc, hub, new = with_hubs(np.concatenate(keys), np.concatenate(ids))
        found, begin = np.unique(bucket_of(key, buckets), return_index=True)
        blobs, pairs = [], []
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(key)]):
            first, other = a + np.flatnonzero(new[a:b]), a + np.flatnonzero(~new[a:b] & (doc[a:b] != hub[a:b]))
            blobs.append(planes(key[first]) + planes(doc[first]))
            pairs.append(planes(key[other]) + planes(doc[other]) + planes(hub[other]))
        return _table(MESSAGE, bucket=found, keys=blobs, pairs=pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, held = [], [], 0
        for batch in batches:
            for part, raw, at in text_slices(batch, size=SMALL_SLICE):
                key, text = link_keys(*distinct_shingles(raw, at, words), near)
                doc = part.column("doc_id").to_pylist()
                known = np.array([x is not None for x in doc], bool)[text]
                keys.append(key[known])
                ids.append(np.array([x or 0 for x in doc], np.int64)[text[known]])
                held += len(keys[-1])
                if held >= MESSAGE_KEYS:
                    yield flushed(keys, ids)
                    keys, ids, held = [], [], 0
        if held:
            yield flushed(keys, ids)

    return mapped(docs, run, MESSAGE)


def with_hubs(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows by key and document, with the key's first document and whether the row is the first."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return key, doc, doc[new][np.cumsum(new) - 1], new


def bucket_members(table: pa.Table) -> pa.Table:
    """Documents of a bucket with the first one that has their key, in all or in their message."""

    def columns(name: str, width: int) -> list[np.ndarray]:
        parts = [[] for _ in range(width)]
        for blob in table.column(name).to_pylist():
            n = len(blob) // (8 * width)
            for k in range(width):
                parts[k].append(unplaned(memoryview(blob)[8 * n * k : 8 * n * (k + 1)], np.uint64 if k == 0 else np.int64))
        return [np.concatenate(x) for x in parts]

    key, doc, hub, _ = with_hubs(*columns("keys", 2))
    other = np.flatnonzero(doc != hub)
    inner = columns("pairs", 3)
    rows = {"key": (key[other], inner[0]), "doc_id": (doc[other], inner[1]), "hub": (hub[other], inner[2])}
    rows = {k: np.concatenate(v).view(np.int64) for k, v in rows.items()}
    whole = _table("doc_id long, key long, hub long", **rows)
    return pa.Table.from_batches([whole.slice(a, BATCH_ROWS) for a in range(0, max(1, whole.num_rows), BATCH_ROWS)])


class Tree:
    """R-tree of points, packed by size and then by coordinates; a node keeps its least size and largest coordinates."""

    def __init__(self, point: np.ndarray, beyond: np.ndarray, n: np.ndarray) -> None:
        order = np.lexsort((*point.T[:4], n))
        self.levels = [(order, point[order], beyond[order], n[order])]
        while len(self.levels[-1][1]) > LEAF:
            _, high, over, least = self.levels[-1]
            cuts = np.arange(0, len(high), LEAF)
            self.levels.append((cuts, np.maximum.reduceat(high, cuts), np.maximum.reduceat(over, cuts), np.minimum.reduceat(least, cuts)))

    def near(self, point: np.ndarray, beyond: int, n: int, near: int) -> np.ndarray:
        """Points whose summed minima with this one do not rule a link out."""
        at = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            cuts, high, over, least = self.levels[depth]
            most = np.minimum(high[at], point).sum(axis=1, dtype=np.int64) + np.minimum(over[at], beyond)
            at = at[near_bound(most, n, least[at], near)]
            if depth:
                below = len(self.levels[depth - 1][1])
                starts = cuts[at]
                at = flat_ranges(starts, np.minimum(starts + LEAF, below) - starts)
        return self.levels[0][0][at]


def cell_links(table: pa.Table, *, near: int, every: bool) -> pa.Table:
    """Pairs across components that the finer points do not rule out, for each key of a group of cells.

    Of the pairs that join the same components of a cell only the first is given, so
    a cell gives fewer pairs than it has components; with ``every`` all are. The first
    pair of a key lists the documents of pairs left out: no others can give a pair once one given is no link.
    """
    key, doc, part, n = (table.column(c).to_numpy() for c in ("key", "doc_id", "component", "n"))
    asks, held = (table.column(c).to_numpy() for c in ("asks", "held"))
    fine, refused = table.column("fine").to_pylist(), table.column("refused").to_pylist()
    order = np.lexsort((doc, asks, key))
    _, begin = np.unique(key[order], return_index=True)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    lists: list[list[int] | None] = []
    for own in np.split(order, begin[1:]):
        if not held[own].any() or not asks[own].any():
            continue
        _, label = np.unique(part[own], return_inverse=True)
        joined = np.arange(label.max() + 1)
        if len(joined) == 1:
            continue
        point, beyond = cell_points([fine[k] for k in own.tolist()])
        coarse, size, ids = folded(point, COORDINATES), n[own], doc[own]
        rows = np.flatnonzero(held[own])
        tree = Tree(coarse[rows], beyond[rows], size[rows])
        asked, left, given = np.zeros(len(own), bool), np.zeros(len(own), bool), len(lists)
        for q in np.flatnonzero(asks[own]).tolist():
            found = rows[tree.near(coarse[q], int(beyond[q]), int(size[q]), near)]
            found = found[label[found] != label[q]]
            if held[own[q]]:  # those that asked before have met this one
                found = found[~asked[found]]
            asked[q] = True
            if len(found) and refused[own[q]]:
                found = found[~np.isin(ids[found], refused[own[q]])]
            if not len(found):
                continue
            apart = joined[label[found]] != joined[label[q]]
            later, found = found[~apart], found[apart]
            overlap = np.minimum(point[found], point[q]).sum(axis=1, dtype=np.int64) + np.minimum(beyond[found], beyond[q])
            found = found[near_bound(overlap, size[found], size[q], near)]
            if not every and len(found):
                labels, first = np.unique(joined[label[found]], return_index=True)
                later = np.concatenate([later, np.delete(found, first)])
                found = found[first]
                joined[np.isin(joined, labels)] = joined[label[q]]
            if len(later):
                left[later] = left[q] = True
            if len(found):
                out.append((np.full(len(found), key[own[0]]), np.minimum(ids[found], ids[q]), np.maximum(ids[found], ids[q])))
                lists += [None] * len(found)
        if left.any():
            lists[given] = ids[left].tolist()
    k, a, b = (np.concatenate(x) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 3
    return pa.Table.from_batches([_table(CELL_LINK, key=k, hub=a, doc_id=b, left=lists)])


def in_cells(near: int, every: bool) -> Callable[[pa.Table], pa.Table]:
    return lambda table: cell_links(table, near=near, every=every)


def dealt_cells(rows: DataFrame, buckets: int) -> DataFrame:
    """Documents of contested keys in cells where strays ask and all are held.

    A key in one part is one cell, many of which make a group. Otherwise each part of
    its strays meets each part of all its documents in a cell that is a group by itself.
    """
    stray_part, part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("strays_parts")), F.pmod(F.xxhash64("doc_id"), F.col("size_parts"))
    asking = F.transform(F.sequence(F.lit(0), F.col("size_parts") - 1), lambda j: F.struct(stray_part.alias("i"), j.alias("j"), F.lit(True).alias("asks"), (j == part).alias("held")))
    other = F.transform(F.sequence(F.lit(0), F.col("strays_parts") - 1), lambda i: F.struct(i.alias("i"), part.alias("j"), F.lit(False).alias("asks"), F.lit(True).alias("held")))
    other = F.filter(other, lambda c: ~F.col("stray") | (c["i"] != stray_part))
    cells = rows.withColumn("at", F.explode(F.when(F.col("stray"), F.concat(asking, other)).otherwise(other)))
    cells = cells.withColumn("tree", F.pmod(F.xxhash64("key"), F.lit(4 * buckets))).withColumn(
        "cell", F.when(F.col("size_parts") > 1, F.xxhash64("key", "at.i", "at.j")).otherwise(F.lit(0).cast("long"))
    )
    return cells.select("tree", "cell", "key", "doc_id", "component", "n", "fine", "refused", "at.asks", "at.held")


def packed_texts(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Compressed whole texts of all documents that share a key.

    Their ids grow with the corpus, so they are not broadcast at any size.
    """
    wanted = members.select(F.col("hub").alias("doc_id")).union(members.select("doc_id")).distinct()

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [zlib.compress((t or "").encode(), 1) for t in batch.column("text").to_pylist()]
            yield _table("doc_id long, packed binary", doc_id=batch.column("doc_id"), packed=texts)

    return mapped(docs, squeeze, "doc_id long, packed binary").hint("merge").join(wanted, "doc_id", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame, words: int, near: int) -> DataFrame:
    """The pairs (hub, doc_id) of distinct ids that link, on their whole texts."""
    both = pairs.join(texts.select(F.col("doc_id").alias("hub"), F.col("packed").alias("hub_text")), "hub").join(texts, "doc_id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shingles(packed: bytes) -> set[bytes]:
            own = zlib.decompress(packed).translate(ASCII_LOWER).split()
            k = max(1, min(words, len(own)))
            return {b" ".join(own[i : i + k]) for i in range(len(own) - k + 1)}

        for batch in batches:
            hubs, ids = batch.column("hub").to_pylist(), batch.column("doc_id").to_pylist()
            hub_texts, own_texts = batch.column("hub_text").to_pylist(), batch.column("packed").to_pylist()
            out, last, hub_set = [], None, set()
            for hub, doc, hub_text, own_text in zip(hubs, ids, hub_texts, own_texts):
                if hub_text != last:
                    last, hub_set = hub_text, shingles(hub_text)
                own = shingles(own_text)
                if own and hub_set and near_bound(len(own & hub_set), len(own), len(hub_set), near):
                    out.append((hub, doc))
            if out:
                yield _table("hub long, doc_id long", hub=[x[0] for x in out], doc_id=[x[1] for x in out])

    return mapped(both, compare, "hub long, doc_id long").distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """Each linked document (doc_id) with the smallest id it can reach (component), by alternating large and small stars."""
    edges = kept(links.select(F.greatest("hub", "doc_id").alias("u"), F.least("hub", "doc_id").alias("v")).distinct(), f"{name}_edges")
    done, step = None, 0
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        large = large.distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        edges = kept(small.union(smallest.select("u", F.col("m").alias("v"))).distinct(), f"{name}_{step}")
        figure = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if figure == done:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "doc_id")
        done, step = figure, step + 1


def _bounded(pairs: DataFrame, documents_: DataFrame, near: int) -> DataFrame:
    """Pairs that the bound does not rule out; ``same`` where the sets are equal."""
    own = documents_.select("doc_id", "n", "digest", "fine")
    hub = documents_.select(F.col("doc_id").alias("hub"), F.col("n").alias("hub_n"), F.col("digest").alias("hub_digest"), F.col("fine").alias("hub_fine"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n1, n2, d1, d2 = (batch.column(c).to_numpy() for c in ("n", "hub_n", "digest", "hub_digest"))
            f1, f2 = (batch.column(c).to_pylist() for c in ("fine", "hub_fine"))
            same = (n1 == n2) & (d1 == d2) & np.array([a == b for a, b in zip(f1, f2)], bool)
            overlap = np.array([fine_overlap(a, b) for a, b in zip(f1, f2)], np.int64)
            keep = pa.array(near_bound(overlap, n1, n2, near) & (n1 > 0) & (n2 > 0))
            out = pa.record_batch([batch.column("hub"), batch.column("doc_id"), pa.array(same)], names=["hub", "doc_id", "same"])
            yield out.filter(keep)

    return mapped(pairs.join(own, "doc_id").join(hub, "hub"), run, "hub long, doc_id long, same boolean")


def contested_rows(holders: DataFrame, parts: DataFrame, single: DataFrame, refused: DataFrame) -> DataFrame:
    """Documents of the keys that several components share, with their points and the partners they are known not to link with.

    Of the keys that the same documents have, one is looked at: their number and two exclusive ors of their hashes tell.
    """
    own = kept(holders.join(parts, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")), "holders")
    marks = [F.bit_xor(F.xxhash64("doc_id", F.lit(salt))).alias(f"mark{salt}") for salt in (2, 3)]
    keys = own.groupBy("key").agg(F.count("*").alias("size"), F.min("component").alias("main"), F.max("component").alias("last"), *marks)
    keys = keys.filter("main < last").groupBy("size", "main", "mark2", "mark3").agg(F.min("key").alias("key")).select("key", "main", "size")
    strays = own.join(keys.filter(F.col("size") > TREE_ROWS), "key").filter("component <> main").groupBy("key").agg(F.count("*").alias("strays"))
    keys = keys.join(strays, "key", "left").withColumn("strays", F.coalesce("strays", F.lit(1)))
    keys = keys.select("key", "main", *[F.ceil(F.col(c) / TREE_ROWS).alias(f"{c}_parts") for c in ("size", "strays")])
    both = refused.union(refused.select(F.col("doc_id").alias("hub"), F.col("hub").alias("doc_id")))
    partners = both.groupBy("doc_id").agg(F.collect_set("hub").alias("refused"))
    rows = own.join(keys, "key").join(single.select("doc_id", "n", "fine"), "doc_id").join(partners, "doc_id", "left")
    return rows.withColumn("stray", F.col("component") != F.col("main"))


def join(docs: DataFrame, words: int = WORDS, near: int = NEAR) -> DataFrame:
    """Per document the size of its set and its component."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    small_batches(docs.sparkSession)
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BLOCKS, -(-total // BLOCK_BYTES))
    found = kept(sketches(own, words), "sketch")
    # One set for each id: the largest, if rows repeat.
    each = Window.partitionBy("doc_id").orderBy(F.col("n").desc(), "digest")
    single = found.filter("doc_id IS NOT NULL").select("doc_id", "n", "digest", "fine")
    single = kept(single.withColumn("rank", F.row_number().over(each)).filter("rank = 1").drop("rank"), "single")
    messages = key_messages(own, words, near, buckets)
    members = kept(messages.groupBy("bucket").applyInArrow(bucket_members, "doc_id long, key long, hub long"), "members")

    # Each document with the one that is first for most of its keys.
    shared = members.groupBy("doc_id", "hub").agg(F.count("*").alias("keys"))
    likeliest = shared.groupBy("doc_id").agg(F.max(F.struct("keys", (-F.col("hub")).alias("minus"))).alias("best"))
    likeliest = likeliest.select((-F.col("best.minus")).alias("hub"), "doc_id")
    pairs = kept(_bounded(likeliest, single, near), "pairs")
    texts = kept(packed_texts(members, own), "texts")
    links = kept(pairs.filter("same").select("hub", "doc_id").union(verified(pairs.filter("NOT same").select("hub", "doc_id"), texts, words, near)), "links")

    # Keys whose documents are in several components: hold these against each other.
    holders = members.select("key", "doc_id").union(members.select("key", F.col("hub").alias("doc_id"))).distinct()
    ordered = pairs.filter("NOT same").select(F.least("hub", "doc_id").alias("hub"), F.greatest("hub", "doc_id").alias("doc_id"))
    known = links.select(F.least("hub", "doc_id").alias("hub"), F.greatest("hub", "doc_id").alias("doc_id"))
    refused = kept(ordered.join(known, ["hub", "doc_id"], "left_anti"), "refused")
    parts = components(links, "parts")
    for turn in range(TURNS):
        rows = contested_rows(holders, parts, single, refused)
        dealt = dealt_cells(rows, buckets)
        crossing = dealt.groupBy("tree", "cell").applyInArrow(in_cells(near, turn == TURNS - 1), CELL_LINK)
        crossing = kept(crossing, "crossing")
        given = kept(crossing.select("hub", "doc_id").distinct(), "bounded")
        if given.isEmpty():
            break
        more = kept(verified(given, texts, words, near), "more")
        if not more.isEmpty():
            parts = components(parts.select(F.col("component").alias("hub"), "doc_id").filter("hub <> doc_id").union(more), f"parts{turn}")
        wrong = kept(given.join(more, ["hub", "doc_id"], "left_anti"), "wrong")
        if wrong.isEmpty():
            break  # each cell's pairs are links, so what the bound leaves is joined
        # Pairs left out for one that is no link come up next: only at the keys where that can be, and only their documents.
        refused = kept(refused.union(wrong), "refused")
        failed = crossing.join(wrong, ["hub", "doc_id"], "left_semi").select("key").distinct()
        left = crossing.filter("left IS NOT NULL").select("key", "left").join(failed, "key", "left_semi")
        holders = left.select("key", F.explode("left").alias("doc_id")).distinct()

    labelled = single.select("doc_id", F.col("n").alias("n_shingles")).join(parts, "doc_id", "left")
    labelled = labelled.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    unknown = found.filter("doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return labelled.union(unknown)


def firsts(docs: DataFrame, words: int = 5, near: int = 80) -> DataFrame:
    """The first document of each component, with its own columns.

    Here rows of one id with other texts are documents of their own, and rows equal
    in id and text are one. A row without an id is kept.
    """
    known = docs.filter("doc_id IS NOT NULL")
    unknown = docs.filter("doc_id IS NULL")
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        ids = join(known, words, near).filter("component_id = doc_id").select("doc_id")
        return known.join(ids, "doc_id", "left_semi").select(*docs.columns).union(unknown)
    # Numbers in the order of the ids stand for the rows.
    row = "row"
    while row in docs.columns:
        row += "_"
    numbered = known.dropDuplicates(["doc_id", "text"]).orderBy("doc_id", "text").withColumn(row, F.monotonically_increasing_id())
    numbered = kept(numbered, "numbered")
    first = join(numbered.select(F.col(row).alias("doc_id"), "text"), words, near).filter("component_id = doc_id")
    return numbered.join(first.select(F.col("doc_id").alias(row)), row, "left_semi").select(*docs.columns).union(unknown)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir))
