"""Conversation prefix trie: member intervals of prefixes from sorted conversations and range minima.

Turns become 128-bit digests before anything is shuffled; a conversation is the
sequence of its turns' digests with the running sums of their code points. All are
sorted, so the conversations that start with a prefix stand side by side. They are
cut into blocks of about ``BLOCK_TURNS`` turns. A block takes the longest common
prefixes (LCPs) of its neighbours and builds their sparse table. Each prefix then
finds the first and last conversation that share it by itself, with two binary
searches for the nearest LCP below its depth; no stack, and no prefix waits for
another. Counts and sums over a prefix's members are differences of running sums.

- A conversation stands for the prefixes that its predecessor has not: one node each.
- The saved text of a subtree is what each later member shares with its predecessor
  below the subtree's top.
- A node has a child for each member that is longer than it and shares no more than
  it with the predecessor, and a leaf for each member that does not begin its successor.

A prefix of a block's first or last conversation may go on in other blocks. Its row
holds only sums over its part, and those of one prefix are added up afterwards: a row
for each block and depth, however many conversations share the prefix. Blocks learn
beforehand what their edges share with their neighbours.

The digest of conversations that end at a node runs over their ids in order. For a
node that spans blocks each block sends them as one string, and these pass
through the digest one after another.

Rows of one conversation with the same turn number follow in order of their digests;
a repeated row is a turn of its own. Rows without ``conv_id`` belong to no conversation
and are left out. Only columns ``conv_id turn role text`` are read. An empty table
gives no row. Ids below zero fall in the hundred nearer to zero. One conversation is one
row of 24 bytes a turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import flat_ranges, kept

BLOCK_TURNS = 400_000
HUNDRED, MOST = 100, 6
UNIT = 16  # bytes of a turn's digest
CLOSED, FIRST, LAST = 0, 1, 2  # where an open prefix stands: at the block's first conversation, or only at its last
NODES = (
    "block int, depth long, side int, parent_side int, parent_conv_id long, key binary, parent_key binary, conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string, ends_sha256 string"
)
NO_ENDS = sha256(b"").hexdigest()


def conversations(turns: DataFrame) -> DataFrame:
    """One row a conversation: its turns in order, each a digest in hexadecimal and its code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * UNIT)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.char_length(text).cast("long").alias("size"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).filter("conv_id IS NOT NULL")
    ordered = F.sort_array(F.collect_list("t"))  # a null turn is first
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: t.dropFields("turn")).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Each conversation with the first turns of its hundred's first one in place of its own."""
    h = (F.crc32(F.col("conv_id").cast("string")) % MOST).cast("int")
    heads = convs.filter(F.col("conv_id") % HUNDRED == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, MOST - 1).alias("head"))
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % HUNDRED).withColumn("h", h)
    joined = own.join(heads, "base", "left")
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), F.array()).otherwise(F.slice("head", 1, F.greatest("h", F.lit(1))))
    return joined.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def sorted_paths(convs: DataFrame) -> DataFrame:
    """``(block, conv_id, path, sizes)`` in order within blocks, which follow one another."""
    rows = kept(
        convs.select(
            "conv_id",
            F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
            F.transform("turns", lambda t: t["size"]).alias("sizes"),
        ),
        "paths",
    )
    n = rows.agg(F.coalesce(F.sum(1 + F.size("sizes")), F.lit(0)).alias("n")).first().n
    spread = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // BLOCK_TURNS), min(spread, n // 1000))
    ordered = rows.repartitionByRange(blocks, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    return kept(ordered.withColumn("block", F.spark_partition_id()), "blocks")


def shared(a: bytes | None, b: bytes | None) -> int:
    """Turns that two paths begin with in common; -1 if there is no such path."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // UNIT
    x, y = (np.frombuffer(p, f"V{UNIT}", n) for p in (a, b))
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def block_edges(paths: DataFrame) -> DataFrame:
    """What each block's first path shares with the last one before, and its last with the first one after."""
    edges = paths.groupBy("block").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = Window.orderBy("block")  # one row a block
    near = edges.select("block", "first", "last", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))

    def lcps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            before, after = ([shared(r[a], r[b]) for r in rows] for a, b in (("before", "first"), ("last", "after")))
            yield pa.record_batch([batch.column("block"), pa.array(before, pa.int64()), pa.array(after, pa.int64())], names=["block", "lcp_before", "lcp_after"])

    return near.mapInArrow(lcps, "block int, lcp_before long, lcp_after long")


class SparseTable:
    """Minima of all ranges of lengths that are powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.n = len(values)
        self.levels = [values]
        while 2 * (width := 1 << (len(self.levels) - 1)) <= self.n:
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))

    def minimum(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Least value of each range; ranges are not empty."""
        level = np.frexp((stop - start).astype(np.float64))[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            own = level == k
            table = self.levels[k]
            out[own] = np.minimum(table[start[own]], table[stop[own] - (1 << k)])
        return out

    def reach_right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each place the end of the values from there on that are all at least so much: a binary search."""
        at = start.copy()
        for k in reversed(range(len(self.levels))):
            table = self.levels[k]
            can = np.flatnonzero(at + (1 << k) <= self.n)
            go = can[table[at[can]] >= least[can]]
            at[go] += 1 << k
        return at

    def reach_left(self, stop: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The same to the left: the first of the values before each place that are all at least so much."""
        at = stop.copy()
        for k in reversed(range(len(self.levels))):
            table = self.levels[k]
            can = np.flatnonzero(at >= 1 << k)
            go = can[table[at[can] - (1 << k)] >= least[can]]
            at[go] -= 1 << k
        return at


def member_interval(lcp: SparseTable, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that share a row's prefix of some depth; ``lcp`` has rows i and i+1 at i."""
    return lcp.reach_left(row, depth), lcp.reach_right(row, depth)


def neighbour_lcps(paths: list[bytes]) -> np.ndarray:
    """Turns that each path shares with the next one."""
    units = np.array([len(p) for p in paths], np.int64) // UNIT
    flat = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)
    start = np.cumsum(units) - units
    n = np.minimum(units[:-1], units[1:])
    differ = (flat[flat_ranges(start[:-1], n)] != flat[flat_ranges(start[1:], n)]).any(axis=1)
    out, ends = n.copy(), np.cumsum(n)
    places = np.flatnonzero(differ)
    pair = np.searchsorted(ends, places, "right")
    first = np.unique(pair, return_index=True)
    out[first[0]] = places[first[1]] - (ends - n)[first[0]]
    return out


def prefix_keys(path: bytes) -> list[bytes]:
    """A digest of each prefix, from the empty one on."""
    state, out = blake2b(digest_size=UNIT), []
    out.append(state.copy().digest())
    for k in range(0, len(path), UNIT):
        state.update(path[k : k + UNIT])
        out.append(state.copy().digest())
    return out


def block_nodes(block: int, ids: np.ndarray, paths: list[bytes], sizes: tuple[np.ndarray, np.ndarray], before: int, after: int) -> pa.Table:
    """All prefixes of a block's sorted conversations; ``sizes`` are the code points of all turns and where each conversation's begin."""
    n = len(ids)
    units = np.array([len(p) for p in paths], np.int64) // UNIT
    lcp = neighbour_lcps(paths)
    table = SparseTable(lcp) if n > 1 else SparseTable(np.full(1, -1))
    flat, begin = sizes
    sums = np.concatenate([[0], np.cumsum(flat)])
    text = lambda row, depth: sums[begin[row] + depth] - sums[begin[row]]  # noqa: E731  code points of the first turns

    previous, following = np.concatenate([[before], lcp]), np.concatenate([lcp, [after]])
    fresh = np.concatenate([[-1], lcp])  # in this block
    row = np.repeat(np.arange(n), units - fresh)
    depth = flat_ranges(fresh + 1, units - fresh)
    first, last = member_interval(table, row, depth)

    at_first, at_last = first == 0, last == n - 1
    side = np.where(at_first, FIRST, np.where(at_last, LAST, CLOSED))

    leaf = np.concatenate([[0], np.cumsum(following < units)])
    n_leaves = leaf[last + 1] - leaf[first]
    # Members, but for a node's first of all blocks, share at least the node with their predecessor.
    begins = np.where(at_first, previous[0] < depth, True)
    later = first + begins
    saved = np.concatenate([[0], np.cumsum(text(np.arange(n), np.maximum(previous, 0)))])
    above = text(first, np.maximum(depth - 1, 0)) * (depth > 0)
    n_later = last + 1 - later
    saved_tokens = saved[last + 1] - saved[later] - n_later * above
    # Later members that share just the node and are longer begin a child, as does the first one if it is longer.
    branch = np.flatnonzero((previous >= 0) & (units > previous))
    code = np.sort(previous[branch] * (n + 1) + branch)
    n_children = np.searchsorted(code, depth * (n + 1) + last, "right") - np.searchsorted(code, depth * (n + 1) + later, "left")
    n_children += begins & (units[first] > depth)

    least = SparseTable(ids).minimum(first, last + 1)
    group = np.concatenate([[0], np.cumsum((lcp < units[1:]) | (lcp < units[:-1]))])
    stop = np.searchsorted(group, group[first], "right")
    n_ends = np.where(units[first] == depth, stop - first, 0)
    names = list(map(str, ids.tolist()))
    ends: list[str | None] = [None] * len(row)
    hashes: list[str | None] = [NO_ENDS] * len(row)
    for k in np.flatnonzero(n_ends).tolist():
        joined = ",".join(names[first[k] : first[k] + n_ends[k]])
        if side[k] == CLOSED:
            hashes[k] = sha256(joined.encode()).hexdigest()
        else:
            ends[k] = joined

    # The parent is a node of the first row that shares one turn less.
    node = np.cumsum(units - fresh) - (units - fresh) - (fresh + 1)  # where a row's node of depth 0 is or would be
    parent = np.where(depth > 0, node[table.reach_left(row, np.maximum(depth - 1, 0))] + depth - 1, -1)
    parent_side = np.where(parent >= 0, side[parent], CLOSED)
    parent_conv = np.where(parent >= 0, least[parent], 0)
    keys: list[bytes | None] = [None] * len(row)
    parent_keys: list[bytes | None] = [None] * len(row)
    known = {FIRST: prefix_keys(paths[0]), LAST: prefix_keys(paths[-1])}
    for k in np.flatnonzero(side != CLOSED).tolist():
        own = known[int(side[k])]
        d = int(depth[k])
        keys[k], parent_keys[k] = own[d], own[d - 1] if d else None
    columns = [
        pa.array(np.full(len(row), block, np.int32)), pa.array(depth), pa.array(side.astype(np.int32)), pa.array(parent_side.astype(np.int32)),
        pa.array(parent_conv, mask=(parent < 0) | (parent_side != CLOSED)), pa.array(keys, pa.binary()), pa.array(parent_keys, pa.binary()),
        pa.array(least), pa.array(last + 1 - first), pa.array(n_children.astype(np.int64)), pa.array(n_leaves.astype(np.int64)), pa.array(saved_tokens),
        pa.array(ends, pa.string()), pa.array(hashes, pa.string()),
    ]
    return pa.table(columns, names=[x.split()[0] for x in NODES.split(", ")])


def all_nodes(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """The prefixes of each block."""

    def of_block(key: tuple[pa.Scalar, ...], rows: pa.Table, edge: pa.Table) -> pa.Table:
        rows = rows.sort_by([("path", "ascending"), ("conv_id", "ascending")]).combine_chunks()
        ids = rows.column("conv_id").to_numpy()
        lists = rows.column("sizes").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        at = np.asarray(lists.offsets, np.int64)
        flat = np.asarray(lists.values, np.int64)
        sizes = (flat[at[0] : at[-1]], at[:-1] - at[0])
        before, after = (edge.column(c)[0].as_py() for c in ("lcp_before", "lcp_after"))
        return block_nodes(key[0].as_py(), ids, rows.column("path").to_pylist(), sizes, before, after)

    return paths.groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(of_block, NODES)


def whole_ends(parts: DataFrame) -> DataFrame:
    """Digest of the ids that end at each open node, block by block: ``(key, ends_sha256)``.

    Rows of a node stand together and in order within a partition, so a digest sees them as they pass.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for own, ids in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if own == key:
                    state.update(b"," + ids.encode())
                else:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = own, sha256(ids.encode())
            yield pa.record_batch([pa.array([k for k, _ in out], pa.binary()), pa.array([h for _, h in out], pa.string())], names=["key", "ends_sha256"])
        if state:
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    ordered = parts.filter("ends IS NOT NULL").select("key", "block", "ends").repartition("key").sortWithinPartitions("key", "block")
    return ordered.mapInArrow(digests, "key binary, ends_sha256 string")


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations."""
    return trie_of(sorted_paths(rebuilt(conversations(turns))))


def trie_of(paths: DataFrame) -> DataFrame:
    nodes = kept(all_nodes(paths, block_edges(paths)), "nodes")
    parts = nodes.filter(F.col("side") != CLOSED)
    merged = parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = kept(merged.join(whole_ends(parts), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))), "open_nodes")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    spanning = merged.join(parents, "parent_key", "left").select(*RESULT)
    inner = nodes.filter(F.col("side") == CLOSED)
    # The open parent of a closed node: a row a block, depth and side.
    names = parts.join(merged.select("key", F.col("conv_id").alias("whole")), "key").select(
        "block", (F.col("depth") + 1).alias("depth"), F.col("side").alias("parent_side"), "whole"
    )
    inner = inner.join(names, ["block", "depth", "parent_side"], "left")
    return inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "whole")).select(*RESULT).unionByName(spanning)


_FIRSTS = """
WITH ordered AS (
  SELECT conv_id, list(coalesce(role, '') || chr(31) || coalesce(text, '') ORDER BY turn NULLS FIRST) AS t,
         list(length(coalesce(text, ''))::BIGINT ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
  SELECT conv_id, t, s, conv_id - conv_id % 100 AS base,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(conv_id::VARCHAR)), lambda i: ascii((conv_id::VARCHAR)[i + 1])::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM ordered
), rebuilt AS (
  SELECT a.conv_id, coalesce(b.t[1 : a.h], []) || a.t[a.h + 1 :] AS t, coalesce(b.s[1 : a.h], []) || a.s[a.h + 1 :] AS s
  FROM (SELECT *, xor(crc, 4294967295) % 6 AS h FROM headed) a LEFT JOIN ordered b ON b.conv_id = a.base
)"""

SQL = f"""{_FIRSTS}, prefixes AS (
  SELECT conv_id, len(t) AS n, d, t[1 : d] AS p, CASE WHEN d > 0 THEN t[1 : d - 1] END AS up, CASE WHEN d > 0 THEN s[d] ELSE 0 END AS size
  FROM rebuilt, LATERAL (SELECT unnest(range(0, len(t) + 1)) AS d)
), nodes AS MATERIALIZED (
  SELECT p, any_value(up) AS up, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(CASE WHEN n = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY p, d
), children AS (SELECT up AS p, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY 1
), tops AS (
  SELECT nodes.p, saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, p[1 : k] AS top
  FROM (SELECT p, d, saved, n_children FROM nodes LEFT JOIN children USING (p)) nodes, LATERAL (SELECT unnest(range(0, d + 1)) AS k)
), subtrees AS (SELECT top AS p, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM tops GROUP BY 1)
SELECT x.conv_id, x.d::BIGINT AS depth, y.conv_id AS parent_conv_id, x.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, x.ends_sha256
FROM nodes x LEFT JOIN nodes y ON x.up = y.p LEFT JOIN children c ON c.p = x.p JOIN subtrees s ON s.p = x.p
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
