"""Vector code compression: parts of whole-number vectors as codes, by exact matrix products.

Each component becomes ``floor(256 * x)``. A vector is cut into ``parts`` equal
parts, and each part is the index of its nearest codebook entry. The nearest one
is the first smallest ``c.c - 2 x.c``, so all dot products of a batch with a
codebook are one matrix product. For exact results the integers are broken into
signed limbs, so narrow that a dot product of limbs stays below 2^53, where
float64 holds every integer; the limbs' products are then put together as
64-bit integers. Should those not be wide enough for a batch's values, they are put
together as Python integers.

A round adds up, in every task, the parts of each entry: a row for each entry,
position and limb, whatever the number of vectors. Only codebooks, bounded by
``entries`` and the vectors' dimension, pass through the driver.

Vectors that are null or hold a null, NaN or infinite component are dropped. Of
the others those of the most frequent length that ``parts`` divides stay (of
equally frequent ones the longest), as the rest cannot be cut alike. Repeated
rows are all coded; a repeated id gives the codebook one entry, from its first
vector in order. A null id gives none. Fewer ids than ``entries`` make a shorter
codebook. Equal distances go to the lower index, and entries that nothing chose
stay. An error or a sum
of errors that 64 bits cannot hold is null. Other columns are not read. An empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import flat_ranges, kept

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
EXACT = 53  # float64 holds all integers up to two to this power
WORD = 62  # and sums of a few terms below this one fit 64-bit integers
CARRIED = 24  # bits of a limb of the sums that tasks hand on
ROWS = 4096  # vectors of one matrix product
FIRSTS = "length long, n long, vec_id long, vector array<double>"
SUMS = "part int, entry int, position int, limb int, total long"
CODED = "vec_id long, label long, code string, error long"


def limb_bits(terms: int) -> int:
    """Width of signed limbs of which so many products add up to less than 2^53."""
    return (EXACT - max(1, terms).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Signed limbs of integers, lowest first, as float64: ``sum(limb << (bits * k))`` is x."""
    out, half = [], 1 << (bits - 1)
    while True:
        low = ((x + half) & ((1 << bits) - 1)) - half
        out.append(low.astype(np.float64))
        x = (x - low) >> bits
        if not x.any():
            return out


def bits_of(x: np.ndarray) -> int:
    """Bits of the largest magnitude."""
    return max((int(v).bit_length() for v in (x.max(), -x.min())), default=0) if x.size else 0


def exact_product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y.T`` of integers without rounding: float64 products of limbs, put together as integers."""
    terms = x.shape[1]
    bits = limb_bits(terms)
    wide = bits_of(x) + bits_of(y) + terms.bit_length() > WORD
    kind = object if wide else np.int64
    total = np.zeros((len(x), len(y)), kind)
    mine, theirs = limbs(x, bits), limbs(y, bits)
    for i, a in enumerate(mine):
        for j, b in enumerate(theirs):
            product = (a @ b.T).astype(np.int64).astype(kind)
            total += product * (1 << (bits * (i + j))) if i + j else product
    return total


def squares(x: np.ndarray) -> np.ndarray:
    """The squared length of each row, exactly."""
    wide = 2 * bits_of(x) + x.shape[1].bit_length() > WORD
    x = x.astype(object) if wide else x
    return (x * x).sum(axis=1) if x.shape[1] else np.zeros(len(x), x.dtype)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, the lowest of equally near ones, and the squared distance."""
    top = max(bits_of(x), bits_of(book))
    if 2 * top + x.shape[1].bit_length() + 3 > WORD:
        x, book = x.astype(object), book.astype(object)
    apart = squares(book)[None, :] - 2 * exact_product(x, book)
    chosen = apart.argmin(axis=1)
    return chosen, apart[np.arange(len(x)), chosen] + squares(x)


def whole(values: np.ndarray) -> np.ndarray:
    """``floor(256 * x)``; Python integers if 64 bits are too few for one."""
    scaled = np.floor(values * SCALE)
    if scaled.size and np.abs(scaled).max() >= 2.0**WORD:
        return np.array([[int(v) for v in row] for row in scaled.tolist()], object).reshape(scaled.shape)
    return scaled.astype(np.int64)


def finite_rows(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with a full vector by length: the rows and their vectors, a few at a time."""
    vectors = batch.column("vector")
    at = np.asarray(vectors.offsets)
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    sizes = np.diff(at)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = np.asarray(vectors.is_valid()) & (bad[at[1:]] == bad[at[:-1]])
    for size in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == size))
        for k in range(0, len(rows), ROWS):
            own = rows[k : k + ROWS]
            yield batch.take(pa.array(own)), flat[flat_ranges(at[own], sizes[own])].reshape(len(own), size)


def columns(vectors: DataFrame) -> DataFrame:
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def first_vectors(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Vectors of the smallest ids, the codebooks' start; None without any row that can be cut."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        least: dict[int, dict[int, tuple]] = {}
        for batch in batches:
            for rows, values in finite_rows(batch):
                size = values.shape[1]
                if not size or size % parts:
                    continue
                counts[size] = counts.get(size, 0) + len(values)
                best = least.setdefault(size, {})
                ids = rows.column("vec_id").to_pylist()
                limit = max(best) if len(best) >= entries else None
                for k, vec_id in enumerate(ids):
                    if vec_id is None or (limit is not None and vec_id > limit):
                        continue
                    own = tuple(values[k].tolist())
                    best[vec_id] = min(own, best.get(vec_id, own))
                    if len(best) > entries:
                        del best[max(best)]
                        limit = max(best)
        out = [(size, n, None, None) for size, n in counts.items()]
        out += [(size, 0, vec_id, list(v)) for size, best in least.items() for vec_id, v in best.items()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)], names=["length", "n", "vec_id", "vector"])

    found = kept(vectors.mapInArrow(firsts, FIRSTS), "firsts")
    size = found.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if size is None:
        return None
    own = found.filter((F.col("length") == size.length) & F.col("vector").isNotNull())
    rows = own.groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id").limit(entries).collect()
    return np.array([r.vector for r in rows], np.float64).reshape(len(rows), size.length)


def coded(rows: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all parts and the distances' sums."""
    width = rows.shape[1] // len(books)
    codes, error = np.zeros((len(rows), len(books)), np.int64), np.zeros(len(rows), object)
    narrow = 2 * max(bits_of(rows), max(map(bits_of, books))) + rows.shape[1].bit_length() + 3 <= WORD
    if narrow:
        error = error.astype(np.int64)
    for k, book in enumerate(books):
        codes[:, k], apart = nearest(rows[:, k * width : (k + 1) * width], book)
        error = error + apart
    return codes, error


def entry_sums(vectors: DataFrame, books: list[np.ndarray]) -> dict[tuple[int, int, int], int]:
    """Sums of the parts at each entry, by part, entry and position; position -1 has their number."""
    width = books[0].shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(books), len(books[0]), width + 1)
        total = np.zeros(shape, object)
        for batch in batches:
            for _, values in finite_rows(batch):
                if values.shape[1] != width * len(books):
                    continue
                rows = whole(values)
                codes, _ = coded(rows, books)
                narrow = bits_of(rows) + len(rows).bit_length() <= WORD
                for k in range(len(books)):
                    part = np.zeros((shape[1], width + 1), np.int64 if narrow else object)
                    np.add.at(part, codes[:, k], np.column_stack([np.ones(len(rows), rows.dtype), rows[:, k * width : (k + 1) * width]]))
                    total[k] += part
        out = []
        for (part, entry, position), n in np.ndenumerate(total):
            sign, n, limb = (-1 if n < 0 else 1), abs(int(n)), 0
            while n:
                if low := n & ((1 << CARRIED) - 1):
                    out.append((part, entry, position - 1, limb, sign * low))
                n, limb = n >> CARRIED, limb + 1
        kinds = (*[pa.int32()] * 4, pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], names=[x.split()[0] for x in SUMS.split(", ")])

    found: dict[tuple[int, int, int], int] = {}
    for r in vectors.mapInArrow(sums, SUMS).groupBy("part", "entry", "position", "limb").agg(F.sum("total").alias("total")).collect():
        key = (r.part, r.entry, r.position)
        found[key] = found.get(key, 0) + (r.total << (CARRIED * r.limb))
    return found


def moved(books: list[np.ndarray], sums: dict[tuple[int, int, int], int]) -> list[np.ndarray]:
    """Each entry at the mean of its parts, rounded down."""
    out = []
    for k, book in enumerate(books):
        rows = [
            [sums.get((k, e, p), 0) // n for p in range(len(row))] if (n := sums.get((k, e, -1), 0)) else row
            for e, row in enumerate(book.tolist())
        ]
        wide = any(abs(v) >= 1 << WORD for row in rows for v in row)
        out.append(np.array(rows, object if wide else np.int64).reshape(book.shape))
    return out


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray] | None:
    """A codebook for each part, from the vectors of the smallest ids; None if no row can be cut or has an id."""
    first = first_vectors(vectors, parts, entries)
    if first is None or not len(first):
        return None
    books = np.split(whole(first), parts, axis=1)
    for _ in range(rounds):
        books = moved(books, entry_sums(vectors, books))
    return books


def digest(books: list[np.ndarray]) -> str:
    return sha256(",".join(str(v) for book in books for row in book.tolist() for v in row).encode()).hexdigest()


def codes(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Each kept vector's code, two hex digits a part, and its error."""
    size = sum(book.shape[1] for book in books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in finite_rows(batch):
                if values.shape[1] != size:
                    continue
                code, error = coded(whole(values), books)
                text = code.astype(np.uint8).tobytes().hex()
                width = 2 * len(books)
                errors = [v if v < 1 << 63 else None for v in error.tolist()]
                names = [text[k : k + width] for k in range(0, len(text), width)]
                columns = [rows.column("vec_id"), rows.column("label"), pa.array(names, pa.string()), pa.array(errors, pa.int64())]
                yield pa.record_batch(columns, names=[x.split()[0] for x in CODED.split(", ")])

    return vectors.mapInArrow(encode, CODED)


def decoder(books: list[np.ndarray]) -> Callable[[str], list[int]]:
    """A function that gives back the whole-number vector that a code stands for."""
    return lambda code: [int(v) for k, book in enumerate(books) for v in book[int(code[2 * k : 2 * k + 2], 16)]]


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes, errors, the errors' sum over rows of the same label, and the codebooks' digest."""
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    vectors = columns(table)
    books = codebooks(vectors, parts, entries, rounds)
    if books is None:
        rows = table.sparkSession.createDataFrame([], CODED)
        name = digest([])
    else:
        rows, name = kept(codes(vectors, books), "codes"), digest(books)
    unlabelled = F.col("label").isNull().alias("unlabelled")
    label = F.coalesce("label", F.lit(0)).alias("label")
    sums = rows.groupBy(label, unlabelled).agg(F.try_sum("error").alias("label_error"))
    return rows.select("vec_id", label, unlabelled, "code", "error").join(sums, ["label", "unlabelled"]).select(
        "vec_id", "code", "error", "label_error", F.lit(name).alias("codebooks_sha256")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_BOOK = """
book{k} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(m.v, b.v) AS v
  FROM book{j} b LEFT JOIN (
    SELECT part, entry, pos, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
    FROM near{j} JOIN parts USING (vec_id, part) GROUP BY ALL
  ) m USING (part, entry, pos)
)"""
_NEAR = """
near{j} AS MATERIALIZED (
  SELECT vec_id, part, min_by(entry, d * 64 + entry) AS entry, min(d) AS d
  FROM (
    SELECT vec_id, part, entry, sum((p.v - b.v) * (p.v - b.v))::BIGINT AS d
    FROM parts p JOIN book{j} b USING (part, pos) GROUP BY ALL
  ) GROUP BY ALL
)"""

SQL = f"""
WITH kept AS (
  SELECT vec_id, label, embedding, len(embedding) // {PARTS} AS width FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, (i // width)::INTEGER AS part, (i % width)::INTEGER AS pos, floor(256 * embedding[i + 1]::DOUBLE)::BIGINT AS v
  FROM kept, LATERAL (SELECT unnest(range(0, len(embedding))) AS i)
), book0 AS MATERIALIZED (
  SELECT part, entry, pos, v
  FROM parts JOIN (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1)::INTEGER AS entry FROM kept QUALIFY entry < {ENTRIES}) USING (vec_id)
), {_NEAR.format(j=0)}, {_BOOK.format(k=1, j=0)}, {_NEAR.format(j=1)}, {_BOOK.format(k=2, j=1)}, {_NEAR.format(j=2)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY vec_id
), named AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), named
"""
