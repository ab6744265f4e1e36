"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs. Built-in functions only.

A paragraph is a stretch of 64 to 192 characters that ends with a line, or 192
characters, or the rest. Its 64-bit digest falls into three cells of a sketch, each with a
count, the exclusive or of its digests and that of their checks. Two versions'
cells are subtracted; peeling cells that hold one digest recovers the differing
ones. A text's fingerprint is its sketch of ``CELLS`` cells. For a likeness the
digests are split by their own bits over as many sketches as their number asks
for; a sketch that cannot be peeled is retried with two and four times the cells,
and after that its digests are compared directly.

The likeness of two sets is the share of digests that both have; two empty ones
are alike. A null text is empty. The next document is by descending id, nulls
last, then by the text's hash. Equal rows get equal fingerprints. Other columns
are not read; an empty table gives no row. A single row follows itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import documents

PARAGRAPH = r"(?s).{64,192}?\n|.{1,192}"
CELLS = 12
ROUNDS = 8
# Digests of both versions to a sketch when differences are recovered.
LOAD = 8
BIN_BYTES = 8 << 20
COARSE = 64


def digests(text: str) -> str:
    """Distinct digests of a text's paragraphs."""
    pattern = PARAGRAPH.replace("\\", "\\\\")
    return f"array_distinct(transform(regexp_extract_all({text}, '{pattern}', 0), p -> xxhash64(p)))"


def hit(digest: str, cell: str, cells: int) -> str:
    """Whether a digest falls into a cell: one of each third, by other bits of it."""
    third = cells // 3
    return f"(pmod(shiftrightunsigned({digest}, 13 * ({cell} div {third})), {third}L) = {cell} % {third})"


def sketch(items: str, cells: int) -> str:
    """Cells of an array of structs (d: digest, w: 1 or -1)."""
    return (
        f"transform(sequence(0, {cells - 1}), j -> aggregate(filter({items}, x -> {hit('x.d', 'j', cells)}), "
        "named_struct('n', 0, 'k', 0L, 'c', 0L), "
        "(s, x) -> named_struct('n', s.n + x.w, 'k', s.k ^ x.d, 'c', s.c ^ xxhash64(x.d))))"
    )


def peeled(items: str, cells: int) -> str:
    """Number of digests that differ, recovered from the subtracted cells; null if peeling gets stuck."""
    pure = (
        "array_distinct(transform(filter(st.cells, c -> abs(c.n) = 1 AND c.c = xxhash64(c.k)), "
        "c -> named_struct('d', c.k, 'w', c.n)))"
    )
    removed = (
        f"transform(t.cells, (c, j) -> aggregate(filter(p, x -> {hit('x.d', 'j', cells)}), c, "
        "(s, x) -> named_struct('n', s.n - x.w, 'k', s.k ^ x.d, 'c', s.c ^ xxhash64(x.d))))"
    )
    step = f"aggregate(array({pure}), st, (t, p) -> IF(size(p) = 0, t, named_struct('cells', {removed}, 'found', t.found + size(p))))"
    start = f"named_struct('cells', {sketch(items, cells)}, 'found', 0)"
    done = "forall(st.cells, c -> c.n = 0 AND c.k = 0L AND c.c = 0L)"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (st, r) -> {step}, st -> IF({done}, st.found, NULL))"


def differing(items: str) -> str:
    """Digests that differ in one sketch's items, with larger sketches on failure."""
    plus, minus = (f"transform(filter({items}, x -> x.w = {w}), x -> x.d)" for w in (1, -1))
    direct = f"size(array_except({plus}, {minus})) + size(array_except({minus}, {plus}))"
    return f"coalesce({peeled(items, CELLS)}, {peeled(items, 2 * CELLS)}, {peeled(items, 4 * CELLS)}, {direct})"


def likeness(a: str, b: str) -> str:
    """Share of the digests of two arrays that both have, from the recovered differences."""
    items = f"concat(transform({a}, d -> named_struct('d', d, 'w', 1)), transform({b}, d -> named_struct('d', d, 'w', -1)))"
    # Sketches: a power of two, split in two steps so that long texts cost less than their square.
    bits = f"CAST(greatest(0, ceil(log2(greatest(1, size({a}) + size({b})) / {LOAD}))) AS INT)"
    outer = f"transform(sequence(0, (1 << ({bits} div 2)) - 1), s -> filter(z.items, x -> (shiftrightunsigned(x.d, 44) & ((1L << (z.bits div 2)) - 1)) = s))".replace(bits, "z.bits")
    inner = "transform(sequence(0, (1 << (z.bits - z.bits div 2)) - 1), s -> filter(o, x -> (shiftrightunsigned(x.d, 54) & ((1L << (z.bits - z.bits div 2)) - 1)) = s))"
    summed = f"aggregate({outer}, 0L, (n, o) -> n + aggregate({inner}, 0L, (m, i) -> m + IF(size(i) = 0, 0, {differing('i')})))"
    total = f"aggregate(array(named_struct('items', {items}, 'bits', {bits})), 0L, (q, z) -> q + {summed})"
    sizes = f"(size({a}) + size({b}))"
    return f"IF({sizes} = 0, 1D, aggregate(array({total}), 0D, (q, n) -> q + ({sizes} - n) / ({sizes} + n)))"


def fingerprint(array: str) -> str:
    """The sketch of one text as a string: count, digests and checks of each cell in hexadecimal."""
    items = f"transform({array}, d -> named_struct('d', d, 'w', 1))"
    return f"array_join(transform({sketch(items, CELLS)}, c -> concat_ws('.', hex(c.n), hex(c.k), hex(c.c))), '-')"


def binned(docs: DataFrame) -> DataFrame:
    """Documents with a bin that falls with their place in the order: even shares of the ids, nulls below all."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shares = [k / COARSE for k in range(COARSE + 1)]
    figures = own.agg(F.percentile_approx("doc_id", shares).alias("cuts"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum(F.octet_length("text")).alias("bytes")).first()
    fine = -(-max(COARSE, (figures.bytes or 0) // BIN_BYTES) // COARSE)
    cuts = sorted({figures.low, *(figures.cuts or []), figures.high} - {None}) or [0]
    bounds = f"array({', '.join(f'{c}L' for c in [*cuts, cuts[-1] + 1 if cuts[-1] < 2**63 - 1 else cuts[-1]])})"
    at = f"size(filter({bounds}, b -> b <= doc_id))"
    bin_ = (
        f"CASE WHEN doc_id IS NULL THEN -1 - pmod(digest, {COARSE}L) ELSE aggregate(array(least({at}, {len(cuts)})), 0L, (q, k) -> k * {fine}L + "
        f"least({fine - 1}L, CAST({fine} * ((doc_id - CAST(element_at({bounds}, k) AS DOUBLE)) / greatest(1D, CAST(element_at({bounds}, k + 1) AS DOUBLE) - element_at({bounds}, k))) AS BIGINT))) END"
    )
    return own.withColumn("digest", F.xxhash64("text")).withColumn("bin", F.expr(bin_))


def with_next(docs: DataFrame) -> DataFrame:
    """Documents with the text of the next one; after the last comes the first."""
    own = binned(docs)
    order = [F.col("doc_id").desc_nulls_last(), F.col("digest").desc(), F.col("text").desc()]
    inside = Window.partitionBy("bin").orderBy(*order)
    # One row a bin leaves each task, so the texts are shuffled once only.
    firsts = own.withColumn("place", F.row_number().over(inside)).filter("place = 1").select("bin", F.col("text").alias("head"))
    # As many rows as bins, a number set by BIN_BYTES: one small window of numbers.
    around = Window.orderBy(F.col("bin").desc())
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = own.select("bin").distinct().select("bin", F.coalesce(F.lead("bin").over(around), F.first("bin").over(whole)).alias("next_bin"))
    heads = following.join(firsts.withColumnRenamed("bin", "next_bin"), "next_bin").select("bin", "head")
    rows = own.withColumn("following", F.lead("text").over(inside))
    joined = rows.join(heads, "bin", "left")
    return joined.select("doc_id", "text", F.coalesce("following", "head").alias("next_text"))


def versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text, and likenesses."""
    half = "CAST(floor(n_chars / 2) AS INT)"
    texts = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    texts = texts.withColumn("edited", F.expr(f"concat(substring(text, 1, CAST(n_chars AS INT) - {half}), substring(next_text, 1, {half}))"))
    sets = texts.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.expr(digests("text")).alias("own"),
        F.expr(digests("edited")).alias("new"),
        F.expr(digests("next_text")).alias("other"),
    )
    return sets.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.expr(fingerprint("own")).alias("fingerprint"),
        F.expr(fingerprint("new")).alias("edited_fingerprint"),
        F.expr(likeness("own", "new")).alias("near_edited"),
        F.expr(likeness("own", "other")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions(documents(spark, sf_dir))
