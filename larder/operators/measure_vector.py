"""Hundreds of measurements of a document as one vector, and rules on it.

A column per measurement (``operators/nested.py``) unrolls a look-up each, which
ends at the size of a method that the JVM still compiles. Here the ids of a batch
of documents are merged once with the sorted wanted ids, and a table with a cell
per document and measurement notes which entry to use. The work grows with the
entries read and the cells written, and no expression grows with the measurements.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

from larder.config import FOODS, HEALTH_RULES, HEALTHY_MIN, REQUIRED, Layout, Rule

# Cells of one table: documents of a batch times measurements.
CELLS = 1 << 20


def _free(names: Iterable[str], wanted: str) -> str:
    taken = set(names)
    while wanted in taken:
        wanted += "_"
    return wanted


def _slices(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, CELLS // width)
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _chosen(ids: pa.Array, values: pa.Array, known: np.ndarray, dup: str, missing_value: float | None):
    """For each cell the place of the entry to use, -1 without one; the entries' values, and which have one."""
    row = pc.list_parent_indices(ids).to_numpy()
    key, value = ids.flatten(), values.flatten()
    number = key.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    slot = np.minimum(np.searchsorted(known, number), len(known) - 1)
    hit = np.flatnonzero(key.is_valid().to_numpy(zero_copy_only=False) & (known[slot] == number))
    given = value.is_valid().to_numpy(zero_copy_only=False)[hit]
    amount = value.fill_null(0.0 if missing_value is None else missing_value).to_numpy(zero_copy_only=False)[hit]
    if missing_value is not None:
        given = np.ones(len(hit), bool)
    cell = row[hit] * len(known) + slot[hit]
    order = np.arange(len(hit))
    if dup == "max":
        # Without a value lowest, not a number highest, as when sorted.
        order = np.lexsort((amount, given))
    table = np.full(len(ids) * len(known), -1, np.int64)
    table[cell[order]] = order  # the last entry of a cell stays
    return table, amount, given


def _list_of(flat: pa.Array, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), flat)


def _wanted(measures: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and the place among them of each measurement."""
    if not len(measures):
        raise ValueError("no measurement is wanted")
    return np.unique(np.array(measures, np.int64), return_inverse=True)


def _checked(dup: str, grain: str = "id") -> None:
    if dup not in ("max", "last"):
        raise ValueError(f"dup is 'max' or 'last', not {dup!r}")
    if grain not in ("id", "document"):
        raise ValueError(f"grain is 'id' or 'document', not {grain!r}")


def _dense(
    rows: DataFrame, ids: str, values: str, measures: Sequence[int], dup: str, missing_value: float | None, keep_empty: bool, name: str
) -> DataFrame:
    """The arrays ``ids`` and ``values`` replaced by a vector; other columns pass."""
    others = [c for c in rows.columns if c not in (ids, values)]
    known, places = _wanted(measures)
    schema = StructType([*[rows.schema[c] for c in others], StructField(name, ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, max(len(known), len(places))):
                table, amount, given = _chosen(part.column(ids), part.column(values), known, dup, missing_value)
                table = table.reshape(part.num_rows, len(known))
                if not keep_empty:
                    present = (table >= 0).any(axis=1)
                    part, table = part.filter(pa.array(present)), table[present]
                entry = table[:, places].ravel()
                empty = entry < 0
                if len(amount):
                    empty |= ~given[entry]
                flat = amount[entry] if len(amount) else np.zeros(len(entry))
                vector = _list_of(pa.array(flat, pa.float64(), mask=empty), np.full(part.num_rows, len(places)))
                yield pa.record_batch([*[part.column(c) for c in others], vector], names=[*others, name])

    return rows.mapInArrow(run, schema)


def _sparse(rows: DataFrame, ids: str, values: str, known: np.ndarray, dup: str, missing_value: float | None, name: str) -> DataFrame:
    """The arrays replaced by one of the used entries (slot, value), at most one a measurement."""
    others = [c for c in rows.columns if c not in (ids, values)]
    entry = StructType([StructField("slot", IntegerType()), StructField("value", DoubleType())])
    schema = StructType([*[rows.schema[c] for c in others], StructField(name, ArrayType(entry))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, len(known)):
                table, amount, given = _chosen(part.column(ids), part.column(values), known, dup, missing_value)
                table = table.reshape(part.num_rows, len(known))
                row, slot = np.nonzero(table >= 0)
                used = table[row, slot]
                flat = pa.StructArray.from_arrays(
                    [pa.array(slot, pa.int32()), pa.array(amount[used], pa.float64(), mask=~given[used])], names=["slot", "value"]
                )
                found = _list_of(flat, np.bincount(row, minlength=part.num_rows))
                yield pa.record_batch([*[part.column(c) for c in others], found], names=[*others, name])

    return rows.mapInArrow(run, schema)


def measure_vector(
    docs: DataFrame,
    measures: Sequence[int],
    *,
    dup: str = "max",
    missing_value: float | None = None,
    grain: str = "id",
    order_by: Sequence[str] = (),
    keep_empty: bool = False,
    name: str = "measures",
    layout: Layout = FOODS,
) -> DataFrame:
    """An array ``name`` with the value of each wanted id at its place, null where there is none.

    ``dup``, ``missing_value``, ``grain``, ``order_by`` and ``keep_empty`` mean what they mean in
    :func:`larder.operators.nested.pivot`, and the values are those of its columns. A null array, entry or id is no
    measurement; an id asked for twice is there twice; no rows give no rows. ``grain="document"`` does not shuffle and
    keeps all other columns. ``grain="id"`` adds up (id, measurement) before the shuffle, so that an id with many
    documents costs a row a measurement and task, and no task gathers more than a vector of one id.
    """
    _checked(dup, grain)
    known, _ = _wanted(measures)
    others = [c for c in docs.columns if c != layout.array]
    ids, values = _free(others, "_ids"), _free(others, "_values")
    entries = F.col(layout.array)
    arrays = [entries[layout.measure_id].alias(ids), entries[layout.value].cast("array<double>").alias(values)]
    if grain == "document":
        return _dense(docs.select(*others, *arrays), ids, values, measures, dup, missing_value, keep_empty, name)

    place = F.struct(*[F.col(c).alias(f"_order_{c}") for c in order_by], *layout.attributes)
    keys = [layout.source, layout.id]
    own = docs.select(*keys, place.alias("_place"), *arrays)
    found = _sparse(own, ids, values, known, dup, missing_value, "_found")
    if not keep_empty:
        found = found.where(F.size("_found") > 0)
    cells = found.select(*keys, "_place", F.explode_outer("_found").alias("_m")).select(*keys, "_place", "_m.slot", "_m.value")
    value = F.max("value") if dup == "max" else F.max_by("value", F.when(F.col("value").isNotNull(), F.col("_place")))
    merged = cells.groupBy(*keys, "slot").agg(value.alias("value"), F.min("_place").alias("_first"))
    gathered = merged.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "value"))).alias("_found"), F.min("_first").alias("_first")
    )
    rows = gathered.select(
        *keys, *[F.col("_first")[c].alias(c) for c in layout.attributes], F.col("_found.slot").alias(ids), F.col("_found.value").alias(values)
    )
    # One entry a slot is left, and places are counted among the distinct ids.
    slots = np.searchsorted(known, np.array(measures, np.int64)).tolist()
    return _dense(rows, ids, values, slots, "last", None, True, name)


def label_vectors(
    rows: DataFrame,
    columns: Sequence[str],
    rules: Sequence[Rule] = HEALTH_RULES,
    *,
    required: Sequence[str] = REQUIRED,
    minimum: int = HEALTHY_MIN,
    null_compare: str = "sql",
    name: str = "measures",
) -> DataFrame:
    """Score and label rows with a vector whose places are named by ``columns``.

    The same points as :func:`larder.operators.labeling.label`, for any number of rules: rows without a ``required``
    place are dropped, then ``healthScore``, ``isHealthy`` and ``label`` are added. A null vector has no value at all.
    """
    if null_compare not in ("sql", "lowest"):
        raise ValueError(f"null_compare is 'sql' or 'lowest', not {null_compare!r}")
    at: Mapping[str, int] = {column: k for k, column in enumerate(columns)}
    width, need = len(columns), [at[c] for c in required]
    place = np.array([at[r.column] for r in rules], np.int64)
    bound = np.array([r.bound for r in rules], float)
    below = np.array([r.op == "<" for r in rules], bool)
    replaced = np.array([r.null_as is not None for r in rules], bool)
    stand_in = np.array([r.null_as or 0.0 for r in rules], float)
    added = "healthScore", "isHealthy", "label"
    others = [c for c in rows.columns if c not in added]
    types = IntegerType(), BooleanType(), DoubleType()
    schema = StructType([*[rows.schema[c] for c in others], *[StructField(c, t) for c, t in zip(added, types)]])

    def points(values: np.ndarray, missing: np.ndarray) -> np.ndarray:
        value, gap = values[:, place], missing[:, place]
        value = np.where(gap & replaced, stand_in, value)
        gap = gap & ~replaced
        # Not a number is larger than all numbers.
        holds = np.where(below, value < bound, ~(value <= bound))
        holds = np.where(gap, below & (null_compare == "lowest"), holds)
        return holds.sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, max(width, len(rules), 1)):
                vector = part.column(name)
                full = vector.is_valid().to_numpy(zero_copy_only=False)
                flat = vector.flatten()
                values, missing = np.zeros((part.num_rows, width)), np.ones((part.num_rows, width), bool)
                values[full] = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, width)
                missing[full] = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, width)
                kept = ~missing[:, need].any(axis=1)
                part = part.filter(pa.array(kept))
                score = points(values[kept], missing[kept])
                healthy = score >= minimum
                yield pa.record_batch(
                    [*[part.column(c) for c in others], pa.array(score, pa.int32()), pa.array(healthy), pa.array(healthy.astype(float))],
                    names=[*others, *added],
                )

    return rows.mapInArrow(run, schema)
