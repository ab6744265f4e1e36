"""Schemaless documents with dirty values: what fits the schema is loaded, the rest is set aside with its reasons.

A line is parsed once into a ``VARIANT``, which takes any JSON. Every field of the schema
is then asked for with a cast that gives null instead of failing, so ``"12.5"`` is a number
and ``"n/a"`` is none. A field that is there, is not null and does not cast is a
problem, named by its path; absent and null fields are missing values as ever. Fields
outside the schema stay in the variant, for :func:`field`. All of it is built-in and
needs no shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from larder.config import FOODS, Layout
from larder.sources.schemas import Extra, document_schema

RAW, TEXT, PROBLEMS = "raw", "text", "problems"
NOT_JSON = "not a JSON object"


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def field(value: Column | str, name: str, kind: str) -> Column:
    """A field of a variant column, null where it is missing or does not cast."""
    return F.try_variant_get(F.col(value) if isinstance(value, str) else value, _path(name), kind)


def _has_fields(kind: DataType) -> bool:
    return isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType)


def _ddl(kind: DataType, leaf: str | None = None) -> str:
    """A type for a cast; with ``leaf`` all fields of an array's objects are of that type."""
    if not _has_fields(kind):
        return kind.simpleString()
    fields = ("`" + f.name.replace("`", "``") + "`:" + (leaf or _ddl(f.dataType)) for f in kind.elementType.fields)
    return f"array<struct<{','.join(fields)}>>"


def _filled(value: Column, kind: DataType) -> Column:
    """An entry that is no object has no fields, but counts."""
    if not _has_fields(kind):
        return value
    return F.transform(value, lambda e: F.struct(*[_filled(e[f.name], f.dataType).alias(f.name) for f in kind.elementType.fields]))


def _problems(typed: Column, found: Column, kind: DataType, path: str) -> list[Column]:
    """Paths of what is there, is not null and did not cast, for a field and those of its entries.

    An array is cast as a whole, once to its type and once to objects of variants; the second
    is looked at only in entries that lack a field.
    """
    nothing = F.array().cast("array<string>")
    wrong = [F.when(found.isNotNull() & ~F.is_variant_null(found) & typed.isNull(), F.array(F.lit(path))).otherwise(nothing)]
    if not _has_fields(kind):
        return wrong
    fields = kind.elementType.fields
    there = F.try_variant_get(found, "$", _ddl(kind, "variant"))

    def of_entry(entry: Column, variants: Column) -> Column:
        return F.concat(*[p for f in fields for p in _problems(entry[f.name], variants[f.name], f.dataType, f"{path}.{f.name}")])

    if not any(_has_fields(f.dataType) for f in fields):
        gaps = F.exists(typed, lambda e: reduce(or_, [e[f.name].isNull() for f in fields]))
    else:
        gaps = F.lit(True)
    inner = F.flatten(F.zip_with(typed, there, of_entry))
    return [*wrong, F.when(gaps, F.coalesce(F.array_distinct(inner), nothing)).otherwise(nothing)]


def parse_documents(lines: DataFrame, *, text: str = "value", extra: Extra = (), layout: Layout = FOODS) -> DataFrame:
    """Each JSON text as a document of the schema, with its variant, the text itself if it has problems, and these.

    Other columns are kept. A blank line is dropped, as a JSON reader does.
    """
    schema = document_schema(extra, layout)
    named = {*schema.fieldNames(), RAW, TEXT, PROBLEMS}
    others = [c for c in lines.columns if c != text and c not in named]
    parsed = lines.where(F.trim(F.regexp_replace(text, r"[\r\n\t]", " ")) != "").withColumn(RAW, F.try_parse_json(text))
    value = F.col(RAW)
    is_object = value.isNotNull() & F.regexp_like(F.col("_line"), F.lit(r"^\s*\{"))
    columns = [_filled(F.try_variant_get(value, _path(f.name), _ddl(f.dataType)), f.dataType).alias(f.name) for f in schema.fields]
    problems = [p for f in schema.fields for p in _problems(F.col(f"`{f.name}`"), F.try_variant_get(value, _path(f.name), "variant"), f.dataType, f.name)]
    wrong = F.when(is_object, F.concat(*problems)).otherwise(F.array(F.lit(NOT_JSON)))
    typed = parsed.select(*others, *columns, RAW, F.col(text).alias("_line"))
    rows = typed.withColumn(PROBLEMS, wrong).select(*others, *schema.fieldNames(), RAW, PROBLEMS, "_line")
    return rows.withColumn(TEXT, F.when(F.size(PROBLEMS) > 0, F.col("_line"))).drop("_line")


def read_dirty(spark: SparkSession, path: str, *, extra: Extra = (), layout: Layout = FOODS) -> DataFrame:
    """A landed snapshot of JSON Lines whose values may be dirty."""
    return parse_documents(spark.read.text(path), extra=extra, layout=layout)
