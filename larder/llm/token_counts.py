"""Token counts from an exact histogram of encoded lengths.

Every whole text is encoded once. Tasks add up their documents by length, so
only one row per task and length is shuffled. Suffix sums over the histogram
then answer totals, quantiles and truncated totals for every context limit.

Null and empty texts have length 0 and are counted; repeated rows count as
often as they occur; other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import documents, kept, text_slices
from larder.llm.tokens import WordEncoder, vocabulary_path

HISTOGRAM = "length long, n_docs long"
# Lengths are summed in ranges first, so that no window holds all of them.
RANGE = 256


def length_histogram(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """Documents per encoded length."""
    path = vocabulary or vocabulary_path()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, counted = WordEncoder(path), np.zeros(0, np.int64)
        for batch in batches:
            for _, raw, at in text_slices(batch):
                n = np.bincount(encoder.counts(raw, at))
                if len(n) > len(counted):
                    n[: len(counted)] += counted
                    counted = n
                else:
                    counted[: len(n)] += n
        found = np.flatnonzero(counted)
        yield pa.record_batch({"length": pa.array(found, pa.int64()), "n_docs": pa.array(counted[found], pa.int64())})

    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(lengths, HISTOGRAM)
    return parts.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """For each length as a context limit: documents and tokens that reach it, and all tokens left after truncation.

    ``docs_below`` with ``docs_at_least`` gives the limit's quantile.
    """
    here = histogram.select(
        "length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("length") / RANGE).alias("part")
    )
    total = here.groupBy("part").agg(F.sum("n_docs").alias("part_docs"), F.sum("n_tokens").alias("part_tokens"))
    wide = total.withColumn("group", F.floor(F.col("part") / RANGE))
    groups = wide.groupBy("group").agg(F.sum("part_docs").alias("group_docs"), F.sum("part_tokens").alias("group_tokens"))
    later = Window.orderBy(F.col("group").desc()).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("group", *[F.coalesce(F.sum(f"group_{c}").over(later), F.lit(0)).alias(f"g_{c}") for c in ("docs", "tokens")])
    inner = Window.partitionBy("group").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    parts = wide.join(groups, "group").select(
        "part", *[(F.coalesce(F.sum(f"part_{c}").over(inner), F.lit(0)) + F.col(f"g_{c}")).alias(f"p_{c}") for c in ("docs", "tokens")]
    )
    own = Window.partitionBy("part").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = here.join(parts, "part").select(
        "length",
        "n_docs",
        (F.sum("n_docs").over(own) + F.col("p_docs")).alias("docs_at_least"),
        (F.sum("n_tokens").over(own) + F.col("p_tokens")).alias("tokens_at_least"),
    )
    all_docs, all_tokens = (F.lit(n) for n in total_tokens(histogram).first())
    return summed.select(
        "length",
        "n_docs",
        "docs_at_least",
        (all_docs - F.col("docs_at_least")).alias("docs_below"),
        "tokens_at_least",
        (all_tokens - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
    )


def total_tokens(histogram: DataFrame, limit: int | None = None) -> DataFrame:
    """One row: documents and tokens, each document cut at the limit."""
    length = F.col("length") if limit is None else F.least(F.col("length"), F.lit(limit))
    return histogram.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum(length * F.col("n_docs")), F.lit(0)).alias("n_tokens")
    )


def length_quantile(table: DataFrame, share: float) -> DataFrame:
    """One row: the least length that at least this share of the documents does not exceed; null without documents."""
    reached = (F.col("docs_below") + F.col("n_docs")) >= F.lit(share) * (F.col("docs_below") + F.col("docs_at_least"))
    return table.filter(reached).agg(F.min("length").alias("length"))


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return context_table(kept(length_histogram(docs, vocabulary), "lengths"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
