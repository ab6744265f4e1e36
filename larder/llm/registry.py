"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from larder.llm import (
    bpe_stream, decontamination, fingerprints, language_id, ngram_join, packing, prefix_trie, secret_scans, sql, substring_dedup,
    suffix_dedup, token_counts, toxicity, vector_codes,
)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": substring_dedup.query,
        "op2_secret_scans": secret_scans.query,
        "op3_ngram_jaccard_join": ngram_join.query,
        "op4_document_fingerprints": fingerprints.query,
        "op5_token_counts": token_counts.query,
        "op6_suffix_array_dedup": suffix_dedup.query,
        "op7_benchmark_decontamination": decontamination.query,
        "op8_toxicity": toxicity.query,
        "op9_best_fit_packing": packing.query,
        "op10_language_id": language_id.query,
        "op11_vector_codes": vector_codes.query,
        "op12_bpe_stream": bpe_stream.query,
        "op13_prefix_trie": prefix_trie.query,
        "pipeline": corpus_pipeline.run,
    }


def all_sql() -> dict[str, str]:
    return sql.all_sql()
