"""SQL of the operators that SQL can express."""

from __future__ import annotations

from larder.llm import decontamination, prefix_trie, vector_codes

# Runs of covered windows become spans; what lies between the spans is kept.
_SPANS = """
marked AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {window} AS apart
  FROM windows JOIN firsts USING (s) WHERE first_id < doc_id
), numbered AS (
  SELECT doc_id, i, sum(CASE WHEN apart IS NULL OR apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked
), spans AS (
  SELECT doc_id, span, min(i) AS a, max(i) + {window} AS b FROM numbered GROUP BY 1, 2
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL
  SELECT d.doc_id, coalesce(max(s.b), 0), any_value(d.n) FROM d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id
), removed AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY 1)
"""

WORDS = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, len(w) AS n FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1 : i + 13], ' ') AS s FROM d, LATERAL (SELECT unnest(range(0, n - 12)) AS i) WHERE n >= 13
), firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
{_SPANS.format(window=13)},
kept AS (
  SELECT doc_id, string_agg(array_to_string(w[a + 1 : b], ' '), ' ' ORDER BY a) AS t
  FROM gaps JOIN d USING (doc_id) WHERE b > a GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

BYTES = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, length(h) // 2 AS n FROM documents
), windows AS (
  SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS s FROM d, LATERAL (SELECT unnest(range(0, n - 49)) AS i) WHERE n >= 50
), firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
{_SPANS.format(window=50)},
kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS t
  FROM gaps JOIN d USING (doc_id) WHERE b > a GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

JOIN = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w, least(3, len(w)) AS k
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s
  FROM d WHERE k > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other)::BIGINT AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": WORDS,
        "op3_ngram_jaccard_join": JOIN,
        "op6_suffix_array_dedup": BYTES,
        "op7_benchmark_decontamination": decontamination.SQL,
        "op11_vector_codes": vector_codes.SQL,
        "op13_prefix_trie": prefix_trie.SQL,
    }
