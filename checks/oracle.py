"""The checked queries as SQL over the given tables.

The SQL works on flat facts and never builds an array, so a wrong unnest or
pivot on the Spark side shows. Common tables come first; each key adds a final
SELECT.
"""

from __future__ import annotations

from math import exp, factorial

# Measurement id of each wide column.
IDS = {
    "calories": 1008,
    "protein": 1003,
    "total_fat": 1004,
    "total_sugars": 2000,
    "sodium": 1093,
    "fiber": 1079,
    "saturated_fat": 1258,
    "cholesterol": 1253,
}
EIGHT = ", ".join(IDS)
KEY_IDS = ", ".join(str(i) for i in IDS.values())
MAIN_IDS = "1008, 1003, 1004, 2000"

_max_columns = ",\n".join(f"MAX(CASE WHEN nutrientId = {i} THEN value END) AS {n}" for n, i in IDS.items())
_last_columns = ",\n".join(
    f"ARG_MAX(COALESCE(value, CAST(0 AS DOUBLE)), pos) FILTER (WHERE nutrientId = {i}) AS {n}"
    for n, i in IDS.items()
)
_filled = ", ".join(f"COALESCE({n}, CAST(0 AS DOUBLE)) AS {n}" for n in IDS)

DOCS = """
foods AS (
  SELECT p_partkey AS fdcId, p_name AS description,
         CASE WHEN p_partkey % 20 < 11 THEN 'Survey (FNDDS)'
              WHEN p_partkey % 20 < 19 THEN 'SR Legacy' ELSE 'Foundation' END AS dataType,
         CASE WHEN p_size = 50 THEN NULL ELSE p_type END AS foodCategory,
         CASE WHEN p_partkey % 20 < 11 THEN 'survey'
              WHEN p_partkey % 20 < 19 THEN 'legacy' ELSE 'foundation' END AS sourceCollection
  FROM part
),
docs AS (
  SELECT 0 AS copy, foods.* FROM foods
  UNION ALL
  SELECT 1 AS copy, foods.* FROM foods WHERE fdcId % 40 = 3
),
measures AS (
  SELECT l_partkey, CAST(l_linenumber % 7 AS INTEGER) AS slot,
         CAST((l_orderkey + l_linenumber) % 12 AS INTEGER) AS kind,
         MAX(CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN NULL ELSE l_extendedprice END) AS price
  FROM lineitem WHERE l_partkey % 50 <> 7
  GROUP BY 1, 2, 3
),
named AS (
  SELECT l_partkey, slot, slot * 12 + kind AS pos,
         CASE kind WHEN 0 THEN 1008 WHEN 1 THEN 1003 WHEN 2 THEN 1004 WHEN 3 THEN 2000 WHEN 4 THEN 1093
                   WHEN 5 THEN 1079 WHEN 6 THEN 1258 WHEN 7 THEN 1253 ELSE 1051 END AS nutrientId,
         CASE kind WHEN 0 THEN 'Energy' WHEN 1 THEN 'Protein' WHEN 2 THEN 'Total fat' WHEN 3 THEN 'Sugars'
                   WHEN 4 THEN 'Sodium' WHEN 5 THEN 'Fiber' WHEN 6 THEN 'Saturated fat'
                   WHEN 7 THEN 'Cholesterol' ELSE 'Water' END AS nutrientName,
         CASE kind WHEN 0 THEN 'KCAL' WHEN 4 THEN 'MG' WHEN 7 THEN 'MG' ELSE 'G' END AS unitName,
         price / (CASE kind WHEN 0 THEN 180 WHEN 1 THEN 4000 WHEN 2 THEN 2500 WHEN 3 THEN 5000
                            WHEN 4 THEN 130 WHEN 5 THEN 15000 WHEN 6 THEN 10000 WHEN 7 THEN 500
                            ELSE 1000 END) AS value
  FROM measures
),
facts AS (
  SELECT docs.*, pos, nutrientId, nutrientName, unitName, value
  FROM docs JOIN named ON fdcId = l_partkey
  WHERE copy = 0 OR slot % 2 = 0
)"""

WIDE_MAX = f"""{DOCS},
key_facts AS (SELECT * FROM facts WHERE nutrientId IN ({KEY_IDS})),
pivoted AS (
  SELECT sourceCollection, fdcId, {_max_columns}
  FROM key_facts GROUP BY sourceCollection, fdcId
),
firsts AS (
  SELECT sourceCollection, fdcId, description, dataType, foodCategory,
         ROW_NUMBER() OVER (PARTITION BY sourceCollection, fdcId
           ORDER BY copy, description NULLS FIRST, dataType NULLS FIRST, foodCategory NULLS FIRST) AS rn
  FROM key_facts
),
wide_max AS (
  SELECT f.sourceCollection, f.fdcId, description, dataType, foodCategory, {EIGHT}
  FROM firsts f JOIN pivoted p ON f.sourceCollection = p.sourceCollection AND f.fdcId = p.fdcId
  WHERE rn = 1
)"""

WIDE_LAST = f"""{DOCS},
held AS (
  SELECT 0 AS half, named.* FROM named
  UNION ALL
  SELECT 1 AS half, named.* FROM named WHERE slot % 2 = 0
),
lasts AS (SELECT l_partkey, half, {_last_columns} FROM held GROUP BY l_partkey, half),
wide_last AS (
  SELECT fdcId, copy, COALESCE(description, '') AS description,
         COALESCE(foodCategory, 'Unknown') AS foodCategory, dataType, sourceCollection, {EIGHT}
  FROM docs LEFT JOIN lasts ON fdcId = l_partkey AND copy = half
)"""


def _points(sugars: str) -> str:
    return f"""(CASE WHEN calories < 300 THEN 1 ELSE 0 END
    + CASE WHEN {sugars} THEN 1 ELSE 0 END
    + CASE WHEN COALESCE(sodium, 0) < 400 THEN 1 ELSE 0 END
    + CASE WHEN COALESCE(saturated_fat, 0) < 5 THEN 1 ELSE 0 END
    + CASE WHEN COALESCE(fiber, 0) > 3 THEN 1 ELSE 0 END
    + CASE WHEN protein > 5 THEN 1 ELSE 0 END)"""


LOWEST = _points("total_sugars IS NULL OR total_sugars < 10")
SQL_NULLS = _points("total_sugars < 10")

LABELED_MAX = f"""{WIDE_MAX},
scored AS (
  SELECT *, {LOWEST} AS healthScore FROM wide_max
  WHERE calories IS NOT NULL AND protein IS NOT NULL AND total_fat IS NOT NULL
),
labeled_max AS (SELECT *, healthScore >= 4 AS isHealthy FROM scored)"""

LABELED_LAST = f"""{WIDE_LAST},
rated AS (
  SELECT *, {SQL_NULLS} AS healthScore, {LOWEST} AS lowest_score FROM wide_last
  WHERE calories IS NOT NULL AND protein IS NOT NULL AND total_fat IS NOT NULL
),
labeled_last AS (
  SELECT *, healthScore >= 4 AS isHealthy,
         CAST(CASE WHEN healthScore >= 4 THEN 1 ELSE 0 END AS DOUBLE) AS label
  FROM rated
)"""

# Sums of one (food, copy) first: a part may have several rows, each a document of its own.
_counted = """
SELECT d.fdcId, d.description, d.dataType, d.foodCategory, d.sourceCollection,
       COALESCE(n_nutrients, 0) AS n_nutrients, COALESCE(id_sum, 0) AS id_sum,
       COALESCE(value_sum, 0) AS value_sum, COALESCE(n_unread, 0) AS n_unread
FROM docs d LEFT JOIN (
  SELECT l_partkey, half, CAST(COUNT(*) AS INTEGER) AS n_nutrients, CAST(SUM(nutrientId * place) AS BIGINT) AS id_sum,
         CAST(SUM(CAST(ROUND(COALESCE(value, -1) * 100) AS BIGINT) * place) AS BIGINT) AS value_sum,
         CAST(COUNT(*) - COUNT(value) AS INTEGER) AS n_unread
  FROM (
    SELECT l_partkey, half, nutrientId, value, ROW_NUMBER() OVER (PARTITION BY l_partkey, half ORDER BY pos) AS place
    FROM named, (SELECT UNNEST([0, 1]) AS half) WHERE half = 0 OR slot % 2 = 0
  ) GROUP BY l_partkey, half
) f ON d.fdcId = l_partkey AND d.copy = half"""

_long = f"""
SELECT g.sourceCollection, g.foodCategory, nutrient, avg_value, count,
       COUNT(*) OVER (PARTITION BY g.sourceCollection, g.foodCategory) AS nutrient_groups, food_count
FROM (
  SELECT sourceCollection, foodCategory, nutrientName AS nutrient,
         ROUND_EVEN(AVG(value), 2) AS avg_value, COUNT(*) AS count
  FROM facts WHERE nutrientId IN ({KEY_IDS})
  GROUP BY sourceCollection, foodCategory, nutrientName
) g JOIN (
  SELECT sourceCollection, foodCategory, COUNT(*) AS food_count FROM docs d
  WHERE EXISTS (
    SELECT 1 FROM named n WHERE n.l_partkey = d.fdcId AND (d.copy = 0 OR n.slot % 2 = 0)
      AND nutrientId IN ({KEY_IDS}))
  GROUP BY sourceCollection, foodCategory
) c ON g.sourceCollection = c.sourceCollection AND g.foodCategory IS NOT DISTINCT FROM c.foodCategory"""
_summary = f"SELECT * EXCLUDE sourceCollection FROM ({_long}) WHERE sourceCollection = 'legacy'"


def _top(source: str, nutrient_id: int) -> str:
    return f"""
SELECT fdcId, description, foodCategory, nutrientName, value, unitName AS unit
FROM facts WHERE sourceCollection = '{source}' AND nutrientId = {nutrient_id}
ORDER BY value DESC NULLS LAST, fdcId, description NULLS FIRST, foodCategory NULLS FIRST, nutrientName, unit
LIMIT 5"""


def _listed(healthy: str, direction: str) -> str:
    return f"""
SELECT description, foodCategory, healthScore, calories, fdcId
FROM labeled_max WHERE {healthy}
ORDER BY healthScore {direction}, fdcId, description NULLS FIRST, foodCategory NULLS FIRST, calories
LIMIT 10"""


def _end(side: str, direction: str) -> str:
    return f"""
(SELECT '{side}' AS side, fdcId, description, healthScore, calories
 FROM labeled_max ORDER BY healthScore {direction}, fdcId, description NULLS FIRST, calories LIMIT 5)"""


_labeled_max = f"SELECT sourceCollection, fdcId, {EIGHT}, healthScore, isHealthy FROM labeled_max"
_wide_last = f"SELECT fdcId, description, foodCategory, dataType, sourceCollection, {EIGHT} FROM wide_last"

_quality = """,
scored AS (
  SELECT label, CAST(CASE WHEN lowest_score >= 4 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, lowest_score AS s
  FROM labeled_last
),
cells AS (
  SELECT label, prediction, CAST(COUNT(*) AS DOUBLE) AS n FROM scored GROUP BY label, prediction
),
classes AS (
  SELECT truth.class, truth.n AS truth, COALESCE(hits.n, 0) AS hits,
         COALESCE(hits.n / predicted.n, 0) AS p, COALESCE(hits.n / truth.n, 0) AS r
  FROM (SELECT label AS class, SUM(n) AS n FROM cells GROUP BY label) truth
  LEFT JOIN (SELECT prediction AS class, SUM(n) AS n FROM cells GROUP BY prediction) predicted
    ON truth.class = predicted.class
  LEFT JOIN (SELECT label AS class, n FROM cells WHERE label = prediction) hits
    ON truth.class = hits.class
),
averages AS (
  SELECT SUM(hits) / SUM(truth) AS accuracy, SUM(p * truth) / SUM(truth) AS precision_,
         SUM(r * truth) / SUM(truth) AS recall_,
         SUM(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * truth) / SUM(truth) AS f1
  FROM classes
),
by_score AS (
  SELECT s, SUM(label) AS pos, SUM(1 - label) AS neg FROM scored GROUP BY s
),
ranked AS (
  SELECT pos, neg, SUM(neg) OVER (ORDER BY s) - neg AS below FROM by_score
),
area AS (
  SELECT SUM(pos * (below + neg / 2)) / (SUM(pos) * SUM(neg)) AS auc FROM ranked
)
SELECT 'accuracy' AS metric, ROUND(accuracy, 4) AS value FROM averages
UNION ALL SELECT 'precision', ROUND(precision_, 4) FROM averages
UNION ALL SELECT 'recall', ROUND(recall_, 4) FROM averages
UNION ALL SELECT 'f1', ROUND(f1, 4) FROM averages
UNION ALL SELECT 'auc', ROUND(auc, 4) FROM area"""

# A Poisson number of mean one from each of the eight 15-bit numbers of a digest.
_cuts, _sum = [], 0.0
for _k in range(7):
    _sum += exp(-1) / factorial(_k)
    _cuts.append(round(_sum * 32768))

_intervals = f""",
judged AS (
  SELECT 'other_nulls' AS model, fdcId, label, CAST(CASE WHEN lowest_score >= 4 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
         lowest_score / CAST(6 AS DOUBLE) AS score
  FROM labeled_last
  UNION ALL
  SELECT 'calories', fdcId, label, CASE WHEN calories < 300 THEN 1 ELSE 0 END, 1 - LEAST(calories, 1000) / CAST(1000 AS DOUBLE)
  FROM labeled_last
),
drawn AS (
  SELECT -1 AS replicate, NULL AS fdcId, CAST(1 AS BIGINT) AS w
  UNION ALL
  SELECT replicate, fdcId, {' + '.join(f'CAST(number >= {c} AS BIGINT)' for c in _cuts)}
  FROM (
    SELECT replicate, fdcId,
           (CAST('0x' || SUBSTR(MD5(CAST(fdcId AS VARCHAR) || ':' || CAST(replicate // 8 AS VARCHAR)),
              CASE WHEN replicate % 8 < 4 THEN 1 ELSE 16 END, 15) AS BIGINT) >> CAST(15 * (replicate % 4) AS BIGINT)) & 32767 AS number
    FROM (SELECT DISTINCT fdcId FROM labeled_last), (SELECT UNNEST(RANGE(60)) AS replicate)
  )
),
cells AS (
  SELECT model, replicate, label, prediction, LEAST(49, CAST(FLOOR(score * 50) AS INTEGER)) AS bin, SUM(w) AS n
  FROM judged j JOIN drawn d ON d.fdcId = j.fdcId OR d.replicate = -1 GROUP BY ALL HAVING SUM(w) > 0
),
truths AS (SELECT model, replicate, label AS class, SUM(n) AS n FROM cells GROUP BY ALL),
saids AS (SELECT model, replicate, prediction AS class, SUM(n) AS n FROM cells GROUP BY ALL),
hits AS (SELECT model, replicate, label AS class, SUM(n) AS n FROM cells WHERE label = prediction GROUP BY ALL),
sides AS (
  SELECT model, replicate, t.n AS truth, COALESCE(h.n, 0) AS hit, COALESCE(h.n / s.n, 0) AS p, COALESCE(h.n / t.n, 0) AS r
  FROM truths t LEFT JOIN saids s USING (model, replicate, class) LEFT JOIN hits h USING (model, replicate, class)
),
ranked AS (
  SELECT model, replicate, pos, neg, SUM(neg) OVER (PARTITION BY model, replicate ORDER BY bin) - neg AS below
  FROM (
    SELECT model, replicate, bin, SUM(CASE WHEN label = 1 THEN n ELSE 0 END) AS pos, SUM(CASE WHEN label = 1 THEN 0 ELSE n END) AS neg
    FROM cells GROUP BY ALL
  )
),
found AS (
  SELECT model, replicate, UNNEST(['accuracy', 'precision', 'recall', 'f1']) AS metric,
         UNNEST([SUM(hit) / SUM(truth), SUM(p * truth) / SUM(truth), SUM(r * truth) / SUM(truth),
                 SUM(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * truth) / SUM(truth)]) AS value
  FROM sides GROUP BY model, replicate
  UNION ALL
  SELECT model, replicate, 'auc',
         CASE WHEN SUM(pos) * SUM(neg) > 0 THEN SUM(pos * (below + neg / 2)) / (SUM(pos) * SUM(neg)) END
  FROM ranked GROUP BY model, replicate
),
compared AS (
  SELECT * FROM found
  UNION ALL
  SELECT 'other_nulls - calories', replicate, metric, a.value - b.value
  FROM (SELECT * FROM found WHERE model = 'other_nulls') a JOIN (SELECT * FROM found WHERE model = 'calories') b USING (replicate, metric)
)
SELECT model, metric, ROUND(MAX(value) FILTER (WHERE replicate = -1), 4) AS value,
       ROUND(QUANTILE_CONT(value, 0.025) FILTER (WHERE replicate >= 0), 4) AS low,
       ROUND(QUANTILE_CONT(value, 0.975) FILTER (WHERE replicate >= 0), 4) AS high
FROM compared GROUP BY model, metric"""

_cube_parts = (
    ("category_label", "foodCategory", None, "isHealthy"), ("category", "foodCategory", None, None),
    ("source_label", None, "sourceCollection", "isHealthy"), ("source", None, "sourceCollection", None), ("all", None, None, None),
)


def _cube(table: str) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{level}' AS level, {c or 'NULL'} AS category, {s or 'NULL'} AS source, {h or 'NULL'} AS isHealthy, COUNT(*) AS total,
  COUNT(*) FILTER (WHERE isHealthy) AS healthy, COUNT(*) FILTER (WHERE NOT isHealthy) AS unhealthy,
  ROUND(AVG(healthScore), 4) AS "avg_healthScore", ROUND(AVG(calories), 4) AS avg_calories, ROUND(AVG(protein), 4) AS avg_protein,
  ROUND(AVG(total_sugars), 4) AS avg_total_sugars
FROM {table}{' GROUP BY ' + keys if (keys := ', '.join(k for k in (c, s, h) if k)) else ''}"""
        for level, c, s, h in _cube_parts
    )


# Documents that the dates hold in the end.
DATED = DOCS.replace("FROM part\n", "FROM part WHERE p_partkey % 4 IN (0, 2) OR p_partkey % 8 = 1\n", 1)

# key -> (common tables, final SELECT)
_parts = {
    "read_snapshot": (DOCS, _counted),
    "read_array": (DOCS, _counted),
    "scan_raw": (DOCS, _counted),
    "load_replace": (DOCS, _counted),
    "load_replace_empty": (DOCS, _counted.replace("FROM docs d", "FROM (SELECT * FROM docs WHERE sourceCollection <> 'legacy') d")),
    "load_append": (DOCS, """
SELECT sourceCollection, COUNT(*) * (CASE WHEN sourceCollection = 'foundation' THEN 2 ELSE 1 END) AS row_count
FROM docs GROUP BY sourceCollection"""),
    "verify_counts": (DOCS, """
SELECT sourceCollection, COUNT(*) AS landed, COUNT(*) AS loaded, TRUE AS matches
FROM docs GROUP BY sourceCollection"""),
    "load_rejects": (DOCS, """
SELECT CASE WHEN fdcId % 10 <> 0 THEN sourceCollection END AS sourceCollection,
       CASE WHEN fdcId % 10 <> 0 AND sourceCollection IN ('survey', 'legacy') THEN 'loaded' ELSE 'rejected' END AS state,
       COUNT(*) AS row_count, CAST(SUM(fdcId) AS BIGINT) AS id_sum
FROM docs GROUP BY 1, 2"""),
    "load_dirty": (DOCS, f"""
SELECT * FROM ({_counted}) WHERE fdcId % 17 <> 0 AND (fdcId % 13 <> 0 OR n_nutrients = n_unread)"""),
    "load_dirty_rejects": (DOCS, f"""
SELECT sourceCollection, CASE WHEN fdcId % 17 = 0 THEN 'not a JSON object' ELSE 'foodNutrients.value' END AS problem, COUNT(*) AS row_count
FROM ({_counted}) WHERE fdcId % 17 = 0 OR (fdcId % 13 = 0 AND n_nutrients > n_unread) GROUP BY 1, 2"""),
    "load_refused": (DOCS, _counted),
    "load_versions": (DOCS, """
SELECT version, sourceCollection, COUNT(*) * MAX(CASE WHEN version = 3 AND sourceCollection = 'legacy' THEN 2 ELSE 1 END) AS row_count
FROM docs, (SELECT UNNEST([1, 2, 3]) AS version)
WHERE version = 1 OR sourceCollection <> 'survey' OR fdcId % 2 = 0
GROUP BY version, sourceCollection"""),
    "write_labeled": (LABELED_MAX, _labeled_max),
    "summary_to_table": (DOCS, _summary),
    "nutrition_summary_all_sources": (DOCS, _long),
    "nutrition_summary_nested": (DOCS, f"""
SELECT foodCategory, string_agg(printf('%s=%.2f/%d', nutrient, avg_value, count), '; ' ORDER BY nutrient) AS nutrients,
       any_value(nutrient_groups) AS nutrient_groups, any_value(food_count) AS food_count
FROM ({_summary}) GROUP BY foodCategory"""),
    "count_foods_all_sources": (DOCS, """
SELECT sourceCollection, foodCategory, COUNT(*) AS count FROM docs GROUP BY 1, 2"""),
    "avg_nutrients_all_sources": (DOCS, f"""
SELECT sourceCollection, foodCategory, nutrientName AS nutrient, ROUND_EVEN(AVG(value), 2) AS avg_value
FROM facts WHERE nutrientId IN ({MAIN_IDS}) GROUP BY 1, 2, 3"""),
    "avg_nutrients_by_category": (DOCS, f"""
SELECT foodCategory, string_agg(printf('%s=%.2f', nutrient, avg_value), '; ' ORDER BY nutrient) AS nutrients
FROM (
  SELECT foodCategory, nutrientName AS nutrient, ROUND_EVEN(AVG(value), 2) AS avg_value
  FROM facts WHERE sourceCollection = 'foundation' AND nutrientId IN ({MAIN_IDS}) GROUP BY 1, 2
) GROUP BY foodCategory"""),
    "query_timing": ("one AS (SELECT 1)", """
SELECT unnest(['count_by_category', 'avg_nutrients_by_category', 'top_10_highest_calorie',
  'healthy_vs_unhealthy_by_category', 'cross_collection_comparison', 'high_protein_low_fat']) AS query, TRUE AS was_timed"""),
    "predictions_csv": (LABELED_LAST, f"""
SELECT CASE WHEN description = '' THEN NULL ELSE description END AS description, foodCategory, label, {_filled}
FROM labeled_last WHERE CAST('0x' || SUBSTR(MD5(CAST(fdcId AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 80"""),
    "label_other_rules": (f"""{DOCS},
other AS (
  SELECT sourceCollection, fdcId, MAX(CASE WHEN nutrientId = 1051 THEN value END) AS water,
         MAX(CASE WHEN nutrientId = 1079 THEN value END) AS fiber
  FROM facts WHERE nutrientId IN (1051, 1079) GROUP BY 1, 2
)""", """
SELECT sourceCollection, fdcId, water, fiber, points AS healthScore, points >= 2 AS isHealthy
FROM (
  SELECT *, CAST((CASE WHEN water > 40 THEN 1 ELSE 0 END)
    + (CASE WHEN COALESCE(fiber, 9) < 3 THEN 1 ELSE 0 END) AS INTEGER) AS points
  FROM other WHERE water IS NOT NULL
)"""),
    "unnest": (DOCS, f"""
SELECT fdcId, copy, sourceCollection, nutrientId, nutrientName, unitName, value
FROM facts WHERE nutrientId IN ({KEY_IDS})"""),
    "pivot_max": (WIDE_MAX, f"""
SELECT sourceCollection, fdcId, description, dataType, foodCategory, {EIGHT} FROM wide_max"""),
    "load_wide_last": (WIDE_LAST, _wide_last),
    "all_foods_union": (WIDE_LAST, _wide_last),
    "all_foods_limit": (DOCS, """
SELECT fdcId, description, foodCategory, dataType FROM docs WHERE sourceCollection = 'survey'
ORDER BY fdcId, description NULLS FIRST, foodCategory NULLS FIRST, dataType LIMIT 5"""),
    "foods_by_category": (DOCS, """
SELECT fdcId, description, foodCategory FROM docs
WHERE sourceCollection = 'legacy' AND foodCategory = 'ECONOMY'"""),
    "count_foods_by_category": (DOCS, """
SELECT foodCategory, COUNT(*) AS count FROM docs WHERE sourceCollection = 'legacy' GROUP BY foodCategory"""),
    "nutrition_summary": (DOCS, _summary),
    "avg_nutrients_long": (DOCS, f"""
SELECT foodCategory, nutrientName AS nutrient, ROUND_EVEN(AVG(value), 2) AS avg_value
FROM facts WHERE sourceCollection = 'foundation' AND nutrientId IN ({MAIN_IDS})
GROUP BY foodCategory, nutrientName"""),
    "cross_source_nutrients": (DOCS, f"""
SELECT sourceCollection, nutrientName, ROUND(AVG(value), 4) AS avg_value,
       MIN(value) AS min_value, MAX(value) AS max_value, COUNT(*) AS count
FROM facts WHERE nutrientId IN ({MAIN_IDS}) GROUP BY sourceCollection, nutrientName"""),
    "top_foods_by_nutrient": (DOCS, _top("survey", 1008)),
    "top_protein_foods": (DOCS, _top("legacy", 1003)),
    "label_document": (LABELED_MAX, _labeled_max),
    "label_sql": (LABELED_LAST, f"""
SELECT fdcId, copy, sourceCollection, {EIGHT}, healthScore, isHealthy, label FROM labeled_last"""),
    "label_counts": (
        LABELED_MAX + "," + LABELED_LAST.removeprefix(DOCS + ","),
        """
SELECT 'document' AS path, COUNT(*) AS total, COUNT(*) FILTER (WHERE isHealthy) AS healthy,
       COUNT(*) FILTER (WHERE NOT isHealthy) AS unhealthy FROM labeled_max
UNION ALL
SELECT 'spark', COUNT(*), COUNT(*) FILTER (WHERE isHealthy), COUNT(*) FILTER (WHERE NOT isHealthy)
FROM labeled_last""",
    ),
    "healthy_foods": (LABELED_MAX, _listed("isHealthy", "DESC")),
    "unhealthy_foods": (LABELED_MAX, _listed("NOT isHealthy", "ASC")),
    "healthiest_and_least": (
        LABELED_MAX, _end("healthiest", "DESC") + "\nUNION ALL" + _end("least_healthy", "ASC")
    ),
    "healthy_by_category_long": (LABELED_MAX, """
SELECT foodCategory AS category, CASE WHEN isHealthy THEN 'healthy' ELSE 'unhealthy' END AS label,
       COUNT(*) AS count
FROM labeled_max GROUP BY 1, 2"""),
    "avg_score_by_source": (LABELED_MAX, """
SELECT CASE WHEN isHealthy THEN 'healthy' ELSE 'unhealthy' END AS label, sourceCollection,
       ROUND(AVG(healthScore), 4) AS avg_health_score, COUNT(*) AS count
FROM labeled_max GROUP BY 1, 2"""),
    "sql_count_by_category": (LABELED_LAST, """
SELECT foodCategory, COUNT(*) AS count FROM labeled_last GROUP BY foodCategory"""),
    "sql_avg_nutrients": (LABELED_LAST, """
SELECT foodCategory, ROUND(AVG(calories), 2) AS avg_calories, ROUND(AVG(protein), 2) AS avg_protein,
       ROUND(AVG(total_fat), 2) AS avg_fat, ROUND(AVG(total_sugars), 2) AS avg_sugars
FROM labeled_last GROUP BY foodCategory"""),
    "sql_top10_calories": (LABELED_LAST, """
SELECT description, foodCategory, calories, protein, total_fat FROM labeled_last
ORDER BY calories DESC NULLS LAST, fdcId, description, foodCategory, protein, total_fat LIMIT 10"""),
    "sql_healthy_by_category": (LABELED_LAST, """
SELECT foodCategory, COUNT(*) FILTER (WHERE isHealthy) AS healthy_count,
       COUNT(*) FILTER (WHERE NOT isHealthy) AS unhealthy_count,
       ROUND(AVG(healthScore), 2) AS avg_health_score
FROM labeled_last GROUP BY foodCategory"""),
    "sql_cross_source": (LABELED_LAST, """
SELECT sourceCollection, COUNT(*) AS total, ROUND(AVG(calories), 2) AS avg_cal,
       ROUND(AVG(protein), 2) AS avg_protein, ROUND(AVG(total_sugars), 2) AS avg_sugars,
       ROUND(AVG(healthScore), 2) AS avg_health_score
FROM labeled_last GROUP BY sourceCollection"""),
    "high_protein_low_fat": (LABELED_LAST, """
SELECT description, foodCategory, protein, total_fat, calories FROM labeled_last
WHERE protein > 20 AND total_fat < 5
ORDER BY protein DESC, fdcId, description, foodCategory, total_fat, calories LIMIT 10"""),
    "label_cube": (LABELED_MAX, _cube("labeled_max")),
    "label_cube_spark": (LABELED_LAST, _cube("labeled_last")),
    "best_and_worst_by_category": (LABELED_MAX, """
SELECT * FROM (
  SELECT label, "group", fdcId, description, healthScore, calories,
         ROW_NUMBER() OVER (PARTITION BY label, "group" ORDER BY CASE WHEN label = 'healthy' THEN -healthScore ELSE healthScore END,
           fdcId, description NULLS FIRST, calories NULLS FIRST)::INTEGER AS rank
  FROM (SELECT *, CASE WHEN isHealthy THEN 'healthy' ELSE 'unhealthy' END AS label, foodCategory AS "group" FROM labeled_max)
) WHERE rank <= 5"""),
    "top_foods_every_nutrient": (DOCS, f"""
SELECT * FROM (
  SELECT sourceCollection, fdcId, description, foodCategory, nutrientId, nutrientName, value, unitName AS unit,
         ROW_NUMBER() OVER (PARTITION BY sourceCollection, nutrientId ORDER BY value DESC NULLS LAST, fdcId, description NULLS FIRST,
           foodCategory NULLS FIRST, nutrientName, unitName)::INTEGER AS rank
  FROM facts WHERE nutrientId IN ({KEY_IDS})
) WHERE rank <= 10"""),
    "measure_vector": (DOCS, f"""
SELECT d.sourceCollection, d.fdcId, d.copy, nutrientId, value
FROM docs d JOIN (
  SELECT l_partkey, half, nutrientId, MAX(value) AS value
  FROM named, (SELECT UNNEST([0, 1]) AS half) WHERE half = 0 OR slot % 2 = 0 GROUP BY 1, 2, 3
) f ON d.fdcId = l_partkey AND d.copy = half WHERE value IS NOT NULL"""),
    "measure_vector_by_id": (DOCS, """
SELECT sourceCollection, fdcId, nutrientId, MAX(value) AS value FROM facts WHERE value IS NOT NULL GROUP BY 1, 2, 3"""),
    "label_many_rules": (f"""{LABELED_MAX},
water AS (SELECT sourceCollection, fdcId, MAX(value) AS water FROM facts WHERE nutrientId = 1051 GROUP BY 1, 2)""", """
SELECT sourceCollection, fdcId, foodCategory, CAST(points AS INTEGER) AS healthScore, points >= 496 AS isHealthy,
       CAST(CASE WHEN points >= 496 THEN 1 ELSE 0 END AS DOUBLE) AS label
FROM (
  SELECT l.*, healthScore + 491 + CASE WHEN COALESCE(water, 0) < 60 THEN 1 ELSE 0 END AS points
  FROM labeled_max l LEFT JOIN water USING (sourceCollection, fdcId)
)"""),
    "metric_intervals": (LABELED_LAST, _intervals),
    "incremental_summary": (DATED, f"""
SELECT g.foodCategory, nutrient, avg_value, count, COUNT(*) OVER (PARTITION BY g.foodCategory) AS nutrient_groups, food_count
FROM (
  SELECT foodCategory, nutrientName AS nutrient, ROUND_EVEN(AVG(value), 2) AS avg_value, COUNT(*) AS count
  FROM facts WHERE nutrientId IN ({KEY_IDS}) GROUP BY 1, 2
) g JOIN (
  SELECT foodCategory, COUNT(*) AS food_count FROM docs d
  WHERE EXISTS (SELECT 1 FROM named n WHERE n.l_partkey = d.fdcId AND (d.copy = 0 OR n.slot % 2 = 0) AND nutrientId IN ({KEY_IDS}))
  GROUP BY 1
) c ON g.foodCategory IS NOT DISTINCT FROM c.foodCategory"""),
    "incremental_means": (DATED, f"""
SELECT foodCategory, nutrientName AS nutrient, ROUND_EVEN(AVG(value), 2) AS avg_value
FROM facts WHERE nutrientId IN ({MAIN_IDS}) GROUP BY 1, 2"""),
    "incremental_cross_source": (DATED, f"""
SELECT sourceCollection, nutrientName, ROUND(AVG(value), 4) AS avg_value,
       MIN(value) AS min_value, MAX(value) AS max_value, COUNT(*) AS count
FROM facts WHERE nutrientId IN ({MAIN_IDS}) GROUP BY sourceCollection, nutrientName"""),
    "ml_features": (LABELED_LAST, f"SELECT fdcId, copy, {_filled}, label FROM labeled_last"),
    "ml_split": (LABELED_LAST, """
SELECT CASE WHEN CAST('0x' || SUBSTR(MD5(CAST(fdcId AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
            THEN 'train' ELSE 'test' END AS part,
       COUNT(*) AS rows, COUNT(*) FILTER (WHERE label = 1) AS healthy_rows
FROM labeled_last GROUP BY 1"""),
    "classification_metrics": (LABELED_LAST, _quality),
}


def all_sql() -> dict[str, str]:
    return {key: f"WITH {common}\n{final}".replace("\n\n", "\n") for key, (common, final) in _parts.items()}
