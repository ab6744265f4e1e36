from larder.operators import raw_queries as rq
from larder.operators.nested import unnest


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_unnest_drops_or_keeps_documents_without_measurements(foods):
    docs = foods(
        (1, "A", "survey", [(1008, 1.0), (1051, 2.0)]), (2, "A", "survey", []), (3, "A", "survey", None)
    ).select("fdcId", "foodNutrients")
    assert rows(unnest(docs)) == [(1, 1008, "n1008", "G", 1.0), (1, 1051, "n1051", "G", 2.0)]
    assert rows(unnest(docs, [1051])) == [(1, 1051, "n1051", "G", 2.0)]
    kept = unnest(docs, keep_empty=True).orderBy("fdcId", "nutrientId")
    assert [r[:2] for r in rows(kept)] == [(1, 1008), (1, 1051), (2, None), (3, None)]
    only = unnest(docs, [1008], keep_empty=True).orderBy("fdcId")
    assert [r[:2] for r in rows(only)] == [(1, 1008), (2, None), (3, None)]


def test_listing_and_filtering(foods):
    docs = foods((3, "B", "survey", []), (1, "A", "legacy", []), (2, "A", "survey", []))
    assert [r[0] for r in rows(rq.all_foods(docs, limit=2))] == [1, 2]
    assert rq.all_foods(docs).count() == 3
    assert rows(rq.foods_by_category(rq.of_source(docs, "survey"), "A")) == [(2, "food 2", "A")]


def test_counts_descend_and_include_the_missing_category(foods):
    docs = foods((1, "A", "s", []), (2, None, "s", []), (3, "B", "s", []), (4, "B", "s", []))
    assert rows(rq.count_foods_by_category(docs)) == [("B", 2), (None, 1), ("A", 1)]


def test_summary_counts_names_and_documents(foods):
    docs = foods(
        (1, "A", "s", [(1051, 9.0), (1008, 0.25), (1008, 0.0), (1003, None)]),
        (2, "A", "s", [(1003, 4.0)]),
        (3, "A", "s", [(1051, 9.0)]),
        (4, "B", "s", [(1008, 1.0)]),
    )
    nested = rq.nutrition_summary(docs)
    assert rows(nested.select("foodCategory", "nutrient_groups", "food_count")) == [("A", 2, 2), ("B", 1, 1)]
    # The mean of 0.25 and 0 is 0.125; the even digit wins the tie.
    assert sorted(rows(rq.nutrition_summary_long(nested))) == [
        ("A", "n1003", 4.0, 2, 2, 2),
        ("A", "n1008", 0.12, 2, 2, 2),
        ("B", "n1008", 1.0, 1, 1, 1),
    ]
    up = rq.nutrition_summary_long(rq.nutrition_summary(docs, ties="up"))
    assert ("A", "n1008", 0.13, 2, 2, 2) in rows(up)


def test_summary_of_a_single_measure(foods):
    docs = foods((1, "A", "s", [(1051, 1.0), (1008, 2.0)]))
    assert rows(rq.nutrition_summary_long(rq.nutrition_summary(docs, [1008]))) == [
        ("A", "n1008", 2.0, 1, 1, 1)
    ]


def test_averages_by_category(foods):
    docs = foods(
        (1, "B", "s", [(1008, 1.0), (1079, 7.0)]),
        (2, None, "s", [(1008, 3.0)]),
        (3, "B", "s", [(1008, 2.0), (1003, 1.0)]),
    )
    assert rows(rq.avg_nutrients_long(docs)) == [
        (None, "n1008", 3.0),
        ("B", "n1003", 1.0),
        ("B", "n1008", 1.5),
    ]
    nested = rq.avg_nutrients_by_category(docs).collect()
    assert [tuple(n) for n in nested[1]["nutrients"]] == [("n1003", 1.0), ("n1008", 1.5)]


def test_comparison_skips_missing_values_but_counts_them(foods):
    docs = foods((1, "A", "x", [(1008, 1.0), (1008, None)]), (2, "A", "y", [(1008, 4.0)]))
    assert rows(rq.cross_source_comparison(docs)) == [
        ("x", "n1008", 1.0, 1.0, 1.0, 2),
        ("y", "n1008", 4.0, 4.0, 4.0, 1),
    ]


def test_top_puts_missing_values_last_and_breaks_ties_by_id(foods):
    docs = foods(
        (3, "A", "s", [(1008, 5.0)]),
        (2, "A", "s", [(1008, 5.0)]),
        (1, "A", "s", [(1008, None)]),
        (4, "A", "s", [(1003, 99.0)]),
    )
    top = rows(rq.top_foods_by_nutrient(docs, 1008, 3))
    assert [(r[0], r[4], r[5]) for r in top] == [(2, 5.0, "G"), (3, 5.0, "G"), (1, None, "G")]
