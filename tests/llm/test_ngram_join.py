import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import ngram_join
from tests.llm.conftest import rows_of, sentence


def brute_force(rows, words=3, near=90):
    sets = {}
    for doc, text in rows:
        own = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        k = min(words, len(own))
        found = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        if doc not in sets or len(found) > len(sets[doc]):
            sets[doc] = found
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= near * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((d, len(s), root(d)) for d, s in sets.items())


def near_copies(seed=3):
    """Chains and clouds of near copies, so that components reach beyond one link."""
    rng = random.Random(seed)
    rows, n = [], 0
    for size in (3, 6, 12, 30, 80, 150):
        for _ in range(3):
            words = sentence(rng, size).split()
            for _ in range(8):
                rows.append((n, " ".join(words)))
                n += 1
                for _ in range(rng.randint(0, max(1, size // 40))):
                    words[rng.randrange(size)] = sentence(rng, 1) + str(rng.random())[2:5]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "near"), [(3, 90), (5, 80)])
def test_equal_to_brute_force(table, texts, words, near):
    rows = near_copies() + [(d + 10_000, t) for d, t in texts]
    found = rows_of(ngram_join.join(table(rows, clashing=True), words, near), "doc_id", "n_shingles", "component_id")
    assert found == brute_force(rows, words, near)


def test_small_trees_and_messages(table, monkeypatch):
    """Keys in parts and in several messages give the same components."""
    monkeypatch.setattr(ngram_join, "TREE_ROWS", 3)
    rows = near_copies(4)
    found = rows_of(ngram_join.join(table(rows), 3, 90), "doc_id", "n_shingles", "component_id")
    assert found == brute_force(rows)


def test_null_ids_link_with_nothing_and_empty_table(table):
    found = rows_of(ngram_join.join(table([(None, "a b c d"), (1, "a b c d"), (2, "A b C d")])), "doc_id", "n_shingles", "component_id")
    assert found == [(1, 2, 1), (2, 2, 1), (None, 2, None)]
    assert ngram_join.join(table([])).count() == 0


def test_tree_misses_no_pair_within_the_bound():
    rng = np.random.default_rng(0)
    point = rng.poisson(3, (300, ngram_join.COORDINATES)).astype(np.uint8)
    beyond = rng.integers(0, 5, 300)
    point[100:200] = point[:100] + (rng.random((100, ngram_join.COORDINATES)) < 0.1)
    n = point.sum(axis=1).astype(np.int64) + beyond
    tree = ngram_join.Tree(point, beyond, n)
    for q in range(0, 300, 7):
        bound = np.minimum(point, point[q]).sum(axis=1).astype(np.int64) + np.minimum(beyond, beyond[q])
        expected = np.flatnonzero(ngram_join.near_bound(bound, n, n[q], 90))
        assert sorted(tree.near(point[q], int(beyond[q]), int(n[q]), 90).tolist()) == expected.tolist()


def test_firsts_keep_one_of_each_group(table):
    rows = near_copies()
    kept = sorted(r.doc_id for r in ngram_join.firsts(table(rows)).collect())
    assert kept == sorted({c for _, _, c in brute_force(rows, 5, 80)})


def rows_with_repeats():
    """Near copies, rows without an id, and ids that repeat with equal, near, other and no text."""
    rows = near_copies(6)
    texts = dict(rows)
    rows += [(None, texts[0]), (None, texts[0]), (None, None), (5, texts[5]), (5, texts[5]), (9, texts[5]), (9, "quite another text of this id")]
    return rows + [(700, "quite another text of this id"), (701, ""), (701, ""), (701, None), (702, "A b c d e f g"), (702, "a b c d e f g")]


def first_rows(rows):
    """One row of each group: distinct rows in order of id and text, by brute force."""
    known = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    groups = brute_force([(k, t) for k, (_, t) in enumerate(known)], 5, 80)
    return [known[k] for k in sorted({c for _, _, c in groups})] + [r for r in rows if r[0] is None]


def test_firsts_keep_rows_without_id_and_one_of_repeated_rows(table):
    rows = rows_with_repeats()
    order = lambda r: tuple((x is None, x or 0 if k == 0 else x or "") for k, x in enumerate(r))
    found = [(r.doc_id, r.text) for r in ngram_join.firsts(table(rows).withColumn("row", F.lit(1))).collect()]
    assert sorted(found, key=order) == sorted(first_rows(rows), key=order)
    unique = near_copies(6) + [(None, "a b c d e f"), (None, "a b c d e f")]
    found = [(r.doc_id, r.text) for r in ngram_join.firsts(table(unique)).collect()]
    assert sorted(found, key=order) == sorted(first_rows(unique), key=order)


def test_run_keeps_rows_without_id_and_one_of_repeated_rows(spark, table, tmp_path, monkeypatch):
    """All stages of the pipeline but the last, which cuts the texts into pieces."""
    import corpus_pipeline

    rows = rows_with_repeats()
    table(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "no document has these words in it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[:-1])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clean = [(r.doc_id, r.text) for r in corpus_pipeline.known_languages(spark, docs, str(tmp_path)).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    found = [(r.doc_id, r.text) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(found, key=order) == sorted(first_rows(clean), key=order)
    assert len([1 for d, _ in found if d is None]) == 2


def test_fine_points_bound_the_overlap():
    rng = np.random.default_rng(3)
    for size in (0, 1, 5, 70, 300, 9000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 2**63, size // 2 + size // 9).astype(np.uint64)]))
        x, y = ngram_join.fine_points(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        shared = len(np.intersect1d(a, b))
        assert shared <= ngram_join.fine_overlap(x, y) <= min(len(a), len(b))
    many = np.arange(300_000, dtype=np.uint64) * np.uint64(4096)  # one group holds more than a byte
    (x,) = ngram_join.fine_points(many, np.array([0, len(many)]))
    assert ngram_join.fine_overlap(x, x) == len(many)


def test_empty_groups_make_no_common_key():
    """Unrelated sets share no key, and every linked pair does."""
    rng = np.random.default_rng(2)
    for near in (80, 90):
        sets = [np.unique(rng.integers(0, 2**63, size).astype(np.uint64)) for size in rng.integers(1, 200, 3000)]
        pairs = []
        for k in range(0, 1500):
            a, change = sets[k], int(rng.integers(0, 1 + len(sets[k]) * (100 - near) // 100))
            b = np.unique(np.concatenate([a[: len(a) - change], rng.integers(0, 2**63, int(rng.integers(0, change + 1))).astype(np.uint64)]))
            if 100 * len(np.intersect1d(a, b)) >= near * len(np.union1d(a, b)):
                pairs.append((k, len(sets)))
                sets.append(b)
        key, text = ngram_join.link_keys(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]), near)
        own = [set() for _ in sets]
        for k, t in zip(key.tolist(), text.tolist()):
            own[t].add(k)
        assert len(pairs) > 500 and all(own[a] & own[b] for a, b in pairs)
        _, holders = np.unique(np.unique(np.stack([key, text.astype(np.uint64)]), axis=1)[0], return_counts=True)
        # A set and its copy; the rest are unrelated.
        assert holders.max() <= 4


def test_cells_hold_each_pair_in_a_bounded_group(spark, monkeypatch):
    """Strays of a key do not go to all parts: no cell has more than its share on either side."""
    monkeypatch.setattr(ngram_join, "TREE_ROWS", 50)
    # 400 documents of one key, 200 of them strays: 8 parts, 4 of strays.
    rows = spark.range(400).selectExpr("7L AS key", "id AS doc_id", "id % 2 AS component", "id % 2 = 1 AS stray", "8L AS size_parts", "4L AS strays_parts", "5L AS n", "X'00' AS fine", "CAST(NULL AS ARRAY<BIGINT>) AS refused")
    cells = {}
    for r in ngram_join.dealt_cells(rows, 4).collect():
        cells.setdefault((r.tree, r.cell), []).append(r)
    asked = [(a.doc_id, b.doc_id) for own in cells.values() for a in own if a.asks for b in own if b.held]
    assert len(cells) == 32 and sorted(asked) == [(a, b) for a in range(1, 400, 2) for b in range(400)]
    assert max(sum(r.asks for r in own) for own in cells.values()) <= 80 and max(sum(r.held for r in own) for own in cells.values()) <= 80


def thue_morse(n):
    return [bin(k).count("1") % 2 for k in range(n)]


@pytest.mark.parametrize("length", [64, 1024, 2048])
def test_words_that_collide_in_sums_of_powers_are_told_apart(spark, table, length):
    from larder.llm import substring_dedup

    word, other = ("".join("ab"[x ^ turn] for x in thue_morse(length)) for turn in (0, 1))
    rows = [(1, " ".join([word] * 13)), (2, " ".join([other] * 13)), (3, " ".join([word] * 13 + ["x"]))]
    assert rows_of(ngram_join.join(table(rows)), "doc_id", "component_id") == [(1, 1), (2, 2), (3, 3)]
    removed = {r.doc_id: r.n_removed for r in substring_dedup.dedup(table(rows)).collect()}
    assert removed == {1: 0, 2: 0, 3: 13}


def cell(sets, component, near=90):
    """A cell of one key that all documents share, each in a component."""
    import pyarrow as pa

    first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    fine = ngram_join.fine_points(np.concatenate(sets), first)
    n = len(sets)
    columns = {"key": [5] * n, "doc_id": list(range(n)), "component": component, "n": [len(x) for x in sets], "fine": fine, "refused": [None] * n, "asks": [True] * n, "held": [True] * n}
    return pa.table(columns)


@pytest.mark.parametrize("linking", [False, True])
def test_a_cell_gives_fewer_pairs_than_documents(linking):
    """Near copies that link, and a family whose members are too far apart; both far more pairs than rows."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    for n in (100, 200, 400):
        changed = 5 if linking else 40
        sets = [np.concatenate([base[changed:], rng.integers(0, 2**63, changed, dtype=np.uint64)]) for _ in range(n)]
        found = ngram_join.cell_links(cell(sets, list(range(n))), near=90, every=False)
        assert found.num_rows == (n - 1 if linking else 0)
        if linking:
            every = ngram_join.cell_links(cell(sets, list(range(n))), near=90, every=True)
            assert len(set(zip(every["hub"].to_pylist(), every["doc_id"].to_pylist()))) == n * (n - 1) // 2


def test_only_documents_of_pairs_left_out_come_up_again():
    """Before, every document of a key came up again once a pair given for it was no link."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    family = [np.concatenate([base[5:], rng.integers(0, 2**63, 5, dtype=np.uint64)]) for _ in range(10)]
    others = [rng.integers(0, 2**63, 400, dtype=np.uint64) for _ in range(200)]
    # The first eight are one component, two strays are near them; the rest are like nothing. Both pairs of the first one are given.
    found = ngram_join.cell_links(cell(family + others, [0] * 8 + list(range(8, 210))), near=90, every=False)
    lists = [x for x in found["left"].to_pylist() if x is not None]
    assert found.num_rows == 2 and [sorted(x) for x in lists] == [list(range(1, 10))]
    # Refused pairs were looked at, and those met once are not left out because both ask.
    two = cell(family[:2], [0, 1])
    assert ngram_join.cell_links(two, near=90, every=False)["left"].to_pylist() == [None]
    import pyarrow as pa

    two = two.set_column(two.schema.get_field_index("refused"), "refused", pa.array([[1], [0]], pa.list_(pa.int64())))
    assert ngram_join.cell_links(two, near=90, every=False).num_rows == 0


def test_a_pair_that_is_no_link_does_not_hide_another(spark, table, monkeypatch):
    """The finer points are made useless, so that cells give pairs that fail on the texts."""
    monkeypatch.setattr(ngram_join, "FINEST", ngram_join.COORDINATES)
    rng = random.Random(8)
    base = sentence(rng, 700).split()
    rows = []
    for k in range(40):
        words = list(base)
        for _ in range(rng.choice((5, 30, 60))):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        rows.append((k, " ".join(words)))
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for k, t in rows}
    parent = {k: k for k in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert rows_of(ngram_join.join(table(rows)), "doc_id", "component_id") == [(k, root(k)) for k in sorted(sets)]
