import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import prefix_trie as m
from tests.llm.conftest import rows_of

TURN = "conv_id long, turn long, role string, text string"


def rebuilt(turns):
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    lists = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in lists.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = lists.get(c - int(np.fmod(c, 100)), [])[:h] + v[h:]
    return out


def brute(turns):
    convs = rebuilt(turns)
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[q] for q in children[p])
    return sorted(
        (
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
            sha256(",".join(str(c) for c in members[p] if len(convs[c]) == len(p)).encode()).hexdigest(),
        )
        for p in members
    )


def turns(n, seed=1, most=7, words=2):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(-150, 10 * n), n):
        for t in range(rng.randint(1, most)):
            out.append((c, t, rng.choice(("user", "bot")), rng.choice(("", "hi", "é" * rng.randint(1, words), "no"))))
    return out


def awkward():
    given = turns(150)
    given += [(20700 + k, t, "user", "the same") for k in range(60) for t in range(3)]  # copies
    given += [(20800, t, "user", "long " * (t % 3)) for t in range(300)] + [(20801, t, "user", "long " * (t % 3)) for t in range(299)]
    given += [(20900, None, None, None), (20900, None, None, None), (20901, 5, None, "x"), (None, 1, "user", "no conversation"), (1000, 1, "a", "b" * 100_000)]
    given += [(20950 + k, None if k % 2 else 3, "user", "tie") for k in range(20) for _ in range(2)]
    rng = random.Random(2)
    rng.shuffle(given)
    return given


def table(spark, given):
    return spark.createDataFrame(given, TURN).repartition(3)


@pytest.mark.parametrize("clashing", [False, True])
def test_equal_to_brute_force(spark, clashing):
    given = awkward()
    df = table(spark, given)
    if clashing:
        df = df.selectExpr("*", "'x' AS path", "1 AS block", "'y' AS base", "'z' AS turns", "2 AS h", "'k' AS key")
    found = m.prefix_trie(df)
    assert found.columns == list(m.RESULT)
    assert rows_of(found, *m.RESULT) == sorted(brute(given), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("blocks", [2, 7, 40])
def test_prefixes_that_span_blocks(spark, monkeypatch, blocks):
    given = awkward() + [(5000 + k, t, "user", "hot" if t < 2 else str(k % 3)) for k in range(200) for t in range(3)]
    total = len(given) + len({r[0] for r in given})
    monkeypatch.setattr(m, "BLOCK_TURNS", -(-total // blocks))
    paths = m.sorted_paths(m.rebuilt(m.conversations(table(spark, given))))
    assert paths.select("block").distinct().count() >= min(blocks, 30)
    assert rows_of(m.trie_of(paths), *m.RESULT) == sorted(brute(given), key=lambda r: tuple((x is None, x) for x in r))


def test_one_conversation_and_none(spark):
    for given in ([(100, 0, "user", "hi")], [(7, 0, "a", "b"), (7, 1, "a", "b")]):
        assert rows_of(m.prefix_trie(table(spark, given)), *m.RESULT) == sorted(brute(given), key=lambda r: tuple((x is None, x) for x in r))
    assert m.prefix_trie(table(spark, [])).collect() == []
    assert m.prefix_trie(table(spark, [(None, 0, "user", "hi")])).collect() == []


def test_role_and_text_do_not_run_together(spark):
    given = [(101, 9, "ab", "c"), (102, 9, "a", "bc"), (103, 9, "1:a", ""), (104, 9, "1", ":a")]
    assert m.prefix_trie(table(spark, given)).count() == len(brute(given))


def test_intervals_by_binary_search():
    rng = random.Random(3)
    for n in (1, 2, 3, 17, 200):
        lcp = [rng.randint(0, 4) for _ in range(n)]
        sparse = m.SparseTable(np.array(lcp))
        for row in range(n + 1):
            for depth in range(6):
                first = last = row
                while first and lcp[first - 1] >= depth:
                    first -= 1
                while last < n and lcp[last] >= depth:
                    last += 1
                got = m.member_interval(sparse, np.array([row]), np.array([depth]))
                assert (int(got[0][0]), int(got[1][0])) == (first, last)
        starts, stops = zip(*((a, b) for a in range(n) for b in range(a + 1, n + 1)))
        want = [min(lcp[a:b]) for a, b in zip(starts, stops)]
        assert sparse.minimum(np.array(starts), np.array(stops)).tolist() == want


def test_rebuilding(spark):
    given = awkward()
    convs = m.rebuilt(m.conversations(table(spark, given)))
    sizes = {r.conv_id: list(r.s) for r in convs.select("conv_id", F.expr("transform(turns, t -> t.size)").alias("s")).collect()}
    assert sizes == {c: [len(text) for _, text in v] for c, v in rebuilt(given).items()}
