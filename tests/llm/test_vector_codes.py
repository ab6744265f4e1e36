import math
import random
from hashlib import sha256

import numpy as np
import pytest

from larder.llm import vector_codes as m

ROW = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=m.PARTS, entries=m.ENTRIES, rounds=m.ROUNDS):
    """The contract in plain Python integers."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    sizes = [len(r[1]) for r in good if r[1] and len(r[1]) % parts == 0]
    size = max(sizes, key=lambda n: (sizes.count(n), n), default=0)
    good = [r for r in good if len(r[1]) == size and size]
    whole = [[math.floor(256 * x) for x in r[1]] for r in good]
    width = size // parts
    cut = [[tuple(v[k * width : (k + 1) * width]) for k in range(parts)] for v in whole]
    first = {}
    for r, v in sorted(((r[0], r[1]), c) for r, c in zip(good, cut) if r[0] is not None):
        first.setdefault(r[0], v)
    if not first:
        return []
    books = [[first[i][k] for i in sorted(first)[:entries]] for k in range(parts)]

    def near(v, book):
        return min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(v, book[e])), e))

    for _ in range(rounds):
        chosen = [[near(c[k], books[k]) for k in range(parts)] for c in cut]
        for k in range(parts):
            for e in range(len(books[k])):
                own = [c[k] for c, x in zip(cut, chosen) if x[k] == e]
                if own:
                    books[k][e] = tuple(sum(col) // len(own) for col in zip(*own))
    out, totals = [], {}
    for r, c in zip(good, cut):
        code = [near(c[k], books[k]) for k in range(parts)]
        error = sum((a - b) ** 2 for k in range(parts) for a, b in zip(c[k], books[k][code[k]]))
        totals[r[2]] = totals.get(r[2], 0) + error
        out.append((r[0], "".join(f"{x:02x}" for x in code), error, r[2]))
    name = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, code, error, totals[label], name) for i, code, error, label in out]


def rows(n, size, seed=1, scale=1.0):
    rng = random.Random(seed)
    near = [float(np.float32(rng.gauss(0, scale))) for _ in range(size)]
    out = []
    for i in range(n):
        v = [float(np.float32(rng.choice((near[k], rng.gauss(0, scale), rng.randint(-4, 4) / 256)))) for k in range(size)]
        out.append((i * 3 - 20, v, rng.choice((None, 0, 1, 2))))
    return out


def found(spark, given, clashing=False, **options):
    df = spark.createDataFrame(given, ROW).repartition(3)
    if clashing:
        df = df.selectExpr("*", "'x' AS code", "1 AS error", "'y' AS vector", "2 AS unlabelled")
    got = m.compress(df, **options)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def awkward():
    given = rows(150, 32)
    given += [(900, None, 1), (901, [float("nan")] * 32, 1), (902, [float("inf")] + [0.0] * 31, None), (903, [None] + [0.0] * 31, 2)]
    given += [(904, [], 1), (905, [1.0] * 16, 1), (906, [1.0] * 31, 1), (None, [0.25] * 32, 1), (None, [0.5] * 32, None)]
    given += [(907, [0.5] * 32, None)] * 40 + [(-500, [0.0] * 32, 1), (-500, [-1.0] * 32, 1), (-500, [0.0] * 32, 1)]
    return given


@pytest.mark.parametrize("clashing", [False, True])
def test_equal_to_brute_force(spark, clashing):
    given = awkward()
    assert found(spark, given, clashing) == sorted(brute(given), key=str)


def test_few_rows_and_none(spark):
    few = rows(5, 16)
    assert found(spark, few) == sorted(brute(few), key=str)
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1), (2, [1.0] * 5, 1)]) == []


def test_ties_go_to_the_lower_index(spark):
    given = [(i, [float(i % 2)] * 16, 0) for i in range(70)]
    got = found(spark, given)
    assert got == sorted(brute(given), key=str)
    assert {r[1] for r in got} == {"00" * 16, "01" * 16}


@pytest.mark.parametrize("scale", [1e3, 1e6, 1e9])
def test_large_values_stay_exact(spark, scale):
    given = rows(60, 16, seed=7, scale=scale)
    want = [(i, c, e if e < 1 << 63 else None, None if e is None else t, n) for i, c, e, t, n in brute(given, entries=8)]
    got = found(spark, given, entries=8)
    if scale < 1e9:
        assert got == sorted(want, key=str)
    else:  # errors that 64 bits cannot hold are null
        assert [(r[0], r[1], r[4]) for r in got] == [(r[0], r[1], r[4]) for r in sorted(want, key=str)]
        assert {r[0]: r[2] for r in got} == {r[0]: r[2] for r in want}


@pytest.mark.parametrize("bits", [3, 20, 30, 52, 61, 90])
def test_products_are_exact(bits):
    rng = random.Random(bits)
    x, y = ([[rng.randint(-(1 << bits), 1 << bits) for _ in range(7)] for _ in range(n)] for n in (9, 5))
    kind = np.int64 if bits < 62 else object
    want = [[sum(a * b for a, b in zip(r, s)) for s in y] for r in x]
    assert m.exact_product(np.array(x, kind), np.array(y, kind)).tolist() == want
    width = m.limb_bits(7)
    parts = m.limbs(np.array(x, kind), width)
    assert all(np.abs(p).max() <= 1 << (width - 1) for p in parts)
    assert [[sum(int(p[i][j]) << (width * k) for k, p in enumerate(parts)) for j in range(7)] for i in range(9)] == x


def test_codes_decode_to_entries(spark):
    given = rows(100, 32, seed=4)
    df = m.columns(spark.createDataFrame(given, ROW))
    books = m.codebooks(df)
    decode = m.decoder(books)
    vectors = {r[0]: [math.floor(256 * x) for x in r[1]] for r in given}
    for r in m.codes(df, books).collect():
        assert sum((a - b) ** 2 for a, b in zip(decode(r.code), vectors[r.vec_id])) == r.error
