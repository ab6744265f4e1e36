import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside; a table may have columns of these names too.
CLASHING = ("block", "bucket", "level", "entries", "digest", "bin", "score", "lang_pred", "rank", "task", "key", "component")


def sentence(rng, words):
    return " ".join("".join(rng.choice(("ba", "ke", "lo", "mi", "tu", "ra", "é", "sol")) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def texts():
    """Documents with copies, shared passages, overlaps and empty or missing values: (doc_id, text)."""
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(0, 120)) for _ in range(30)]
    passage, line = sentence(rng, 40), "This line is in very many documents of the table"
    rows = list(enumerate(base))
    for k in range(30, 60):
        words = base[rng.randrange(30)].split() or ["x"]
        cut = rng.randrange(len(words))
        kind = k % 5
        if kind == 0:
            text = " ".join(words)
        elif kind == 1:
            text = " ".join(words[:cut]) + "\n" + passage + "\t" + sentence(rng, 20)
        elif kind == 2:
            text = " ".join(words[cut:] + words[:cut])
        elif kind == 3:
            text = sentence(rng, 10) + " " + line + " " + sentence(rng, 30)
        else:
            text = " ".join(w if rng.random() > 0.03 else "new" for w in words)
        rows.append((k * 7, text))
    rows += [(1000, ""), (1001, None), (1002, " \n\t "), (1003, "one"), (1004, "one two"), (1005, "AAA " * 200), (1006, "AAA " * 150)]
    rows += [(1007, base[3]), (1007, base[3]), (1008, " ".join(base) * 3)]
    return rows


@pytest.fixture(scope="session")
def table(spark):
    """A documents table of (doc_id, text) rows, with columns of clashing names on demand."""

    def build(rows, clashing=False):
        full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, DOC)
        if clashing:
            for name in CLASHING:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df.repartition(3)

    return build


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, x) for x in r))
