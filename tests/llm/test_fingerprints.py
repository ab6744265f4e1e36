import re
from hashlib import sha256

from larder.llm import fingerprints
from tests.llm.conftest import rows_of

PARAGRAPH = re.compile(r"(?s:.{64,192}?\n|.{1,192})")


def likeness(a, b):
    a, b = set(PARAGRAPH.findall(a)), set(PARAGRAPH.findall(b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_versions_equal_brute_force(table, texts):
    long = "\n".join(f"{i} " + "word " * (i % 60) for i in range(900))
    rows = [(d, t) for d, t in texts if d != 1007] + [(5000, long), (5001, long + "end"), (-3, "first\nof all")]
    ordered = sorted(((d, t or "") for d, t in rows), reverse=True)
    expected = []
    for k, (doc, text) in enumerate(ordered):
        following, half = ordered[(k + 1) % len(ordered)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((doc, len(text), sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, following)))
    found = fingerprints.versions(table(rows, clashing=True)).cache()
    assert rows_of(found, "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next") == sorted(expected)
    prints = {}
    texts_by_id = dict(rows)
    for r in found.collect():
        prints.setdefault(texts_by_id[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in prints.values())


def test_nulls_ties_and_small_tables(table):
    assert fingerprints.versions(table([])).count() == 0
    single = fingerprints.versions(table([(1, "abcd")])).first()
    assert (single.edited_sha256, single.near_next) == (sha256(b"abab").hexdigest(), 1.0)
    rows = [(None, "xyxy"), (None, None), (4, "abcd"), (4, "abcd"), (5, "efgh")]
    found = rows_of(fingerprints.versions(table(rows)), "doc_id", "n_chars")
    assert found == [(4, 4), (4, 4), (5, 4), (None, 0), (None, 4)]


def test_stuck_sketches_are_retried(spark):
    """Many more differences than cells: larger sketches or the direct way still count them all."""
    for n in (3, 9, 20, 200):
        items = f"transform(sequence(1, {n}), i -> named_struct('d', xxhash64(i), 'w', IF(i % 3 = 0, -1, 1)))"
        assert spark.sql(f"SELECT {fingerprints.differing(items)} AS n").first().n == n
