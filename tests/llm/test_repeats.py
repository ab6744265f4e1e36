import random
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from larder.llm import segments, substring_dedup, suffix_dedup
from tests.llm.conftest import rows_of

NO_ID = 1 << 63


def covered(symbols, window, equal):
    """By document number, which symbols lie in a window that also starts in a document with a smaller id."""
    first = {}
    for doc, own in symbols:
        for i in range(len(own) - window + 1):
            k = equal(own[i : i + window])
            first[k] = min(first.get(k, NO_ID), doc)
    out = []
    for doc, own in symbols:
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            if first[equal(own[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        out.append(gone)
    return out


def words_by_brute_force(rows, window=13):
    symbols = [(NO_ID - 1 if d is None else d, re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())) for d, t in rows]
    out = []
    for (doc, _), (_, own), gone in zip(rows, symbols, covered(symbols, window, tuple)):
        kept = [w for w, x in zip(own, gone) if not x]
        out.append((doc, len(own), sum(gone), sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def bytes_by_brute_force(rows, window=50):
    symbols = [(NO_ID - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    out = []
    for (doc, _), (_, own), gone in zip(rows, symbols, covered(symbols, window, bytes)):
        spans = len(re.findall("1+", "".join("01"[x] for x in gone)))
        out.append((doc, len(own), sum(gone), spans, sha256(bytes(b for b, x in zip(own, gone) if not x)).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")
BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.fixture
def marked_anchors(monkeypatch):
    """Anchors with two segments in a block are marked, here and in the workers."""
    source = segments.Segments._unique

    def unique(self):
        before, segments.BLOCK_GROUP = segments.BLOCK_GROUP, 1
        try:
            source(self)
        finally:
            segments.BLOCK_GROUP = before

    def patched(make):
        def built(*arguments):
            kept, segments.Segments._unique = segments.Segments._unique, unique
            try:
                return make(*arguments)
            finally:
                segments.Segments._unique = kept

        return built

    for module, name in ((substring_dedup, "Words"), (suffix_dedup, "Bytes")):
        monkeypatch.setattr(module, name, patched(getattr(module, name)))


def test_marked_anchors_change_nothing(texts, marked_anchors):
    """The exchange by hand, without Spark, so that the patch holds on both sides."""
    rows = [(d, t or "") for d, t in texts]
    blocks = [segments.Block(pa.table({"doc_id": pa.array([d for d, _ in rows[k::3]], pa.int64()), "text": [t for _, t in rows[k::3]]})) for k in range(3)]

    def exchanged(sends):
        by_bucket = {}
        for row in (r for send in sends for r in send):
            by_bucket.setdefault((row[0], row[2]), []).append(row)
        out = {k: [] for k in range(3)}
        for (_, level), own in by_bucket.items():
            judge = suffix_dedup.judged_suffixes(segments.messages(own), 50) if level == suffix_dedup.SUFFIXES else segments.judged(segments.messages(own))
            for r in judge.to_pylist():
                out[r["block"]].append(r)
        return out

    def answers(*found):
        rows = [r for x in found for r in x]
        return segments.Answers(pa.Table.from_pylist(rows, segments.messages([]).schema))

    own = [suffix_dedup.Bytes(b, 50, 20).segments for b in blocks]
    first = exchanged([segments.sent(s.entries(), k, 1, 4) for k, s in enumerate(own)])
    sends, hot = [], 0
    for k, (b, s) in enumerate(zip(blocks, own)):
        states, _ = s.answered(answers(first[k]), 1, 4)
        strings = segments.Windows(s, suffix_dedup.first_rows(s, states, segments.HOT))
        hot += len(strings.start)
        sends.append(suffix_dedup.suffix_messages(b, s, states, k, 4) + segments.sent(strings.entries(), k, 3, 4))
    assert hot
    second = exchanged(sends)
    got = []
    for k, (b, s) in enumerate(zip(blocks, own)):
        gone = suffix_dedup.removed(b, s, answers(first[k], second[k]), 4)
        got += [(doc, int(b.at[j + 1] - b.at[j]), int(gone[b.at[j] : b.at[j + 1]].sum())) for j, doc in enumerate(b.rows)]
    assert sorted(got) == [r[:3] for r in bytes_by_brute_force(rows)]


@pytest.mark.parametrize("blocks", [1, 7])
def test_words_equal_brute_force(table, texts, monkeypatch, blocks):
    monkeypatch.setattr(segments, "LEAST_BLOCKS", blocks)
    rows = [*texts, (None, texts[1][1]), (None, None)]
    assert rows_of(substring_dedup.dedup(table(rows, clashing=True)), *WORDS) == words_by_brute_force(rows)


@pytest.mark.parametrize("hot", [2048, 1])
def test_bytes_equal_brute_force(table, texts, monkeypatch, hot):
    """With groups of more than one segment counted as hot, strings go one by one; the result is the same."""
    monkeypatch.setattr(segments, "LEAST_BLOCKS", 5)
    if hot == 1:
        source = segments.judged

        def judged(table):
            before, segments.HOT_GROUP = segments.HOT_GROUP, 1
            try:
                return source(table)
            finally:
                segments.HOT_GROUP = before

        monkeypatch.setattr(segments, "judged", judged)
    rows = [*texts, (None, texts[1][1])]
    assert rows_of(suffix_dedup.dedup(table(rows, clashing=True)), *BYTES) == bytes_by_brute_force(rows)


def test_empty_tables(table):
    assert substring_dedup.dedup(table([])).count() == 0
    assert suffix_dedup.dedup(table([])).count() == 0


def test_factors_name_a_source_that_has_the_words(table, texts):
    by_id = {}
    for doc, text in texts:
        by_id.setdefault(doc, []).append(re.findall(r"[^\x20\x09-\x0d]+", text or ""))
    found = substring_dedup.factors(table(texts)).collect()
    assert found
    for f in found:
        assert f.source_id < f.doc_id and f.n_words >= 13
        own = [" ".join(w[f.start : f.start + 13]) for w in by_id[f.doc_id]]
        assert any(o and o in " ".join(s) for o in own for s in by_id[f.source_id])


def test_spans_add_up(table, texts):
    spans = suffix_dedup.repeat_spans(table(texts)).groupBy("doc_id").sum("n_bytes").collect()
    removed = {r.doc_id: r.n_removed for r in suffix_dedup.dedup(table(texts)).filter("n_removed > 0").groupBy("doc_id").sum("n_removed").withColumnRenamed("sum(n_removed)", "n_removed").collect()}
    assert {r[0]: r[1] for r in spans} == removed


def test_hot_groups_are_answered_as_hot():
    n = 10
    coarse = np.full(n, 99, np.uint64)
    entries = (coarse, np.arange(n, dtype=np.uint32), np.arange(n, dtype=np.int64), np.zeros((n, 2), np.uint8))
    message = segments.messages(segments.sent(entries, 0, 1, 4))
    before = segments.HOT_GROUP
    try:
        for limit, state in ((20, segments.MIXED), (5, segments.HOT)):
            segments.HOT_GROUP = limit
            answer = segments.Answers(segments.judged(message))
            states, source = answer.states(1, entries, 4)
            assert set(states.tolist()) == {state} and set(source.tolist()) == {segments.NO_ID}
    finally:
        segments.HOT_GROUP = before


def test_maximal_repeats_equal_brute_force():
    rng = random.Random(2)
    for _ in range(30):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randint(4, 14))).encode() for _ in range(4)]
        data = np.frombuffer(b"".join(strings), np.uint8)
        lengths = np.array([len(s) for s in strings])
        array = suffix_dedup.SuffixArray(data, np.cumsum(lengths) - lengths, lengths, np.arange(4), 3)
        found = set()
        for first, last, length, smallest in array.repeats():
            places = {(int(array.string[i]), int(array.within[i])) for i in range(first, last + 1)}
            one = next(iter(places))
            found.add((strings[one[0]][one[1] : one[1] + length], frozenset(places), smallest))
        expected = set()
        for text in {s[i:j] for s in strings for i in range(len(s)) for j in range(i + 3, len(s) + 1)}:
            places = {(k, i) for k, s in enumerate(strings) for i in range(len(s)) if s.startswith(text, i)}
            before = {strings[k][i - 1] if i else (k, i) for k, i in places}
            after = {strings[k][i + len(text)] if i + len(text) < len(strings[k]) else (k, i) for k, i in places}
            if len(places) > 1 and len(before) > 1 and len(after) > 1:
                expected.add((text, frozenset(places), min(k for k, _ in places)))
        assert found == expected
        flags = array.covered()
        at = 0
        for k, s in enumerate(strings):
            for i in range(max(0, len(s) - 2)):
                assert flags[at] == any(s[i : i + 3] in t for t in strings[:k])
                at += 1


def test_messages_keep_entries():
    rng = np.random.default_rng(1)
    entries = (np.sort(rng.integers(0, 2**63, 50).astype(np.uint64)), rng.integers(0, 9, 50).astype(np.uint32), rng.integers(0, 99, 50), rng.integers(0, 255, (50, 2)).astype(np.uint8))
    rows = segments.sent(entries, 0, 1, 8)
    got = [np.concatenate(x) for x in zip(*(segments.received(r[3]) for r in rows))]
    assert all(np.array_equal(a, b) for a, b in zip(entries, got))
    assert isinstance(segments.messages(rows), pa.Table)
