import re
import zlib
from collections import Counter

import numpy as np
import pytest

from larder.llm import packing, token_counts
from larder.llm.tokens import WordEncoder, vocabulary_path
from tests.llm.conftest import rows_of

ODD = [
    "Ünïcode ǅ ΣΑΣ é A b <|endoftext|>x don't İst", "\x1c!\x1c ﬁ 12½ it's ×÷ a×b", "ÀB1234..--a", "  \n", "", "é x", " a b",
    "tab\tnew\nline\x0b\x0cend", "ÀÉÎÕÜß àéîõüÿ ÐÞ", "日本語 text 123", "a" * 5000, "😀😀 :-) !!", "I'LL We've", "\u0000nul",
]


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(vocabulary_path())


def slices(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])])


def plain_ids(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer(encoder, texts):
    own = ODD + [t or "" for _, t in texts]
    ids, counts = encoder.ids(*slices(own))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [plain_ids(encoder, t) for t in own]
    assert encoder.counts(*slices(own)).tolist() == counts.tolist()


def test_forgetting_words_changes_nothing(encoder, texts, monkeypatch):
    own = [t or "" for _, t in texts]
    before = encoder.ids(*slices(own))[0].tolist()
    monkeypatch.setattr("larder.llm.tokens.REMEMBERED_WORDS", 10)
    assert [x for t in own for x in encoder.ids(*slices([t]))[0].tolist()] == before


def test_packing_is_exact(table, texts, encoder):
    rows = [*texts, (None, "no id"), (7000, "word " * 700)]
    got = packing.pack(table(rows, clashing=True), capacity=64).collect()
    documents = sorted(((d, [*plain_ids(encoder, t), 0]) for d, t in rows), key=str)
    pieces = Counter()
    for doc, ids in documents:
        for k, start in enumerate(range(0, len(ids), 64)):
            own = ids[start : start + 64]
            pieces[doc, k, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(table([])).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_plans_are_gapless_and_tight(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(8, 80))
    counts = {int(k): int(n) for k, n in zip(rng.integers(1, capacity + 1, 30), rng.integers(1, 40, 30))}
    plan = packing.Plan(dict(counts), capacity)
    places = {}
    for length, slots in plan.table().items():
        given = plan.given[length]
        assert given == counts[length]
        for rank in range(given):
            first, each, sequence, offset = slots[np.searchsorted(slots[:, 0], rank, "right") - 1].tolist()
            places.setdefault(sequence + (rank - first) // each, []).append((offset + (rank - first) % each * length, length))
    assert len(places) == plan.sequences
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * n > capacity for _, n in own) <= 2
    # Best fit decreasing never needs more than 11/9 of the least number and one.
    assert plan.sequences <= 11 / 9 * -(-sum(k * n for k, n in counts.items()) // capacity) + sum(n for k, n in counts.items() if 2 * k > capacity) + 1


def test_large_items_are_matched_optimally():
    """Above a third of the capacity no sequence takes three, so pairs decide."""
    counts = {60: 2, 50: 1, 40: 3, 45: 2, 35: 1}
    assert packing.Plan(counts, 100).sequences == 5


def test_token_counts_equal_brute_force(table, texts, encoder):
    lengths = [len(plain_ids(encoder, t)) for _, t in texts]
    got = token_counts.token_counts(table(texts, clashing=True)).cache()
    expected = []
    for n in sorted(set(lengths)):
        at_least = [x for x in lengths if x >= n]
        expected.append((n, lengths.count(n), len(at_least), len(lengths) - len(at_least), sum(at_least), sum(min(x, n) for x in lengths)))
    assert rows_of(got, "length", "n_docs", "docs_at_least", "docs_below", "tokens_at_least", "truncated_tokens") == expected
    for share in (0.01, 0.5, 0.9, 1.0):
        least = sorted(lengths)[max(0, int(np.ceil(share * len(lengths))) - 1)]
        assert token_counts.length_quantile(got, share).first().length == least
    histogram = token_counts.length_histogram(table(texts))
    assert tuple(token_counts.total_tokens(histogram, 50).first()) == (len(lengths), sum(min(x, 50) for x in lengths))
    assert tuple(token_counts.total_tokens(histogram).first()) == (len(lengths), sum(lengths))


def test_empty_token_counts(table):
    assert token_counts.token_counts(table([])).count() == 0
    assert re.fullmatch(r".*\.json", vocabulary_path())


def test_a_worker_remembers_few_words_however_many_there_are():
    """400,000 of them took 67 MB a worker more than 150,000."""
    encoder = WordEncoder(vocabulary_path())
    for k in range(9):
        text = " ".join(f"{'abcdefghij'[k]}{''.join(chr(97 + int(c)) for c in str(n))}z" for n in range(20_000)).encode()
        ids, counts = encoder.ids(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert len(ids) == counts.sum()
    assert 0 < len(encoder.index) <= 150_000
