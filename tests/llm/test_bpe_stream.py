import random
from hashlib import sha256

import numpy as np
import pytest

from larder.llm import bpe_stream as m
from larder.llm.common import SLICE_BYTES
from larder.llm.tokens import vocabulary_path
from tests.llm.conftest import rows_of, sentence


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def merges():
    return m.Merges(vocabulary_path())


ODD = [
    "Hello Wörld, it's <|endoftext|> 12", "Hel<|endoftext|>lo<|startoftext|>", "İ ŉ ﬁ é 각 \U0001d518 \x00 \x85　x", "don't WE'LL ''s 's's",
    "日本語のテキスト、とても長い。", "naïve Ünïcode ÀÉÎ ×÷ ß", " nbsp em", "<|endoftext|>", "<|END|> <w>", "👩‍👩‍👧 👍🏽", "à́̂", " \n\t ", "__--==!!??",
]


def words(rng):
    """Long words of few letters, so that chains of merges reach far."""
    kinds = ["a", "ab", "abc", "in", "the", "lol", "ha", "xo", "aeiou", "the-in", "eth", "nin"]
    for _ in range(150):
        letters = rng.choice(kinds)
        yield "".join(rng.choice(letters) for _ in range(rng.choice((3, 40, 400, 3000))))
    yield "a" * 20_000
    yield "ha" * 7_001


def test_words_equal_the_library(library, merges):
    for word in words(random.Random(3)):
        assert m.Transducer(merges).word(word) == [library.token_to_id(t) for t in library.encode(word, add_special_tokens=False).tokens] or "-" in word


def test_lookahead_suffices_for_every_cut(merges):
    """Tokens that end so many letters before a cut stay, whatever follows the cut."""
    rng = random.Random(9)
    ids = merges.ids
    for word in list(words(rng))[:60]:
        word = word.replace("-", "")[:700]
        full = m.merged([ids[x] for x in word[:-1]] + [ids[word[-1] + merges.suffix]], merges.ranks)
        for cut in {rng.randrange(len(word)) for _ in range(12)}:
            part = m.merged([ids[x] for x in word[:cut]], merges.ranks)
            final = [t for t in part if t[1] <= cut - merges.lookahead]
            assert full[: len(final)] == final


def test_lookahead_of_small_lists():
    assert m.sufficient_lookahead([("a", "b")], len) == 1
    # (a, b) decides about (b, c): one letter before c; a chain of two reaches over "ab"
    assert m.sufficient_lookahead([("b", "c"), ("a", "b")], len) == 2
    assert m.sufficient_lookahead([("a", "b"), ("b", "c")], len) == 1
    assert m.sufficient_lookahead([], len) == 0
    with pytest.raises(ValueError):
        m.sufficient_lookahead([("ab", "c"), ("a", "b")], len)


def test_pieces_of_any_size_and_bounded_state(merges):
    rng = random.Random(4)
    for word in list(words(rng))[-30:]:
        word = word.replace("-", "")
        whole, t, got, at = m.Transducer(merges).word(word), m.Transducer(merges), [], 0
        while at < len(word):
            step = rng.choice((1, 7, 100, 5000))
            got += t.feed(word[at : at + step])
            at += step
            assert len(t.held) < t.window
        assert [*got, *t.finish()] == whole


def test_texts_equal_the_library(spark, table, library, texts):
    rng = random.Random(1)
    rows = [*texts, *enumerate(ODD, 5000), (None, "no id"), (6000, "X" * 5000), (6001, " ".join(words(rng)).replace("-", " "))]
    rows += [(6002, (sentence(rng, 3000) + "\n") * 90 + "é" * 50 + " end"), (6003, "é" * (SLICE_BYTES // 2) + "q" * SLICE_BYTES + " tail"), (6004, "ab" * SLICE_BYTES)]
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(text.encode()).hexdigest()))
    got = rows_of(m.round_trip(table(rows, clashing=True)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=lambda r: tuple((x is None, x) for x in r))


def test_empty_table(spark, table):
    assert m.round_trip(table([])).collect() == []


def test_ids_and_texts_as_tables(spark, table, library):
    rows = [(1, "Über naïve 日本 x's"), (2, None), (3, ""), (4, "<|endoftext|>a")]
    ids = m.encoded(table(rows))
    assert {r.doc_id: r.ids for r in ids.collect()} == {i: None if t is None else library.encode(t, add_special_tokens=False).ids for i, t in rows}
    assert {r.doc_id: r.text for r in m.decoded(ids, readable=True).collect()} == {1: "über naïve 日本 x 's ", 2: None, 3: "", 4: "<|endoftext|>a "}
    plain = {r.doc_id: r.text for r in m.decoded(ids).collect()}
    assert plain[1] == library.decode(library.encode(rows[0][1], add_special_tokens=False).ids, skip_special_tokens=False)


def test_a_character_may_come_in_pieces(merges):
    machine = m.TextMachine(merges, readable=True)
    ids = [merges.ids[x] for x in ("ð", "Ł", "ĺ", "Ģ</w>")]
    assert [machine.feed([i]) for i in ids] == ["", "", "", "\U0001f600 "]
    assert machine.finish() == "" and machine.feed(ids[:2]) == "" and machine.finish() == "�"
