"""Exact token ids of whole texts, looked up word by word."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from larder.llm.common import IS_SPACE, byte_prefix, flat_ranges, span_hash, word_spans

VOCABULARY = "word_bpe_49k.json"
# Distinct words a worker remembers before it starts over; bounds memory, never the result.
REMEMBERED_WORDS = 150_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Bytes that hand a word to the tokenizer's own way: contractions, special tokens, control characters, and
# letters but those of two bytes led by C3, which have normal form C and lower case letter by letter.
ODD = np.ones(256, bool)
ODD[0x20:0x7F] = False
ODD[[0x27, 0x3C]] = True
ODD[IS_SPACE] = False
ODD[0x80:0xC0] = False
ODD[0xC3] = False
LETTER, DIGIT, OTHER = 1, 2, 3
KIND = np.full(256, OTHER, np.uint8)
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = LETTER
KIND[0x30:0x3A] = DIGIT


def byte_letters() -> dict[int, int]:
    """The printable letter that byte-level vocabularies write for a byte that is none."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {x: 256 + i for i, x in enumerate(x for x in range(256) if x not in shown)}


def units(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes; starts and ends of the units to encode; which are whole odd words; first unit of each text.

    Letters, other signs and single digits are units of their own, as in the
    pre-tokenizer's pattern; a word with an odd byte is one unit.
    """
    starts, ends, _ = word_spans(raw, at)
    odd = ODD[raw]
    accent = np.flatnonzero(raw[:-1] == 0xC3) + 1 if len(raw) else np.zeros(0, np.int64)
    odd[accent[(raw[accent] == 0x97) | (raw[accent] == 0xB7)]] = True  # signs among the letters
    lower = raw + ((raw >= 0x41) & (raw <= 0x5A)).astype(np.uint8) * np.uint8(32)
    capital = accent[(raw[accent] >= 0x80) & (raw[accent] <= 0x9E)]
    lower[capital] += 0x20
    sums = np.concatenate([[0], np.cumsum(odd)])
    whole = sums[ends] > sums[starts]
    kind = KIND[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    for a, b in zip(starts[whole].tolist(), ends[whole].tolist()):
        first[a:b] = False
        lower[a:b] = raw[a:b]
    first[starts] = True
    inside = ~IS_SPACE[raw]
    out = np.flatnonzero(first[:-1] & inside)
    last = first[1:].copy()
    last[ends - 1] = True
    stops = np.flatnonzero(last & inside) + 1
    is_whole = np.zeros(len(raw) + 1, bool)
    is_whole[starts[whole]] = True
    return lower, out, stops, is_whole[out], np.searchsorted(out, at)


class WordEncoder:
    """Ids of a vocabulary that never joins tokens over white space, with lower case and byte-level letters.

    A text's ids are those of its units one after the other, and each distinct
    unit is encoded only once.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.index: dict[tuple[bytes, bool], int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _encoded(self, unit: bytes, whole: bool) -> list[int]:
        if whole:
            return self.tokenizer.encode(unit.decode("utf-8", "replace"), add_special_tokens=False).ids
        text = unit.decode("latin-1")
        return [x.id for x in self.tokenizer.model.tokenize(text if text.isascii() else text.translate(self.letters))]

    def _learn(self, keys: list[tuple[bytes, bool]]) -> None:
        encoded = [self._encoded(*k) for k in keys]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(encoded), np.uint32, int(lengths.sum()))])
        self.index.update(zip(keys, range(len(self.index), len(self.index) + len(keys))))

    def rows(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of all units in the encoder's table; first unit of each text."""
        lower, starts, ends, whole, first = units(raw, at)
        hashes = span_hash(byte_prefix(lower), starts, ends) ^ whole.astype(np.uint64)
        _, chosen, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        same = starts[chosen][inverse]
        lengths = ends - starts
        if not (
            np.array_equal((ends - starts)[chosen][inverse], lengths)
            and np.array_equal(whole[chosen][inverse], whole)
            and np.array_equal(lower[flat_ranges(same, lengths)], lower[flat_ranges(starts, lengths)])
        ):  # two units with one hash: take each by itself
            chosen = inverse = np.arange(len(starts))
        data = lower.tobytes()
        keys = [(data[a:b], w) for a, b, w in zip(starts[chosen].tolist(), ends[chosen].tolist(), whole[chosen].tolist())]
        if len(self.index) + len(keys) > REMEMBERED_WORDS:
            self._forget()
        if missing := list(dict.fromkeys(k for k in keys if k not in self.index)):
            self._learn(missing)
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))[inverse], first

    def counts(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Number of ids of each text."""
        rows, first = self.rows(raw, at)
        return np.diff(np.concatenate([[0], np.cumsum(self.lengths[rows])])[first])

    def ids(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other; number of ids of each text."""
        rows, first = self.rows(raw, at)
        lengths = self.lengths[rows]
        return self.pool[flat_ranges(self.starts[rows], lengths)], np.diff(np.concatenate([[0], np.cumsum(lengths)])[first])
