"""BPE encoding and decoding as streams: a transducer with bounded lookahead, and a byte-to-text machine.

Encoding merges the pair of the lowest rank first, so what follows a place in a
word can change the tokens before it, but not arbitrarily far. Compare the merges
of a word with those of its beginning. Their tokens agree left of some boundary.
That boundary moves to the left only when a merge (u, v) crosses it, by the length
of u, in one of the two. The token that then starts there is u, or grows from it by
later merges, so the next crossing merge has a later rank and a right side that is
u, or grew from u or uv by merges of rising rank. ``sufficient_lookahead`` is the
longest such chain, found in one pass over the merge list, each token followed down
its left spine. It needs a list whose merges only use tokens made by earlier ones,
which is checked.

``Transducer`` therefore emits a token as soon as so many letters after its end
are read, and goes on from there: a boundary that is final splits the word into two
that merge independently. It holds one window of letters, however long the word.

Texts are read in stretches cut at white space, over which tokens never reach, and
digests are carried from one to the next; a word is one stretch at least. Distinct units are
remembered up to a bound (``tokens.REMEMBERED_WORDS`` and ``REMEMBERED_BYTES``). Decoding
looks up each id's bytes and turns them to text as they come, with at most an
unfinished character in between.

A null or empty text has no ids. Rows come out as they come in, repeated ids
and null ids too. Other columns are not read. An empty table gives no row.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import IS_SPACE, SLICE_BYTES, documents, flat_ranges, text_slices
from larder.llm.tokens import WordEncoder, byte_letters, vocabulary_path

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
REMEMBERED_BYTES = 32 << 20
# A window holds so many times the lookahead: what it reads twice is one part in as many.
WINDOWS = 8


class Merges:
    """A vocabulary with its ranked merges; letters at the end of a word carry a suffix."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in content["added_tokens"]}
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.pairs: list[tuple[str, str]] = pairs
        self.ranks = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.strings: dict[int, str] = {i: s for s, i in (self.ids | self.special).items()}
        self.lookahead = sufficient_lookahead(pairs, self.length)

    def length(self, token: str) -> int:
        """Letters of a token."""
        return len(token) - len(self.suffix) if self.suffix and token.endswith(self.suffix) and token != self.suffix else len(token)


def sufficient_lookahead(pairs: list[tuple[str, str]], length) -> int:
    """Letters after a token's end that decide it, whatever comes after them."""
    made: dict[str, int] = {}
    for rank, (a, b) in enumerate(pairs):
        if any(length(t) > 1 and t not in made for t in (a, b)) or a + b in made:
            raise ValueError(f"merge {rank} does not build on earlier merges, so no lookahead is known to suffice")
        made[a + b] = rank
    longest: dict[str, int] = {}  # the longest chain so far that ends with a merge of this left side
    at_rank: list[int] = []  # the same when the merge was listed
    most = 0
    for rank, (a, b) in enumerate(pairs):
        chain, token = longest.get(b, 0), b
        while (q := made.get(token, rank)) < rank:
            chain = max(chain, at_rank[q])
            token = pairs[q][0]
        own = length(a) + chain
        longest[a] = max(longest.get(a, 0), own)
        at_rank.append(longest[a])
        most = max(most, own)
    return most


def merged(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[tuple[int, int]]:
    """Tokens of some letters with the place of their ends: always the pair of lowest rank, the leftmost first."""
    n = len(symbols)
    symbols, after, before = symbols[:], list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        if found := ranks.get((symbols[i], symbols[i + 1])):
            heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(heap)
    gone = [False] * n
    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j >= n or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], gone[j] = new, True
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if found := ranks.get((new, symbols[k])):
                heapq.heappush(heap, (found[0], i, new, symbols[k], found[1]))
        if (h := before[i]) >= 0 and (found := ranks.get((symbols[h], new))):
            heapq.heappush(heap, (found[0], h, symbols[h], new, found[1]))
    out, i = [], 0
    while i < n:
        out.append((symbols[i], after[i]))
        i = after[i]
    return out


class Transducer:
    """Reads the letters of one word piece by piece and gives its ids once they are final."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.window = WINDOWS * merges.lookahead + 1
        self.held = ""

    def feed(self, letters: str) -> Iterator[int]:
        at = 0
        while at < len(letters):
            more = self.window - len(self.held)
            self.held += letters[at : at + more]
            at += more
            if len(self.held) >= self.window:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        ids, final = self.merges.ids, len(self.held) - self.merges.lookahead
        done = 0
        for token, end in merged([ids[x] for x in self.held], self.merges.ranks):
            if end > final:
                break
            yield token
            done = end
        self.held = self.held[done:]

    def finish(self) -> Iterator[int]:
        """The ids of what is still held: the word ends here."""
        if self.held:
            ids = self.merges.ids
            symbols = [ids[x] for x in self.held[:-1]] + [ids[self.held[-1] + self.merges.suffix]]
            yield from (token for token, _ in merged(symbols, self.merges.ranks))
        self.held = ""

    def word(self, letters: str) -> list[int]:
        return [*self.feed(letters), *self.finish()]


class StreamEncoder(WordEncoder):
    """Ids of whole texts by the transducer; units are found as :class:`WordEncoder` finds them.

    A word with letters whose normal form needs their neighbours is normalised and cut
    by the vocabulary's own normaliser and pre-tokenizer. Special tokens keep their id.
    """

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.merges = Merges(path)
        self.transducer = Transducer(self.merges)
        names = sorted(self.merges.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def _forget(self) -> None:
        super()._forget()
        self.held_bytes = 0

    def _learn(self, keys: list[tuple[bytes, bool]]) -> None:
        super()._learn(keys)
        self.held_bytes += sum(len(k) for k, _ in keys)

    def _encoded(self, unit: bytes, whole: bool) -> list[int]:
        if not whole:
            text = unit.decode("latin-1")
            return self.transducer.word(text if text.isascii() else text.translate(self.letters))
        out: list[int] = []
        text = unit.decode("utf-8", "replace")
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.merges.special:
                out.append(self.merges.special[part])
            elif part:
                for letters, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part)):
                    out += self.transducer.word(letters)
        return out

    def ids(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.held_bytes > REMEMBERED_BYTES:
            self._forget()
        return super().ids(raw, at)


class TextMachine:
    """Text of ids as they come, the way the vocabulary writes tokens: one blank between them.

    With ``readable`` byte letters become the bytes they stand for, and a word's end a blank.
    """

    def __init__(self, merges: Merges, readable: bool = False) -> None:
        n = max(merges.strings, default=-1) + 1
        pieces = [merges.strings.get(i, "") for i in range(n)]
        if readable:
            of_letter = {chr(v): k for k, v in byte_letters().items()}
            special = set(merges.special)
            self.pieces = [self._bytes(s, merges.suffix, of_letter) if s not in special else s.encode() for s in pieces]
        else:
            self.pieces = [b" " + s.encode() for s in pieces]
        self.lengths = np.fromiter(map(len, self.pieces), np.int64, n)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.skip = 0 if readable else 1
        self.restart()

    @staticmethod
    def _bytes(token: str, suffix: str, of_letter: dict[str, int]) -> bytes:
        end = b" " if suffix and token.endswith(suffix) else b""
        letters = token[: len(token) - len(suffix)] if end else token
        return bytes(of_letter[c] if c in of_letter else ord(c) for c in letters) + end

    def restart(self) -> None:
        self.begun = False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of many ids, and how many each has."""
        lengths = self.lengths[ids]
        return self.pool[flat_ranges(self.starts[ids], lengths)], lengths

    def feed_bytes(self, data: bytes) -> str:
        """Text that the next bytes of a text's ids complete."""
        if data and not self.begun:
            data, self.begun = data[self.skip :], True
        return self.machine.decode(data)

    def feed(self, ids: Iterable[int]) -> str:
        return self.feed_bytes(b"".join(self.pieces[i] for i in ids))

    def finish(self) -> str:
        text = self.machine.decode(b"", True)
        self.restart()
        return text


def stretches(raw: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of a text of about ``SLICE_BYTES``, each up to the next white space."""
    start = 0
    while start < len(raw):
        end = min(len(raw), start + SLICE_BYTES)
        while end < len(raw) and not (found := IS_SPACE[raw[end : end + SLICE_BYTES]]).any():
            end = min(len(raw), end + SLICE_BYTES)
        if end < len(raw):
            end += int(found.argmax())
        yield raw[start:end]
        start = end


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Number of ids of each document, and digests of the ids and of the text they decode to."""
    path = vocabulary or vocabulary_path()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = StreamEncoder(path)
        machine = TextMachine(encoder.merges)
        for batch in batches:
            for part, raw, at in text_slices(batch):
                out = []
                if len(part) == 1 and len(raw) > SLICE_BYTES:  # a text longer than a slice, stretch by stretch
                    n, of_ids, of_text = 0, sha256(), sha256()
                    for piece in stretches(raw):
                        ids, _ = encoder.ids(piece, np.array([0, len(piece)]))
                        n += len(ids)
                        of_ids.update(ids.astype("<u4").tobytes())
                        of_text.update(machine.feed_bytes(machine.bytes_of(ids)[0].tobytes()).encode())
                    of_text.update(machine.finish().encode())
                    out.append((n, of_ids.hexdigest(), of_text.hexdigest()))
                else:
                    ids, counts = encoder.ids(raw, at)
                    data, lengths = machine.bytes_of(ids)
                    ends = np.concatenate([[0], np.cumsum(lengths)])
                    packed, text, start = ids.astype("<u4").tobytes(), data.tobytes(), 0
                    for n in counts.tolist():
                        own = machine.feed_bytes(text[ends[start] : ends[start + n]]) + machine.finish()
                        out.append((n, sha256(packed[4 * start : 4 * (start + n)]).hexdigest(), sha256(own.encode()).hexdigest()))
                        start += n
                kinds = (pa.int64(), pa.string(), pa.string())
                columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, kinds)]
                yield pa.record_batch([part.column("doc_id"), *columns], names=[x.split()[0] for x in RESULT.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(digests, RESULT)


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The ids themselves: ``(doc_id, ids)``, null where the text is null."""
    path = vocabulary or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = StreamEncoder(path)
        for batch in batches:
            for part, raw, at in text_slices(batch):
                ids, counts = encoder.ids(raw, at)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                empty = part.column("text").is_null()
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)), mask=empty if part.column("text").null_count else None)
                yield pa.record_batch([part.column("doc_id"), column], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, vocabulary: str | None = None, readable: bool = False) -> DataFrame:
    """Texts of ``(doc_id, ids)``; ``readable`` gives bytes for byte letters and blanks for word ends."""
    path = vocabulary or vocabulary_path()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = TextMachine(Merges(path), readable)
        for batch in batches:
            texts = [None if ids is None else machine.feed(ids) + machine.finish() for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
