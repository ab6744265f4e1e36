"""Secret scans: a random forest over candidate strings, trained from labelled findings to drop false positives.

A candidate is a run of at least ``SHORT`` key characters with a digit or capitals
inside, any of at least ``LONG``, and any of at least ``ASSIGNED`` after a
credential's name and ``=`` or ``:``. Its features are
its length, the kinds of characters and the transitions between them, its
entropy, how likely its letter pairs are in ordinary words, how much of it
words of the corpus cover, marks of a path or address around it, and the
neighbouring words. The forest is trained in numpy on a bounded sample of
labelled findings (``SAMPLE_ROWS`` of each label, lowest hash first), and every
candidate of every whole text is scored.

Without labelled findings of their own, callers get them by ``weak_labels``: known
formats of keys, placeholders, paths, addresses and numbers, and whether a candidate
stands after a credential's name and an assignment. The forest then does not see
the features ``UNSEEN`` that tell the latter, so it judges the candidate itself. Null and empty texts have no candidates; repeated rows each have
theirs; without findings of both labels nothing is a secret; clashing columns
are not read; an empty table gives no row. The secret itself is never returned.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import documents, kept, mapped

SAMPLE_ROWS = 2000
DICTIONARY_WORDS = 3000
TREES, DEPTH, LEAF = 25, 6, 3
MASK = "<secret>"
ASSIGNED, SHORT, LONG = 6, 8, 16
# A sign of assignment ends a run, padding at its end does not.
CANDIDATE = re.compile(rf"[A-Za-z0-9_+/\-.!@$%]{{{ASSIGNED},}}={{0,2}}")
UNLIKE_WORDS = re.compile(r"[0-9]|[a-z][A-Z]|[A-Z]{2}[a-z]")
LETTER = re.compile(r"[A-Za-z]")
CREDENTIAL = re.compile(r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)\W{0,3}\s*[:=]\s*\W{0,3}$")
# Whole candidates, for weak labels.
KEY_FORMATS = (
    r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^github_pat_\w{40,}$|^glpat-[\w\-]{20,}$|^xox[abeoprs]-[0-9A-Za-z\-]{10,}$|^AIza[\w\-]{35}$"
    r"|^[rs]k_live_[0-9A-Za-z]{16,}$|^sk-[\w\-]{20,}$|^npm_[0-9A-Za-z]{36}$|^SG\.[\w\-]{16,}\.[\w\-]{16,}$|^eyJ[\w\-]{8,}\.eyJ[\w\-]{8,}\.[\w\-]{8,}$"
)
PLACEHOLDERS = r"(?i)example|sample|dummy|placeholder|change[_-]?me|replace[_-]|insert[_-]|redacted|^your|[_-]your|x{4,}|^\W*(\w)\1+\W*$|^0?123456|\.\.\.|^[$%]\w+%?$"
PLACES = r"^(\.{0,2}|~)/[\w.]|^//|^www\.|^[\w.+%\-]+@[\w\-]+(\.[\w\-]+)+$|^([A-Za-z0-9\-]+\.)+[A-Za-z]{2,6}(/\S*)?$|^[\w.\-]+(/[\w.\-]+)*\.[a-z]{1,4}$"
NUMBERS = r"^[0-9+\-][0-9.,/+\-%]*$"
ORDINARY = r"^[.!@$%/_\-]*([A-Z]?[a-z]+|[A-Z]+)([.!@$%/_\-]+([A-Z]?[a-z]+|[A-Z]+))*[.!@$%/_\-]*$"
UNSEEN = ("assigned", "name")
BEFORE, AFTER = 48, 16
FINDINGS = "doc_id long, start long, n_chars long, candidate string, before string, after string"
FEATURES = (
    "length", "digits", "capitals", "small", "signs", "transitions", "entropy", "pairs",
    "coverage", "slashes", "address", "quoted", "assigned", "name", "hexadecimal", "number_before",
)


def candidates(text: str) -> Iterator[tuple[int, int]]:
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        while text[b - 1] == ".":  # ends a sentence
            b -= 1
        before = text[max(0, a - 8) : a]
        if b - a >= SHORT and UNLIKE_WORDS.search(text, a, b) or b - a >= LONG and LETTER.search(text, a, b):
            yield a, b
        elif b - a >= ASSIGNED and (":" in before or "=" in before) and CREDENTIAL.search(text[max(0, a - BEFORE) : a]):
            yield a, b


def findings(docs: DataFrame) -> DataFrame:
    """Every candidate with the text around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if not (text := text.as_py()):
                    continue
                for a, b in candidates(text):
                    out.append((doc_id, a, b - a, text[a:b], text[max(0, a - BEFORE) : a], text[b : b + AFTER]))
            if out:
                kinds = (*[pa.int64()] * 3, *[pa.string()] * 3)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in FINDINGS.split(", ")])

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, FINDINGS)


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings with ``label``: null where nothing but the candidate itself tells."""
    own, assigned = F.col("candidate"), F.col("before").rlike(CREDENTIAL.pattern)
    label = F.when(own.rlike(PLACEHOLDERS), 0).when(own.rlike(KEY_FORMATS), 1).when(own.rlike(PLACES), 0)
    # Words and numbers may be passwords, after a name.
    label = label.when(own.rlike(ORDINARY), F.when(~assigned, 0)).when(own.rlike(NUMBERS) & ~assigned, 0).when(assigned, 1)
    return found.withColumn("label", label.cast("int"))


class Words:
    """Letter pairs and the most frequent of the given words."""

    def __init__(self, words: dict[str, int]) -> None:
        self.words = frozenset(w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:DICTIONARY_WORDS])
        pairs: Counter[str] = Counter()
        for w, n in words.items():
            for a, b in zip(w, w[1:]):
                pairs[a + b] += n
        total = sum(pairs.values()) + 1
        self.pairs = {p: log((n + 0.1) / total) for p, n in pairs.items()}
        self.least = log(0.1 / total)

    def likelihood(self, s: str) -> float:
        return sum(self.pairs.get(s[i : i + 2], self.least) for i in range(len(s) - 1)) / max(1, len(s) - 1)

    def coverage(self, s: str) -> float:
        """Share of the characters in words of the dictionary, the longest first from the left."""
        covered = at = 0
        while at < len(s):
            for n in range(min(12, len(s) - at), 2, -1):
                if s[at : at + n] in self.words:
                    covered, at = covered + n, at + n
                    break
            else:
                at += 1
        return covered / max(1, len(s))


def kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def features(candidate: str, before: str, after: str, words: Words) -> list[float]:
    kinds = [kind(c) for c in candidate]
    n, low = len(candidate), candidate.lower()
    shares = [kinds.count(k) / n for k in range(4)]
    counts = Counter(candidate).values()
    previous = re.findall(r"\w+", before)
    return [
        float(n),
        *shares,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        -sum(c / n * log(c / n, 2) for c in counts),
        words.likelihood(low),
        words.coverage(low),
        float(candidate.count("/") + before.endswith("/")),
        float("@" in before[-2:] or after.startswith(("@", "."))),
        float(before[-1:] in ("'", '"') and after[:1] in ("'", '"')),
        float(bool(re.search(r"[:=]\W*$", before))),
        float(bool(CREDENTIAL.search(before))),
        float(all(c in "0123456789abcdef" for c in low)),
        float(bool(previous) and previous[-1].isdigit()),
    ]


def blanked(row: list[float], unseen: list[int]) -> list[float]:
    for f in unseen:
        row[f] = 0.0
    return row


class Forest:
    """Trees on bootstrap samples, each split among a few random features by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        self.trees: list[list[tuple[int, float, int, int, float]]] = []
        if len(set(y.tolist())) == 2:
            rng = np.random.default_rng(seed)
            for _ in range(TREES):
                rows = rng.integers(0, len(y), len(y))
                nodes: list = []
                self._grow(nodes, x[rows], y[rows].astype(float), DEPTH, rng)
                self.trees.append(nodes)

    def _grow(self, nodes: list, x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator) -> int:
        at, mean = len(nodes), float(y.mean())
        nodes.append((-1, 0.0, 0, 0, mean))
        if depth and 0 < mean < 1:
            best = (mean * (1 - mean) * len(y) - 1e-9, -1, 0.0)
            for f in rng.choice(x.shape[1], 4, replace=False):
                order = np.argsort(x[:, f], kind="stable")
                v, s = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(y))
                left, right = s[:-1] / n, (s[-1] - s[:-1]) / (len(y) - n)
                cost = n * left * (1 - left) + (len(y) - n) * right * (1 - right)
                cost[(v[1:] == v[:-1]) | (n < LEAF) | (len(y) - n < LEAF)] = np.inf
                if len(cost) and cost.min() < best[0]:
                    k = int(cost.argmin())
                    best = (float(cost[k]), int(f), float((v[k] + v[k + 1]) / 2))
            if best[1] >= 0:
                low = x[:, best[1]] <= best[2]
                a = self._grow(nodes, x[low], y[low], depth - 1, rng)
                b = self._grow(nodes, x[~low], y[~low], depth - 1, rng)
                nodes[at] = (best[1], best[2], a, b, mean)
        return at

    def score(self, row: list[float]) -> float:
        if not self.trees:
            return 0.0
        total = 0.0
        for nodes in self.trees:
            f, cut, a, b, mean = nodes[0]
            while f >= 0:
                f, cut, a, b, mean = nodes[a if row[f] <= cut else b]
            total += mean
        return total / len(self.trees)


class Scanner:
    """A forest with the places of the features that it does not see."""

    def __init__(self, forest: Forest, words: Words, unseen: tuple[str, ...] = ()) -> None:
        self.forest, self.words, self.unseen = forest, words, [FEATURES.index(f) for f in unseen]

    def score(self, candidate: str, before: str, after: str) -> float:
        return self.forest.score(blanked(features(candidate, before, after, self.words), self.unseen))

    def masked(self, text: str) -> str:
        out, at = [], 0
        for a, b in candidates(text):
            if self.score(text[a:b], text[max(0, a - BEFORE) : a], text[b : b + AFTER]) >= 0.5:
                out += [text[at:a], MASK]
                at = b
        return "".join([*out, text[at:]]) if at else text


def corpus_words(docs: DataFrame) -> Words:
    """The words in the most documents, each document counted once for a word."""
    own = F.array_distinct(F.expr(r"regexp_extract_all(lower(CAST(text AS STRING)), '\\p{L}{3,12}', 0)"))
    counted = docs.select(F.explode(own).alias("word")).groupBy("word").count()
    top = counted.orderBy(F.col("count").desc(), "word").limit(4 * DICTIONARY_WORDS)
    return Words({r.word: r["count"] for r in top.collect()})


def train(labelled: DataFrame, words: Words, rows: int = SAMPLE_ROWS, unseen: tuple[str, ...] = ()) -> Scanner:
    """Fit on at most so many findings of each label, without the features ``unseen``."""
    x, y, hidden = [], [], [FEATURES.index(f) for f in unseen]
    for label in (0, 1):
        own = labelled.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start", "candidate").limit(rows)
        for r in own.collect():
            x.append(blanked(features(r.candidate, r.before, r.after, words), hidden))
            y.append(label)
    return Scanner(Forest(np.array(x).reshape(-1, len(FEATURES)), np.array(y)), words, unseen)


def scored(found: DataFrame, scanner: Scanner) -> DataFrame:
    """Findings with the forest's score; only their place is returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("candidate", "before", "after")])
            score = np.array([scanner.score(*r) for r in rows], float)
            columns = [batch.column(c) for c in ("doc_id", "start", "n_chars")]
            yield pa.record_batch([*columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "start", "n_chars", "score", "is_secret"])

    return mapped(found, run, "doc_id long, start long, n_chars long, score double, is_secret int")


def trained(docs: DataFrame, found: DataFrame | None, labelled: DataFrame | None) -> Scanner:
    """On labelled findings, or on weak labels of those found."""
    words = corpus_words(docs)
    return train(weak_labels(found), words, unseen=UNSEEN) if labelled is None else train(labelled, words)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of the documents with its score."""
    found = kept(findings(docs), "findings")
    return scored(found, trained(docs, found, labelled))


def masked(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents with their secrets masked and ``n_chars`` renewed; other columns as they are."""
    scanner = trained(docs, kept(findings(docs), "findings") if labelled is None else None, labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else scanner.masked(t) for t in batch.column("text").to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = mapped(docs, run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
