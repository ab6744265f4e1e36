"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word (a run of ASCII letters, digits and other bytes above, in lower case)
enters by a hashed embedding and by the mean embedding of its bytes with their
neighbours. Two recurrences read each window of ``WINDOW`` words in both
directions, attention pools their states, and a logistic unit scores the
window. All overlapping windows of the whole text are scored, one every ``STRIDE``
words, so any passage of ``WINDOW - STRIDE`` words is read whole by one of them; a
document's score is that of its worst window.

The network learns from a bounded sample of labelled rows (``SAMPLE_ROWS`` of each
label, lowest hash of the id first, those with words; the bias then follows the
labels' shares in all rows), from each the window with the words likeliest in
toxic rows and some spread evenly. The first embedding column starts from the words'
log-odds in that sample; training looks at the first ``LONGEST`` letters of a word,
scoring at all. Only texts are inputs of a score.

A null or empty text or one without words is one window without words. Rows with
equal texts get equal scores. Without labels of both kinds every score is 0.
Other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import byte_prefix, documents, flat_ranges, fold, kept, lowest_of_each, span_hash, text_slices, usual_batches, word_spans

SAMPLE_ROWS = 1500
SAMPLE_WINDOWS = 4
WINDOW, STRIDE = 32, 16
WORD_BUCKETS, LETTER_BUCKETS = 8192, 2048
EMBED, HIDDEN, ATTEND = 8, 8, 8
EPOCHS, BATCH, RATE = 5, 128, 0.01
LEAST_STEPS = 300
FOLDS, HELD_OUT = 5, 0
RESULT = "doc_id long, held_out boolean, score double, predicted int"

_WORD = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _WORD[_low:_high] = np.arange(_low, _high)
_WORD[0x41:0x5B] = np.arange(0x61, 0x7B)


class Text:
    """Distinct words of a slice of texts, and the word at each place."""

    def __init__(self, raw: np.ndarray, at: np.ndarray) -> None:
        plain = _WORD[raw]
        starts, ends, self.first = word_spans(plain, at)
        hashes, chosen, self.place = np.unique(span_hash(byte_prefix(plain), starts, ends), return_index=True, return_inverse=True)
        self.bucket = (hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
        starts, self.sizes = starts[chosen], (ends - starts)[chosen]
        here = flat_ranges(starts, self.sizes)
        begin = np.cumsum(self.sizes) - self.sizes
        before = np.concatenate([[0], plain])[here].astype(np.uint32)
        after = np.concatenate([plain, [0]])[here + 1].astype(np.uint32)
        if len(begin):
            before[begin] = 0
            after[begin + self.sizes - 1] = 0
        code = (before * np.uint32(257) + plain[here]) * np.uint32(257) + after
        self.letters = ((code * np.uint32(2654435761)) >> np.uint32(21)).astype(np.int64)
        self.letter_first = begin

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the first word and number of words of each window; the first window of each text, and at the end of all."""
        n = np.diff(self.first)
        counts = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
        before = np.concatenate([[0], np.cumsum(counts)])
        start = flat_ranges(np.zeros(len(n), np.int64), counts) * STRIDE
        return start + np.repeat(self.first[:-1], counts), np.minimum(WINDOW, np.repeat(n, counts) - start), before


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters; ``*_f`` read forwards, ``*_b`` backwards."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        shapes = {"word": (WORD_BUCKETS, EMBED), "letter": (LETTER_BUCKETS, EMBED), "attend": (2 * HIDDEN, ATTEND), "point": (ATTEND,), "out": (2 * HIDDEN,)}
        for d in "fb":
            shapes |= {f"in_{d}": (2 * EMBED, 3 * HIDDEN), f"bias_{d}": (3 * HIDDEN,), f"gate_{d}": (HIDDEN, 2 * HIDDEN), f"new_{d}": (HIDDEN, HIDDEN)}
        self.p = {k: rng.normal(0, 0.1 if k in ("word", "letter") else 1 / np.sqrt(s[0]), s).astype(np.float32) for k, s in shapes.items()}
        for d in "fb":
            self.p[f"bias_{d}"][:] = 0
        self.p["bias"] = np.zeros(1, np.float32)

    def read(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States after each word; x has the words' gate inputs."""
        gate, new = self.p[f"gate_{d}"], self.p[f"new_{d}"]
        n, length = mask.shape
        h, out = np.zeros((n, HIDDEN), np.float32), np.empty((n, length, HIDDEN), np.float32)
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            zr = sigmoid(x[:, t, : 2 * HIDDEN] + h @ gate)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(x[:, t, 2 * HIDDEN :] + (r * h) @ new)
            m = mask[:, t, None]
            if keep is not None:
                keep.append((t, h, z, r, c, m))
            h = h + m * (1 - z) * (c - h)
            out[:, t] = h
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        seen = np.tanh(states @ self.p["attend"])
        weight = np.exp(np.minimum(seen @ self.p["point"], 30)) * mask
        weight = weight / np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", weight, states)
        return pooled @ self.p["out"] + self.p["bias"], pooled, weight, seen

    def projected(self, text: Text) -> dict[str, np.ndarray]:
        """Gate inputs of the distinct words, and of no word at the end."""
        letters = self.p["letter"][text.letters]
        mean = np.add.reduceat(letters, text.letter_first) / text.sizes[:, None] if len(text.sizes) else np.zeros((0, EMBED), np.float32)
        x = np.concatenate([self.p["word"][text.bucket], mean.astype(np.float32)], axis=1)
        x = np.concatenate([x, np.zeros((1, 2 * EMBED), np.float32)])
        return {d: x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"] for d in "fb"}

    def scores(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Worst window's probability of each text."""
        text = Text(raw, at)
        projected = self.projected(text)
        start, size, before = text.windows()
        place = np.append(text.place, len(text.sizes))
        out = np.empty(len(start), np.float32)
        for a in range(0, len(start), 1024):
            s, n = start[a : a + 1024], size[a : a + 1024]
            mask = np.arange(WINDOW) < n[:, None]
            word = place[np.where(mask, s[:, None] + np.arange(WINDOW), len(text.place))]
            mask = mask.astype(np.float32)
            states = np.concatenate([self.read(projected[d][word], mask, d) for d in "fb"], axis=2)
            out[a : a + 1024] = self.pool(states, mask)[0]
        worst = np.maximum.reduceat(out, before[:-1]) if len(before) > 1 else out
        return sigmoid(worst.astype(np.float64))

    def gradients(self, word: np.ndarray, letters: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch; letters has LETTER_BUCKETS where a word is over."""
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        table = np.concatenate([p["letter"], np.zeros((1, EMBED), np.float32)])
        count = np.maximum((letters < LETTER_BUCKETS).sum(axis=2, keepdims=True), 1)
        x = np.concatenate([p["word"][word], table[letters].sum(axis=2) / count], axis=2).astype(np.float32)
        saved: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.read(x @ p[f"in_{d}"] + p[f"bias_{d}"], mask, d, saved[d]) for d in "fb"], axis=2)
        logit, pooled, weight, seen = self.pool(states, mask)
        prob = sigmoid(logit)
        loss = float(-np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7)))
        back = (prob - y) / len(y)
        g["bias"][:] = back.sum()
        g["out"] = pooled.T @ back
        d_pooled = back[:, None] * p["out"]
        d_weight = np.einsum("nh,nth->nt", d_pooled, states)
        d_states = weight[:, :, None] * d_pooled[:, None, :]
        d_point = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        g["point"] = np.einsum("nt,nta->a", d_point, seen)
        d_seen = d_point[:, :, None] * p["point"] * (1 - seen**2)
        g["attend"] = np.einsum("nth,nta->ha", states, d_seen)
        d_states = d_states + d_seen @ p["attend"].T
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            own = d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            d_h, d_in = np.zeros((len(y), HIDDEN), np.float32), np.zeros((*mask.shape, 3 * HIDDEN), np.float32)
            gate, new = p[f"gate_{d}"], p[f"new_{d}"]
            for t, h, z, r, c, m in reversed(saved[d]):
                d_h = d_h + own[:, t]
                d_c = d_h * m * (1 - z) * (1 - c**2)
                d_rh = d_c @ new.T
                d_zr = np.concatenate([-d_h * m * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)], axis=1)
                d_in[:, t] = np.concatenate([d_zr, d_c], axis=1)
                g[f"new_{d}"] += (r * h).T @ d_c
                g[f"gate_{d}"] += h.T @ d_zr
                d_h = d_h * (1 - m * (1 - z)) + d_rh * r + d_zr @ gate.T
            g[f"in_{d}"] = np.einsum("nti,ntg->ig", x, d_in)
            g[f"bias_{d}"] = d_in.sum(axis=(0, 1))
            d_x += d_in @ p[f"in_{d}"].T
        np.add.at(g["word"], word, d_x[:, :, :EMBED])
        spread = np.broadcast_to((d_x[:, :, EMBED:] / count)[:, :, None, :], (*letters.shape, EMBED))
        real = letters < LETTER_BUCKETS
        np.add.at(g["letter"], letters[real], spread[real])
        return loss, g

    def fit(self, word: np.ndarray, letters: np.ndarray, mask: np.ndarray, y: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, batches = 0, max(1, len(y) // BATCH)
        epochs = max(EPOCHS, LEAST_STEPS // batches)
        for epoch in range(epochs):
            order = rng.permutation(len(y))
            for some in np.array_split(order, batches):
                step += 1
                _, g = self.gradients(word[some], letters[some], mask[some], y[some])
                rate = RATE / (1 + EPOCHS * epoch / epochs)
                for k, v in self.p.items():
                    first[k] += 0.1 * (g[k] - first[k])
                    second[k] += 0.001 * (g[k] ** 2 - second[k])
                    v -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


LONGEST = 16  # letters of a word that training looks at


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Network | None:
    """Fit on the labelled rows with the lowest hashes of their id; None without labels of both kinds."""
    usable = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # Letters, digits and bytes above make words.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text RLIKE '[0-9A-Za-z]|[^\\\\x00-\\\\x7F]'")
    ids = kept(usable.join(texts.select("doc_id").distinct(), "doc_id").withColumn("place", F.xxhash64("doc_id")), "labelled_ids")
    shares = {r.toxic: r["count"] for r in ids.groupBy("toxic").count().collect()}
    if len(shares) < 2:
        return None
    chosen = lowest_of_each(ids, "toxic", shares, sample_rows).select("doc_id", "toxic")
    sample = kept(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "labelled")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with each word bucket, by label; bucket -1 for all texts."""
        totals = np.zeros((2, WORD_BUCKETS + 1), np.int64)
        for batch in batches:
            for part, raw, at in text_slices(batch):
                text = Text(raw, at)
                for k, toxic in enumerate(part.column("toxic").to_pylist()):
                    totals[toxic, np.unique(text.bucket[text.place[text.first[k] : text.first[k + 1]]])] += 1
                    totals[toxic, -1] += 1
        yield pa.record_batch({"bucket": pa.array(np.arange(WORD_BUCKETS + 1)), "clean": pa.array(totals[0]), "toxic": pa.array(totals[1])})

    rows = sample.mapInArrow(counted, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean"), F.sum("toxic")).collect()
    totals = np.zeros((2, WORD_BUCKETS + 1))
    for bucket, clean, toxic in rows:
        totals[:, bucket] = clean, toxic
    if not totals[:, -1].all():
        return None
    odds = np.log((totals[1, :-1] + 1) / (totals[1, -1] + 2)) - np.log((totals[0, :-1] + 1) / (totals[0, -1] + 2))
    prior = (np.clip(odds, -4, 4) * np.minimum(1, totals[:, :-1].sum(axis=0) / 10)).astype(np.float32)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in text_slices(batch):
                text, out = Text(raw, at), []
                start, size, before = text.windows()
                for k, toxic in enumerate(part.column("toxic").to_pylist()):
                    own = np.arange(before[k], before[k + 1])
                    best = [prior[text.bucket[text.place[start[w] : start[w] + size[w]]]].max(initial=-9) for w in own]
                    spread = [] if toxic else np.linspace(0, len(own) - 1, SAMPLE_WINDOWS).astype(int).tolist()
                    for w in sorted({int(np.argmax(best)), *spread}):
                        words = text.place[start[own[w]] : start[own[w]] + size[own[w]]]
                        letters = [text.letters[text.letter_first[x] : text.letter_first[x] + min(LONGEST, text.sizes[x])].tolist() for x in words]
                        out.append((text.bucket[words].tolist(), letters, toxic))
                kinds = (pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64())), pa.int32())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["words", "letters", "toxic"])

    rows = sorted(sample.mapInArrow(windows, "words array<long>, letters array<array<long>>, toxic int").collect())
    word = np.zeros((len(rows), WINDOW), np.int64)
    letters = np.full((len(rows), WINDOW, LONGEST), LETTER_BUCKETS, np.int16)
    mask = np.zeros((len(rows), WINDOW), np.float32)
    for k, row in enumerate(rows):
        word[k, : len(row.words)] = row.words
        mask[k, : len(row.words)] = 1
        for t, x in enumerate(row.letters):
            letters[k, t, : len(x)] = x
    network = Network()
    network.p["word"][:, 0] = prior
    network.fit(word, letters, mask, np.array([r.toxic for r in rows], np.float32))
    # Sampled evenly, so the labels' shares in all rows come back into the bias.
    taken = {k: min(n, sample_rows) for k, n in shares.items()}
    network.p["bias"] += np.float32(np.log(shares[1] / taken[1]) - np.log(shares[0] / taken[0]))
    return network


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, whether the id is held out, score and prediction of each row."""
    usual_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in text_slices(batch):
                found = network.scores(raw, at) if network else np.zeros(part.num_rows)
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return own.mapInArrow(run, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels.filter(fold("doc_id", FOLDS) != HELD_OUT)))
