"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

Every run of one to three bytes of the text (ASCII letters in lower case, other
ASCII as a space) hashes to an embedding; their mean goes through a softmax.
Trained on a bounded sample of labelled rows (``SAMPLE_ROWS`` of each language,
lowest hash of the id first; the bias then follows the shares in all rows), of
which a fifth calibrates a temperature and two limits, each set to turn away
``FALSE_REJECTIONS`` of known languages: of the score, and of how usual the text's
subwords are in the learned texts, whatever their language. A prediction below
either is ``rejected``.

A text that is null or has no letter is ``und`` with score 0 and rejected, whatever else. Rows
without a label are predicted, never learned from. Repeated rows get equal
results. Without any labelled row every row is ``und``. Other columns pass
unread; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import SMALL_SLICE, documents, fold, kept, lowest_of_each, mapped, text_slices

SAMPLE_ROWS = 1000
BUCKETS = 4096
WIDTH = 16
EPOCHS = 12
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
# Share of texts in known languages that each of the two limits is set to reject.
FALSE_REJECTIONS = 0.001
TEMPERATURES = np.geomspace(0.05, 20, 60)
# Share of subwords assumed of one that no learned text has.
UNSEEN = 1e-7

_PLAIN = np.full(256, 0x20, np.uint32)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
_PLAIN[0x80:] = np.arange(0x80, 0x100)


def subword_buckets(raw: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """For each subword length the bucket at each byte; BUCKETS where a text ends too early."""
    plain = _PLAIN[raw]
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(raw))
    code = np.zeros(len(raw), np.uint32)
    for n in (1, 2, 3):
        code *= np.uint32(257)
        code[: len(raw) - n + 1] += plain[n - 1 :]
        bucket = ((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(20)
        yield np.where(left >= n, bucket, BUCKETS)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # language, bucket and one for no subword
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    usual: np.ndarray | None = None  # logarithm of each bucket's share, and one for no subword
    unusual_below: float = -np.inf

    def grams(self, at: np.ndarray) -> np.ndarray:
        lengths = np.diff(at)
        return np.maximum(lengths * 3 - 3, lengths + (lengths > 1) * (lengths - 1))

    def logits(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        lengths, grams = np.diff(at), self.grams(at)
        filled = np.flatnonzero(lengths)
        out = np.zeros((len(lengths), len(self.languages)))
        if len(filled):
            for bucket in subword_buckets(raw, at):
                for k, own in enumerate(self.weights):
                    out[filled, k] += np.add.reduceat(own[bucket], at[:-1][filled])
            out[filled] /= grams[filled, None]
        return (out + self.bias) / self.temperature

    def predict(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shares = softmax(self.logits(raw, at))
        return shares.argmax(axis=1), shares.max(axis=1)

    def rejected(self, raw: np.ndarray, at: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Whether a prediction of this score is rejected, for each text."""
        if self.usual is None:
            return np.ones(len(share), bool)
        filled = np.flatnonzero(np.diff(at))
        mean = np.full(len(share), -np.inf)
        if len(filled):
            sums = sum(np.add.reduceat(self.usual[bucket], at[:-1][filled]) for bucket in subword_buckets(raw, at))
            mean[filled] = sums / self.grams(at)[filled]
        return (share < self.reject_below) | (mean < self.unusual_below)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def lower_limit(values: np.ndarray) -> float:
    """Below it fall ``FALSE_REJECTIONS`` by their quantile or by a normal tail, the lower of both: few rows do not tell the quantile."""
    return float(min(np.quantile(values, FALSE_REJECTIONS), values.mean() + NormalDist().inv_cdf(FALSE_REJECTIONS) * values.std()))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label and bucket counts of sampled rows, at most BUCKETS a row."""
    for batch in batches:
        for part, raw, at in text_slices(batch, size=SMALL_SLICE):
            buckets, used, counts = list(subword_buckets(raw, at)), [], []
            for a, b in zip(at[:-1], at[1:]):
                found = sum(np.bincount(bucket[a:b], minlength=BUCKETS + 1)[:BUCKETS] for bucket in buckets)
                used.append(np.flatnonzero(found).astype(np.int32))
                counts.append(found[used[-1]])
            yield pa.record_batch(
                {
                    "lang": part.column("lang"),
                    "buckets": pa.array(used, pa.list_(pa.int32())),
                    "counts": pa.array(counts, pa.list_(pa.int64())),
                }
            )


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> LanguageModel:
    """Fit on the labelled rows of each language with the lowest hashes of their id."""
    texts = labelled.select("doc_id", "lang", F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    ids = kept(texts.select("doc_id", "lang", F.xxhash64("doc_id").alias("place")).distinct(), "labelled_ids")
    totals = {r.lang: r["count"] for r in ids.groupBy("lang").count().collect()}
    chosen = lowest_of_each(ids, "lang", totals, sample_rows).select("doc_id", "lang")
    sample = texts.join(F.broadcast(chosen), ["doc_id", "lang"]).distinct()
    rows = mapped(sample, _features, "lang string, buckets array<int>, counts array<long>").collect()
    rows = sorted(rows, key=lambda r: (r.lang, r.buckets, r.counts))
    languages = sorted({r.lang for r in rows})
    if not languages:
        return LanguageModel([UNKNOWN], np.zeros((1, BUCKETS + 1)), np.zeros(1))
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for k, r in enumerate(rows):
        x[k, r.buckets] = np.array(r.counts, np.float32) / max(1, sum(r.counts))
    y = np.array([languages.index(r.lang) for r in rows])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5]
    learned = order[len(rows) // 5 :]
    embedding = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    out, bias = rng.normal(0, 0.1, (WIDTH, len(languages))), np.zeros(len(languages))
    for epoch in range(EPOCHS):
        rng.shuffle(learned)
        rate = 4.0 / (1 + epoch)
        for some in np.array_split(learned, max(1, len(learned) // 16)):
            mean = x[some] @ embedding
            error = softmax(mean @ out + bias)
            error[np.arange(len(some)), y[some]] -= 1
            error /= len(some)
            back = error @ out.T
            out -= rate * mean.T @ error
            bias -= 0.1 * rate * error.sum(axis=0)
            # The mean spreads a text over many embeddings, so these take longer steps.
            embedding -= 20 * rate * x[some].T @ back
    model = LanguageModel(languages, np.zeros((len(languages), BUCKETS + 1)), bias)
    model.weights[:, :BUCKETS] = (embedding @ out).T
    # Sampled evenly, so the shares in all rows come back into the bias, at the scale of the calibrated scores.
    shares = np.array([totals[k] for k in languages], float) / np.bincount(y)
    prior = np.log(shares / shares.max())
    if len(held):
        z = x[held] @ model.weights[:, :BUCKETS].T + bias
        loss = [-np.log(softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in TEMPERATURES]
        model.temperature = float(TEMPERATURES[int(np.argmin(loss))])
        best = softmax(z / model.temperature + prior).max(axis=1)
        odds = np.log(best + 1e-12) - np.log(1 - best + 1e-12)
        model.reject_below = float(1 / (1 + np.exp(-lower_limit(odds))))
    # Each language counts the same, so texts of rare ones are as usual as others.
    shares = np.mean([x[learned[y[learned] == k]].mean(axis=0) for k in np.unique(y[learned])], axis=0)
    model.usual = np.append(np.log(shares.astype(np.float64) + UNSEEN), 0.0)
    if len(held):
        model.unusual_below = lower_limit(x[held] @ model.usual[:BUCKETS])
    model.bias = bias + model.temperature * prior
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows with ``lang_pred``, ``score`` and ``rejected``; columns of these names are replaced."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    texted = docs.select(*[F.col(c).alias(f"_{c}") for c in names], F.col("text").cast("string").alias("text"), F.coalesce(F.col("text").cast("string").rlike("\\p{L}"), F.lit(False)).alias("lettered"))
    fields = texted.drop("text", "lettered").schema
    out_names = [*fields.names, "_lang_pred", "_score", "_rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in text_slices(batch, size=SMALL_SLICE):
                best, share = model.predict(raw, at)
                lettered = part.column("lettered").to_numpy(zero_copy_only=False)
                found = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)]
                yield pa.record_batch(
                    [
                        *[part.column(f"_{c}") for c in names],
                        pa.array(found, pa.string()),
                        pa.array(np.where(lettered, share, 0.0)),
                        pa.array(~lettered | model.rejected(raw, at, share)),
                    ],
                    names=out_names,
                )

    return mapped(texted, run, fields.add("_lang_pred", "string").add("_score", "double").add("_rejected", "boolean")).toDF(*names, "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows whose language the model does not reject, with their own columns, whatever their names."""
    names, flag = docs.columns, "lettered"
    while flag in names:
        flag += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in text_slices(batch, size=SMALL_SLICE):
                _, share = model.predict(raw, at)
                lettered = part.column(flag).to_numpy(zero_copy_only=False)
                keep = lettered & ~model.rejected(raw, at, share)
                yield part.select(names).filter(pa.array(keep))

    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    return mapped(docs.withColumn(flag, lettered), run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    model = train(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")
