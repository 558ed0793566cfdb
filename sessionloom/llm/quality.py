"""Quality classifier: learned vectors of hashed words and character n-grams, averaged over a document, and a softmax on top.

Features of a text are its words between blanks, whether each repeats the word before it, and its byte n-grams (blanks included),
hashed into `BUCKETS`. Training is numpy
stochastic gradient descent with a falling rate over a bounded sample of labelled rows, drawn by the smallest hashes of the id
(`TRAIN_ROWS`, the documented bound). The classes weigh equally, so that the rarer one isn't drowned. After training
a bucket's vector times the difference of the softmax weights is one number; a document's score is the logistic of their mean, so
scoring reads one number for each feature of the whole text.

Defined cases: a null or empty text has no features, its score comes from the bias alone. Rows with a null label teach nothing, and
labels other than 0 and 1 neither; an id labelled twice alike counts once, one labelled both ways teaches nothing. Without labels of
both kinds every score is 0.5 (predicted 1). Repeated rows each give a row. Other columns, labels included, never enter a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_BLANK, Texts, owner, prefix_sums, query, stretch_hash, table, texts, words

BUCKETS = 1 << 18
GRAMS = (2, 3, 4)
DIM = 8
EPOCHS = 6
#: A small sample is read more often, until so many steps are taken.
STEPS = 6000
RATE = 0.5
#: The bound of the sample of labelled rows.
TRAIN_ROWS = 1500
FOLDS = 3
HELD_OUT = 1


def held_out(id_: Column, folds: int = FOLDS, out: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(F.encode(id_.cast("string"), "UTF-8")) % folds == out, F.lit(False))


def features(t: Texts, buckets: int = BUCKETS, grams=GRAMS):
    """Pairs (bucket of each feature, first feature of each text): words, shapes of word pairs (buckets 0 and 1), n-grams of each length."""
    sums = prefix_sums(t.data)
    mask = np.uint64(buckets - 1)
    start, stop, first = words(t, NOT_BLANK)
    word = stretch_hash(sums, start, stop)
    yield (word & mask).astype(np.int32), first
    # the shape of a word pair: whether the word repeats the one before it in the same text
    again = np.zeros(len(word), np.int32)
    again[1:] = word[1:] == word[:-1]
    again[first[:-1][first[:-1] < len(word)]] = 0
    yield again, first
    size = np.diff(t.at)
    for n in grams:
        count = np.maximum(size - n + 1, 0)
        first = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(first[-1]) - np.repeat(first[:-1] - t.at[:-1], count)
        yield (stretch_hash(sums, at, at + n) & mask).astype(np.int32), first


class Model:
    def __init__(self, logit: np.ndarray, bias: float, grams=GRAMS):
        self.logit, self.bias, self.grams = logit.astype(np.float32), bias, grams

    def score(self, t: Texts) -> np.ndarray:
        total, count = np.zeros(len(t)), np.zeros(len(t))
        for bucket, first in features(t, len(self.logit), self.grams):
            run = np.concatenate([[0.0], np.cumsum(self.logit[bucket], dtype=np.float64)])
            total += run[first[1:]] - run[first[:-1]]
            count += np.diff(first)
        z = self.bias + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def counted(column: pa.Array, buckets: int, grams) -> list[tuple[bytes, bytes]]:
    """For each text its distinct buckets and their shares of all features."""
    out = []
    for t in texts(column):
        parts = list(features(t, buckets, grams))
        for i in range(len(t)):
            all_ = np.concatenate([b[f[i] : f[i + 1]] for b, f in parts])
            bucket, n = np.unique(all_, return_counts=True)
            out.append((bucket.astype("<i4").tobytes(), (n / max(len(all_), 1)).astype("<f4").tobytes()))
    return out


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, grams=GRAMS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 0) -> Model:
    """samples: (buckets, shares, label). Softmax over two classes; one step for each document and epoch."""
    label = np.array([y for _, _, y in samples])
    if len(np.unique(label)) < 2:
        return Model(np.zeros(buckets), 0.0, grams)
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    weight = len(label) / (2 * np.bincount(label, minlength=2))
    epochs = max(epochs, -(-STEPS // len(samples)))
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for k in draw.permutation(len(samples)):
            bucket, share, y = samples[k]
            now = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[bucket]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            g = (now * weight[y] * p).astype(np.float32)
            down = g @ out
            out -= np.outer(g, hidden)
            bias -= 0.1 * g
            # the mean divides every feature's gradient by their number; the root keeps steps useful for long documents
            vectors[bucket] -= np.outer(np.sqrt(share), down)
    return Model(vectors @ (out[1] - out[0]), float(bias[1] - bias[0]), grams)


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """(text, label) of the labelled rows with the smallest hashes of the id, outside the held-out fold."""
    known = labels.select(F.col(label_id).cast("string").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("top")).where("label = top")
    # a few rows more are drawn than used, as labels may lack their document; a document that repeats counts once
    known = known.orderBy(F.xxhash64("id"), "id").limit(2 * rows)
    body = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    # equal texts teach once for each label; the limit is taken by hash again, before any text is gathered
    return body.orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(rows).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, buckets: int = BUCKETS, grams=GRAMS, **names) -> Model:
    """The model from the bounded sample: the executors count features, at most `buckets` for each of `rows` documents, and training is here."""

    def count(batches):
        for batch in batches:
            pairs = counted(batch.column(0), buckets, grams)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.binary()), pa.array([b for _, b in pairs], pa.binary()), batch.column(1)], names=["bucket", "share", "label"])

    got = training_rows(docs, labels, rows, **names).mapInArrow(count, "bucket binary, share binary, label int")
    samples = [(np.frombuffer(r["bucket"], "<i4"), np.frombuffer(r["share"], "<f4"), r["label"]) for r in got.collect()]
    return train(samples, buckets, grams)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, score): the columns `keep` (all by default) in a struct, and the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(F.struct(*[F.col(c) for c in keep or docs.columns]).alias("row"), F.col(text_col).alias("text"))

    def run(batches):
        m = shared.value
        for batch in batches:
            parts = [m.score(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts) if parts else np.empty(0))], names=["row", "score"])

    kind = out.schema["row"].dataType.simpleString()
    return out.mapInArrow(run, f"row {kind}, score double")


@query("op6_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model, keep=["doc_id"])
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
