"""Quality classifier: a convolutional network over bytes, in numpy.

A text's bytes are read in overlapping chunks that together cover all of it. Learned filters of ``WIDTH`` bytes slide
over a chunk; each filter's largest response in the chunk is kept. A text is then described by each filter's largest
and mean response over its chunks, and one logistic unit turns that into a probability. The first layer is a table of
weights per place and byte value, so a filter's response is a sum of ``WIDTH`` table rows.

Training takes at most ``TRAIN_ROWS`` labelled rows (their whole texts); scoring takes every row.

A null or empty text is one chunk of padding and gets that chunk's score; without any label the score is 0.5.
Repeated rows are scored alike. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import fold, labelled_sample, ship, slices, table
from daybook.llm.text import Texts

TRAIN_ROWS = 4000
TEXTS_SEEN = 16_000  # epochs follow from this and the number of rows
MOST_EPOCHS = 40
FILTERS = 8
WIDTH = 5
STRIDE = 256  # a chunk is two strides of bytes; each stride is in two chunks
THRESHOLD = 0.3
PAD = 256  # the byte value outside the text


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x 257 x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # of the largest, then the mean responses
    intercept: float

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        filters = rng.normal(0, 0.3, (WIDTH, 257, FILTERS)).astype(np.float32)
        filters[:, PAD] = 0
        weights = rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
        return Network(filters, np.zeros(FILTERS, np.float32), weights, 0.0)

    def responses(self, padded: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Response of every filter at every place by stride; ``padded`` has WIDTH - 1 places more than there are responses.

        A text's last WIDTH - 1 windows would reach into the next text and count for nothing; all its bytes are in
        earlier windows as well.
        """
        n = len(padded) - WIDTH + 1
        out = self.filters[0].take(padded[:n], axis=0)
        for k in range(1, WIDTH):
            out += self.filters[k].take(padded[k : n + k], axis=0)
        out = out.reshape(first[-1], STRIDE, FILTERS)
        out[first[1:] - 1, STRIDE - WIDTH + 1 :] = -np.inf
        return out

    def describe(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunk maxima, the text of each chunk, and each text's largest and mean response."""
        # Each text is laid out in whole strides with padding behind it, so that strides never mix texts.
        lengths = np.diff(texts.at)
        strides = np.maximum(1, -(-lengths // STRIDE))
        first = np.concatenate([[0], np.cumsum(strides)])
        padded = np.full(first[-1] * STRIDE + WIDTH - 1, PAD, dtype=np.int16)
        shift = np.repeat(first[:-1] * STRIDE - texts.at[:-1], lengths)
        padded[np.arange(len(texts.data)) + shift] = texts.data
        peaks = self.responses(padded, first).max(axis=1) + self.bias
        np.maximum(peaks, 0, out=peaks)
        # A chunk is a stride and the next one of the same text.
        chunks = peaks.copy()
        chunks[:-1] = np.maximum(chunks[:-1], peaks[1:])
        chunks[first[1:] - 1] = peaks[first[1:] - 1]
        best = np.maximum.reduceat(chunks, first[:-1], axis=0)
        mean = np.add.reduceat(chunks, first[:-1], axis=0) / strides[:, None]
        return padded, first, np.hstack([best, mean])

    def score(self, texts: Texts) -> np.ndarray:
        _, _, described = self.describe(texts)
        return 1 / (1 + np.exp(-(described @ self.weights + self.intercept).astype(np.float64)))


def _step(net: Network, texts: Texts, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weighted log loss."""
    padded, first, described = net.describe(texts)
    logits = described @ net.weights + net.intercept
    error = (weight * (1 / (1 + np.exp(-logits)) - labels)).astype(np.float32)
    up = error[:, None] * net.weights
    to_best, to_mean = up[:, :FILTERS], up[:, FILTERS:] / np.diff(first)[:, None]

    response = net.responses(padded, first)
    place = response.argmax(axis=1)
    raw = np.take_along_axis(response, place[:, None, :], axis=1)[:, 0] + net.bias
    peaks = np.maximum(raw, 0)
    # The gradient of a chunk goes to the stride that had its maximum.
    source = np.repeat(np.arange(first[-1])[:, None], FILTERS, axis=1)
    later = np.zeros_like(source, dtype=bool)
    later[:-1] = peaks[1:] > peaks[:-1]
    later[first[1:] - 1] = False
    source += later
    chunks = np.take_along_axis(peaks, source, axis=0)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    grad = np.zeros_like(peaks)
    columns = np.arange(FILTERS)
    for t in range(len(texts)):
        top = first[t] + chunks[first[t] : first[t + 1]].argmax(axis=0)
        np.add.at(grad, (source[top, columns], columns), to_best[t])
    np.add.at(grad, (source, np.broadcast_to(columns, source.shape)), to_mean[owner])
    grad *= raw > 0

    filters = np.zeros_like(net.filters)
    position = np.arange(first[-1])[:, None] * STRIDE + place
    for k in range(WIDTH):
        np.add.at(filters[k], (padded[position + k], np.broadcast_to(columns, position.shape)), grad)
    filters[:, PAD] = 0
    return [filters, grad.sum(axis=0), described.T @ error, np.float32(error.sum())]


def train(sample: pa.Table, seed: int = 7) -> Network:
    """Fit on rows of (text, label) by Adam; both labels weigh the same at first."""
    net = Network.fresh(seed)
    labels = sample["label"].to_numpy().astype(np.float32)
    if not len(labels):
        net.weights[:] = 0
        return net
    share = labels.mean()
    net.intercept = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    values = sample["text"].combine_chunks()
    rng = np.random.default_rng(seed)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (net.filters, net.bias, net.weights, np.float32(0))]
    step, size = 0, 16
    epochs = min(MOST_EPOCHS, -(-TEXTS_SEEN // len(labels)))
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), size):
            rows = order[at : at + size]
            part = values.take(pa.array(rows))
            weight = np.full(len(rows), 1 / len(rows), dtype=np.float32)
            step += 1
            rate = 0.02 * (1 - epoch / epochs)
            parameters = [net.filters, net.bias, net.weights, np.float32(net.intercept)]
            for i, g in enumerate(_step(net, Texts.of(part, 0, len(rows)), labels[rows], weight)):
                m, v = state[i]
                state[i] = [0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g]
                parameters[i] = parameters[i] - rate * (state[i][0] / (1 - 0.9**step)) / (
                    np.sqrt(state[i][1] / (1 - 0.99**step)) + 1e-6
                )
            net = Network(parameters[0], parameters[1], parameters[2], float(parameters[3]))
    return net


def score(documents: DataFrame, net: Network) -> DataFrame:
    """doc_id and the probability of label 1, for every row."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [net.score(Texts.of(batch["text"], a, b)) for a, b in slices(batch["text"], 1 << 18)]
            scores = pa.array(np.concatenate(parts) if parts else [], pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], scores], names=["doc_id", "score"])

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(rate, "doc_id long, score double")


def keep(documents: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores ``threshold`` or more."""

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["text"]
            scores = [net.score(Texts.of(values, a, b)) for a, b in slices(values, 1 << 18)]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) >= threshold))

    ship(documents.sparkSession)
    return documents.mapInArrow(passing, documents.schema)


def fit(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Network:
    """The network trained on rows of the training folds."""
    known = labels.where(fold("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    return train(labelled_sample(documents, known, limit))


def classify(documents: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    return score(documents, net).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return classify(documents, fit(documents, table(spark, sf_dir, "labels")))
