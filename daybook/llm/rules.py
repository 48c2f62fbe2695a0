"""Quality rules: counts per text against fixed thresholds, then a calibrated logistic regression on hashed n-grams.

The regression sees three groups of features, hashed into tables: words, pairs of neighbouring words, and runs of
``CHARS`` bytes. A group's part of the logit is the mean weight of its n-grams, so long and short texts compare. It
is fitted on four fifths of a bounded sample of labelled rows (``TRAIN_ROWS``) and calibrated on the last fifth
(Platt scaling). Texts are scored in Arrow batches; a text is kept when the counts pass and the probability of label 1
is ``THRESHOLD`` or more.

A null or empty text has no words, so all counts are 0 and it fails. Without labels every probability is 0.5.
Repeated rows are judged alike. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import labelled_sample, ship, slices, table
from daybook.llm.text import U64, Texts, mix

TRAIN_ROWS = 2000
ROUNDS = 80
BITS = 15
CHARS = 3
SCALE = 20.0
THRESHOLD = 0.3

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, score double"
)


def _by_text(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that only agree inside a text."""
    return mix(hashes + owner.astype(U64) * U64(0x9FB21C651E98DF25))


def duplicate_lines(texts: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    starts = np.sort(np.concatenate([texts.at[:-1], breaks + 1]))
    owner = np.searchsorted(texts.at[1:], starts, side="right")
    # A break at the very end of a text opens an empty line there, which may coincide with the next text's first.
    ends = np.append(starts[1:], len(texts.data))
    ends = ends - ((ends > starts) & (ends > 0) & (texts.data[np.maximum(ends, 1) - 1] == 0x0A)) if len(texts.data) else ends
    words = texts.spans[0]
    real = np.searchsorted(words, ends) > np.searchsorted(words, starts)
    owner, keys = owner[real], texts.hashes(starts[real], ends[real])
    n = len(texts)
    _, first = np.unique(_by_text(keys, owner), return_index=True)
    return np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)


def repeated_words(texts: Texts, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Words inside a run of ``window`` words that their text has twice or more, the first time included."""
    hashes, first = texts.windows(window)
    n_words = len(texts.spans[0])
    edges = np.zeros(n_words + 1, dtype=np.int64)
    if len(hashes):
        keys = _by_text(hashes, texts.word_text[first])
        order = np.argsort(keys)
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        again = np.zeros(len(keys), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        np.add.at(edges, first[again], 1)
        np.add.at(edges, first[again] + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
    return np.diff(covered[texts.word_at])


def counts(texts: Texts) -> dict[str, np.ndarray]:
    starts, ends = texts.spans
    edges = np.zeros(len(texts.data) + 1, dtype=np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    visible = (np.cumsum(edges[:-1], dtype=np.int8) > 0) & ((texts.data & 0xC0) != 0x80)
    return {
        "n_words": texts.word_counts,
        "word_chars": texts.per_text(visible),
        "n_symbols": texts.per_text(SYMBOLS[texts.data]),
        "n_dup_lines": duplicate_lines(texts),
        "n_repeat_words": repeated_words(texts),
    }


def _char_runs(data: np.ndarray) -> np.ndarray:
    n = len(data) - CHARS + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    code = data[:n].astype(np.uint32)
    for k in range(1, CHARS):
        code = code * np.uint32(0x9E3779B1) + data[k : n + k]
    return (code * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)


def features(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each group: hashed n-grams in order, and where each text's begin, with the end of the last."""
    mask = U64((1 << BITS) - 1)
    words = (texts.word_hashes & mask).astype(np.uint16), texts.word_at
    pairs, first = texts.windows(2)
    codes = _char_runs(texts.data)
    owner = np.searchsorted(texts.at[1:], np.arange(len(codes)), side="right")
    inside = np.arange(len(codes)) + CHARS <= texts.at[1:][owner] if len(codes) else np.zeros(0, bool)
    kept = np.concatenate([[0], np.cumsum(inside)])
    return [
        words,
        ((pairs & mask).astype(np.uint16), np.searchsorted(first, texts.word_at)),
        (codes[inside].astype(np.uint16), kept[np.minimum(texts.at, len(codes))]),
    ]


@dataclass
class Regression:
    weights: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1 << BITS, np.float32) for _ in range(3)])
    intercept: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def logits(self, groups: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.full(len(groups[0][1]) - 1, self.intercept)
        for weights, (codes, at) in zip(self.weights, groups, strict=True):
            sums = np.concatenate([[0.0], np.cumsum(weights[codes], dtype=np.float64)])
            out += SCALE * np.diff(sums[at]) / np.maximum(1, np.diff(at))
        return out

    def probability(self, texts: Texts) -> np.ndarray:
        logits = self.slope * self.logits(features(texts)) + self.shift
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def _platt(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with softened targets."""
    positive, negative = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([logits, np.ones_like(logits)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (p - target) + 1e-3 * theta
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(curvature, gradient), -2, 2)
    return float(theta[0]), float(theta[1])


def _all_features(values: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of many texts, taken from a few at a time."""
    parts = [features(Texts.of(values, a, b)) for a, b in slices(values)]
    out = []
    for group in zip(*parts, strict=True):
        sizes = np.concatenate([np.diff(at) for _, at in group])
        out.append((np.concatenate([codes for codes, _ in group]), np.concatenate([[0], np.cumsum(sizes)])))
    return out


def train(sample: pa.Table) -> Regression:
    """Fit on rows of (text, label): every fifth row calibrates, the rest train."""
    model = Regression()
    labels = sample["label"].to_numpy().astype(np.float64)
    if not len(labels):
        return model
    groups = _all_features(sample["text"].combine_chunks())
    calibrates = np.arange(len(labels)) % 5 == 4
    weight = np.where(calibrates, 0.0, 1 / max(1, (~calibrates).sum()))
    moments = [[np.zeros(1 << BITS), np.zeros(1 << BITS)] for _ in groups]
    share = (labels.sum() + 1) / (len(labels) + 2)
    model.intercept = float(np.log(share / (1 - share)))
    for step in range(1, ROUNDS + 1):
        error = weight * (1 / (1 + np.exp(-np.clip(model.logits(groups), -30, 30))) - labels)
        model.intercept -= float(error.sum())
        for i, (codes, at) in enumerate(groups):
            sizes = np.diff(at)
            each = np.repeat((SCALE * error / np.maximum(1, sizes)).astype(np.float32), sizes)
            gradient = np.bincount(codes, weights=each, minlength=1 << BITS) + 1e-6 * model.weights[i]
            m, v = moments[i]
            m[:] = 0.9 * m + 0.1 * gradient
            v[:] = 0.99 * v + 0.01 * gradient**2
            move = (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
            model.weights[i] -= (0.05 * move).astype(np.float32)
    held = calibrates if calibrates.any() else ~calibrates
    model.slope, model.shift = _platt(model.logits(groups)[held], labels[held])
    return model


def judge(documents: DataFrame, model: Regression, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, the verdict of the counts alone, the final verdict and the probability, for every row."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"], 1 << 19):
                texts = Texts.of(batch["text"], a, b)
                found = counts(texts)
                n = found["n_words"]
                failed = (n < MIN_WORDS) | (100 * found["n_repeat_words"] > REPEAT_PERCENT * n)
                score = model.probability(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(a, b - a),
                        *(pa.array(column, pa.int64()) for column in found.values()),
                        pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score),
                    ],
                    names=["doc_id", *found, "base_failed", "kept", "score"],
                )

    ship(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rate, SCHEMA)


def fit(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Regression:
    return train(labelled_sample(documents, labels.select("doc_id", F.col("quality").alias("label")), limit))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return judge(documents, fit(documents, table(spark, sf_dir, "labels")))
