"""Resampling documents towards a target: hashed word runs say how much likelier a text is in the target than here.

Features are runs of ``LEAST_WORDS`` to ``MOST_WORDS`` consecutive words, joined by one space and counted as often as
they occur; a feature's bucket is the CRC-32 of its bytes modulo ``BUCKETS`` (``crc.py``). A bucket's gain is the
logarithm of its share in the target over its share in the documents, both smoothed by one, in whole thousandths. A
document's weight is the floored mean gain of its features; with Gumbel noise from its id added, taking the highest
scores draws documents without replacement in proportion to their weights.

Both passes over the texts are map-only; the tasks send ``BUCKETS`` counts each, and ``BUCKETS`` gains come back. Ranks
come from a sort by ranges: every range numbers its own rows, and adds how many rows the ranges before it hold.

A null or empty text has no feature and weight 0. A null doc_id takes the noise of the text ``null`` and comes last
among equal scores. Repeated rows are scored alike, all count, and each has a rank of its own. Without documents the
result is empty; without target texts all its counts are 0. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import ROW_KEY, keyed, saved, ship, slices, table
from daybook.llm.crc import crc32
from daybook.llm.text import Texts

LEAST_WORDS, MOST_WORDS = 1, 1
BUCKETS = 10_000
SEED = 2024
LEAST_FEATURED = 20  # words a document needs to be drawn
PERCENT = 10

# Bytes of a word, after A-Z became a-z: digits, letters and all of any character beyond ASCII.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

COUNTS = "bucket int, n long"
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def word_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of every word, the byte behind it, and the number of words before each text, and in all."""
    inside = WORD_BYTE[texts.data]
    edge = np.ones(len(inside) + 1, dtype=bool)  # between two bytes of which only one is a word's, or of two texts
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[texts.at] = True
    starts, ends = np.flatnonzero(inside & edge[:-1]), np.flatnonzero(inside & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, texts.at)


def features(texts: Texts, least: int = LEAST_WORDS, most: int = MOST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature, the text each is of, and each text's number of words; ``texts`` are in lower case."""
    starts, ends, at = word_spans(texts)
    count = np.diff(at)
    owner = np.repeat(np.arange(len(texts)), count)
    lengths = ends - starts
    # The words again, one space behind each, so that a run of words is a run of bytes.
    place = np.cumsum(lengths + 1) - (lengths + 1)
    joined = np.full(int((lengths + 1).sum()), 0x20, dtype=np.uint8)
    offset = np.repeat(place - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    joined[offset] = texts.data[WORD_BYTE[texts.data]]
    buckets, owners = [], []
    for words in range(least, most + 1):
        first = np.arange(max(0, len(starts) - words + 1))
        first = first[owner[first] == owner[first + words - 1]]
        last = first + words - 1
        buckets.append((crc32(joined, place[first], place[last] + lengths[last]) % np.uint32(BUCKETS)).astype(np.int64))
        owners.append(owner[first])
    return np.concatenate(buckets), np.concatenate(owners), count


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    for batch in batches:
        for a, b in slices(batch["text"]):
            yield batch.slice(a, b - a), Texts.of(batch["text"], a, b).lowered()


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many features each bucket holds, over all rows; the driver gets ``BUCKETS`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for _, texts in _texts(batches):
            total += np.bincount(features(texts)[0], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    ship(rows.sparkSession)
    found = rows.select(F.col("text").cast("string").alias("text")).mapInArrow(count, COUNTS)
    summed = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: floored thousandths of the log ratio of the smoothed shares."""
    s_all, t_all = float(documents.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(documents.tolist(), target.tolist())],
        dtype=np.int64,
    )


def noise(doc_id: int | None) -> int:
    """Gumbel noise of an id, in floored thousandths."""
    digits = hashlib.sha256(f"{SEED}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8]
    return math.floor(-1000 * math.log(-math.log((int(digits, 16) + 0.5) / 4294967296)))


def scored(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            buckets, owners, words = features(texts)
            n = np.bincount(owners, minlength=len(texts))
            # Whole numbers far below 2 ** 53, so their sums in doubles are exact.
            sums = np.bincount(owners, weights=gain[buckets], minlength=len(texts)).astype(np.int64)
            weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
            score = weight + np.array([noise(i) for i in batch["doc_id"].to_pylist()], dtype=np.int64)
            columns = [batch["doc_id"], *(pa.array(x.astype(np.int64)) for x in (words, n, weight, score))]
            yield pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in SCORED.split(", ")])

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(rate, SCORED)


def drawn(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_FEATURED) -> DataFrame:
    """The rows of ``scored`` with ``rank``: 1, 2, ... for the highest scores, ``percent`` of the rows long enough.

    Equal scores go by doc_id. No task sees more than its range of rows, whatever scores or ids repeat.
    """
    rows = keyed(rows, "scored")
    able = F.col("n_words") >= least_words
    take = rows.where(able).count() * percent // 100
    # Scores are whole thousandths of logarithms of 64-bit numbers, so there are some 100,000 different ones at most.
    steps = rows.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by([("score", "descending")])
    reached = np.cumsum(steps["n"].to_numpy()) if take else np.zeros(0, np.int64)
    lowest = steps["score"][int(np.searchsorted(reached, take))].as_py() if take else None
    within = able & (F.col("score") >= F.lit(lowest)) if take else F.lit(False)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc(ROW_KEY)]
    sorted_rows = rows.where(within).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(
        sorted_rows.withColumns({
            "__range": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
        }),
        "placed",
    )
    # One number a range.
    sizes = sorted((r["__range"], r["n"]) for r in placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for number, n in sizes:
        starts.append((number, before))
        before += n
    offsets = rows.sparkSession.createDataFrame(starts, "`__range` int, `__before` long")
    rank = F.col("__before") + F.col("__at") + 1
    ranked = placed.join(F.broadcast(offsets), "__range").withColumn("rank", F.when(rank <= take, rank))
    rest = rows.where(~F.coalesce(within, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every document with its weight and score towards ``target`` (both with ``text``), and the rank of those drawn."""
    gain = gains(bucket_counts(documents), bucket_counts(target))
    return drawn(scored(documents, gain), percent)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
