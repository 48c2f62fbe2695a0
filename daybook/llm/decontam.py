"""Benchmark decontamination: which documents contain a test item.

An item is contained when a document has at least ``PERCENT`` percent of the item's distinct ``WORDS``-word shingles,
wherever they stand. Search is by MinHash containment: an item's sketch is its smallest shingle hashes, and a document
is a candidate when it has one of them. Items are partitioned by size; a partition's sketch has floor((100 - percent)
q / 100) + 1 of q hashes, so that a contained item must show at least one: candidates lose nothing, however long the
document. Documents with too few shingles for a partition skip it. Every candidate is verified on all of its shingles.

Items are searched in blocks, each against all documents; a block ends at ``BLOCK`` items or ``BLOCK_HASHES`` hashes, and
only a block's hashes go to the tasks.

An item or document with fewer words than a shingle is one shingle. Items and documents that are null, empty or without words
match nothing. A null or repeated id is kept as it is: rows of equal (doc_id, item_id) may repeat when their inputs do.
Other columns are ignored; with no items or no documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import ROW_KEY, keyed, ship, slices, table
from daybook.llm.text import U64, Texts, shingle_sets

WORDS = 5
PERCENT = 75
BLOCK = 50_000
BLOCK_HASHES = 2_000_000  # of a block's items together

FOUND = "doc_id long, item_id long, item_shingles long, shared_shingles long"


@dataclass
class Partition:
    """Items of about equal size: their sketches as an inverted index, and their whole sets."""

    smallest: int  # shingles that a document must have
    sketch: np.ndarray  # sorted hashes
    sketch_item: np.ndarray  # item of each
    sets: list[np.ndarray]
    ids: list[int | None]


def partitions(ids: list[int | None], sets: list[np.ndarray], percent: int) -> list[Partition]:
    """Size classes of powers of two."""
    by_size: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        if len(s):
            by_size.setdefault(len(s).bit_length(), []).append(i)
    out = []
    for _, members in sorted(by_size.items()):
        sketches = [sets[i][: (100 - percent) * len(sets[i]) // 100 + 1] for i in members]  # sets are sorted
        hashes = np.concatenate(sketches)
        owner = np.repeat(np.arange(len(members)), [len(s) for s in sketches])
        order = np.argsort(hashes, kind="stable")
        smallest = min(-(-percent * len(sets[i]) // 100) for i in members)
        out.append(Partition(smallest, hashes[order], owner[order], [sets[i] for i in members], [ids[i] for i in members]))
    return out


def contained(document: np.ndarray, part: Partition, percent: int) -> list[tuple[int | None, int, int]]:
    """Items of the partition in a document, given as sorted distinct shingle hashes: id, size, shared."""
    if len(document) < part.smallest:
        return []
    at = np.searchsorted(part.sketch, document)
    hit = document[part.sketch[np.minimum(at, len(part.sketch) - 1)] == document]
    if not len(hit):
        return []
    low, high = np.searchsorted(part.sketch, hit), np.searchsorted(part.sketch, hit, side="right")
    items = np.unique(np.concatenate([part.sketch_item[a:b] for a, b in zip(low, high, strict=True)]))
    out = []
    for i in items:
        own = part.sets[i]
        place = np.minimum(np.searchsorted(document, own), len(document) - 1)
        shared = int((document[place] == own).sum())
        if 100 * shared >= percent * len(own):
            out.append((part.ids[i], len(own), shared))
    return out


def _blocks(items: DataFrame, n: int) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """Items and their shingle sets, a bounded number at a time."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    ids: list[int | None] = []
    sets: list[np.ndarray] = []
    hashes = 0
    for row in rows.toLocalIterator():
        ids.append(row["item_id"])
        sets += shingle_sets(Texts.of(pa.array([row["text"]]), 0, 1).lowered(), n)
        hashes += len(sets[-1])
        if len(ids) >= BLOCK or hashes > BLOCK_HASHES:
            yield ids, sets
            ids, sets, hashes = [], [], 0
    if ids:
        yield ids, sets


def search(documents: DataFrame, items: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document and contained item."""
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = [rows.mapInArrow(_search_block(partitions(*block, percent), n, percent), FOUND) for block in _blocks(items, n)]
    out = spark.createDataFrame([], FOUND)
    for frame in found:
        out = frame if frame is found[0] else out.union(frame)
    return out


def _finder(parts: list[Partition], n: int, percent: int):
    """A function that gives, for a column of texts, each row that contains items, and those items."""
    # Every sketch hash at once: most documents have none of them.
    every = np.unique(np.concatenate([p.sketch for p in parts])) if parts else np.zeros(0, U64)

    def find(column: pa.Array) -> Iterator[tuple[int, list[tuple[int | None, int, int]]]]:
        if not len(every):
            return
        for a, b in slices(column):
            texts = Texts.of(column, a, b).lowered()
            hashes, first = texts.windows(n)
            hit = np.zeros(len(texts), dtype=bool)
            hit[texts.word_text[first[every[np.minimum(np.searchsorted(every, hashes), len(every) - 1)] == hashes]]] = True
            hit |= texts.word_counts < n  # these are one shingle, which is not a window
            for i in np.flatnonzero(hit & (texts.word_counts > 0)):
                own = shingle_sets(Texts.of(column, a + i, a + i + 1).lowered(), n)[0]
                if items := [item for part in parts for item in contained(own, part, percent)]:
                    yield a + i, items

    return find


def _search_block(parts: list[Partition], n: int, percent: int):
    schema = pa.schema([(name, pa.int64()) for name in ("doc_id", "item_id", "item_shingles", "shared_shingles")])
    find = _finder(parts, n, percent)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(batch["doc_id"][i].as_py(), *item) for i, items in find(batch["text"]) for item in items]
            columns = zip(*out, strict=True) if out else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return read


def _keep_block(parts: list[Partition], n: int, percent: int):
    find = _finder(parts, n, percent)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[[i for i, _ in find(batch["text"].cast(pa.string()))]] = False
            yield batch.filter(pa.array(keep))

    return read


def clean(documents: DataFrame, items: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, that contain no item. Each row is judged by its own text, whatever its ``doc_id``."""
    blocks = _blocks(items, n)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return documents
    if second is None:
        ship(documents.sparkSession)
        return documents.mapInArrow(_keep_block(partitions(*first, percent), n, percent), documents.schema)
    rows = keyed(documents, "rows")
    found = search(rows.select(F.col(ROW_KEY).alias("doc_id"), "text"), items, n, percent)
    found = found.select(F.col("doc_id").alias(ROW_KEY)).distinct()
    return rows.join(found, ROW_KEY, "left_anti").select(*documents.columns)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
