"""Best-fit packing by linear grouping.

Documents are cut into pieces of at most ``capacity`` tokens. Large pieces are rounded up within groups of equal
cardinality, so that few sizes remain; configurations of those sizes are searched on the histogram of lengths and
applied as often as the counts allow; actual pieces take the configurations' places in order of length; what
remains, and the small pieces, go to the fullest sequence that still has room. The driver only sees the histogram,
which has at most ``capacity`` rows at any size of the input. Places are dealt to pieces by their rank among the
pieces of equal length, and ranks come from counts per bucket of ids, so no group gathers in one task.

Null and empty texts are documents of one token (the end mark). Repeated rows are packed once each. Other columns
are ignored. An empty table gives no rows. A null ``doc_id`` is kept as null.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import saved, ship, table

CAPACITY = 2048
END_ID = 0
GROUPS = 256  # size groups of the large pieces
LARGE = 8  # pieces of more than capacity / LARGE tokens are large
BUCKETS = 1024  # ranks are counted per length and bucket of ids
STRETCH = 1 << 16  # characters that are encoded at once, or more up to the next place to cut at

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

# The pre-tokenizer always cuts in front of a space that has a visible character behind it.
_SAFE_SPACE = re.compile(r" (?=\S)")


class Encoder:
    """Token ids of a text as bytes, little-endian, 32 bits each.

    A long text is encoded stretch by stretch, so that a worker never holds all its ids as Python objects; the ids of
    a text are the ids of its stretches in a row. Nothing is kept between texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = _same_ids_faster(path)

    def encode(self, text: str) -> bytes:
        if self.plain is not None and "<|" not in text:
            ids = self.plain.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        out, start = [], 0
        while cut := _SAFE_SPACE.search(text, start + STRETCH):
            out.append(self.encode(text[start : cut.start()]))
            start = cut.start()
        out.append(self.encode(text[start:]))
        return b"".join(out)


def _same_ids_faster(path: str):
    """The same vocabulary as ranks, where the file lies beside ``path``: equal ids for text without special tokens."""
    import base64
    from pathlib import Path

    ranks = Path(path).with_suffix(".tiktoken")
    if not ranks.exists():
        return None
    import public_tokenizers
    import tiktoken

    pairs = (line.split() for line in ranks.open("rb"))
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
    )


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its document, number, first token, length, and crc32 of its ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = own.ids(text.as_py() or "") + end
                total = len(ids) // 4
                starts = [0, *range(total % capacity or capacity, total, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], total], strict=True)):
                    row = (doc_id, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema)

    ship(documents.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32"))]
    )
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences, as lengths in order of place, and how many there are of each."""
    left = Counter({length: n for length, n in counts.items() if n and length < capacity})
    bins: list[tuple[tuple[int, ...], int]] = [((capacity,), counts[capacity])] if counts.get(capacity) else []
    bins += _configurations(left, capacity)
    return _best_fit(bins, left, capacity)


def _groups(left: Counter, capacity: int) -> tuple[np.ndarray, list[list[int]]]:
    """Large lengths in groups of about equal cardinality: each group's rounded size, and its lengths, largest first."""
    large = sorted(length for length in left if length * LARGE > capacity)
    share = max(1, -(-sum(left[length] for length in large) // GROUPS))
    members: list[list[int]] = []
    held = share
    for length in large:
        if held >= share:
            members.append([])
            held = 0
        members[-1].append(length)
        held += left[length]
    return np.array([m[-1] for m in members], dtype=np.int64), [m[::-1] for m in members]


def _fullest(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[int]:
    """Groups, each at most as often as it has pieces, whose rounded sizes fill ``room`` best; the largest first."""
    usable = [g for g in np.argsort(-sizes, kind="stable") if counts[g] > 0 and sizes[g] <= room]
    reached = np.zeros(room + 1, dtype=bool)
    reached[0] = True
    last = np.full(room + 1, -1)  # group that reached a sum first
    for g in usable:
        for _ in range(min(int(counts[g]), room // int(sizes[g]))):
            fresh = np.zeros_like(reached)
            fresh[sizes[g] :] = reached[: -sizes[g]]
            fresh &= ~reached
            if not fresh.any():
                break
            last[fresh] = g
            reached |= fresh
    at = int(np.flatnonzero(reached)[-1])
    chosen = []
    while at:
        chosen.append(int(last[at]))
        at -= int(sizes[last[at]])
    return chosen


def _configurations(left: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Use up large pieces in configurations of rounded sizes; every round exhausts a group at least."""
    sizes, members = _groups(left, capacity)
    counts = np.array([sum(left[x] for x in m) for m in members], dtype=np.int64)
    out: list[tuple[tuple[int, ...], int]] = []
    while len(counts) and counts.any():
        largest = int(np.flatnonzero(counts)[-1])
        counts[largest] -= 1
        chosen = [largest, *_fullest(sizes, counts, capacity - int(sizes[largest]))]
        counts[largest] += 1
        uses = Counter(chosen)
        times = int(min(counts[g] // n for g, n in uses.items()))
        slots = [_take(left, members[g], times) for g in chosen]
        for g, n in uses.items():
            counts[g] -= n * times
        out += _side_by_side(slots)
    return out


def _take(left: Counter, lengths: list[int], n: int) -> list[tuple[int, int]]:
    """The ``n`` longest remaining pieces of a group, as runs of equal length."""
    runs = []
    for length in lengths:
        used = min(n, left[length])
        if used:
            runs.append((length, used))
            left[length] -= used
            n -= used
        if not n:
            break
    return runs


def _side_by_side(slots: list[list[tuple[int, int]]]) -> list[tuple[tuple[int, ...], int]]:
    """Runs beside each other: sequences that hold the same lengths, and how many."""
    ends = sorted({int(e) for runs in slots for e in np.cumsum([n for _, n in runs])})
    out, start = [], 0
    position = [[0, runs[0][1]] for runs in slots]
    for end in ends:
        kind = []
        for place, runs in zip(position, slots, strict=True):
            while place[1] <= start:
                place[0] += 1
                place[1] += runs[place[0]][1]
            kind.append(runs[place[0]][0])
        out.append((tuple(kind), end - start))
        start = end
    return out


def _best_fit(bins: list, left: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The small pieces, longest first, into the fullest kind of sequence with room; new sequences when none has."""
    by_room: dict[int, list] = {}
    for kind, n in bins:
        by_room.setdefault(capacity - sum(kind), []).append((kind, n))
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = min((r for r in by_room if r >= length and by_room[r]), default=None)
            if room is None:
                each = min(n, capacity // length)
                opened = [((length,) * each, n // each)]
                n %= each
            else:
                kind, times = by_room[room].pop()
                each = min(room // length, n)
                used = min(times, n // each)
                if times > used:
                    by_room[room].append((kind, times - used))
                opened = [(kind + (length,) * each, used)]
                n -= each * used
            for kind, times in opened:
                by_room.setdefault(capacity - sum(kind), []).append((kind, times))
        left[length] = 0
    return [item for items in by_room.values() for item in items]


def places(bins: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Which ranks of a length go where: rank r of a run lies in sequence ``sequence + r - first`` at ``offset``."""
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for kind, n in bins:
        offset = 0
        for length in kind:
            rows.append((length, ranks[length], sequence, offset))
            ranks[length] += n
            offset += length
        sequence += n
    frame = pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"])
    return frame.sort_values(["length", "first"], ignore_index=True)


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    spark = documents.sparkSession
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS))
    cut = saved(pieces(documents, tokenizer, capacity), "pieces").withColumn("bucket", bucket)
    bucketed = cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    histogram = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    runs = places(plan({r["length"]: r["n"] for r in histogram}, capacity))

    # Ranks: pieces of equal length in smaller buckets come first.
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start")
    ranked = cut.withColumn("nth", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])

    first = {int(n): g.to_numpy() for n, g in runs.groupby("length")[["first", "sequence", "offset"]]}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            where = np.empty((len(lengths), 2), dtype=np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                run = first[int(length)]
                at = np.searchsorted(run[:, 0], ranks[rows], side="right") - 1
                where[rows, 0] = run[at, 1] + ranks[rows] - run[at, 0]
                where[rows, 1] = run[at, 2]
            columns = [batch[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(where[:, 0]), pa.array(where[:, 1])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ship(spark)
    return ranked.withColumn("rank", F.col("nth") + F.col("before")).drop("bucket", "nth", "before").mapInArrow(place, PACKED)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
