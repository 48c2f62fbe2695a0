"""Periodic runs of words: stretches that repeat one block at least four times, found with a run-length grammar.

Recompression builds the grammar over all texts of a slice at once: each level replaces maximal blocks of one symbol by
a symbol for (symbol, length), then pairs (left symbol, right symbol) by a symbol each, until one symbol is left. Which
symbols are left or right is chosen by hash, the same everywhere, so equal stretches are cut alike but for their edges.
How far two places agree (their longest common extension) is read off the levels: rise while whole symbols agree, fall
where they differ; a block counts as one step however long it is.

A run of period p has p words in common between any place inside it and the place p further, for at least 3p places.
A grid of every 3p-th place therefore meets each run; over all p that are n / 3 * ln n candidates. Extending a candidate
both ways gives the run exactly, and of equal stretches the smallest period counts.

A null or empty text, or one without words, has no run. Repeated rows are searched each; a null doc_id is like any
other. Other columns are ignored; an empty table gives no rows. Texts are read whole at any length: a slice's memory is
in proportion to its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import ship, slices, table
from daybook.llm.text import mix

LEAST_WORDS = 6
LEAST_TIMES = 4
CANDIDATES_AT_ONCE = 1 << 20
TRIED = 4  # ways to tell left from right symbols, of which the one that pairs most is taken

FOUND = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass
class Level:
    """Symbols that spell the words: where each starts (and the end), and how many equal ones follow and precede."""

    start: np.ndarray
    symbol: np.ndarray
    ahead: np.ndarray  # equal symbols from this one on, itself included
    behind: np.ndarray  # equal symbols up to this one, itself included

    @staticmethod
    def of(start: np.ndarray, symbol: np.ndarray) -> tuple[Level, np.ndarray, np.ndarray]:
        """The level, with the first symbol of each of its blocks and the block's length."""
        n = len(symbol)
        first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]])) if n else np.zeros(0, np.int64)
        size = np.diff(np.append(first, n))
        inside = np.arange(n) - np.repeat(first, size)
        return Level(start, symbol, np.repeat(size, size) - inside, inside + 1), first, size


def _renamed(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def grammar(words: np.ndarray) -> list[Level]:
    """Levels over a sequence of word numbers, the words themselves first."""
    start, symbol = np.arange(len(words) + 1), words.astype(np.int64)
    levels: list[Level] = []
    while True:
        level, first, size = Level.of(start, symbol)
        levels.append(level)
        if len(symbol) < 2:
            return levels
        symbol, start = symbol[first], np.append(start[first], start[-1])
        if (size > 1).any():
            symbol = _renamed(symbol * (int(size.max()) + 1) + size)
        best = np.zeros(max(0, len(symbol) - 1), dtype=bool)
        for attempt in range(TRIED):
            right = (mix(symbol.astype(np.uint64) + np.uint64(len(levels) * TRIED + attempt + 1)) & np.uint64(1)).astype(bool)
            for side in (right, ~right):
                pairs = ~side[:-1] & side[1:]
                if pairs.sum() > best.sum():
                    best = pairs
            if 4 * best.sum() >= len(symbol) - 1:
                break
        if not best.any() and len(symbol) > 1:
            # Hashes that tell no neighbours apart: take the first symbol for the only left one.
            best = (symbol[:-1] == symbol[0]) & (symbol[1:] != symbol[0])
        if len(symbol) > 1:
            opens = np.ones(len(symbol), dtype=bool)
            opens[1:] = ~best
            partner = np.zeros(len(symbol), dtype=np.int64)
            partner[:-1] = np.where(best, symbol[1:] + 1, 0)
            symbol = _renamed((symbol * (int(symbol.max()) + 2) + partner)[opens])
            start = np.append(start[:-1][opens], start[-1])


def extension(levels: list[Level], x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
    """For each pair of places how many words agree from there on, or up to there; ``x < y``."""
    x, y, begin = x.copy(), y.copy(), y.copy()
    fallen = np.zeros(len(x), dtype=np.int64)  # the level on which a pair stopped rising

    def step(level: Level, which: np.ndarray) -> np.ndarray:
        """Moves pairs past equal blocks; which of them moved."""
        s, t = np.searchsorted(level.start, x[which]), np.searchsorted(level.start, y[which])
        if forward:
            here = t < len(level.symbol)
            which, s, t = which[here], s[here], t[here]
        else:
            here = s > 0
            which, s, t = which[here], s[here] - 1, t[here] - 1
        same = level.symbol[s] == level.symbol[t]
        which, s, t = which[same], s[same], t[same]
        if forward:
            far = np.minimum(level.ahead[s], level.ahead[t])
            x[which], y[which] = level.start[s + far], level.start[t + far]
        else:
            far = np.minimum(level.behind[s], level.behind[t])
            x[which], y[which] = level.start[s - far + 1], level.start[t - far + 1]
        return which

    rising = np.arange(len(x))
    for h, level in enumerate(levels):
        above = levels[h + 1].start if h + 1 < len(levels) else None
        waiting, up = rising, []
        while len(waiting):
            moved = step(level, waiting)
            stopped = np.setdiff1d(waiting, moved, assume_unique=True)
            fallen[stopped] = h
            waiting = moved
            if above is not None and len(waiting):
                # Both places must begin a symbol of the next level.
                ready = (above[np.searchsorted(above, x[waiting])] == x[waiting]) & (
                    above[np.searchsorted(above, y[waiting])] == y[waiting]
                )
                up.append(waiting[ready])
                waiting = waiting[~ready]
        rising = np.concatenate(up) if up else np.zeros(0, np.int64)
        if not len(rising):
            break
    for h in range(int(fallen.max(initial=0)) - 1, -1, -1):
        going = np.flatnonzero(fallen > h)
        while len(going):
            going = step(levels[h], going)
    return np.abs(y - begin)


def _candidates(words: np.ndarray, text: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the grid whose words, and a neighbour's, agree a period further in the same text."""
    n = len(words)
    places, periods, held = [], [], 0
    for p in range(1, longest // LEAST_TIMES + 1):
        i = np.arange(0, n - p, 3 * p)
        i = i[(words[i] == words[i + p]) & (text[i] == text[i + p])]
        if not len(i):
            continue
        after = np.minimum(i + 1, n - p - 1)
        before = np.maximum(i - 1, 0)
        i = i[(words[after] == words[after + p]) | (words[before] == words[before + p])]
        places.append(i)
        periods.append(np.full(len(i), p))
        held += len(i)
        if held >= CANDIDATES_AT_ONCE:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def find_runs(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows (first word, length, period) of all runs, by first word and period; ``at`` cuts ``words`` into texts."""
    count = np.diff(at)
    text = np.repeat(np.arange(len(count)), count)
    longest = int(count.max(initial=0))
    found = [np.zeros((0, 3), dtype=np.int64)]
    levels = None
    for place, period in _candidates(words, text, longest):
        levels = levels or grammar(words)
        own = text[place]
        # Agreement past the text's end, or before its start, does not count.
        ahead = np.minimum(extension(levels, place, place + period, True), at[own + 1] - place - period)
        back = np.minimum(extension(levels, place, place + period, False), place - at[own])
        length = back + period + ahead
        good = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
        found.append(np.stack([(place - back)[good], length[good], period[good]], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)
    # Sorted by start, length, period: the first of equal stretches has the smallest period.
    fresh = np.ones(len(runs), dtype=bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts in a row, and where each text's begin."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.string()))
    values, cuts = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
    full = pc.not_equal(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(full)])[cuts]
    return values.filter(pa.array(full)), at


def _searched(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    values, at = _words(texts)
    words = values.dictionary_encode().indices.to_numpy()
    runs = find_runs(words, at)
    owner = np.searchsorted(at, runs[:, 0], side="right") - 1
    # A word goes where a run covers it behind the run's first period.
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edge[:-1]) == 0
    kept_at = np.concatenate([[0], np.cumsum(kept)])[at]
    rest = pa.ListArray.from_arrays(pa.array(kept_at.astype(np.int32)), values.filter(pa.array(kept)))
    run_at = pa.array(np.searchsorted(owner, np.arange(len(at))).astype(np.int32))
    columns = [pa.array(c) for c in (runs[:, 0] - at[owner], runs[:, 1], runs[:, 2])]
    listed = pa.ListArray.from_arrays(run_at, pa.StructArray.from_arrays(columns, fields=list(RUN)))
    return pa.RecordBatch.from_arrays(
        [ids, listed, pc.binary_join(rest, " ")], names=["doc_id", "runs", "collapsed"]
    )


def detect(documents: DataFrame) -> DataFrame:
    """doc_id, all runs by start and period, and the words no run repeats joined by one space, for every row."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                yield _searched(batch["doc_id"].slice(a, b - a), batch["text"].slice(a, b - a))

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, FOUND)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """The documents with one in ten made periodic from some word on, by its id; a null id leaves the text alone."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    planted = documents.select("doc_id", "text", h.alias("__h"), g.alias("__g")).withColumn(
        "__words", F.when(F.col("__h") % 10 == 0, words)
    )
    n = F.nullif(F.size("__words").cast("long"), F.lit(0).cast("long"))
    first = F.col("__g") % n
    period = 1 + F.floor((n - first) / (3 + F.col("__g") % 8)).cast("long")
    place = F.sequence(F.lit(0).cast("long"), n - 1)

    def source(i: Column) -> Column:
        return F.when(i >= F.col("__first"), F.col("__first") + (i - F.col("__first")) % F.col("__period")).otherwise(i)

    made = planted.withColumns({"__first": first, "__period": period}).select(
        "doc_id",
        F.when(
            F.size("__words") > 0,
            F.array_join(F.transform(place, lambda i: F.get("__words", source(i).cast("int"))), " "),
        ).otherwise(F.col("text")).alias("text"),
    )
    return made


def digest(found: DataFrame) -> DataFrame:
    """Per row the number of runs, the longest (then first, then of smallest period), and hashes of all of it."""
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.array_join(
        F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n"
    )
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(detect(with_planted_runs(table(spark, sf_dir, "documents"))))
