"""Language-model scoring with class-based n-grams.

Tokens are words in lower case and one end mark per text, which also is the context of a text's first token. Every
word has a class, chosen in two steps. Exchange clustering first assigns units to classes so that class pairs predict
best: a unit is one of the ``HEAD`` most frequent words, the end mark, or an ending (a word's last two bytes; the
``ENDINGS`` most frequent ones, and one unit for the others). Then every word that is no unit itself, however rare, moves
to the class under which its own occurrences in the training texts are likeliest, given its neighbours' classes of the
first step; if none is better than its ending's class it stays there, as do words that no training text has. Class
pairs are counted again after the moves. A text's probability is the product of class transitions (Witten-Bell smoothed)
and word emissions (add-one within the class, one unknown word included).

All counts cover every training text. The units' pair counts (at most ``(HEAD + ENDINGS + 2) ** 2``) are clustered on the
driver; words' neighbours are shuffled in one row per word and slice of texts. The ``NEAR`` most frequent words' counts
and classes go to every task; those of all other words are joined, after summing each text's words. Classes of training
texts are counted and those of all texts scored from the same rows. Words are told apart by 64-bit hashes.

A null or empty text is its end mark alone. Without training texts all counts are 0 and the base score is that of an
empty vocabulary. Repeated rows are scored each and, if in training, counted each. Other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import fold, saved, ship, slices, table
from daybook.llm.text import Texts

HEAD = 1500
ENDINGS = 400
NEAR = 200_000
CLASSES = 48
SWEEPS = 5
HELD = 1 << 20  # rows that a task sums, or passes on, at once
END = 0x5BD1E9955BD1E995  # the end mark's place among word hashes

COUNTS = "word long, ending int, n long"
PAIRS = "pair long, n long"
CONTEXTS = "word long, contexts binary"
MOVED = "word long, own int, class int"
PARTS = "row long, doc_id long, n_tokens long, known long, counts double, codes binary, word long, places binary"
RATED = "doc_id long, n_tokens long, n_known long, logs double, transitions double, spread double"


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Texts]]:
    for batch in batches:
        for a, b in slices(batch["text"], 1 << 21):
            yield batch["doc_id"].slice(a, b - a), Texts.of(batch["text"], a, b).lowered()


def _distinct(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word hashes, the ending of each, the number of each word among them, and how often each occurs."""
    starts, ends = texts.spans
    words, inverse = _numbered(texts.word_hashes.view(np.int64))
    times = np.bincount(inverse, minlength=len(words))
    first = np.zeros(len(words), np.int64)
    first[inverse[::-1]] = np.arange(len(inverse))[::-1]
    last = texts.data[ends[first] - 1].astype(np.int32)
    before = np.where(ends[first] - starts[first] > 1, texts.data[np.maximum(ends[first] - 2, 0)], 0).astype(np.int32)
    return words, before * 256 + last, inverse, times


def _numbered(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words, and the number of each word among them."""
    found = pa.array(words).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy().astype(np.int64)


def _tokens(texts: Texts, of_words: np.ndarray, of_end: int) -> np.ndarray:
    """A value per token from one per word, each text's end mark included."""
    out = np.full(len(of_words) + len(texts), of_end, dtype=of_words.dtype)
    spots = np.ones(len(out), dtype=bool)
    spots[texts.word_at[1:] + np.arange(len(texts))] = False
    out[spots] = of_words
    return out


def word_counts(training: DataFrame) -> DataFrame:
    """word, ending, n: how often each token occurs."""

    def summed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        words, endings, times = (np.concatenate(x) for x in zip(*held, strict=True))
        words, inverse = _numbered(words)
        ending, n = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        ending[inverse] = endings
        np.add.at(n, inverse, times)
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(ending), pa.array(n)], names=["word", "ending", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for ids, texts in _texts(batches):
            words, endings, _, times = _distinct(texts)
            held.append((np.append(words, END), np.append(endings, -1), np.append(times, len(ids))))
            size += len(words) + 1
            if size >= HELD:
                yield summed(held)
                held, size = [], 0
        if held:
            yield summed(held)

    counted = _rows(training).mapInArrow(count, COUNTS)
    return counted.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))


@dataclass
class Units:
    """What is clustered: unit 0 is the end mark, then frequent words, endings, and one for all other endings."""

    words: np.ndarray  # sorted hashes of the frequent words and the end mark
    word_unit: np.ndarray
    ending_unit: np.ndarray  # by ending
    size: int

    @staticmethod
    def of(frequent: np.ndarray, endings: np.ndarray) -> Units:
        words = np.concatenate([[END], frequent[frequent != END]]).astype(np.int64)
        order = np.argsort(words)
        table = np.full(1 << 16, len(words) + len(endings))
        table[endings] = len(words) + np.arange(len(endings))
        return Units(words[order], order, table, len(words) + len(endings) + 1)

    def find(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.word_unit[at], self.ending_unit[endings])

    def sequence(self, texts: Texts) -> np.ndarray:
        """Units of all tokens, each text's end mark included."""
        words, endings, inverse, _ = _distinct(texts)
        return _tokens(texts, self.find(words, endings)[inverse], 0)


def pair_counts(training: DataFrame, units: Units) -> DataFrame:
    """pair (left unit * units + right unit) and n; a text's first token follows an end mark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(units.size * units.size, np.int64)
        for _, texts in _texts(batches):
            sequence = units.sequence(texts)
            pairs, times = np.unique(np.concatenate([[0], sequence[:-1]]) * units.size + sequence, return_counts=True)
            found[pairs] += times
        pairs = np.flatnonzero(found)
        for a in range(0, len(pairs), HELD):
            some = pairs[a : a + HELD]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["pair", "n"])

    return _rows(training).mapInArrow(count, PAIRS).groupBy("pair").agg(F.sum("n").alias("n"))


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of every unit, from a matrix of pair counts: units move to the class that raises the likelihood most."""
    size = len(pairs)
    left, right = pairs.sum(axis=1), pairs.sum(axis=0)
    order = np.argsort(-(left + right), kind="stable")
    order = order[order != 0]
    own = np.zeros(size, dtype=np.int64)  # the end mark stays alone in class 0
    own[order] = 1 + np.arange(size - 1) % (classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), own] = 1
    forward, backward = pairs @ member, pairs.T @ member  # counts of each unit before and after each class
    n = member.T @ forward
    n_left, n_right = n.sum(axis=1), n.sum(axis=0)
    for _ in range(sweeps):
        moved = 0
        for u in order:
            a, itself = own[u], pairs[u, u]
            r, l = forward[u].copy(), backward[u].copy()
            r[a] -= itself
            l[a] -= itself
            n[a] -= r
            n[:, a] -= l
            n[a, a] -= itself
            n_left[a] -= left[u]
            n_right[a] -= right[u]
            rows, columns = _f(n + r) - _f(n), _f(n + l[:, None]) - _f(n)
            diagonal = n.diagonal()
            gain = rows.sum(axis=1) - rows.diagonal() + columns.sum(axis=0) - columns.diagonal()
            gain += _f(diagonal + r + l + itself) - _f(diagonal)
            gain -= _f(n_left + left[u]) - _f(n_left) + _f(n_right + right[u]) - _f(n_right)
            gain[0] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            n[b] += r
            n[:, b] += l
            n[b, b] += itself
            n_left[b] += left[u]
            n_right[b] += right[u]
            if b != a:
                moved += 1
                own[u] = b
                forward[:, a] -= pairs[:, u]
                forward[:, b] += pairs[:, u]
                backward[:, a] -= pairs[u]
                backward[:, b] += pairs[u]
        if not moved:
            break
    return own


@dataclass
class Lexicon:
    """Which class each word is in: units and near words in arrays, the other words that moved in a table."""

    units: Units
    class_of: np.ndarray  # by unit
    near: np.ndarray  # sorted hashes of frequent words
    near_counts: np.ndarray
    near_classes: np.ndarray
    moved: DataFrame  # word, own (its unit's class), class: words that left their unit's class


@dataclass
class Model:
    lexicon: Lexicon
    transition: np.ndarray  # log10, left class x right class
    spread: np.ndarray  # log10 of each class's emission denominator
    tokens: int
    types: int
    rows: DataFrame | None = None  # of ``coded``, for all documents that ``fit`` was given


def _estimate(between: np.ndarray, class_types: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transitions and emission denominators of the classes, log10, from counts of class pairs and of words by class."""
    class_n = between.sum(axis=0)
    total, followers = between.sum(axis=1, keepdims=True), (between > 0).sum(axis=1, keepdims=True)
    prior = (class_n + 1) / (class_n.sum() + CLASSES)
    weight = np.maximum(followers, 1)
    return np.log10((between + weight * prior) / (total + weight)), np.log10(class_n + class_types + 1)


def contexts(training: DataFrame, units: Units, class_of: np.ndarray) -> DataFrame:
    """word, contexts for every word that is no unit itself: how often which class stands next to it.

    A context is a class to the right, CLASSES more for one to the left, or 2 * CLASSES for the same word to the right
    (which to the left is not counted again). A row has all contexts of a word in some texts, eight bytes each: the
    context, above it the class of the word's unit, and above that how often it occurs.
    """
    kinds = 2 * CLASSES + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches):
            words, endings, inverse, _ = _distinct(texts)
            unit = units.find(words, endings)
            own = class_of[unit]
            token = _tokens(texts, inverse, -1)
            classes = _tokens(texts, own[inverse], 0)
            at = np.flatnonzero(_tokens(texts, (unit >= len(units.words))[inverse], False))  # an end mark stands behind
            itself = token[at + 1] == token[at]
            right = np.where(itself, 2 * CLASSES, classes[at + 1])
            again = (at > 0) & (token[at - 1] == token[at])
            left = CLASSES + np.where(at > 0, classes[at - 1], 0)[~again]
            keys = np.concatenate([token[at] * kinds + right, token[at[~again]] * kinds + left])
            keys, times = np.unique(keys, return_counts=True)
            word, context = np.divmod(keys, kinds)
            entries = ((times * CLASSES + own[word]) * kinds + context).astype("<i8")
            first = np.flatnonzero(np.diff(word, prepend=-1))
            for a in range(0, len(first), HELD):
                at = np.append(first, len(keys))[a : a + HELD + 1]
                columns = [pa.array(words[word[at[:-1]]]), _binary(entries[at[0] : at[-1]].view(np.uint8), 8 * (at - at[0]))]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "contexts"])

    return _rows(training).mapInArrow(count, CONTEXTS)


def moves(contexts: DataFrame, transition: np.ndarray, spread: np.ndarray) -> DataFrame:
    """word, own, class of the words whose occurrences are likelier in another class than in their unit's."""
    kinds = 2 * CLASSES + 1
    # Log probability that an occurrence adds in each class, by context; an occurrence has one context to the right.
    gains = np.concatenate([transition.T - spread, transition, [transition.diagonal() - spread]])

    def chosen(words: np.ndarray, context: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        nth = np.cumsum(np.concatenate([[0], words[1:] != words[:-1]]))
        counts = np.bincount(nth * kinds + context % kinds, weights=n, minlength=len(first) * kinds).reshape(-1, kinds)
        each = counts @ gains
        each[:, 0] = -np.inf  # the end mark's
        own, best = context[first] // kinds, each.argmax(axis=1)
        rows = np.arange(len(first))
        kept = each[rows, best] > each[rows, own] + 1e-9
        columns = [pa.array(x[kept]) for x in (words[first], own.astype(np.int32), best.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["word", "own", "class"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last word's rows: more of them may follow
        for batch in batches:
            if not batch.num_rows:
                continue
            data, at = _bytes(batch["contexts"])
            n, context = np.divmod(data.view("<i8"), CLASSES * kinds)
            rows = [np.repeat(batch["word"].to_numpy(), np.diff(at) // 8), context, n]
            if held is not None:
                rows = [np.concatenate(pair) for pair in zip(held, rows, strict=True)]
            last = int(np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1]]))[-1])
            context, nth = np.unique(rows[1][last:], return_inverse=True)
            n = np.zeros(len(context), np.int64)
            np.add.at(n, nth, rows[2][last:])
            held = [np.repeat(rows[0][last:][:1], len(n)), context, n]
            if last:
                yield chosen(*(x[:last] for x in rows))
        if held is not None:
            yield chosen(*held)

    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(choose, MOVED)


def coded(documents: DataFrame, lexicon: Lexicon, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, logs (of the tokens' counts plus one), and the classes of all tokens, for every row.

    ``codes`` has a byte per token; ``moved`` lists other places of the text with the class that belongs there.
    """
    units, class_of = lexicon.units, lexicon.class_of
    near, near_counts, near_classes = lexicon.near, lexicon.near_counts, lexicon.near_classes

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        end = int(near_counts[near == END].sum())
        for ids, texts in _texts(batches):
            words, endings, inverse, _ = _distinct(texts)
            at = np.minimum(np.searchsorted(near, words), max(0, len(near) - 1))
            is_near = near[at] == words if len(near) else np.zeros(len(words), bool)
            n = np.where(is_near, near_counts[at], 0) if len(near) else np.zeros(len(words))
            classes = class_of[units.find(words, endings)]
            if len(near):
                classes = np.where(is_near, near_classes[at], classes)
            logs = np.concatenate([[0.0], np.cumsum(np.log10(n + 1)[inverse])])[texts.word_at]
            known = np.concatenate([[0], np.cumsum((n > 0)[inverse])])[texts.word_at]
            codes = _tokens(texts, classes.astype(np.uint8)[inverse], 0)
            stops = texts.word_at + np.arange(len(texts) + 1)

            rows = row + np.arange(len(texts))
            row += len(texts)
            blank, none = pa.nulls(len(texts), pa.int64()), pa.nulls(len(texts), pa.binary())
            first = [
                pa.array(rows), ids, pa.array(texts.word_counts + 1), pa.array(np.diff(known) + (end > 0)),
                pa.array(np.diff(logs) + np.log10(end + 1)), _binary(codes, stops), blank, none,
            ]
            # A text's words that need the tables, each once, with their places.
            far = np.flatnonzero(~is_near[inverse])
            keys = texts.word_text[far] * len(words) + inverse[far]
            order = np.argsort(keys, kind="stable")
            keys, far = keys[order], far[order]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
            text, word = np.divmod(keys[starts], max(1, len(words)))
            places = (far - texts.word_at[texts.word_text[far]]).astype("<i4")
            blank = pa.nulls(len(starts), pa.int64())
            second = [
                pa.array(rows[text]), blank, blank, blank, pa.nulls(len(starts), pa.float64()),
                pa.nulls(len(starts), pa.binary()), pa.array(words[word]),
                _binary(places.view(np.uint8), 4 * np.append(starts, len(keys))),
            ]
            names = [part.split()[0] for part in PARTS.split(", ")]
            for columns in (first, second):
                yield pa.RecordBatch.from_arrays(columns, names=names)

    parts = saved(_rows(documents).mapInArrow(read, PARTS), "coded")
    far = parts.where("word IS NOT NULL").select("row", "word", "places")
    far = far.join(counts.select("word", "n"), "word", "left").join(lexicon.moved.select("word", "class"), "word", "left")
    times = F.when(F.col("n").isNotNull(), F.octet_length("places") / 4)
    seen = far.groupBy("row").agg(
        F.sum(times.cast("long")).alias("more"), F.sum(times * F.log10(F.col("n") + 1.0)).alias("logs"),
        F.collect_list(F.when(F.col("class").isNotNull(), F.struct("places", "class"))).alias("moved"),
    )
    return parts.where("word IS NULL").join(seen, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("counts") + F.coalesce("logs", F.lit(0.0))).alias("logs"), "codes", "moved",
    )


def _binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """Byte strings that lie in a row, from where each begins and where the last ends."""
    buffers = [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, buffers)


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of byte strings in a row, and where each begins, and the end of the last."""
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    if not len(values) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def _classes(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all tokens of some rows of ``coded``, and where each text begins."""
    data, at = _bytes(rows["codes"])
    classes = data.copy()
    moved = rows["moved"]
    lengths = pc.fill_null(pc.list_value_length(moved), 0).to_numpy(zero_copy_only=False)
    places, to = moved.flatten().flatten()
    data, starts = _bytes(places)
    times = np.diff(starts) // 4
    text = np.repeat(at[:-1], lengths)
    classes[np.repeat(text, times) + data.view("<i4")] = np.repeat(to.to_numpy(), times)
    return classes, at[:-1]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for a, b in slices(batch["codes"]):
        yield batch.slice(a, b - a)


def class_pairs(rows: DataFrame) -> np.ndarray:
    """How often a class follows another in rows of ``coded``; a text's first token follows an end mark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for part in _parts(batch):
                classes, _ = _classes(part)
                left = np.concatenate([[0], classes[:-1]])
                found += np.bincount(left * CLASSES + classes, minlength=len(found))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], names=["pair", "n"])

    found = rows.select("codes", "moved").mapInArrow(count, PAIRS).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    between = np.zeros(CLASSES * CLASSES)
    between[found["pair"].to_numpy()] = found["n"].to_numpy()
    return between.reshape(CLASSES, CLASSES)


def fit(training: DataFrame, counts: DataFrame, documents: DataFrame | None = None, among: Column | None = None) -> Model:
    """The model, from the training texts and their saved word counts.

    If the training texts are those rows of ``documents`` for whose ``doc_id`` ``among`` holds, all documents get their
    classes here, and ``score`` need not read them again.
    """
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # What is clustered first does not depend on ``NEAR``, which only says whose counts travel with the tasks.
    clustered = counts.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    frequent = clustered["word"].to_numpy()
    # Endings of the words that are no units themselves: 65,536 at most.
    rest = counts.where("ending >= 0").groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).toArrow()
    ending_n, ending_types = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    ending_n[rest["ending"].to_numpy()] = rest["n"].to_numpy()
    ending_types[rest["ending"].to_numpy()] = rest["types"].to_numpy()
    np.subtract.at(ending_n, clustered["ending"].to_numpy(), clustered["n"].to_numpy())
    np.subtract.at(ending_types, clustered["ending"].to_numpy(), 1)
    endings = np.argsort(-ending_n, kind="stable")[:ENDINGS]
    units = Units.of(frequent, endings[ending_n[endings] > 0])

    found = pair_counts(training, units).toArrow()
    pairs = np.zeros(units.size * units.size)
    pairs[found["pair"].to_numpy()] = found["n"].to_numpy()
    pairs = pairs.reshape(units.size, units.size)
    class_of = exchange(pairs)

    unit_types = np.zeros(units.size, dtype=np.int64)
    unit_types[: len(units.words)] = 1
    np.add.at(unit_types, units.ending_unit, ending_types)
    unit_types[0] = int(n > 0)
    class_types = np.bincount(class_of, weights=unit_types, minlength=CLASSES)
    member = np.zeros((units.size, CLASSES))
    member[np.arange(units.size), class_of] = 1
    first = _estimate(member.T @ pairs @ member, class_types)

    # Every other word by its own neighbours.
    moved = saved(moves(contexts(training, units, class_of), *first), "moved")
    for r in moved.groupBy("own", "class").agg(F.count(F.lit(1)).alias("n")).collect():  # at most CLASSES ** 2 rows
        class_types[r["own"]] -= r["n"]
        class_types[r["class"]] += r["n"]
    top = counts.orderBy(F.desc("n"), "word").limit(NEAR).join(moved.select("word", "class"), "word", "left").toArrow()
    near, endings = top["word"].to_numpy(), np.maximum(top["ending"].to_numpy(), 0)
    own = pa.array(class_of[units.find(near, endings)].astype(np.int32))
    near_classes = pc.coalesce(top["class"].combine_chunks(), own).to_numpy()
    order = np.argsort(near)
    lexicon = Lexicon(units, class_of, near[order], top["n"].to_numpy()[order], near_classes[order], moved)
    rows = None if documents is None else saved(coded(documents, lexicon, counts), "classes")
    between = class_pairs(coded(training, lexicon, counts) if rows is None else rows.where(among))
    return Model(lexicon, *_estimate(between, class_types), int(n), int(v), rows)


def score(documents: DataFrame, counts: DataFrame, model: Model, rows: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score for every row; ``rows`` are the documents' of ``coded``, if known."""
    transition, spread = model.transition, model.spread

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                classes, first = _classes(part)
                steps = transition[np.concatenate([[0], classes[:-1]]), classes]
                sums = [pa.array(np.add.reduceat(x, first)) for x in (steps, spread[classes])]
                columns = [part[name] for name in ("doc_id", "n_tokens", "n_known", "logs")]
                yield pa.RecordBatch.from_arrays([*columns, *sums], names=[x.split()[0] for x in RATED.split(", ")])

    rated = (coded(documents, model.lexicon, counts) if rows is None else rows).mapInArrow(rate, RATED)
    each = float(np.log10(model.tokens + model.types + 1))
    return rated.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * each).alias("base_score"),
        (F.col("transitions") + F.col("logs") - F.col("spread")).alias("score"),
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    ship(spark)
    among = fold("doc_id", 7) != 2
    training = documents.where(among)
    counts = saved(word_counts(training), "counts")
    model = fit(training, counts, documents, among)
    found = score(documents, counts, model, model.rows)
    return found.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
