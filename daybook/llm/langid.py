"""Language identification by unigram pieces, summed over all segmentations.

The pieces are a fixed public vocabulary and every single byte. For each language learned, every piece has a
probability, fitted by expectation maximisation on a bounded sample of labelled rows: up to ``TRAIN_ROWS`` of each
language, so that rare ones are learned too; how frequent languages are is counted over all labelled rows. A word's
probability is the sum over all ways to cut it into pieces, from a forward pass over the whole word; a text's is the
product over its words, and the score is the language's posterior probability. A-Z count as a-z. Only fitting cuts
words longer than ``ROW`` bytes into rows of that length.

A text that is null or has no letter is ``und`` with score 0, and so is everything when no row is labelled. Ties go to the
language that comes first in order. Repeated rows are judged alike; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import fold, sample_by_label, ship, slices, table
from daybook.llm.text import U64, Texts

TRAIN_ROWS = 750  # of a language
ROUNDS = 4
ROW = 48
SEGMENT = 2048  # bytes of a longer word that are read at once
RESCALED = 16  # bytes after which its sums are brought back into range
SCALE = 30.0  # times this for every byte, so that products stay in range
NO_LANGUAGE = "und"

_KEY = U64(0xA24BAED4963EE407)


class Pieces:
    """Byte strings with numbers, found by hash from their first byte on."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {bytes([b]) for b in range(256)}
        for i in range(model.GetPieceSize()):
            if not (model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i)):
                found.add(model.IdToPiece(i).replace("▁", " ").encode())
        # A word has a space before it and none inside, so no other piece can be part of one.
        self.names = sorted(p for p in found if p and b" " not in p[1:])
        self.longest = max(map(len, self.names))
        self.scales = np.array([SCALE ** len(p) for p in self.names] + [0.0])
        # Every beginning of a piece, with the piece's number where it is one itself.
        number = {p: i for i, p in enumerate(self.names)}
        beginnings = sorted({p[:k] for p in self.names for k in range(1, len(p) + 1)})
        keys = np.array([self._key(p) for p in beginnings], dtype=U64)
        values = np.array([number.get(p, len(self.names)) for p in beginnings], dtype=np.int32)
        # Beginnings whose place in the first table is taken are in the next; the tables are checked to suffice.
        self.tables = []
        left = np.arange(len(keys))
        for bits, factor in ((20, 0xD1342543DE82EF95), (18, 0x9FB21C651E98DF25), (16, 0xC2B2AE3D27D4EB4F), (16, 0xA0761D6478BD642F)):
            places = self._place(keys[left], bits, factor)
            _, first = np.unique(places, return_index=True)
            slot_key, slot_id = np.zeros(1 << bits, U64), np.full(1 << bits, -1, np.int32)
            slot_key[places[first]] = keys[left[first]]
            slot_id[places[first]] = values[left[first]]
            self.tables.append((bits, factor, slot_key, slot_id))
            left = np.delete(left, first)
            if not len(left):
                break
        assert not len(left)

    def __len__(self) -> int:
        return len(self.names)

    @staticmethod
    def _key(piece: bytes) -> int:
        key = 0
        for b in piece:
            key = (key * int(_KEY) + b + 1) % (1 << 64)
        return key

    @staticmethod
    def _place(keys: np.ndarray, bits: int, factor: int) -> np.ndarray:
        return ((keys * U64(factor)) >> U64(64 - bits)).astype(np.int64)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key's piece; the number of pieces for a mere beginning of one, -1 for anything else."""
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        for bits, factor, slot_key, slot_id in self.tables:
            place = self._place(keys[open_], bits, factor)
            hit = slot_key[place] == keys[open_]
            out[open_[hit]] = slot_id[place[hit]]
            open_ = open_[~hit]
        return out

    def at(self, rows: np.ndarray, lengths: np.ndarray, places: int | None = None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The pieces that begin at the first ``places`` places of the rows, by length: bounds by place, rows, numbers."""
        width = rows.shape[1]
        place, row = np.nonzero(np.arange(width if places is None else places)[:, None] < lengths)
        key = np.zeros(len(place), dtype=U64)
        out = []
        for size in range(1, self.longest + 1):
            inside = place + size <= lengths[row]
            place, row, key = place[inside], row[inside], key[inside]
            key = key * _KEY + rows[row, place + size - 1].astype(U64) + U64(1)
            ids = self.lookup(key)
            alive, whole = ids >= 0, (ids >= 0) & (ids < len(self))
            out.append((np.searchsorted(place[whole], np.arange(width + 1)), row[whole], ids[whole]))
            place, row, key = place[alive], row[alive], key[alive]
            if not len(place):
                break
        return out


def forward(pieces: list[tuple], width: int, n: int, p: np.ndarray) -> np.ndarray:
    """Scaled probability of the first j bytes of every row, for all j: places x rows x languages."""
    alpha = np.zeros((width + 1, n, p.shape[1]))
    alpha[0] = 1
    for i in range(width):
        for size, (bounds, row, ids) in enumerate(pieces, start=1):
            a, b = bounds[i], bounds[i + 1]
            if a < b:
                alpha[i + size, row[a:b]] += alpha[i, row[a:b]] * p[ids[a:b]]
    return alpha


def expected(pieces: list[tuple], lengths: np.ndarray, weights: np.ndarray, p: np.ndarray) -> np.ndarray:
    """How often each piece is expected in rows that occur ``weights`` times; ``p`` has one column."""
    n, width = len(lengths), int(lengths.max(initial=0))
    alpha = forward(pieces, width, n, p)[:, :, 0]
    rows = np.arange(n)
    beta = np.zeros((width + 1, n))
    beta[lengths, rows] = 1
    for i in range(width - 1, -1, -1):
        for size, (bounds, row, ids) in enumerate(pieces, start=1):
            a, b = bounds[i], bounds[i + 1]
            if a < b:
                beta[i, row[a:b]] += p[ids[a:b], 0] * beta[i + size, row[a:b]]
    total = np.maximum(alpha[lengths, rows], 1e-300)
    out = np.zeros(len(p))
    for size, (bounds, row, ids) in enumerate(pieces, start=1):
        place = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        share = alpha[place, row] * p[ids, 0] * beta[place + size, row] * (weights / total)[row]
        out += np.bincount(ids, weights=share, minlength=len(p))
    return out


@dataclass
class Rows:
    """Distinct words laid out in rows for fitting; a long word has several."""

    word: np.ndarray
    start: np.ndarray
    length: np.ndarray
    leads: np.ndarray

    @staticmethod
    def of(starts: np.ndarray, ends: np.ndarray) -> Rows:
        counts = -(-(ends - starts) // ROW)
        word = np.repeat(np.arange(len(starts)), counts)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = starts[word] + nth * ROW
        return Rows(word, start, np.minimum(ends[word] - start, ROW), nth == 0)

    def groups(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of about equal length: which, their bytes with the space before a word, their lengths."""
        lengths = self.length + self.leads
        low = 0
        for high in (4, 8, 12, 16, 24, ROW + 1):
            every = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            for rows in np.array_split(every, -(-len(every) // 20_000)) if len(every) else []:
                at = (self.start[rows] - self.leads[rows])[:, None] + np.arange(high)
                block = data[np.clip(at, 0, len(data) - 1)]
                block[self.leads[rows], 0] = 0x20
                yield rows, block, lengths[rows]


@dataclass
class Languages:
    names: list[str]
    prior: np.ndarray
    p: np.ndarray  # pieces x languages, scaled; the last row is no piece

    def words(self, vocabulary: Pieces, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(starts), len(self.names)))
        short = np.flatnonzero(ends - starts <= ROW)
        rows = Rows.of(starts[short], ends[short])
        for which, block, lengths in rows.groups(texts.data):
            n = len(which)
            alpha = forward(vocabulary.at(block, lengths), block.shape[1], n, self.p)
            out[short[which]] = np.log(np.maximum(alpha[lengths, np.arange(n)], 1e-300)) - lengths[:, None] * np.log(SCALE)
        long = np.flatnonzero(ends - starts > ROW)
        # Words of like length together, so many that a segment of them is about a megabyte.
        long = long[np.argsort(ends[long] - starts[long], kind="stable")]
        for part in np.array_split(long, -(-len(long) // 256)) if len(long) else []:
            out[part] = self._long_words(vocabulary, texts.data, starts[part], ends[part])
        return out

    def _long_words(self, vocabulary: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The same sums segment by segment: what a segment's pieces reach beyond its end is carried over."""
        lengths, reach = ends - starts + 1, vocabulary.longest
        out = np.zeros((len(starts), len(self.names)))
        logs = np.zeros_like(out)
        carried = np.zeros((reach, *out.shape))
        carried[0] = 1
        for low in range(0, int(lengths.max()) + 1, SEGMENT):
            at = (starts - 1)[:, None] + low + np.arange(SEGMENT + reach)
            block = data[np.clip(at, 0, len(data) - 1)]
            if low == 0:
                block[:, 0] = 0x20
            left = np.clip(lengths - low, 0, SEGMENT + reach)
            pieces = vocabulary.at(block, left, SEGMENT)
            alpha = np.zeros((SEGMENT + reach, *out.shape))
            alpha[:reach] = carried
            for i in range(SEGMENT):
                ended = np.flatnonzero(lengths == low + i)
                out[ended] = np.log(np.maximum(alpha[i, ended], 1e-300)) + logs[ended]
                for size, (bounds, row, ids) in enumerate(pieces, start=1):
                    a, b = bounds[i], bounds[i + 1]
                    if a < b:
                        alpha[i + size, row[a:b]] += alpha[i, row[a:b]] * self.p[ids[a:b]]
                if i % RESCALED == RESCALED - 1:
                    ahead = alpha[i + 1 : i + 1 + reach]
                    most = ahead.max(axis=0)
                    most[most == 0] = 1
                    ahead /= most
                    logs += np.log(most)
            carried = alpha[SEGMENT:]
        return out - lengths[:, None] * np.log(SCALE)

    def score(self, vocabulary: Pieces, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Number of the likeliest language of each text, and its posterior probability."""
        starts, ends = texts.spans
        _, first, inverse = np.unique(texts.word_hashes, return_index=True, return_inverse=True)
        logs = self.words(vocabulary, texts, starts[first], ends[first])
        totals = np.zeros((len(texts), len(self.names)))
        for k in range(len(self.names)):
            sums = np.concatenate([[0.0], np.cumsum(logs[:, k][inverse])])
            totals[:, k] = np.diff(sums[texts.word_at]) + self.prior[k]
        best = totals.argmax(axis=1)
        odds = np.exp(totals - totals.max(axis=1, keepdims=True))
        return best, 1 / odds.sum(axis=1)


_vocabularies: dict[str, Pieces] = {}


def vocabulary(path: str) -> Pieces:
    if path not in _vocabularies:
        _vocabularies[path] = Pieces(path)
    return _vocabularies[path]


def train(sample: pa.Table, path: str, counts: dict[str, int] | None = None) -> Languages:
    """Fit on rows of (text, label); ``counts`` has how many rows there are of each language, else the sample's count."""
    known = vocabulary(path)
    labels = sample["label"].to_pylist()
    names = sorted(set(labels))
    counts = counts or {name: labels.count(name) for name in names}
    columns, prior = [], []
    for name in names:
        picked = np.flatnonzero([x == name for x in labels])
        part = sample["text"].combine_chunks().take(pa.array(picked))
        texts = Texts.of(part, 0, len(part)).lowered()
        starts, ends = texts.spans
        _, first, times = np.unique(texts.word_hashes, return_index=True, return_counts=True)
        rows = Rows.of(starts[first], ends[first])
        laid_out = [(known.at(block, n), n, times[rows.word[which]]) for which, block, n in rows.groups(texts.data)]
        p = np.full(len(known) + 1, 1 / len(known))
        for _ in range(ROUNDS):
            scaled = (p * known.scales)[:, None]
            found = np.full(len(known) + 1, 0.01)
            for ids, n, weight in laid_out:
                found += expected(ids, n, weight, scaled)
            found[-1] = 0
            p = found / found.sum()
        columns.append(p * known.scales)
        prior.append(np.log(counts[name] / sum(counts[x] for x in names)))
    return Languages(names, np.array(prior), np.stack(columns, axis=1) if columns else np.zeros((len(known) + 1, 0)))


def identify(documents: DataFrame, model: Languages, path: str) -> DataFrame:
    """doc_id, language and score for every row."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        names = np.array([*model.names, NO_LANGUAGE], dtype=object)
        for batch in batches:
            lettered = pc.fill_null(pc.match_substring_regex(batch["text"], r"\p{L}"), False).to_numpy(zero_copy_only=False)
            for a, b in slices(batch["text"], 1 << 22):
                best, score = np.full(b - a, len(model.names)), np.zeros(b - a)
                if model.names:
                    best, score = model.score(known, Texts.of(batch["text"], a, b).lowered())
                best, score = np.where(lettered[a:b], best, len(model.names)), np.where(lettered[a:b], score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a), pa.array(names[best], pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"],
                )

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(rate, "doc_id long, lang_pred string, score double")


def fit(documents: DataFrame, path: str, limit: int = TRAIN_ROWS) -> Languages:
    """The languages of the training folds, from up to ``limit`` rows of each; counts are those of all rows."""
    known = documents.where((fold("doc_id", 4) != 2) & F.col("text").isNotNull())
    known = known.select("doc_id", F.col("lang").cast("string").alias("label"))
    sample, counts = sample_by_label(documents, known, limit)
    return train(sample, path, counts)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    documents = table(spark, sf_dir, "documents")
    found = identify(documents, fit(documents, path), path)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
