"""Periodic runs, personal data and importance resampling against plain versions, and samples that stay bounded."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import cnn, common, importance, periodic, pii
from daybook.llm.crc import BLOCK, crc32
from daybook.llm.queries import QUERIES
from daybook.llm.text import Texts
from tests.llm.samples import SF, WORD, documents, given, labels, lower, texts

pytest.importorskip("public_tokenizers")


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


# ---- periodic runs -----------------------------------------------------------------------------------


def plain_runs(words):
    """All runs by definition: every period, every stretch in which words a period apart agree."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_periodic(doc_id, text, plant):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def test_runs_of_random_words():
    rng = random.Random(11)
    for _ in range(300):
        docs = []
        for _ in range(rng.randrange(1, 5)):
            few = rng.choice([1, 2, 2, 3, 40])
            words = [rng.randrange(few) for _ in range(rng.randrange(60))]
            if rng.random() < 0.7:
                block = [rng.randrange(few) for _ in range(rng.randrange(1, 9))]
                words += block * rng.randrange(2, 9) + block[: rng.randrange(len(block))] + [rng.randrange(few)] * rng.randrange(4)
            docs.append(words)
        at = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        got = periodic.find_runs(np.array(sum(docs, []), dtype=np.int64), at)
        assert got.tolist() == [[int(a) + s, n, p] for a, d in zip(at, docs) for s, n, p in plain_runs(d)]


def test_extensions_equal_plain_ones():
    rng = random.Random(3)
    for few in (1, 2, 30):
        words = np.array([rng.randrange(few) for _ in range(200)] + [7, 8, 9] * 40 + [5] * 60)
        levels = periodic.grammar(words)
        assert len(levels[-1].symbol) == 1
        pairs = [sorted(rng.sample(range(len(words)), 2)) for _ in range(400)]
        x, y = np.array(pairs).T
        for forward in (True, False):
            got = periodic.extension(levels, x, y, forward)
            for a, b, n in zip(x, y, got):
                k = 0
                if forward:
                    while b + k < len(words) and words[a + k] == words[b + k]:
                        k += 1
                else:
                    while a - k > 0 and words[a - k - 1] == words[b - k - 1]:
                        k += 1
                assert n == k


def test_periodic_equal_plain_version(spark):
    # The same rows as the query, given tables and odd ones; long runs of one word take the grammar's blocks.
    odd = [*texts(), (20, "ha " * 5000), (21, "a b " * 3 + "a"), (22, "x x x x x x y y y y y"), (23, "p q r " * 9 + "p p p p p p")]
    found = periodic.digest(periodic.detect(documents(spark, odd)))
    assert rows_of(found) == sorted((plain_periodic(i, t, False) for i, t in odd), key=str)
    docs = given(spark, "documents")
    expected = [plain_periodic(r.doc_id, r.text, True) for r in docs.collect()]
    assert any(r[1] for r in expected)
    assert rows_of(QUERIES["op11_periodic_runs"](spark, SF)) == sorted(expected, key=str)
    planted = periodic.digest(periodic.detect(periodic.with_planted_runs(documents(spark, odd))))
    assert rows_of(planted) == sorted((plain_periodic(i, t, True) for i, t in odd), key=str)
    assert periodic.detect(documents(spark, [])).count() == 0


def test_periodic_long_texts_in_time():
    for words in (np.zeros(200_000, np.int64), np.arange(200_000) % 5000, np.arange(200_000) % 7):
        started = time.monotonic()
        runs = periodic.find_runs(words, np.array([0, len(words)]))
        assert len(runs) == 1 and runs[0, 1] == len(words)
        assert time.monotonic() - started < 60


# ---- personal data -----------------------------------------------------------------------------------

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def plain_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")))
                or (kind == "card" and 12 <= len(digits) <= 19 and plain_luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            ):
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


ODD = [
    "a@b.co_x@c.de and é@x.y, x@y.z.@q.r a@b@c.de @d.e a@-.- a.b@c..d",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3.4444 99999.1.2.3.4 .1.2.3.4. 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 4111  1111 1111 1111 0000000000000 79927398713",
    "+1 (017) 555-7713 ++49 30 1234567 +1234567890123456 +12) +1.. 5 +4 (0)-",
    "日本 a@b.co 日本 4111 1111 1111 1111",
]


def test_base_spans_equal_plain_ones(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice("a1.@-+ ()_%9é:") for _ in range(rng.randrange(120))) for _ in range(3000)]
    made += ["".join(rng.choice("0123456789 -") for _ in range(rng.randrange(60))) for _ in range(2000)]
    for text in [*ODD, *made]:
        assert [f"{s.kind}:{s.start}:{s.end}" for s in pii.find(text)[0]] == plain_base(text), text
    rows = [*texts(), *((100 + i, t) for i, t in enumerate(ODD))]
    found = {str(r.doc_id) + r.base_sha256: r for r in pii.digest(pii.detect(documents(spark, rows))).collect()}
    for i, text in rows:
        spans = plain_base(text)
        r = found[str(i) + hashlib.sha256(",".join(spans).encode()).hexdigest()]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in spans) for k in PLAIN]
        assert set(spans) <= set(r.spans.split(","))
    docs = {r.doc_id: r.text for r in given(spark, "documents").collect()}
    for r in QUERIES["op12_pii"](spark, SF).collect():
        assert r.spans == ",".join(plain_base(docs[r.doc_id])), r.doc_id  # the given texts hold base kinds only
    assert pii.detect(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("Pay to DE89 3704 0044 0532 0130 00 today", ["iban"]),
        ("Pay to DE89370400440532013000.", ["iban"]),
        ("Pay to DE88 3704 0044 0532 0130 00 today", []),
        ("GB82 WEST 1234 5698 7654 32 THEN MORE WORDS", ["iban"]),
        ("ssn 123-45-6789", ["ssn"]),
        ("part 123-45-6789", []),
        ("code 123-45-6789 here", []),
        ("call 202-555-0143 now", ["tel"]),
        ("about 202-555-0143 items", []),
        ("call about invoice 202-555-0143 now", ["tel"]),
        ("born 1984-02-17 in", ["birth"]),
        ("on 1984-02-17 in", []),
        ("née le 17/02/1984", ["birth"]),
        ("host 2001:db8:0:0:0:ff00:42:8329 up", ["ip6"]),
        ("at 12:30:45 sharp", []),
        ("device 00:1B:44:11:3A:B7 seen", ["mac"]),
        ("ssn and tel +1 (202) 555-0143", []),  # inside a base span
        ("recall 202-555-0143 now", []),  # a word counts whole
    ],
)
def test_added_spans(text, kinds):
    assert [s.kind for s in pii.find(text)[1]] == kinds


def test_validators():
    assert pii.luhn("79927398713") and not pii.luhn("79927398710")
    account = "DE89370400440532013000"
    assert pii.mod97(account) and not pii.mod97(account[:-1]) and not pii.mod97("XX" + account[2:])
    assert sum(pii.mod97(account[:10] + d + account[11:]) for d in "0123456789") == 1


def test_pii_long_texts_in_time():
    size = 1 << 20
    for text in (
        "a" * size, "a@" * (size // 2), "1" * size, "1." * (size // 2), "+1" * (size // 2), "1-" * (size // 2), "AB12" * (size // 4),
        "a.b-" * (size // 4) + "@", "+1" + "(" * size, "ab:" * (size // 3), "202-555-" * (size // 8), "x@y." * (size // 4),
    ):
        started = time.monotonic()
        pii.find(text)
        assert time.monotonic() - started < 30, text[:20]


def test_masked_rows(spark):
    rows = [(1, "mail a@b.co or +1 (017) 555-7713"), (2, None), (3, "nothing"), (4, "")]
    frame = documents(spark, rows)
    got = pii.masked(frame)
    assert got.columns == frame.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "mail [EMAIL] or [PHONE]", 2: None, 3: "nothing", 4: ""}
    assert all(not any(pii.find(pii.mask(t))) for t in ODD[2:])


# ---- importance resampling ---------------------------------------------------------------------------


def test_crc_equals_zlib():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 20_000).astype(np.uint8)
    lengths = np.concatenate([np.arange(40), [BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK, 2 * BLOCK + 1, 5000], rng.integers(0, 900, 300)])
    starts = rng.integers(0, 10_000, len(lengths))
    got = crc32(data, starts, starts + lengths)
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, lengths)]


WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text, least=1, most=1):
    words = WORDS.findall(lower(text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def test_features_of_longer_runs():
    some = [t for _, t in texts()] + ["a" * 300 + " b", "A-b_c.D9é ß"]
    batch = Texts.of(pa.array(some), 0, len(some)).lowered()
    buckets, owners, words = importance.features(batch, 1, 3)
    got = [Counter(buckets[owners == i].tolist()) for i in range(len(some))]
    expected = [plain_features(t, 1, 3) for t in some]
    assert got == [Counter(b) for _, b in expected] and words.tolist() == [n for n, _ in expected]


def plain_resampling(rows, target):
    s, t = Counter(), Counter()
    for counts, all_texts in ((s, [x for _, x in rows]), (t, target)):
        for text in all_texts:
            counts.update(plain_features(text)[1])
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * t_all**-1 * s_all / (s[b] + 1))) for b in range(10_000)}
    out = []
    for i, text in rows:
        words, buckets = plain_features(text)
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, words, len(buckets), weight, score, None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * 10 // 100], 1):
        r[5] = rank
    return sorted((tuple(r) for r in out), key=str)


def test_resampling_equals_plain_version(spark):
    benchmark = given(spark, "benchmark")
    target = [r.text for r in benchmark.collect()]
    # Repeated ids and a third of all rows with none: equal scores, of which some are drawn.
    rows = [*texts(), *[(None, "one two three " * 9)] * 60, *[(77, "four five six " * 8)] * 40, *[(200 + i, f"w{i} " * 30) for i in range(80)]]
    assert rows_of(importance.resample(documents(spark, rows), benchmark)) == plain_resampling(rows, target)
    empty = documents(spark, [])
    assert importance.resample(empty, benchmark).count() == 0
    none = importance.resample(documents(spark, rows[:5]), benchmark.limit(0)).collect()
    assert [r["rank"] for r in none] == [None] * 5


# ---- network and samples -----------------------------------------------------------------------------


def plain_score(net, text):
    """The network by definition, one window and one chunk at a time."""
    data = list((text or "").encode())
    strides = max(1, -(-len(data) // cnn.STRIDE))
    padded = data + [cnn.PAD] * (strides * cnn.STRIDE - len(data))
    peaks = np.full((strides, cnn.FILTERS), -np.inf)
    for i in range(len(padded) - cnn.WIDTH + 1):
        response = sum(net.filters[k, padded[i + k]] for k in range(cnn.WIDTH))
        peaks[i // cnn.STRIDE] = np.maximum(peaks[i // cnn.STRIDE], response)
    peaks = np.maximum(peaks + net.bias, 0)
    chunks = [np.maximum(peaks[i], peaks[min(i + 1, strides - 1)]) for i in range(strides)]
    described = np.concatenate([np.max(chunks, axis=0), np.mean(chunks, axis=0)])
    return 1 / (1 + math.exp(-(described @ net.weights + net.intercept)))


def test_network_equals_plain_pass_however_texts_are_dealt(spark):
    net = cnn.Network.fresh(5)
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abc #$é") for _ in range(n))) for i, n in enumerate((0, 1, 3, 4, 5, 251, 252, 255, 256, 257, 511, 512, 1500))]
    rows.append((99, None))
    expected = {i: plain_score(net, t) for i, t in rows}
    for order, parts in ((rows, 1), (rows[::-1], 1), (rows, 5)):
        got = {r.doc_id: r.score for r in cnn.score(documents(spark, order).repartition(parts), net).collect()}
        assert got.keys() == expected.keys()
        assert all(abs(got[i] - expected[i]) < 1e-5 for i in got)


def test_samples_are_bounded_by_rows(spark):
    rows = documents(spark, [(1, f"text {i}") for i in range(3000)] + [(i, "other") for i in range(2, 40)])
    marks = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, label int")
    for limit in (1, 10, 39):
        sample = common.labelled_sample(rows, marks, limit)
        assert sample.num_rows == limit and len(set(sample["doc_id"].to_pylist())) == limit
    assert common.labelled_sample(rows, marks.limit(0), 10).num_rows == 0
    assert labels(spark).count()
