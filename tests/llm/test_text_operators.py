"""Operators that judge one text at a time, against plain versions."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import brown, cnn, langid, packing, rules
from tests.llm.samples import WORD, documents, given, labels, lower, texts

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def same_ids(rows):
    return sorted((str(r[0]) for r in rows)) == sorted(str(i) for i, _ in texts())


def test_rule_counts_equal_plain_ones(spark):
    found = rules.judge(documents(spark), rules.fit(documents(spark), labels(spark))).collect()
    assert same_ids(found)

    def plain(text):
        text = text or ""
        words = WORD.findall(text)
        seen, repeated_lines = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                repeated_lines += line in seen
                seen.add(line)
        runs = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        inside = {k + j for k in range(len(words) - 7) if runs[tuple(words[k : k + 8])] > 1 for j in range(8)}
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        return len(words), sum(map(len, words)), symbols, repeated_lines, len(inside), failed

    key = lambda x: (x[0] is None, x)
    got = [(r["doc_id"], *r[1:7]) for r in found]
    assert sorted(got, key=key) == sorted(((i, *plain(t)) for i, t in texts()), key=key)
    assert all(not r["kept"] for r in found if r["base_failed"])


@pytest.mark.parametrize("module", [rules, cnn])
def test_quality_models_hold_out(spark, module):
    docs, marks = given(spark, "documents"), given(spark, "labels")
    model = module.fit(docs, marks)
    scored = rules.judge(docs, model) if module is rules else cnn.classify(docs, model)
    both = scored.join(marks, "doc_id").collect()
    column = "kept" if module is rules else "predicted"
    good = [r[column] for r in both if r["quality"] == 1 and not (module is rules and r["base_failed"])]
    assert np.mean(good) > 0.95
    assert all(0 <= r["score"] <= 1 for r in both)


def test_quality_models_without_rows(spark):
    empty = documents(spark, [])
    for module in (rules, cnn):
        model = module.fit(empty, labels(spark).limit(0))
        assert (rules.judge(empty, model) if module is rules else cnn.classify(empty, model)).count() == 0
    assert {r["score"] for r in cnn.score(documents(spark), cnn.fit(documents(spark), labels(spark).limit(0))).collect()} == {0.5}


def test_network_covers_whole_text(spark):
    """A response anywhere in a long text reaches its description, and chunks do not mix texts."""
    import pyarrow as pa

    from daybook.llm.text import Texts

    net = cnn.Network.fresh()
    long, short = "a" * 5000 + "###$$$" + "a" * 5000, "b" * 10
    alone = [net.describe(Texts.of(pa.array([t]), 0, 1))[2][0] for t in (long, short)]
    _, _, together = net.describe(Texts.of(pa.array([long, short, None]), 0, 3))
    assert np.allclose(together[:2], alone)
    assert not np.allclose(together[0], net.describe(Texts.of(pa.array(["a" * 10_006]), 0, 1))[2][0])


def test_network_gradients_match_differences():
    import pyarrow as pa

    from daybook.llm.text import Texts

    rng = np.random.default_rng(1)
    batch = Texts.of(pa.array(["".join(map(chr, rng.integers(97, 122, n))) for n in (900, 30, 2000)]), 0, 3)
    y, w = np.array([1, 0, 1], np.float32), np.full(3, 1 / 3, np.float32)
    net = cnn.Network.fresh(3)

    def loss():
        p = np.clip(net.score(batch), 1e-9, 1 - 1e-9)
        return float(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())

    gradients = cnn._step(net, batch, y, w)
    for parameter, gradient in ((net.weights, gradients[2]), (net.bias, gradients[1])):
        for i in range(4):
            parameter[i] += 1e-2
            up = loss()
            parameter[i] -= 2e-2
            down = loss()
            parameter[i] += 1e-2
            assert abs((up - down) / 2e-2 - gradient[i]) < 2e-2


def test_language_edges(spark):
    docs = documents(spark)
    model = langid.fit(docs, PIECES)
    found = langid.identify(docs, model, PIECES).collect()
    assert same_ids(found)
    no_letter = {i for i, t in texts() if not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in found if r["lang_pred"] == "und"} == no_letter
    assert all(0 <= r["score"] <= 1 for r in found)
    nothing = langid.fit(docs.limit(0), PIECES)
    assert {r["lang_pred"] for r in langid.identify(docs, nothing, PIECES).collect()} == {"und"}


def test_forward_sums_all_segmentations(monkeypatch):
    """Against a plain sum over all pieces of any length; words run over the ends of segments and characters."""
    import pyarrow as pa

    from daybook.llm.text import Texts

    monkeypatch.setattr(langid, "SEGMENT", 64)
    known = langid.vocabulary(PIECES)
    assert known.longest > 10
    rng = np.random.default_rng(5)
    p = rng.random((len(known) + 1, 2)) / len(known)
    p[-1] = 0
    p[:, 1] /= 50  # far less likely, yet not lost
    model = langid.Languages(["x", "y"], np.zeros(2), p * known.scales[:, None])
    number = {piece: i for i, piece in enumerate(known.names)}

    def total(word, column):
        ways = [1.0] + [0.0] * len(word)
        for j in range(1, len(word) + 1):
            ways[j] = sum(ways[i] * p[number[word[i:j]], column] for i in range(j) if word[i:j] in number)
        return math.log(ways[-1])

    def scaled_total(word, column):
        """The same with the sums of a window brought back into range."""
        window, logs = {0: 1.0}, 0.0
        for j in range(1, len(word) + 1):
            window[j] = sum(w * p[number[word[i:j]], column] for i, w in window.items() if word[i:j] in number)
            window = {i: w for i, w in window.items() if i > j - known.longest}
            most = max(window.values())
            window = {i: w / most for i, w in window.items()}
            logs += math.log(most)
        return math.log(window[len(word)]) + logs

    words = ["the", "straße", "x", "internationally", "日本", "日本語" * 30, "understanding" * 9, "z" * 47, "z" * 48, "z" * 49, "é" * 400, "responsibilities" * 20]
    batch = Texts.of(pa.array([" ".join(words)]), 0, 1)
    got = model.words(known, batch, *batch.spans)
    for column in (0, 1):
        assert np.allclose(got[:, column], [scaled_total(b" " + w.encode(), column) for w in words], rtol=1e-9)
        assert np.allclose(got[:5, column], [total(b" " + w.encode(), column) for w in words[:5]])


def test_rare_languages_and_scripts_are_learned(spark):
    rng = np.random.default_rng(1)
    letters = {"en": "etaoinshr", "ja": "あいうえおかきく", "el": "αβγδεζηθ"}

    def text(lang):
        return " ".join("".join(rng.choice(list(letters[lang]), rng.integers(2, 9))) for _ in range(12))

    langs = ["en"] * 4000 + ["ja"] * 12 + ["el"] * 12
    rows = spark.createDataFrame([(i, text(x), x) for i, x in enumerate(langs)], "doc_id long, text string, lang string")
    model = langid.fit(rows, PIECES, limit=50)
    assert model.names == ["el", "en", "ja"]
    assert model.prior[1] > math.log(0.98)  # from all rows, not from the sample
    found = langid.identify(rows, model, PIECES).join(rows.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["lang"] == r["lang_pred"] for r in found)


def test_language_accuracy(spark):
    docs = given(spark, "documents")
    found = langid.identify(docs, langid.fit(docs, PIECES), PIECES).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97


def test_class_model_counts_and_base(spark):
    docs = documents(spark)
    counts = brown.saved(brown.word_counts(docs.where("doc_id IS NULL OR doc_id % 2 = 0")), "t")
    model = brown.fit(docs.where("doc_id IS NULL OR doc_id % 2 = 0"), counts)
    found = brown.score(docs, counts, model).collect()
    assert same_ids(found)
    tokens = [(i, [*WORD.findall(lower(t or "")), None]) for i, t in texts()]
    c = Counter(w for i, own in tokens for w in own if i is None or i % 2 == 0)
    n, v = sum(c.values()), len(c)
    expected = {
        (i, len(own), sum(c[w] > 0 for w in own), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own), 6))
        for i, own in tokens
    }
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found} == expected
    # Transitions and, within each class, emissions are probabilities.
    assert np.allclose((10**model.transition).sum(axis=1), 1)


def test_class_model_far_words_and_no_training(spark, monkeypatch):
    docs = given(spark, "documents").limit(60)
    counts = brown.saved(brown.word_counts(docs), "t")
    whole = {r["doc_id"]: r for r in brown.score(docs, counts, brown.fit(docs, counts)).collect()}
    monkeypatch.setattr(brown, "NEAR", brown.HEAD)  # most words' counts are joined then
    for r in brown.score(docs, counts, brown.fit(docs, counts)).collect():
        assert abs(r["score"] - whole[r["doc_id"]]["score"]) < 1e-6 and r["n_known"] == r["n_tokens"]
    assert sum(r["score"] for r in whole.values()) > sum(r["base_score"] for r in whole.values())
    none = docs.limit(0)
    empty = brown.saved(brown.word_counts(none), "t")
    assert {r["n_known"] for r in brown.score(docs, empty, brown.fit(none, empty)).collect()} == {0}
    assert brown.score(none, counts, brown.fit(docs, counts)).count() == 0


def word_hash(word):
    return int(brown.Texts.of(pa.array([lower(word)]), 0, 1).word_hashes.view(np.int64)[0])


def test_rare_words_have_classes_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 30)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"{'ab'[k % 2]}{rng.integers(15)}" for k in range(20))) for i in range(300)]
    # Two words of equal ending and count, one always in the place of an a, the other in that of a b.
    rows += [(400 + i, f"a{i} b{i} ouzz b{i + 1} a3") for i in range(6)] + [(500 + i, f"b{i} a{i} inzz a{i + 1} b3") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = brown.saved(brown.word_counts(docs), "t")
    model = brown.fit(docs, counts)
    asked = spark.createDataFrame([(1, "a1 b1 ouzz b2"), (2, "a1 b1 inzz b2"), (3, "b1 a1 inzz a2"), (4, "b1 a1 ouzz a2")], docs.schema)
    found = {r["doc_id"]: r["score"] for r in brown.score(asked, counts, model).collect()}
    assert found[1] > found[2] + 0.5 and found[3] > found[4] + 0.5  # equal before, when both had their ending's class


def test_classes_equal_a_plain_model(spark, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 40)
    docs = documents(spark)
    tokens = [[lower(w) for w in WORD.findall(t or "")] for _, t in texts()]
    counts = brown.saved(brown.word_counts(docs), "t")
    lexicon = brown.fit(docs, counts).lexicon
    units, kinds = lexicon.units, brown.CLASSES
    vocabulary = {w: (word_hash(w), (w.encode()[-2] if len(w.encode()) > 1 else 0) * 256 + w.encode()[-1]) for own in tokens for w in own}
    unit = {w: int(units.find(np.array([h]), np.array([e]))[0]) for w, (h, e) in vocabulary.items()}
    first = {w: int(lexicon.class_of[u]) for w, u in unit.items()}
    # Moves: every word that is no unit, by all of its own pairs.
    rng = np.random.default_rng(1)
    transition, spread = -rng.random((kinds, kinds)), rng.random(kinds)
    gains = {w: np.zeros(kinds) for w, u in unit.items() if u >= len(units.words)}
    for own in tokens:
        for k, w in enumerate(own):
            if w not in gains:
                continue
            before, after = own[k - 1] if k else None, own[k + 1] if k + 1 < len(own) else None
            gains[w] -= spread
            gains[w] += transition.diagonal() if after == w else transition[:, first.get(after, 0)]
            if before != w:
                gains[w] += transition[first.get(before, 0)]
    expected = {}
    for w, gain in gains.items():
        gain[0] = -np.inf
        if gain.max() > gain[first[w]] + 1e-9:
            expected[vocabulary[w][0]] = (first[w], int(gain.argmax()))
    assert len(gains) > 100 and expected
    for parts in (1, 7):  # a word's rows may lie on both sides of a batch's end
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50" if parts == 7 else "10000")
        found = brown.moves(brown.contexts(docs.repartition(parts), units, lexicon.class_of), transition, spread).collect()
        assert len(found) == len(expected) and {r["word"]: (r["own"], r["class"]) for r in found} == expected
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # Class pairs and codes: with the classes that words moved to, wherever those are looked up.
    moved = {r["word"]: r["class"] for r in lexicon.moved.collect()}
    final = {w: moved.get(h, first[w]) for w, (h, _) in vocabulary.items()}
    plain = np.zeros((kinds, kinds))
    for own in tokens:
        classes = [0, *(final[w] for w in own), 0]
        np.add.at(plain, (classes[:-1], classes[1:]), 1)
    assert moved and (brown.class_pairs(brown.coded(docs, lexicon, counts)) == plain).all()
    monkeypatch.setattr(brown, "NEAR", 40)
    assert (brown.class_pairs(brown.coded(docs, brown.fit(docs, counts).lexicon, counts)) == plain).all()


def test_class_model_sums_before_it_shuffles(spark, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 20)
    rng = np.random.default_rng(5)
    words = [[f"{'xyz'[w % 3]}{w}q" for w in rng.zipf(1.3, 40) % 200] for _ in range(60)] + [["r1q"] * 5, []]
    docs = spark.createDataFrame([(i, " ".join(own)) for i, own in enumerate(words)], "doc_id long, text string")
    counts = brown.saved(brown.word_counts(docs), "t")
    units = brown.Units.of(counts.where(F.col("word") != brown.END).orderBy(F.desc("n"), "word").limit(20).toArrow()["word"].to_numpy(), np.array([]).astype(int))
    class_of = 1 + np.arange(units.size) % (brown.CLASSES - 1)
    class_of[0] = 0
    hashes = {w: word_hash(w) for own in words for w in own}
    unit = {w: int(units.find(np.array([h]), np.array([0]))[0]) for w, h in hashes.items()}
    own_class = {w: int(class_of[u]) for w, u in unit.items()}
    pairs, near = Counter(), {h: Counter() for w, h in hashes.items() if unit[w] == units.size - 1}
    for own in words:
        at = [0, *(unit[w] for w in own), 0]
        pairs.update(a * units.size + b for a, b in zip(at, at[1:]))
        for k, w in enumerate(own):
            if hashes[w] in near:
                before, after = own[k - 1] if k else None, own[k + 1] if k + 1 < len(own) else None
                near[hashes[w]][2 * brown.CLASSES if after == w else own_class.get(after, 0)] += 1
                if before != w:
                    near[hashes[w]][brown.CLASSES + own_class.get(before, 0)] += 1

    def contexts(rows):
        found = {h: Counter() for h in near}
        for r in rows:
            for entry in np.frombuffer(r["contexts"], "<i8").tolist():
                n, packed = divmod(entry, brown.CLASSES * (2 * brown.CLASSES + 1))
                assert packed // (2 * brown.CLASSES + 1) == class_of[-1]
                found[r["word"]][packed % (2 * brown.CLASSES + 1)] += n
        return found

    rows = brown.contexts(docs.coalesce(1), units, class_of).collect()
    assert len(rows) == len(near) > 50 and contexts(rows) == near  # several rows a word before
    expected = {**{hashes[w]: n for w, n in Counter(w for own in words for w in own).items()}, brown.END: len(words)}
    transition, spread = -rng.random((brown.CLASSES, brown.CLASSES)), rng.random(brown.CLASSES)
    moved = sorted(brown.moves(brown.contexts(docs, units, class_of), transition, spread).collect())
    assert moved
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # a word's rows fill more than a batch
    for held in (7, 1 << 20):
        monkeypatch.setattr(brown, "HELD", held)
        some = docs.repartition(7)
        assert {r["word"]: r["n"] for r in brown.word_counts(some).collect()} == expected
        assert {r["pair"]: r["n"] for r in brown.pair_counts(some, units).collect()} == pairs
        found = brown.contexts(some, units, class_of)
        assert contexts(found.collect()) == near
        assert sorted(brown.moves(found, transition, spread).collect()) == moved
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_class_model_reads_classes_of_each_text_once(spark, monkeypatch, tmp_path):
    rows = [(i, " ".join(f"{'ab'[k % 2]}{(i * k) % 17}" for k in range(20))) for i in range(60)]
    rows += [(7, "a1 b1"), (7, "a1 b1"), (None, "b3 a4"), (90, None), (91, "")]  # 7 is held out or not with all its rows
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = brown.table(spark, str(tmp_path), "documents")
    training = docs.where(brown.fold("doc_id", 7) != 2)
    assert 0 < training.count() < len(rows)
    counts = brown.saved(brown.word_counts(training), "t")
    apart = brown.score(docs, counts, brown.fit(training, counts)).collect()
    calls, coded = [], brown.coded
    monkeypatch.setattr(brown, "coded", lambda *given: (calls.append(given), coded(*given))[1])
    found = brown.op4_lm_scoring(spark, str(tmp_path))
    plain = lambda r: (str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
    assert sorted(map(plain, found.collect())) == sorted(map(plain, apart)) and len(apart) == len(rows)
    assert len(calls) == 1  # training texts were read a second time before


def test_exchange_finds_alternating_classes():
    pairs = np.zeros((9, 9))
    rng = np.random.default_rng(0)
    for a in range(1, 5):
        for b in range(5, 9):
            pairs[a, b], pairs[b, a] = rng.integers(5, 50, 2)
    own = brown.exchange(pairs, classes=3)
    assert len(set(own[1:5])) == 1 and len(set(own[5:])) == 1 and own[1] != own[5]


def test_encoder_keeps_no_texts_and_cuts_long_ones(monkeypatch):
    import tracemalloc

    from tokenizers import Tokenizer

    tokenizer, own = Tokenizer.from_file(BPE), packing.Encoder(BPE)
    own.ids("first")
    tracemalloc.start()
    for k in range(20):
        own.ids(" ".join(f"word{i}" for i in range(1000 * k, 1000 * k + 1000)))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 200_000  # 2.3 MB before, when a worker kept every chunk
    for stretch in (1, 7, 100, 1 << 16):
        monkeypatch.setattr(packing, "STRETCH", stretch)
        for _, text in [*texts(), (0, "a  b   c \n d\t e  "), (0, " <|endoftext|> x  <|endoftext|>  y "), (0, "  "), (0, " x")]:
            expected = tokenizer.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(own.ids(text or ""), "<u4").tolist() == expected


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    found = packing.pack(documents(spark), BPE).collect()
    own = {}
    for i, text in texts():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own.setdefault(i, []).append(ids)
    for i, versions in own.items():
        parts = sorted((r for r in found if r["doc_id"] == i), key=lambda r: r["piece"])
        assert sum(r["length"] for r in parts) == sum(map(len, versions))
        for r in parts:
            raw = [np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes() for ids in versions]
            assert r["ids_crc32"] in {zlib.crc32(x) for x in raw}
            assert r["length"] == 2048 or r["piece"] == 0
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == list(np.cumsum([0, *(n for _, n in places[:-1])]))
        assert sum(n for _, n in places) <= 2048
    assert packing.pack(documents(spark, []), BPE).count() == 0


def test_packing_plan_is_tight_and_whole():
    rng = np.random.default_rng(2)
    for counts in (
        Counter(int(x) for x in rng.integers(1, 2049, 5000)), Counter(int(x) for x in rng.lognormal(5, 1.2, 5000) if x < 2048),
        {2048: 7}, {1500: 10}, {1: 5000}, {},
    ):
        counts = Counter({k: v for k, v in counts.items() if k > 0})
        bins = packing.plan(counts)
        used = Counter()
        for kind, n in bins:
            assert sum(kind) <= 2048 and n > 0
            for length in kind:
                used[length] += n
        assert used == counts
        least = max(-(-sum(k * v for k, v in counts.items()) // 2048), sum(v for k, v in counts.items() if k > 1024))
        assert sum(n for _, n in bins) <= 1.02 * least + 2
