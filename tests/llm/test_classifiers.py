"""Held-out accuracy, plain versions of the scores, and defined results of odd rows."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest
import xxhash
import zstandard

from aerostrata.llm import language, quality, toxicity
from aerostrata.llm.logistic import fit_logistic, fit_sparse, sigmoid

WORDS = {
    "en": ["the", "thing", "with", "would", "there", "nation", "house", "being"],
    "de": ["der", "schön", "nicht", "straße", "haus", "gegen", "über", "werden"],
    "es": ["el", "niño", "mañana", "casa", "donde", "según", "corazón", "ella"],
}
ODD = [None, "", "12 34 !!", "x", "wort " * 40_000]


def out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0


def sentence(rng, lang="en", n=25):
    return " ".join(rng.choices(WORDS[lang], k=n))


@pytest.fixture(scope="module")
def rng():
    return random.Random(7)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, text string")


def test_language_of_held_out_texts(documents, rng):
    rows = [(i, sentence(rng, lang, 8), lang) for i, lang in enumerate(rng.choices(list(WORDS), k=300))]
    odd = [(1000 + i, t, "en" if i % 2 else None) for i, t in enumerate(ODD)] + [(None, "straße nicht", None), (3, *rows[3][1:])]
    docs = documents(*[(i, t, lang) for i, t, lang in rows + odd])
    found = language.identify(docs, language.learn(docs)).collect()
    assert len(found) == len(rows) + len(odd)
    lang = {i: x for i, _, x in rows}
    held = [r for r in found if r.doc_id in lang and r.held_out]
    assert held and all(r.lang_pred == lang[r.doc_id] for r in held)
    assert all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 for r in found)
    pred = {r.doc_id: r.lang_pred for r in found}
    assert [pred[1000], pred[1001], pred[1002]] == ["und"] * 3 and pred[None] == "de" and pred[1003] != "und"


def plain_trigrams(text):
    plain = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    plain = f" {' '.join(plain.split())} "
    return [plain[k : k + 3] for k in range(len(plain) - 2 if plain.strip() else 0)]


def test_trigrams_equal_a_plain_version():
    texts = ["Straße, 12 nicht!", "", "a", "the thing", "ÀÉ x"]
    grams = language.Trigrams(texts)
    assert grams.has_letter.tolist() == [True, False, True, True, True]
    found = [[] for _ in texts]
    for doc, codes in zip(grams.doc, grams.codes(grams.gram)):
        found[doc].append("".join(map(chr, codes)))
    assert found == [plain_trigrams(t) for t in texts]
    vector = language.bind(np.array([[97, 98, 99]]), 64, 1)[0]
    a, b, c = (language.letter_vector(x, 64, 1) for x in (97, 98, 99))
    assert (vector == np.roll(a, 2) * np.roll(b, 1) * c).all()


@pytest.mark.parametrize("table", [1 << 22, 10])
def test_languages_equal_those_by_cosine(documents, monkeypatch, rng, table):
    """Prototypes, cosines and scores again, one trigram at a time; with a small table by slices of vectors."""
    monkeypatch.setattr(language, "TABLE", table)
    monkeypatch.setattr(language, "VECTORS", 7 if table == 10 else 1 << 13)
    rows = [(i, sentence(rng, lang, 4), lang) for i, lang in enumerate(rng.choices(list(WORDS), k=25))]
    rows += [(100, None, "en"), (101, "12", "de"), (102, "ñ", None), (103, "你好", "zh"), (108, "你", "zh")]
    docs = documents(*rows)
    known = {}

    def vector(gram):
        if gram not in known:
            a, b, c = (language.letter_vector(ord(x), language.DIMENSIONS, language.SEED).astype(float) for x in gram)
            known[gram] = np.roll(a, 2) * np.roll(b, 1) * c
        return known[gram]

    bundle = lambda text: sum(map(vector, plain_trigrams(text)), np.zeros(language.DIMENSIONS))
    prototypes = {}
    for i, text, lang in rows:
        if not out(i) and lang and plain_trigrams(text):
            prototypes[lang] = prototypes.get(lang, 0) + bundle(text) / len(plain_trigrams(text))
    langs = sorted(prototypes)
    unit = np.array([prototypes[x] / np.linalg.norm(prototypes[x]) for x in langs])
    for r in language.identify(docs, language.learn(docs)).collect():
        text = next(t for i, t, _ in rows if i == r.doc_id)
        if not plain_trigrams(text):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        cosine = unit @ bundle(text) / np.linalg.norm(bundle(text))
        share = np.exp((cosine - cosine.max()) / language.TEMPERATURE)
        assert r.lang_pred == langs[cosine.argmax()] and abs(r.score - 1 / share.sum()) < 1e-4


def test_many_texts_of_many_letters_need_little_memory():
    texts = ["".join(chr(0x4E00 + (k * 33 + j) % 20_000) for j in range(33)) for k in range(4000)]
    identifier = language.Identifier(["x"], np.ones((1, language.DIMENSIONS)))
    tracemalloc.start()
    langs, _ = identifier(texts)
    assert set(langs) == {"x"} and tracemalloc.get_traced_memory()[1] < 250 << 20
    tracemalloc.stop()


def test_language_without_labels_or_rows(documents):
    docs = documents((1, "a b c"), (2, "d"))
    nothing = language.learn(docs.where("doc_id < 0"))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), nothing).count() == 0


def test_texts_without_a_letter_go(documents):
    docs = documents((1, "the thing"), (2, "12"), (3, None), (4, "der"), (6, "there"))
    for identifier in (language.learn(docs), language.learn(docs.where("doc_id < 0"))):
        kept = language.keep_identified(docs, identifier)
        assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [1, 4, 6]


def quality_rows(rng, n=400):
    good = [(i, sentence(rng, n=40).capitalize() + ".", 1) for i in range(0, n, 2)]
    bad = [(i, " | ".join(sentence(rng, n=40).upper().split()) + "!!", 0) for i in range(1, n, 2)]
    return good + bad


def test_quality_of_held_out_texts(spark, documents, rng):
    rows = quality_rows(rng)
    odd = [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "x"), (3, "Y")]
    labels = labels_of(spark, [(i, y, 0, "k") for i, _, y in rows] + [(0, 1, 0, ""), (7, None, 0, ""), (None, 1, 0, "")])
    docs = documents(*[(i, t) for i, t, _ in rows], *odd)
    found = quality.score(docs, quality.learn(docs, labels)).collect()
    truth = {i: y for i, _, y in rows if i != 3}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert len(found) == len(rows) + len(odd)


def test_quality_scores_equal_a_plain_version(spark, documents, rng):
    """Dictionaries, sizes, curve and scores of all documents again, from the library's own calls."""
    rows = quality_rows(rng, 300) + [(900, None, None), (901, "", None), (902, "the thing with " * 700, None)]
    docs = documents(*[(i, t) for i, t, _ in rows])
    labels = labels_of(spark, [(i, y, 0, "") for i, _, y in rows])
    found = {r.doc_id: r.score for r in quality.score(docs, quality.learn(docs, labels)).collect()}

    def signed(text):
        h = xxhash.xxh64_intdigest(text, seed=42)
        return h - (1 << 64) if h >> 63 else h

    known = sorted(((t.encode(), y) for i, t, y in rows if y is not None and not out(i)), key=lambda r: signed(r[0]))
    cut = lambda t: [t[k : k + 2048] for k in range(0, len(t), 2048)]
    trained = []
    for v in (1, 0):
        samples = [b for k, (t, y) in enumerate(known) if k % 2 == 0 and y == v for b in cut(t)]
        try:
            raw = zstandard.train_dictionary(64 << 10, samples).as_bytes()
        except zstandard.ZstdError:
            raw = b"".join(samples)[-(64 << 10) :]
        trained.append(zstandard.ZstdCompressionDict(raw))
    options = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}

    def size(block, dictionary):
        more = {} if dictionary is None else {"dict_data": dictionary}
        return len(zstandard.ZstdCompressor(**more, **options).compress(block))

    def of(text):
        if not text:
            return np.zeros(6)
        good, bad, plain = (np.array([size(b, d) for b in cut(text)], float) for d in (*trained, None))
        x = [(bad.sum() - good.sum()) / plain.sum(), min((bad - good) / plain), plain.sum() / len(text), np.log1p(len(text))]
        return np.array([*x, x[0] ** 2, x[1] ** 2])

    y = np.array([v for _, v in known][1::2])
    share = np.mean([v for _, v in known])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = fit_logistic(np.array([of(t) for t, _ in known][1::2]), y, weight)
    for i, t, _ in rows:
        assert abs(found[i] - sigmoid(of((t or "").encode()) @ w[:-1] + w[-1])) < 1e-6


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels_of_both_classes(spark, documents, module):
    docs = documents((1, "a"), (2, None))
    none = module.learn(docs, labels_of(spark, []))
    assert [round(r.score, 6) for r in module.score(docs, none).collect()] == [0.5, 0.5]
    one = module.learn(docs, labels_of(spark, [(1, 1, 1, ""), (2, 1, 1, "")]))
    assert all(r.score > 0.9 for r in module.score(docs, one).collect())
    assert module.score(docs.limit(0), one).count() == 0


def test_long_texts_are_read_to_their_end():
    plain = ("the thing with nation " * 3000).encode()
    shouted = plain[: len(plain) // 2] + (b"THE !! THING !! " * 5000)
    texts = [b"the thing with nation being there " * 20] * 30, [b"THE !! THING !! WITH !! NATION !! " * 20] * 30
    dictionaries = tuple(quality.train_dictionary(t) for t in texts)
    a, b = quality.features([plain, shouted], dictionaries)
    assert a[0] > b[0]
    model = toxicity.ToxicityModel({"idiot": 9.0}, -4.0)
    assert model(["word " * 50_000 + "idiot"])[0] > 0.9 > model(["word " * 50_000])[0]


def toxic_rows(rng, n=400):
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = rng.choices(WORDS["en"], k=30) + ["stupid" if i % 8 else "idiots"] * toxic
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_of_held_out_texts(spark, documents, rng):
    rows = toxic_rows(rng)
    docs = documents(*[(i, t) for i, t, _ in rows], *[(1000 + i, t) for i, t in enumerate(ODD)], (None, "x"))
    labels = labels_of(spark, [(i, 1, y, "") for i, _, y in rows])
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs, model).collect()
    truth = {i: y for i, _, y in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 for r in found)
    assert not any(r.predicted for r in found if r.doc_id is None or r.doc_id >= 1000)
    kept = toxicity.keep_harmless(docs, model)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in found if not r.predicted)


def test_naming_a_group_is_no_sign_of_toxicity(rng):
    texts, y = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = rng.choices(WORDS["en"], k=12)
        if toxic:
            words += ["muslims"] * (rng.random() < 0.9) + [rng.choice(["scum", "trash", "moron", "vermin"])] * (rng.random() < 0.8)
        texts.append(" ".join(words))
        y.append(int(toxic))
    y = np.array(y)
    free = toxicity.fit(texts, y, y.mean(), penalty=0.0)
    fair = toxicity.fit(texts, y, y.mean())
    neutral = ["there would being muslims with the house", "there would being christians with the house"]
    assert free(neutral)[0] > 0.5 > fair(neutral)[0]
    assert abs(fair(neutral)[0] - fair(neutral)[1]) < 0.05
    assert (fair(["the house with scum", "the house with trash vermin"]) > 0.5).all()


def test_logistic_fit_finds_the_minimum():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 3))
    y = (rng.random(500) < sigmoid(x @ [2.0, -1.0, 0.0] + 0.5)).astype(float)
    w = fit_logistic(x, y, np.ones(500), ridge=1e-6)
    p = sigmoid(x @ w[:-1] + w[-1])
    assert np.abs(x.T @ (p - y)).max() < 0.5 and abs((p - y).sum()) < 0.5


def test_sparse_fit_equals_the_dense_one():
    rng = np.random.default_rng(2)
    x = (rng.random((300, 12)) < 0.3).astype(float)
    y = (rng.random(300) < sigmoid(3 * x[:, 0] - 2 * x[:, 1])).astype(float)
    changed = np.array([np.eye(12)[i % 3] - np.eye(12)[3 + i % 2] for i in range(20)])
    pairs = [(np.flatnonzero(c > 0), np.flatnonzero(c < 0)) for c in changed]
    dense = fit_logistic(x, y, np.ones(300), changed=changed, penalty=10.0)
    sparse = fit_sparse([np.flatnonzero(r) for r in x], 12, y, np.ones(300), changed=pairs, penalty=10.0)
    assert np.abs(dense - sparse).max() < 1e-3


def test_features_are_counted_over_all_labelled_rows_and_not_capped(spark, documents):
    own = lambda i: "".join(chr(97 + int(d)) for d in str(i))  # a word that makes every text another one
    rows = [(i, f"plain common house {own(i)} {'insult' + chr(97 + i // 10 % 26) * 9 if i % 2 else 'tree'}", i % 2) for i in range(1, 3000)]
    docs, labels = documents(*[(i, t) for i, t, _ in rows]), labels_of(spark, [(i, 1, y, "") for i, _, y in rows])
    known = [(t, y) for i, t, y in rows if not out(i)]
    texts, y = [t for t, _ in known], np.array([y for _, y in known])
    candidates = toxicity.select_features(texts, y, toxicity.LEAST_SAMPLED, toxicity.LEANING)
    found = toxicity.telling_features(docs, labels, candidates, "doc_id", "text", "toxic")
    assert found == toxicity.select_features(texts, y)
    assert {f"insult{chr(97 + k) * 9}" for k in range(26)} <= set(found)
    model = toxicity.learn(docs, labels, sample=500)
    assert model(["plain common house tree"])[0] < 0.5 and set(found) <= model.weights.keys()


def test_toxicity_scores_equal_a_plain_version(spark, documents, rng):
    """Features, weights and scores of all documents again, by dense rows and loops."""
    rows = [(i, f"{t} {rng.choice(['muslims', 'christians', 'nobody'])}", y) for i, t, y in toxic_rows(rng)]
    docs = documents(*[(i, t) for i, t, _ in rows], (5000, None), (5001, "stupid"))
    labels = labels_of(spark, [(i, 1, y, "") for i, _, y in rows])
    found = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}

    def of(text):
        words = {w for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()}
        ends = [w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) >= n] + ["*" + w[-5:] for w in words if len(w) >= 5]
        return words | set(ends)

    known = list({(t, y) for i, t, y in rows if not out(i)})
    n = [sum(y == v for _, y in known) for v in (0, 1)]
    labelled = [(t, y) for i, t, y in rows if not out(i)]
    total = [sum(y == v for _, y in labelled) for v in (0, 1)]
    features = []
    for f in sorted(set().union(*[of(t) for t, _ in known])):
        def square(texts, n, least):
            a, b = (sum(f in of(t) for t, y in texts if y == v) for v in (1, 0))
            both, all_of = a + b, n[0] + n[1]
            return 0 if both < least else all_of * (a * (n[0] - b) - b * (n[1] - a)) ** 2 / (both * (all_of - both + 1e-9) * n[0] * n[1])
        if square(known, n, 3) > 2.71 and square(labelled, total, 5) > 19.51:
            features.append(f)
    terms = {t for g in toxicity.IDENTITY_TERMS for t in g}
    named = [t for t, _ in known if of(t) & terms]
    features += sorted({f for t in named for w in of(t) & terms for f in of(w)} - set(features))
    row = lambda words: np.array([float(f in words) for f in features])
    x, y = np.array([row(of(t)) for t, _ in known]), np.array([y for _, y in known])
    changed = []
    for t in named:
        words = {w for w in of(t) if "*" not in w}
        for group in toxicity.IDENTITY_TERMS:
            for term in words & set(group):
                changed += [row(of(" ".join(words - {term} | {other}))) - row(of(t)) for other in group if other != term]
    share = total[1] / sum(total)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = fit_logistic(x, y, weight, changed=np.array(changed), penalty=toxicity.PENALTY)
    for i, t in [(i, t) for i, t, _ in rows] + [(5000, None), (5001, "stupid")]:
        assert abs(found[i] - sigmoid(row(of(t)) @ w[:-1] + w[-1])) < 1e-3


def test_a_text_that_does_not_fit_ends_no_sample(spark, documents, monkeypatch):
    from aerostrata.llm import logistic

    monkeypatch.setattr(logistic, "SAMPLE_CHARS", 2000)
    rows = [(i, f"x{i} " * (2000 if i % 3 == 0 else 5)) for i in range(1, 90)] + [(1000 + i, "copy") for i in range(60)]
    labels = labels_of(spark, [(i, 1, i % 2, "") for i, _ in rows])
    texts, y, share = logistic.labelled_sample(documents(*rows), labels, "doc_id", "text", "toxic", 30)
    short = {t.encode() for i, t in rows if not out(i) and len(t) < 100}
    for v in (0, 1):
        of = [t for t, label in zip(texts, y) if label == v]
        assert len(of) == len(set(of)) and sum(map(len, of)) <= 2000
        assert {t for t in short if t in {t.encode() for i, t in rows if i % 2 == v and not out(i)}} == set(of)
