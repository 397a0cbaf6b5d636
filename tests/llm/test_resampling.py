"""Resampling against a plain version, the hash against its library, long texts against whole ones."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from aerostrata.llm import resampling as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def plain(docs, target):
    counts = [Counter(bucket(f) for t in texts for f in features(t)[1]) for texts in ([t for _, t in docs], target)]
    s_all, t_all = (sum(c.values()) for c in counts)
    out = []
    for i, text in docs:
        n, found = features(text)
        weight = 0
        for f in found:
            s, t = (c[bucket(f)] for c in counts)
            weight += math.floor(1000 * math.log((t + 1) * (s_all + 10_000) / ((s + 1) * (t_all + 10_000))))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, weight + noise, n >= 20])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: 5 * len(able) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in out]


VOCABULARY = ["tree", "Rain", "HÄUSER", "x1", "你好", "naïve", "o'clock", "a" * 40, "b-c", "😀", "the", "of"]
ODD = [None, "", " \n", "one", "one two", "A\tb\x00c", "é" * 50, "x" * 300 + " y", "under_score", "the the the"]


def corpus(rows, seed=1):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(VOCABULARY, k=rng.randrange(1, 80))) for _ in range(rows)]
    return [*enumerate(texts + ODD), (3, texts[3]), (None, texts[4])]


def test_equals_the_plain_version(documents, spark):
    docs = corpus(300)
    rng = random.Random(2)
    target = [" ".join(rng.choices(VOCABULARY[:6], k=30)) for _ in range(40)] + [None, ""]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    found = op.resample(documents(*docs).repartition(5), frame)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in found.dtypes} == {"bigint"}
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, plain(docs, target)))
    assert sum(r[4] is not None for r in plain(docs, target)) > 5


def test_empty_tables(documents, spark):
    none = documents((1, "a")).limit(0)
    assert op.resample(none, none).count() == 0
    docs = [(1, "a b c"), (2, None)]
    assert sorted(map(tuple, op.resample(documents(*docs), none).collect())) == sorted(plain(docs, []))


def test_hash_is_that_of_the_library():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    start, length = rng.integers(0, 4900, 2000), rng.integers(1, 90, 2000)
    length[:32] = np.arange(32)
    want = [xxhash.xxh64_intdigest(bytes(data[a : a + n])) for a, n in zip(start, length)]
    assert op.xxhash64(data, start, length).tolist() == want


def test_ngrams_share_a_slot_only_if_their_bytes_are_equal(monkeypatch):
    """With one key for all, every slot is told apart by its bytes alone."""
    monkeypatch.setattr(op, "xxhash64", lambda data, start, length: np.zeros(len(start), np.uint64))
    words = [b"a", b"ab", b"abcdefgh", b"abcdefgi", b"x" * 31, b"x" * 32, b"x" * 33, b"a", b"x" * 33, b"ab"]
    data = np.frombuffer(b"".join(words) + b"\0" * 8, np.uint8)
    length = np.array([len(w) for w in words])
    table = op.GramTable(data, np.cumsum(length) - length, length)
    by_word = {}
    for w, slot in zip(words, table.slots.tolist()):
        assert by_word.setdefault(w, slot) == slot
        assert table.buckets[slot] == zlib.crc32(w) % op.BUCKETS and table.counts[slot] == words.count(w)
    assert len(set(by_word.values())) == len(by_word)


def test_crc_of_texts_that_follow_each_other():
    rng = np.random.default_rng(5)
    pairs = [(rng.bytes(int(a)), rng.bytes(int(b))) for a, b in rng.integers(0, 300, (200, 2))]
    crcs = [np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1)]
    found = op.followed(*crcs, np.array([len(b) for _, b in pairs]))
    assert found.tolist() == [zlib.crc32(a + b) for a, b in pairs]


@pytest.mark.parametrize("size", [1, 7, 50])
def test_slices_of_a_long_text_give_what_it_gives_as_a_whole(monkeypatch, size):
    monkeypatch.setattr(op, "SLICE", size)
    text = " ".join(random.Random(4).choices(VOCABULARY, k=200))
    buckets, words = Counter(), 0
    for table, doc, found in op.interned(pa.array([text.encode()])):
        buckets.update(table.buckets[table.slots].tolist())
        words += int(found.sum())
        assert len(doc) == len(table.slots) and not doc.any()
    n, want = features(text)
    assert words == n and buckets == Counter(map(bucket, want))
