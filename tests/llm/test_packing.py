"""Packing against the tokenizer itself and exact coverage of the windows."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

from aerostrata.llm import packing as op

TEXTS = [
    None, "", " ", "Hello world, it's 12 o'clock!", "a ́b é Straße İ ΣΑΣ z\x1cq \x00x", "x<|endoftext|>y <|startoftext|>",
    "word " * 9000, "word " * 2046, "word " * 2047, "word " * 2048, "你好 мир", "...\"?!'S 'll",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(op.vocabulary_path())


def test_pieces_hold_every_id_once_and_windows_have_no_gap(documents, tokenizer):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choices(["tree", "Rain,", "häuser", "x1"], k=rng.randrange(1, 900))) for _ in range(80)]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "nobody")]
    found = op.pack_documents(documents(*rows), op.vocabulary_path()).collect()
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            part = ids[s : s + 2048]
            want.append((i, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)) for r in found)
    windows = {}
    for r in found:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(windows) == list(range(len(windows)))


def test_pieces_with_their_ids(documents, tokenizer):
    found = op.token_pieces(documents((1, "Hello world")), op.vocabulary_path(), with_ids=True).first()
    assert list(found.ids) == [*tokenizer.encode("Hello world", add_special_tokens=False).ids, 1]


def test_chunks_equal_the_tokenizer(tokenizer):
    rng = random.Random(2)
    letters = "abcdetinsz'.,!<|/w>0129 ÉéßÀ÷×_-\"ABC\n你ﬁ́"
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(4000)]
    coder = op.ChunkEncoder(open(op.vocabulary_path(), encoding="utf-8").read())
    assert coder.coder is not None
    plain = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(np.frombuffer(a, "<u4").tolist() == b.ids for a, b in zip(coder.encode([t.encode() for t in texts]), plain))


def test_ambiguous_merges_are_not_taken_for_unique():
    vocabulary = {f"s{i}": i for i in range(512)} | {"ab": 512, "bc": 513, "abc": 514}
    assert op.joins_are_unique(vocabulary, [("a", "b"), ("b", "c"), ("ab", "c")])
    assert not op.joins_are_unique(vocabulary, [("a", "b"), ("b", "c"), ("a", "bc")])


def test_fill_comes_closest():
    rng = random.Random(3)
    for _ in range(300):
        window = 64
        items = [rng.randint(1, 60) for _ in range(rng.randint(1, 9))]
        counts = {n: items.count(n) for n in items}
        first = max(items)
        rest = list(items)
        rest.remove(first)
        sums = {first + sum(c) for k in range(len(rest) + 1) for c in combinations(rest, k)}
        sums = {s for s in sums if s <= window}
        powers = [s for s in sums if s & (s - 1) == 0]
        found = op.fill(dict(counts), first, window)
        assert all(found[n] <= counts[n] for n in found) and found[first] >= 1
        assert sum(n * k for n, k in found.items()) == (max(powers) if window not in sums and powers else max(sums))


def test_plan_places_every_piece_and_pads_little():
    rng = np.random.default_rng(4)
    lengths, counts = np.unique(rng.integers(1, 2049, 30_000), return_counts=True)
    counts = dict(zip(lengths.tolist(), counts.tolist()))
    table = op.plan(dict(counts))
    windows = int(table[:, 3].max()) + 1
    assert windows <= 1.01 * sum(n * c for n, c in counts.items()) / 2048 + 2
    assert set(table[:, 0].tolist()) == set(counts)


def test_empty_table(documents):
    assert op.pack_documents(documents((1, "a")).limit(0), op.vocabulary_path()).count() == 0
