"""Fill-in-middle against a plain version, chunks and cuts against whole texts."""

import hashlib
import random

import numpy as np
import pytest

from aerostrata.llm import fill_middle as op


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(i, text):
    t, n = text or "", len(text or "")
    digest = sha(f"1:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (i, n, "plain", None, None, t)
    p, m, s = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return (i, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (i, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def texts(rows, seed=1):
    rng = random.Random(seed)
    letters = "ab<>PSM é你😀\n\0"
    passage = "".join(rng.choices(letters, k=3000)).replace("<P>", "").replace("<S>", "").replace("<M>", "")
    found = ["".join(rng.choices(letters, k=rng.choice([0, 1, 2, 5, 60, 500, 5000]))) for _ in range(rows)]
    found += [passage[k:] + "end" for k in range(0, 60, 7)] + ["<P", "a<S>b", "<", "x" * 9000, "é" * 9000, None, ""]
    return found + ["a" * k + "<M>" + "b" * 100 for k in range(4090, 4099)]


def test_equals_the_plain_version(documents):
    rows = [*enumerate(texts(150)), (None, "nobody's text"), (3, "twice"), (3, "twice")]
    found = op.fill_in_middle(documents(*rows).repartition(3)).select("*", op.restored(op.F.col("output"), op.F.col("form")).alias("back"))
    want = sorted(map(str, (plain(i, t) + (t or "",) for i, t in rows)))
    assert sorted(map(str, map(tuple, found.collect()))) == want
    assert {plain(i, t)[2] for i, t in rows} == {"plain", "psm", "spm"}


def test_empty_table(documents):
    assert op.fill_in_middle(documents((1, "a")).limit(0)).count() == 0


def test_chunks_cover_a_text_and_are_bounded(monkeypatch):
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 4096, 4097, 300_000):
        text = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        ends = op.chunk_ends(text)
        sizes = np.diff([0, *ends])
        assert (ends[-1] if ends else 0) == n and all(sizes > 0) and all(sizes <= op.MOST) and all(sizes[:-1] >= op.LEAST)
        monkeypatch.setattr(op, "BLOCK", 1000)
        assert op.chunk_ends(text) == ends
        monkeypatch.undo()


def test_shared_passages_give_shared_chunks():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 128, 50_000, dtype=np.uint8).tobytes()
    cache = op.ChunkCache()
    for k in range(5):
        op.transform(b"x" * (37 * k) + passage, (1, 2, 3, 4), cache)
    assert cache.hits > 0.75 * (cache.hits + cache.misses)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED", 100)
    cache = op.ChunkCache()
    for i, t in enumerate(texts(40)):
        want = plain(i, t)
        h = tuple(int(sha(f"1:{i}")[8 * k : 8 * k + 8], 16) for k in range(4))
        assert op.transform((t or "").encode(), h, cache) == (*want[1:5], want[5].encode())


@pytest.mark.parametrize("form", ["plain", "psm", "spm"])
def test_restored_with_brackets_beside_the_cuts(spark, form):
    p, s, m = "a<", "S>b<P", "M>c<"
    text = {"plain": "a<P", "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    row = spark.createDataFrame([(text, form)], "output string, form string").select(op.restored(op.F.col("output"), op.F.col("form")))
    assert row.first()[0] == ("a<P" if form == "plain" else p + m + s)
