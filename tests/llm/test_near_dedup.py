"""Near duplicates against all pairs of full shingle sets."""

import random
import re

import numpy as np
import pytest

from aerostrata.llm import near_dedup as op
from aerostrata.llm import shingles as sh


def plain_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def plain_components(rows):
    sets = [plain_set(t) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]) and part[i] != part[j]:
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    out = []
    for (i, _), p, s in zip(rows, part, sets):
        ids = [rows[k][0] for k in range(len(rows)) if part[k] == p]
        out.append((i, len(s), min(ids)))
    return sorted(out)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows, doc = [], 0
    passage = [f"p{i}" for i in range(60)]
    for base in range(14):
        words = [f"b{base}x{rng.randrange(400)}" for _ in range(rng.choice([6, 30, 150, 600]))]
        words += passage * (base % 3 == 0)
        for edits in (0, 0, 1, 2, 4, 8, 12, 20):
            rows.append((doc := doc + 1, edited(rng, words, edits)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "ONE  two"), (905, "one two x"), (906, "é É a b c"),
             (907, "É É a b c"), (908, "wort " * 30_000), (909, "wort " * 29_000), (903, "one two")]
    return rows


def test_components(documents, corpus):
    found = op.near_components(documents(*corpus)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == plain_components(corpus)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_blocks_and_rounds_lose_nothing(documents, corpus, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 3)
    monkeypatch.setattr(op, "SET_BLOCK", 2)
    monkeypatch.setattr(op, "CANDIDATES", 0)
    found = op.near_components(documents(*corpus)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == plain_components(corpus)


def test_one_document_of_each_group_stays(documents, corpus):
    docs = documents(*corpus)
    kept = op.keep_representatives(docs)
    assert kept.schema == docs.schema
    want = {c for _, n, c in plain_components(corpus) if n} | {900, 901, 902}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_null_identifiers_and_empty_table(documents):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "a b c d e f g"), (4, "a b c d e f g"), (None, "x y"), (None, None), (9, long + " end"), (None, long)]
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in op.near_components(documents(*rows)).collect()}
    assert found == {(None, 3, 4), (4, 3, 4), (None, 1, None), (None, 0, None), (9, 57, 9), (None, 56, 9)}
    assert op.near_components(documents((1, "a")).limit(0)).count() == 0


def test_components_are_told_apart_without_their_identifiers(documents):
    words = [[f"{k}w{i}" for i in range(60)] for k in range(5)]
    text = [" ".join(w) for w in words]
    rows = [(7, text[0]), (7, text[1]), (7, "lone words"), (7, "other words"), (8, text[0] + " end"), (8, text[1] + " end"),
            (None, text[2]), (None, text[2] + " end"), (None, text[3]), (3, text[3] + " end"), (None, text[4]), (None, "")]
    kept = [(r.doc_id, r.text) for r in op.keep_representatives(documents(*rows)).collect()]
    assert sum(t in (text[2], text[2] + " end") for _, t in kept) == 1
    kept = {r for r in kept if not r[1].startswith("2w")}
    assert kept == {*rows[:4], rows[9], rows[10], rows[11]}


def test_pair_chunks_cover_all_pairs():
    seen = [(a, b) for u, v in op.pair_chunks(3, 9) for a, b in zip(u.tolist(), v.tolist())]
    assert seen == [(a, b) for a in range(3, 12) for b in range(a + 1, 12)]


def test_shingle_sets_do_not_depend_on_the_batch():
    texts = [b"a b c d e f", b"", b"x", b"A b\tc d e  f g h", b" lead and trail "]
    together = sh.shingle_sets(texts)
    assert all((a == sh.shingle_sets([t])[0]).all() for a, t in zip(together, texts))
    assert [len(s) for s in together] == [2, 0, 1, 4, 1]


def test_registers_keep_the_smallest_hash_of_a_bucket():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    found = sh.registers(hashes)
    for bucket in range(sh.BUCKETS):
        mine = [int(h) for h in hashes if int(h) >> 57 == bucket]
        if not mine:
            assert found[bucket] == 0
            continue
        tail = f"{(min(mine) & ((1 << 57) - 1)) >> 5:052b}"
        zeros = len(tail) - len(tail.lstrip("0"))
        mantissa = (tail[zeros + 1 :] + "0" * 60)[: sh.MANTISSA_BITS]
        assert found[bucket] == (zeros << sh.MANTISSA_BITS) + int(mantissa, 2) + 1


def test_estimate_is_near_the_share():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) << np.uint64(1)
    a, b = np.unique(pool[:2200]), np.unique(pool[200:])
    estimate, used = sh.jaccard(sh.registers(a)[None], sh.registers(b)[None], np.array([len(a)]), np.array([len(b)]))
    assert used[0] == sh.BUCKETS and abs(estimate[0] - 2000 / 3000) < 0.17


def test_band_rows_are_never_copied_to_executors(spark, monkeypatch):
    """Spark sizes the exploded bands as the classes they come from, far below what they take."""
    rows = spark.range(50).selectExpr("id AS cls", "cast(repeat(cast(id % 20 AS string), 256) AS binary) AS registers")
    plans = []

    def written(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(op, "kept_table", written)
    members = op.bucket_members(rows)
    assert members.select("cls").distinct().count() == 50
    [plan] = plans
    assert "Generate explode" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_labels_are_never_copied_to_executors(documents, corpus, monkeypatch):
    """Files hold them in far fewer bytes than a copy in memory takes."""
    kept, plans = op.kept_table, {}

    def written(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(op, "kept_table", written)
    op.near_components(documents(*corpus)).collect()
    assert all("strategy=merge" in plans[name] for name in ("members", "candidates", "named"))
