"""Best-fit packing against the tokenizer, the reduction against exact packings, windows without gaps."""

import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from aerostrata.llm import best_fit as op


def fewest(items, window):
    """The least number of windows, by trying all contents with the longest piece."""

    @lru_cache(maxsize=None)
    def least(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]

        def contents(room, at, out):
            yield out
            for k in range(at, len(rest)):
                if rest[k] <= room and (k == at or rest[k] != rest[k - 1]):
                    yield from contents(room - rest[k], k + 1, [*out, k])

        return 1 + min(least(tuple(x for i, x in enumerate(rest) if i not in set(c))) for c in contents(window - first, 0, []))

    return least(tuple(sorted(items, reverse=True)))


def test_the_reduction_keeps_a_best_packing():
    rng = random.Random(1)
    reduced = 0
    for _ in range(400):
        window = rng.choice([10, 20, 30])
        low = rng.choice([1, 3, window // 4])
        items = [rng.randint(low, window) for _ in range(rng.randint(1, 10))]
        plan = op.Plan()
        left = op.reduce(Counter(items), plan, window)
        reduced += plan.windows
        assert plan.windows + fewest(tuple(Counter(left).elements()), window) == fewest(tuple(items), window)
    assert reduced > 500


def unpacked(plan, counts, window):
    """Pieces by window from the plan's rows."""
    windows = {}
    table = plan.table().tolist()
    for i, (length, rank, copies, first, offset) in enumerate(table):
        end = table[i + 1][1] if i + 1 < len(table) and table[i + 1][0] == length else counts[length]
        for k in range(end - rank):
            windows.setdefault(first + k // copies, []).append((offset + k % copies * length, length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(windows) == list(range(plan.windows))
    return windows


def one_by_one(items, window):
    """Best fit of pieces, longest first."""
    rooms = []
    for n in sorted(items, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(window - n)
    return rooms


def test_best_fit_of_equal_pieces_at_once_equals_one_by_one():
    rng = random.Random(2)
    for _ in range(200):
        window = rng.choice([30, 64, 100])
        items = [rng.randint(1, window) for _ in range(rng.randint(1, 120))]
        counts, plan = Counter(items), op.Plan()
        op.best_fit(counts, plan, window)
        found = unpacked(plan, counts, window)
        assert Counter(n for parts in found.values() for _, n in parts) == counts
        rooms = sorted(window - sum(n for _, n in parts) for parts in found.values())
        assert rooms == sorted(one_by_one(items, window))


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    for low, high in ((1, 2049), (600, 1500), (300, 700)):
        lengths, n = np.unique(rng.integers(low, high, 30_000), return_counts=True)
        counts = dict(zip(lengths.tolist(), n.tolist()))
        plan = op.plan_windows(dict(counts))
        unpacked(plan, counts, 2048)
        halves = sum(c for k, c in counts.items() if k > 1024)
        bound = max(halves, -(-sum(k * c for k, c in counts.items()) // 2048))
        assert plan.windows <= 1.09 * bound


def test_documents_stay_whole_and_every_id_is_in_one_piece(documents):
    tokenizer = Tokenizer.from_file(op.vocabulary_path())
    rng = random.Random(4)
    texts = [None, "", "word " * 9000, "word " * 2046, "word " * 2047, "word " * 2048]
    texts += [" ".join(rng.choices(["tree", "Rain,", "häuser", "x1"], k=rng.randrange(1, 900))) for _ in range(80)]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "nobody")]
    found = op.pack_whole_documents(documents(*rows), op.vocabulary_path())
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for s in range(0, len(ids), 2048):
            part = ids[s : s + 2048]
            want.append((i, s // 2048, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    found = found.collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in found)
    windows = {}
    for r in found:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(windows) <= 1.1 * sum(w[3] for w in want) / 2048 + 2


def test_empty_table(documents):
    assert op.pack_whole_documents(documents((1, "a")).limit(0), op.vocabulary_path()).count() == 0


def test_places_of_a_hot_key(spark):
    from aerostrata.llm.ranking import numbered

    rows = [(0 if i % 3 == 0 else i, i) for i in range(1000)]
    table = spark.createDataFrame(rows, "a bigint, b bigint").repartition(7)
    found = numbered(table, [op.F.col("a").desc(), op.F.col("b")]).collect()
    assert [(r.a, r.b) for r in sorted(found, key=lambda r: r.place)] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(r.place for r in found) == list(range(1000))
