"""Target-distribution importance resampling of documents by hashed n-gram features.

Features are all runs of one to three words. They fall into buckets by their CRC; a bucket's gain says how much more often
it occurs in the target table than in the documents, a document's weight is the sum of the gains of its features, and
the documents drawn are those of the highest weight plus Gumbel noise, which is a draw without replacement by weight.

Each Arrow batch interns its n-grams in an open-addressed NumPy table: slots are found by the xxhash64 of an n-gram's
bytes, and an n-gram stays in a slot only if the bytes that own it are its own, so each distinct n-gram has one slot with its
bucket and its count. Occurrences keep their slot's number, by which they gather gains. A text longer than a slice goes
through in several, each beginning with the two words before it, so memory is bounded whatever a text holds.

Bucket counts are added up per task and then over tasks: ``BUCKETS`` numbers, whatever the corpus. The order of all scores comes
from ranges of it (``ranking.numbered``), no task sees them all.

Defined cases: null and empty texts have no feature, weight 0, and are never drawn; a null identifier counts as empty text in
the noise and comes before others of its score; repeated rows are documents of their own; if either table is empty its counts are
0; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm.common import kept_table, read, small_batches
from aerostrata.llm.ranking import numbered

# Buckets, longest run, words of a document that may be drawn, hundredths drawn, start of the noise's text.
BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
SHARE = 5
SEED = "42:"
#: Bytes of texts that are looked at together; tables of this size stay in a core's cache.
SLICE = 1 << 18
# The five primes of 64-bit xxhash.
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
#: Bytes an n-gram has at most to be hashed and compared with others in one go.
SHORT = 31

_codes = np.arange(256, dtype=np.uint8)
#: Bytes of words: digits, letters, and all bytes of characters beyond ASCII.
IN_WORD = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
LOWER = np.where((_codes >= ord("A")) & (_codes <= ord("Z")), _codes + 32, _codes).astype(np.uint8)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lanes(data: np.ndarray, width: str) -> np.ndarray:
    """The number that starts at each byte of ``data``, which ends in eight bytes nobody asks for."""
    return np.ndarray(len(data) - 7, np.dtype(width), data, strides=(1,))


def xxhash64(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit xxhash, seed 0, of the ranges of ``data``; ``data`` ends in eight spare bytes."""
    eight, four = _lanes(data, "<u8"), _lanes(data, "<u4")
    h = P5 + length.astype(np.uint64)
    for k in range(SHORT // 8):
        on = np.flatnonzero(length >= 8 * (k + 1))
        lane = _turned(eight[start[on] + 8 * k] * P2, 31) * P1
        h[on] = _turned(h[on] ^ lane, 27) * P1 + P4
    on = np.flatnonzero(length & 4)
    h[on] = _turned(h[on] ^ (four[start[on] + (length[on] & ~7)].astype(np.uint64) * P1), 23) * P2 + P3
    for k in range(3):
        on = np.flatnonzero(length & 3 > k)
        h[on] = _turned(h[on] ^ (data[start[on] + (length[on] & ~3) + k].astype(np.uint64) * P5), 11) * P1
    h ^= h >> np.uint64(33)
    h *= P2
    h ^= h >> np.uint64(29)
    h *= P3
    h ^= h >> np.uint64(32)
    view = memoryview(data)
    for i in np.flatnonzero(length > SHORT).tolist():
        h[i] = xxhash.xxh64_intdigest(view[start[i] : start[i] + length[i]])
    return h


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ranges of a length at ``a`` and at ``b`` hold the same bytes."""
    eight = _lanes(data, "<u8")
    same = np.ones(len(a), bool)
    for k in range(SHORT // 8 + 1):
        on = np.flatnonzero((length > 8 * k) & (length <= SHORT))
        if not len(on):
            break
        unused = np.uint64(8) * np.maximum(8 * (k + 1) - length[on], 0).astype(np.uint64)
        same[on] &= (eight[a[on] + 8 * k] ^ eight[b[on] + 8 * k]) << unused == 0
    view = memoryview(data)
    for i in np.flatnonzero(length > SHORT).tolist():
        same[i] = view[a[i] : a[i] + length[i]] == view[b[i] : b[i] + length[i]]
    return same


class GramTable:
    """Distinct n-grams of a batch by open addressing: bucket and count by slot, and the slot of every occurrence.

    ``crcs`` are those of the occurrences; without them the CRC of each distinct n-gram is computed from its bytes.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, crcs: np.ndarray | None = None):
        keys = xxhash64(data, start, length)
        bits = max(4, int(2 * len(start)).bit_length())
        mask = (1 << bits) - 1
        owner = np.full(1 << bits, -1, np.int32)  # occurrence whose bytes a slot holds
        at = (keys & np.uint64(mask)).astype(np.int32)
        self.slots = np.zeros(len(start), np.int32)
        left = np.arange(len(start), dtype=np.int32)
        while len(left):
            slot = at[left]
            free = owner[slot] < 0
            owner[slot[free]] = left[free]  # of several that want a slot the last one has it
            holder = owner[slot]
            same = (keys[holder] == keys[left]) & (length[holder] == length[left])
            check = np.flatnonzero(same & (holder != left))
            same[check] = same_bytes(data, start[holder[check]], start[left[check]], length[left[check]])
            self.slots[left[same]] = slot[same]
            left = left[~same]
            at[left] = (at[left] + 1) & mask
        used = np.flatnonzero(owner >= 0)
        self.crcs = np.zeros(1 << bits, np.uint32)
        if crcs is None:
            view = memoryview(data)
            a = start[owner[used]]
            ends = zip(a.tolist(), (a + length[owner[used]]).tolist())
            self.crcs[used] = np.array([zlib.crc32(view[i:j]) for i, j in ends], np.uint32)
        else:
            self.crcs[used] = crcs[owner[used]]
        self.buckets = self.crcs % np.uint32(BUCKETS)
        self.counts = np.bincount(self.slots, minlength=1 << bits)

    def without_first(self, n: int) -> GramTable:
        """Do not count the first ``n`` occurrences."""
        if n:
            self.slots = self.slots[n:]
            self.counts = np.bincount(self.slots, minlength=len(self.counts))
        return self


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, length, document of each word) of the documents that start at ``bounds``.

    The bytes are the words, each followed by a space, so a run of words is one range; eight spare bytes end them.
    """
    inside = IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = bounds[bounds < len(data)]
    first[edges] |= inside[edges]
    doc = np.searchsorted(bounds, np.flatnonzero(first), side="right") - 1
    letters = data[inside]
    word = np.cumsum(first[inside], dtype=np.int64) - 1
    size = np.bincount(word, minlength=len(doc))
    out = np.full(len(letters) + len(doc) + 8, ord(" "), np.uint8)
    out[np.arange(len(letters)) + word] = LOWER[letters]
    return out, np.cumsum(size + 1) - size - 1, size, doc


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """What each byte of a CRC adds once 0 to 63 zero bytes have followed; CRCs are linear in it."""
    at = [[[zlib.crc32(bytes(n), b << 8 * k) ^ zlib.crc32(bytes(n)) for b in range(256)] for k in range(4)] for n in range(64)]
    return np.array(at, np.uint32)


def followed(crc: np.ndarray, by: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC of a text of CRC ``crc`` and one of CRC ``by`` and a length that follows it."""
    shifts, crc, left = _shifts(), crc.copy(), length.copy()
    on = np.arange(len(crc))
    while len(on):
        n, c = np.minimum(left[on], 63), crc[on]
        crc[on] = shifts[n, 0, c & 255] ^ shifts[n, 1, c >> 8 & 255] ^ shifts[n, 2, c >> 16 & 255] ^ shifts[n, 3, c >> 24]
        left[on] -= n
        on = np.flatnonzero(left)
    return crc ^ by


def tables(data: np.ndarray, bounds: np.ndarray, carried: int = 0) -> Iterator[tuple[GramTable, np.ndarray, np.ndarray]]:
    """(table, document of each occurrence, words of each document) for the words and then for the longer runs.

    Runs that end in the first ``carried`` words are left out, as are those words.
    """
    out, start, size, doc = words_of(data, bounds)
    words = GramTable(out, start, size)
    crc = words.crcs[words.slots]
    yield words.without_first(carried), doc[carried:], np.bincount(doc[carried:], minlength=len(bounds))
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    spaced = followed(space, crc, size)
    starts, lengths, docs, crcs = [], [], [], []
    for k in range(2, LONGEST + 1):
        last = np.arange(max(k - 1, carried), len(doc))
        last = last[doc[last] == doc[last - k + 1]]
        run = crc[last - k + 1]
        for j in range(k - 2, -1, -1):
            run = followed(run, spaced[last - j], size[last - j] + 1)
        starts.append(start[last - k + 1])
        lengths.append(start[last] + size[last] - start[last - k + 1])
        docs.append(doc[last])
        crcs.append(run)
    runs = GramTable(out, np.concatenate(starts), np.concatenate(lengths), np.concatenate(crcs))
    yield runs, np.concatenate(docs), np.zeros(len(bounds), np.int64)


def slices(text: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a text of about ``SLICE`` bytes, each cut where no word is."""
    a = 0
    while a < len(text):
        b = min(len(text), a + SLICE)
        while b < len(text):
            gap = np.flatnonzero(~IN_WORD[text[b : b + SLICE]])
            b = min(len(text), b + (int(gap[0]) if len(gap) else SLICE))
            if len(gap):
                break
        yield text[a:b]
        a = b


def last_words(text: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, int]:
    """(the last ``LONGEST - 1`` words of ``before`` and ``text``, each followed by a space; how many they are)."""
    words = (bytes(before) + bytes(np.where(IN_WORD[text], text, ord(" ")).astype(np.uint8))).split(b" ")
    kept = [w for w in words if w][1 - LONGEST :]
    return np.frombuffer(b"".join(w + b" " for w in kept), np.uint8), len(kept)


def interned(column: pa.Array) -> Iterator[tuple[GramTable, np.ndarray, np.ndarray]]:
    """``tables`` of a batch of texts, or of each slice of a long one."""
    texts = pc.fill_null(column, b"")
    n = len(texts)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = bounds[:-1] - bounds[0]
    if n > 1 or len(content) <= 2 * SLICE:
        parts = [(content, bounds, 0)]
    else:
        parts = _with_words_before(content)
    for part, starts, carried in parts:
        yield from tables(part, starts, carried)


def _with_words_before(content: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    before, carried = np.zeros(0, np.uint8), 0
    for part in slices(content):
        yield np.concatenate([before, part]), np.zeros(1, np.int64), carried
        before, carried = last_words(part, before)


def bucket_counts(texts: DataFrame, text_column: str = "text") -> np.ndarray:
    """How many features of all texts each bucket has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in small_batches(batches, 0, SLICE):
            for table, _, _ in interned(batch.column(0)):
                counts += np.bincount(table.buckets, table.counts, BUCKETS).astype(np.int64)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["bucket", "n"])

    counted = texts.select(F.col(f"`{text_column}`").cast("binary").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    counts = np.zeros(BUCKETS, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        counts[r.bucket] = r.n
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much more often a bucket occurs in the target, each count raised by one."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    pairs = zip(corpus.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in pairs], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    names = [id_column, "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1, SLICE):
            words, features, weights = np.zeros((3, batch.num_rows), np.int64)
            for table, doc, found in interned(batch.column(1)):
                words += found
                features += np.bincount(doc, minlength=batch.num_rows)
                gathered = gains[table.buckets][table.slots]
                weights += np.bincount(doc, gathered, batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weights))], names)

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"`{id_column}` bigint, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: int = SHARE,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; ``share`` hundredths of the rows of enough words have a rank."""
    gains = bucket_gains(bucket_counts(docs, text_column), bucket_counts(target, text_column))
    name = F.concat(F.lit(SEED), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weighted(docs, gains, id_column, text_column)
    scored = scored.withColumns({"score": F.col("weight") + noise, "open": F.col("n_words") >= least_words})
    table = kept_table(scored, "scores")
    drawn = share * table.where("open").count() // 100
    order = [F.col("open").desc(), F.col("score").desc(), F.col(f"`{id_column}`").asc_nulls_first(), F.col("n_features"), F.col("weight"), F.col("n_words")]
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")
    return numbered(table, order).select(id_column, "n_features", "weight", "score", rank)


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
