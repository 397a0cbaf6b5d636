"""Hashed word shingles and HyperMinHash registers of whole texts, a batch at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 5
SEED = 20063
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
#: Bits of a hash below its bucket that registers look at.
TAIL_BITS = 52

U = np.uint64
_random = np.random.default_rng(SEED)
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=U) | U(1)
BASE = int(_random.integers(1 << 62, 1 << 63)) | 1
PLACES = _random.integers(1, 1 << 63, WORDS, dtype=U) | U(1)
COUNTS = _random.integers(1, 1 << 63, WORDS + 1, dtype=U)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True


@lru_cache(maxsize=1)
def _powers(size: int) -> np.ndarray:
    x = np.full(size, BASE, U)
    x[0] = 1
    return np.cumprod(x, dtype=U)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles.

    A-Z are lowered and words stand between the six ASCII white-space characters. A text of fewer than
    ``WORDS`` words is one shingle, a text without words none.
    """
    joined = b"\n".join(texts).lower()
    data = np.frombuffer(joined, np.uint8)
    if not len(data):
        return [np.zeros(0, U) for _ in texts]
    space = IS_SPACE[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    size = end - start
    if len(size):
        begin = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(begin, size)
        power = _powers(1 << int(size.max()).bit_length())
        words = np.add.reduceat(BYTE_VALUES[data[~space]] * power[place], begin)
        words = mix(words + size.astype(U))
    else:
        words = np.zeros(0, U)
    sizes = np.array([len(t) + 1 for t in texts])
    first = np.searchsorted(start, np.cumsum(sizes) - sizes)
    last = np.append(first[1:], len(words))
    whole = len(words) - WORDS + 1
    grams = np.zeros(max(0, whole), U)
    for k in range(WORDS):
        if whole > 0:
            grams += words[k : k + whole] * PLACES[k]
    grams = mix(grams + COUNTS[WORDS])
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        n = b - a
        if n >= WORDS:
            out.append(np.unique(grams[a : b - WORDS + 1]))
        elif n:
            out.append(mix((words[a:b] * PLACES[:n]).sum(dtype=U, keepdims=True) + COUNTS[n]))
        else:
            out.append(np.zeros(0, U))
    return out


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of sorted distinct hashes: 0 for an empty bucket, else 1 + (leading zeros, mantissa).

    The leading bits of a hash name its bucket; of the bucket's smallest hash the number of leading zeros
    after them is kept, and ``MANTISSA_BITS`` bits after the first one.
    """
    out = np.zeros(BUCKETS, np.uint16)
    if len(hashes):
        bucket = (hashes >> U(64 - BUCKET_BITS)).astype(np.int64)
        least = np.flatnonzero(np.diff(bucket, prepend=-1))
        tail = (hashes[least] << U(BUCKET_BITS)) >> U(64 - TAIL_BITS)
        zeros = TAIL_BITS - np.frexp(tail.astype(np.float64))[1].astype(np.int64)
        shifted = (tail << (zeros + 1).astype(U)) & U((1 << TAIL_BITS) - 1)
        mantissa = np.where(tail == 0, U(0), shifted >> U(TAIL_BITS - MANTISSA_BITS)).astype(np.int64)
        out[bucket[least]] = (zeros << MANTISSA_BITS) + mantissa + 1
    return out


#: Share of buckets, times 2 ** MANTISSA_BITS, in which registers of large sets of one size agree by chance
#: (fixed value of the published estimator).
CHANCE = 0.169919487159739


def jaccard(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, buckets it rests on) for rows of registers and set sizes, corrected for chance agreement."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    large, small = np.maximum(n, m).astype(float), np.minimum(n, m).astype(float)
    ratio = small / np.maximum(large, 1)
    chance = CHANCE * used * 2.0**-MANTISSA_BITS * 4 * ratio / (1 + ratio) ** 2
    return np.clip((equal - chance) / np.maximum(used, 1), 0, 1), used
