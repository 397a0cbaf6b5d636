"""Fill-in-middle transformation by content-defined chunks.

A rolling hash over the bytes cuts every text into chunks, at places that depend on the 32 bytes before them alone, so passages
that documents share give the same chunks wherever they stand. What a chunk says about its text is remembered by its content:
its number of code points, whether it holds a marker, and the bytes at its two ends, by which a marker over a border is seen.
The counts of the chunks add up to those of the text; a cut at code point *c* lies in the chunk where the
running count passes *c*, and only that chunk is looked at.

Half of what follows is decided by a hash of the identifier: where the cuts lie, which texts stay plain and which of the
two orders the parts take. Texts that hold a marker stay plain, so ``restored`` always finds the parts again.

Defined cases: null text counts as empty and stays plain; a null identifier counts as empty text in the hash; repeated
rows are each transformed, alike; whole texts are read whatever their length; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm.common import read, small_batches

# The markers, and the shares in hundredths of transformed texts and of those with the suffix first.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED = 90
SUFFIX_FIRST = 20
#: Bytes a chunk has at least (but the last one) and at most; a boundary comes every 512 bytes on average.
LEAST, MOST, BOUNDARY_BITS = 64, 4096, 9
WINDOW = 32
BLOCK = 1 << 20
#: Bytes of chunks a worker remembers.
REMEMBERED = 16 << 20
GEAR = np.random.default_rng(12).integers(0, 1 << 32, 256, dtype=np.uint32)
MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that start no code point


def rolling(data: np.ndarray) -> np.ndarray:
    """The hash of the ``WINDOW`` bytes that end at each byte; bytes farther back are shifted out."""
    h = GEAR[data]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of a text end."""
    ends, last = [], 0
    for start in range(0, len(text), BLOCK):
        low = max(0, start - WINDOW + 1)
        data = np.frombuffer(text, np.uint8, min(len(text), start + BLOCK) - low, low)
        hits = np.flatnonzero(rolling(data) >> np.uint32(32 - BOUNDARY_BITS) == 0) + low + 1
        for end in hits[hits > start].tolist():
            while end - last > MOST:
                last += MOST
                ends.append(last)
            if end - last >= LEAST:
                last = end
                ends.append(last)
    while len(text) - last > MOST:
        last += MOST
        ends.append(last)
    return ends if last == len(text) else [*ends, len(text)]


class ChunkCache:
    """Summaries of chunks by content; the dictionary compares whole contents where hashes meet."""

    def __init__(self) -> None:
        self.known: dict[bytes, tuple[int, bool, bytes, bytes]] = {}
        self.size = 0
        self.hits = self.misses = 0

    def summary(self, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        """(code points that start here, whether a marker lies inside, first and last two bytes)."""
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        if self.size > REMEMBERED:
            self.known, self.size = {}, 0
        found = len(chunk.translate(None, FOLLOWING)), any(m in chunk for m in MARKS), chunk[:2], chunk[-2:]
        self.known[chunk] = found
        self.size += len(chunk)
        return found


def code_point_at(chunk: bytes, k: int) -> int:
    """Where the code point number ``k`` of those that start in a chunk starts."""
    return int(np.flatnonzero(np.frombuffer(chunk, np.uint8) & 0xC0 != 0x80)[k])


def transform(text: bytes, h: tuple[int, int, int, int], cache: ChunkCache) -> tuple[int, str, int | None, int | None, bytes]:
    """(code points, form, those of the prefix, those of the middle, output) of a text by its four numbers."""
    ends = chunk_ends(text)
    starts = [0, *ends[:-1]]
    summaries = [cache.summary(text[a:b]) for a, b in zip(starts, ends)]
    counts = np.cumsum([s[0] for s in summaries], dtype=np.int64)
    n = int(counts[-1]) if ends else 0
    over = any(m in a[3] + b[2] for a, b in zip(summaries, summaries[1:]) for m in MARKS)
    if not n or over or any(s[1] for s in summaries) or h[2] % 100 >= TRANSFORMED:
        return n, "plain", None, None, text

    def place(c: int) -> int:
        if c == n:
            return len(text)
        i = int(np.searchsorted(counts, c, side="right"))
        return starts[i] + code_point_at(text[starts[i] : ends[i]], c - (int(counts[i - 1]) if i else 0))

    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = place(first), place(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if h[3] % 100 < SUFFIX_FIRST:
        return n, "spm", first, second - first, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", first, second - first, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i}") for i in range(4)]
    text = F.coalesce(F.col(f"`{text_column}`").cast("binary"), F.lit(b"")).alias("text")
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), text, *numbers)
    names = [id_column, "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache()
        for batch in small_batches(batches, 1):
            numbers = zip(*[batch.column(2 + i).to_pylist() for i in range(4)])
            found = [transform(t, h, cache) for t, h in zip(batch.column(1).to_pylist(), numbers)]
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
            columns[-1] = columns[-1].view(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return rows.mapInArrow(
        run, f"`{id_column}` bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from; no part of a transformed text holds a marker."""

    def parts(text: Column, first: str, second: str) -> tuple[Column, Column, Column]:
        one = F.substring_index(text, second, 1)
        rest = F.substring(text, F.length(one) + F.lit(len(second) + 1), F.length(text))
        two = F.substring_index(rest, MIDDLE, 1)
        three = F.substring(rest, F.length(two) + F.lit(len(MIDDLE) + 1), F.length(rest))
        return F.substring(one, F.lit(len(first) + 1), F.length(one)), two, three

    prefix, suffix, middle = parts(output, PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(output, SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle(read(spark, folder, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), u AS (
  SELECT doc_id, t, n,
         ('0x' || substr(h, 1, 8))::UBIGINT::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::UBIGINT::BIGINT % (n + 1) AS c2,
         ('0x' || substr(h, 17, 8))::UBIGINT::BIGINT % 100 AS p3, ('0x' || substr(h, 25, 8))::UBIGINT::BIGINT % 100 AS p4
  FROM d
), f AS (
  SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p3 >= 90 THEN 'plain'
              WHEN p4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
       sha256(CASE form
         WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1, n - b) || '<M>' || substring(t, a + 1, b - a)
         WHEN 'spm' THEN '<S>' || substring(t, b + 1, n - b) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a)
         ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
