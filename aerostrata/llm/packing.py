"""Packing of token pieces into windows by minimum bin slack.

Texts are tokenised whole and cut at multiples of the window; what remains of a document is one piece
of a length below the window. The plan works on the multiset of those lengths, at most ``window``
numbers whatever the corpus holds: again and again the largest remaining length opens a window, a
bitset subset-sum over the remaining multiset finds the sum closest to its capacity, the
counts of each length are backtracked, and the pattern is repeated as often as the multiset allows.
Pieces are then dealt to the slots of their length by rank; ranks are counted per length and salt, so
a length that holds a third of all pieces is ranked by many tasks.

Defined cases: null text equals empty text and is the end id alone; repeated rows are packed each;
null identifiers are kept as null; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostrata.llm.common import kept_table, read, small_batches

WINDOW = 2048
END_ID = 1
CACHE = 250_000
WORD_END = "</w>"
#: Fixed value: how the vocabulary's pre-tokenizer splits words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same over lower-case ASCII and Latin-1 letters, which normal forms leave as they are.
SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
SIMPLE_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
PIECES = "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def byte_symbols() -> dict[str, int]:
    """The byte of each symbol of a byte-level vocabulary: printable Latin-1 stands for itself, others are moved up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def joins_are_unique(vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> bool:
    """Whether the order of ids alone gives the merges: every merged token comes from its own text by
    earlier merges as the pair it is merged from, so no other pair with that text ever stands side by side."""
    first = 2 * 256
    if any(vocabulary.get(a + b) != first + i for i, (a, b) in enumerate(merges)):
        return False
    order = {pair: i for i, pair in enumerate(merges)}
    for limit, (a, b) in enumerate(merges):
        text = a + b
        symbols = list(text.removesuffix(WORD_END))
        if text.endswith(WORD_END):
            symbols[-1] += WORD_END
        while True:
            rank, i = min((order.get(p, limit), i) for i, p in enumerate(zip(symbols, symbols[1:])))
            if rank >= limit:
                break
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        if symbols != [a, b]:
            return False
    return True


class ChunkEncoder:
    """Token ids of whole texts, from the ids of their chunks between ASCII white space.

    The vocabulary's pre-tokenizer never joins text across white space, so the ids of a text are those of
    its chunks in order. ``CACHE`` chunks are remembered. New chunks of ASCII and Latin-1 letters are
    merged together in one call by a byte-pair coder that holds the same merges (see
    ``joins_are_unique``), a zero byte standing for the end of a word; all others, and all chunks of other
    vocabularies, by the tokenizer itself.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.known: dict[bytes, bytes] = {}
        self.coder, self.ends = _byte_pair_coder(json.loads(vocabulary))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        chunks = [t.split() for t in texts]
        if len(self.known) > CACHE:
            self.known = {}
        known = self.known
        new = [c.decode() for c in set().union(*chunks) if c not in known]
        simple = [c for c in new if SIMPLE.fullmatch(c) and "<|" not in c] if self.coder else []
        self._merge(simple)
        others = [c for c in new if c.encode() not in known]
        coded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        self.known.update((c.encode(), np.array(e.ids, "<u4").tobytes()) for c, e in zip(others, coded))
        return [b"".join(map(self.known.__getitem__, c)) for c in chunks]

    def _merge(self, chunks: list[str]) -> None:
        if not chunks:
            return
        marked = SIMPLE_WORD.sub("\\g<0>\0", "\n".join(chunks).lower())
        words = np.array([c.count("\0") for c in marked.split("\n")])
        ids = np.array(self.coder.encode_ordinary(marked.replace("\n", "")), "<u4")
        last = np.flatnonzero(self.ends[ids])[np.cumsum(words) - 1] + 1
        coded = ids.tobytes()
        for c, a, b in zip(chunks, [0, *last[:-1].tolist()], last.tolist()):
            self.known[c.encode()] = coded[4 * a : 4 * b]


def _byte_pair_coder(spec: dict):
    """(coder, whether an id ends a word), or (None, None) for vocabularies of another form."""
    import tiktoken

    model = spec["model"]
    merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    split = [p["pattern"].get("Regex") for p in spec["pre_tokenizer"].get("pretokenizers", []) if "pattern" in p]
    if model["end_of_word_suffix"] != WORD_END or split != [WORD] or not joins_are_unique(model["vocab"], merges):
        return None, None
    special = {t["content"] for t in spec["added_tokens"]}
    symbols = byte_symbols()
    ranks = {}
    for token, i in model["vocab"].items():
        if token not in special:
            stem = token.removesuffix(WORD_END)
            ranks[bytes(map(symbols.__getitem__, stem)) + b"\0" * (stem != token)] = i
    ends = np.zeros(max(ranks.values()) + 1, bool)
    ends[[i for t, i in model["vocab"].items() if t not in special and t.endswith(WORD_END)]] = True
    coder = tiktoken.Encoding("words", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={})
    return coder, ends


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> ChunkEncoder:
    return ChunkEncoder(vocabulary)


def token_pieces(
    docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text",
    window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``window`` ids of each document; ``with_ids`` adds the ids themselves."""
    # A vocabulary file is some megabytes, whatever the corpus holds.
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()
    schema = PIECES + (", ids array<bigint>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary.value).encode
        for batch in small_batches(batches, 1):
            coded = [x + end for x in encode([t or b"" for t in batch.column(1).to_pylist()])]
            tokens = np.array([len(x) // 4 for x in coded], np.int64)
            pieces = -(-tokens // window)
            doc = np.repeat(np.arange(len(coded)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(window, tokens[doc] - start)
            cut = [coded[d][4 * s : 4 * (s + n)] for d, s, n in zip(doc, start.tolist(), length.tolist())]
            columns = [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length)]
            columns += [pa.array([zlib.crc32(x) for x in cut], pa.int64()), pa.array(tokens[doc])]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in cut], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    text = F.col(f"`{text_column}`").cast("binary").alias("text")
    return docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), text).mapInArrow(run, schema)


def fill(counts: dict[int, int], first: int, window: int) -> dict[int, int]:
    """The multiset of lengths that holds ``first`` and comes closest to ``window``.

    Where no sum is the window itself, a sum that is a power of two is taken before others, as such
    windows are not padded.
    """
    room = window - first
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        steps.append((length, reach))
        left, take = min(counts[length] - (length == first), room // length), 1
        while left > 0:  # bounded multiplicity by binary splitting
            take = min(take, left)
            reach |= (reach << (take * length)) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    powers = [1 << k for k in range(window.bit_length(), -1, -1) if first <= 1 << k <= window]
    total = reach.bit_length() - 1
    if total != room:
        total = next((p - first for p in powers if reach >> (p - first) & 1), total)
    chosen = {first: 1}
    for length, before in reversed(steps):
        k = 0
        while not (total >= k * length and before >> (total - k * length) & 1):
            k += 1
        if k:
            chosen[length] = chosen.get(length, 0) + k
            total -= k * length
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Rows (length, first rank, copies in a window, first window, offset) by length and rank.

    The pieces of a length with ranks from one row's first rank to the next row's belong to that row.
    """
    counts = {n: c for n, c in counts.items() if c}
    used: dict[int, int] = dict.fromkeys(counts, 0)
    rows, windows = [], 0
    while counts:
        pattern = fill(counts, max(counts), window)
        repeats = min(counts[n] // k for n, k in pattern.items())
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            rows.append((n, used[n], k, windows, offset))
            offset += n * k
            used[n] += k * repeats
            counts[n] -= k * repeats
            if not counts[n]:
                del counts[n]
        windows += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` with sequence_id and offset; windows are gapless from offset 0."""
    spark = pieces.sparkSession
    pieces = kept_table(pieces, "pieces")
    salts = max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(salts)))
    sizes = kept_table(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "sizes")
    # At most one row for each length.
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = plan(counts, window)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    # Grows with the salts, so it is no broadcast; ranking has dealt the pieces by the same keys.
    bases = sizes.select("length", "salt", before.alias("base")).hint("merge")
    # Rows that tie on all of these are the same, so a repeated task deals them alike.
    order = Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = salted.withColumn("rank", F.row_number().over(order) - 1).join(bases, ["length", "salt"])
    columns = pieces.columns
    ranked = ranked.select(*columns, (F.col("base") + F.col("rank")).alias("rank"))
    at = columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = np.int64(1 << 46)
        keys = table[:, 0] * span + table[:, 1]
        for batch in batches:
            length = batch.column(at).to_numpy()
            rank = batch.column(len(columns)).to_numpy()
            row = table[np.searchsorted(keys, length * span + rank, side="right") - 1]
            copy, slot = np.divmod(rank - row[:, 1], row[:, 2])
            placed = [pa.array(row[:, 3] + copy), pa.array(row[:, 4] + slot * length)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], *placed], [*columns, "sequence_id", "offset"]
            )

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of all documents with their places in the sequences."""
    packed = pack(token_pieces(docs, vocabulary_path, id_column, text_column))
    return packed.withColumnRenamed("id", id_column)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read(spark, folder, "documents"), vocabulary_path())
