"""SentencePiece encoding by streaming Viterbi, and decoding.

The lattice has a boundary after every character and an edge for every piece. The model merges by rank, so
of the edges into a boundary that edge survives whose piece may stand after the piece that
survives at its start: two pieces may stand side by side if the merges of their joint text give the two.
Each boundary so keeps one backpointer, the last piece of the text up to there, and the ids equal those of
the model's own encoder. Only boundaries the next pieces can start at matter, as many as the longest piece
has characters. Within a unit an automaton finds these pieces: its state is the longest end of the text read that some
piece begins with, and knows the pieces that end there; states and their steps are made as texts need them. Once their backpointer paths meet in one boundary, the ids before it are committed and
forgotten. Paths also meet where no piece crosses: before white space, and at characters without a piece,
which are written as bytes. Units between white space are remembered, so repeated words cost a lookup.

Defined cases: null text equals empty text and has no ids; texts and words of any length are read whole;
null ids decode to null; unknown or control ids decode to nothing; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.llm.common import read, small_batches, texts_of

SPACE = "▁"
CACHE = 400_000
PAIRS = 1_000_000


def unit_pattern(pieces: Iterable[str]) -> re.Pattern:
    """Splits normalised text where no piece crosses: before spaces, and between letters and other characters.

    Letters that some piece joins with another character count as other characters; the spaces before a
    unit belong to it.
    """
    odd: set[str] = set()
    while True:
        more = re.escape("".join(sorted(odd)))
        letter, other = rf"[^\W\d_{more}]", rf"(?:[\d_{more}]|[^\w{SPACE}])"
        mixed = re.compile(f"({letter}){other}|{other}({letter})")
        found = {c for t in pieces for pair in mixed.findall(t) for c in pair if c}
        if not found:
            return re.compile(rf"{SPACE}*{letter}+|{SPACE}*{other}+|{SPACE}+")
        odd |= found


class Pieces:
    """The pieces of a model: text, merge rank and id, and the ids of bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.processor.vocab_size()
        self.text = [self.processor.id_to_piece(i) for i in range(size)]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if self.processor.is_byte(i)}
        hidden = {i for i in range(size) if self.processor.is_byte(i) or self.processor.is_control(i) or self.processor.is_unknown(i)}
        self.id = {t: i for i, t in enumerate(self.text) if i not in hidden}
        self.rank = {t: (-self.processor.get_score(i), i) for t, i in self.id.items()}
        self.longest = max(map(len, self.id))
        self.unit = unit_pattern(self.id)
        self.single = {t for t in self.id if len(t) == 1}
        raw = [b""] * size
        for i, t in enumerate(self.text):
            if i not in hidden:
                raw[i] = t.replace(SPACE, " ").encode()
        for b, i in self.byte.items():
            raw[i] = bytes([b])
        self.raw = raw

    @cached_property
    def ends(self) -> dict:
        """Pieces by their characters from the last to the first."""
        ends: dict = {}
        for t, i in self.id.items():
            node = ends
            for c in reversed(t):
                node = node.setdefault(c, {})
            node[""] = i
        return ends

    @cached_property
    def beginnings(self) -> set[str]:
        """What pieces begin with, whole pieces included."""
        return {t[:k] for t in self.id for k in range(1, len(t) + 1)}


class StreamingViterbi:
    """Commits the ids of a stream of characters, keeping a window of boundaries."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.widest = 0
        self.forget()

    def forget(self) -> None:
        #: For a piece, by the piece before it: whether the two may stand side by side.
        self.after: dict[int, dict[int, bool]] = {}
        #: States by their text; a state has the next ones by character, and below "" the pieces that end there.
        self.states: dict[str, dict] = {}
        self.start: dict = {"": (), "text": ""}
        self.learnt = 0

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges of the joint text of two pieces give the two."""
        after = self._after(right)
        found = after.get(left)
        if found is None:
            a, b = self.pieces.text[left], self.pieces.text[right]
            found = after[left] = self._merged(a + b) == [a, b]
            self.learnt += 1
        return found

    def _after(self, piece: int) -> dict[int, bool]:
        """At the start of a text, -1, any piece may stand."""
        found = self.after.get(piece)
        if found is None:
            found = self.after[piece] = {-1: True}
        return found

    def _step(self, state: dict, c: str) -> dict:
        """The state after one more character, which is a piece."""
        text = state["text"] + c
        while text not in self.pieces.beginnings:
            text = text[1:]
        found = self.states.get(text)
        if found is None:
            ends = ((len(text) - k, self.pieces.id.get(text[k:])) for k in range(len(text)))
            found = {"": tuple((n, i, self._after(i)) for n, i in ends if i is not None), "text": text}
            self.states[text] = found
        state[c] = found
        self.learnt += 1
        return found

    def _merged(self, text: str) -> list[str]:
        parts, rank = list(text), self.pieces.rank
        none = (float("inf"), 0)
        while len(parts) > 1:
            best, i = min((rank.get(x + y, none), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
            if best is none:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def unit(self, text: str) -> list[int]:
        """The ids of a text no piece crosses the ends of; a short one fits the window as a whole."""
        if len(text) > 4 * self.pieces.longest or not self.pieces.single.issuperset(text):
            return list(self.ids(text))
        if self.learnt > PAIRS:
            self.forget()
        back, state = [-1], self.start
        for end, c in enumerate(text):
            state = state.get(c) or self._step(state, c)
            for size, piece, after in state[""]:  # the longest first
                left = back[end + 1 - size]
                follows = after.get(left)
                if follows or follows is None and self.may_follow(left, piece):
                    back.append(piece)
                    break
        return self._path(back, len(text))

    def ids(self, characters: Iterable[str]) -> Iterator[int]:
        """The ids in order, as soon as they are certain.

        ``back`` holds the surviving piece at every boundary of the window; at the first it is the last
        piece committed, or -1 where anything may follow.
        """
        pieces, longest, ends = self.pieces, self.pieces.longest, self.pieces.ends
        window: list[str] = []
        back: list[int] = [-1]
        for c in characters:
            if c not in pieces.single:
                yield from self._path(back, len(window))
                yield from (pieces.byte[b] for b in c.encode("utf-8", "surrogatepass"))
                window, back = [], [-1]
                continue
            window.append(c)
            end, node, edges = len(window), ends, []
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                node = node.get(window[start])
                if node is None:
                    break
                if "" in node:
                    edges.append((start, node[""]))
            for start, piece in reversed(edges):
                if back[start] < 0 or self.may_follow(back[start], piece):
                    back.append(piece)
                    break
            if end >= 4 * longest and end % longest == 0:
                self.widest = max(self.widest, end)
                certain = self._meeting(back, end)
                if certain:
                    yield from self._path(back[: certain + 1], certain)
                    window = window[certain:]
                    # The last piece committed still decides what may follow it.
                    back = back[certain:]
        yield from self._path(back, len(window))

    def _path(self, back: list[int], end: int) -> list[int]:
        text, path = self.pieces.text, []
        while end > 0:
            path.append(back[end])
            end -= len(text[back[end]])
        return path[::-1]

    def _meeting(self, back: list[int], end: int) -> int:
        """The last boundary all paths from the boundaries still in reach go through."""
        text = self.pieces.text
        alive = set(range(end - self.pieces.longest + 1, end + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(last - len(text[back[last]]))
        return alive.pop()


class Coder:
    """Ids and texts of batches."""

    def __init__(self, model: bytes):
        self.pieces = Pieces(model)
        self.viterbi = StreamingViterbi(self.pieces)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        normal = self.pieces.processor.normalize
        for text in texts:
            units = self.pieces.unit.findall(normal(text)) if text else []
            if len(self.known) > CACHE:
                self.known = {}
            known = self.known
            for u in set(units):
                if u not in known:
                    known[u] = array("I", self.viterbi.unit(u)).tobytes()
            out.append(np.frombuffer(b"".join(map(known.__getitem__, units)), "<u4"))
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        raw = self.pieces.raw
        out = []
        for x in ids:
            text = b"".join(map(raw.__getitem__, x.tolist())).decode("utf-8", "replace")
            out.append(text[1:] if text[:1] == " " else text)  # the model puts a space before every text
        return out


@lru_cache(maxsize=2)
def coder(model: bytes) -> Coder:
    return Coder(model)


def _model(spark: SparkSession, path: str):
    # A model file is some hundred kilobytes, whatever the corpus holds.
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text, ids, n_ids, ids_crc32) of every row; null text is empty.

    The checksum is that of the ids as little-endian unsigned 32-bit numbers.
    """
    model = _model(docs.sparkSession, model_path)
    names = [id_column, text_column, "ids", "n_ids", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(model.value).encode
        for batch in small_batches(batches, 1):
            texts = texts_of(batch, 1)
            ids = encode(texts)
            sizes = [len(x) for x in ids]
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            crc = pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())
            columns = [batch.column(0), pa.array(texts), lists, pa.array(sizes, pa.int64()), crc]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{text_column}`"))
    schema = f"`{id_column}` bigint, `{text_column}` string, ids array<int>, n_ids bigint, ids_crc32 bigint"
    return rows.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, model_path: str, ids_column: str = "ids") -> DataFrame:
    """``encoded`` with the text its ids stand for, as decoded."""
    model = _model(encoded.sparkSession, model_path)
    names, at = encoded.columns, encoded.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = coder(model.value).decode
        for batch in batches:
            column = batch.column(at)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            texts = decode([flat[a:b] for a, b in zip(ends, ends[1:])])
            texts = [t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document as digests, and whether decoding gives its text back."""
    path = model_path()
    decoded = decode_documents(encode_documents(read(spark, folder, "documents"), path), path)
    return decoded.select("doc_id", "n_ids", "ids_crc32", (F.col("decoded") == F.col("text")).alias("round_trip"))
