"""Best-fit packing of whole documents behind a dominance reduction.

Documents are packed whole into windows of at most ``WINDOW`` tokens; only longer ones are cut. The plan works on the multiset of
piece lengths, at most ``WINDOW`` numbers whatever the corpus holds, in two steps.

*Reduction*, after Martello and Toth: a window's content is fixed for good where it provably dominates all others with the
same longest piece, that is, where any other content's pieces can be dealt to the places of its pieces without
exceeding them, so some best packing has that window. With ``room`` the space beside the piece:

- nothing else fits: the piece is alone;
- the largest piece that fits fills the room, or no two pieces fit together: that largest piece;
- no three fit together: the largest piece, if the best pair is no longer; or the best pair, if its longer one is as long as the largest
  piece and no two pieces longer than its shorter one fit.

A content that dominates goes on doing so while its pieces last, so it is fixed as often as they do. Fixing shrinks the
instance, which can make further pieces reducible, so passes go on until none is.

*Best fit* of what is left, longest pieces first: each goes to the fullest open window it fits, or opens one. Windows of
equal content are handled together, and a window takes pieces of a length as long as it has room, as it is then the fullest.

Pieces are dealt to the places of their length by their rank, found by all tasks (``ranking.numbered``).

Defined cases: null text equals empty text and is the end id alone; repeated rows are packed each; null identifiers are kept as
null; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aerostrata.llm.common import kept_table, read
from aerostrata.llm.packing import token_pieces, vocabulary_path
from aerostrata.llm.ranking import numbered

WINDOW = 2048
END_ID = 0


def _smallest(lengths: list[int], counts: dict[int, int], above: int, many: int, without: int) -> list[int]:
    """The ``many`` smallest pieces longer than ``above``, one piece of length ``without`` left out; fewer if there are not as many."""
    found: list[int] = []
    for n in lengths[bisect_right(lengths, above) :]:
        found += [n] * min(many - len(found), counts[n] - (n == without))
        if len(found) == many:
            break
    return found


def best_pair(lengths: list[int], counts: dict[int, int], room: int, without: int) -> tuple[int, int]:
    """The two pieces, longer first, whose sum comes closest to ``room``; of equal sums the one with the longest piece."""
    best, low, high = (0, 0), 0, bisect_right(lengths, room) - 1
    left = lambda n: counts[n] - (n == without)
    while low <= high:
        a, b = lengths[high], lengths[low]
        if a + b > room or not left(a):
            high -= 1
        elif not left(b) or (low == high and left(a) < 2):
            low += 1
        else:
            if a + b > sum(best):
                best = (a, b)
            low += 1
    return best


def dominating(lengths: list[int], counts: dict[int, int], longest: int, window: int = WINDOW) -> list[int] | None:
    """What goes beside a piece in a content that dominates all others with it, or None if none is known to.

    ``lengths`` are those of ``counts`` in ascending order; the piece itself is among them.
    """
    room = window - longest
    smallest = _smallest(lengths, counts, 0, 3, longest)
    if not smallest or smallest[0] > room:
        return []
    i = bisect_right(lengths, room) - 1
    while not counts[lengths[i]] - (lengths[i] == longest):
        i -= 1
    largest = lengths[i]
    if largest == room or sum(smallest[:2]) > room or len(smallest) == 1:
        return [largest]
    if sum(smallest) <= room and len(smallest) == 3:
        return None
    a, b = best_pair(lengths, counts, room, longest)
    if a + b <= largest:
        return [largest]
    if a == largest:
        above = _smallest(lengths, counts, b, 2, longest)
        if len(above) < 2 or sum(above) > room:
            return [a, b]
    return None


class Plan:
    """Windows given out, and rows (length, first rank, copies in a window, first window, offset)."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.used: Counter[int] = Counter()
        self.windows = 0

    def place(self, length: int, copies: int, first: int, windows: int, offset: int) -> None:
        """``copies`` pieces into each of some windows that lie side by side, from an offset on."""
        self.rows.append((length, self.used[length], copies, first, offset))
        self.used[length] += copies * windows

    def table(self) -> np.ndarray:
        return np.array(sorted(self.rows), np.int64).reshape(-1, 5)


def reduce(counts: dict[int, int], plan: Plan, window: int = WINDOW) -> dict[int, int]:
    """Fix dominating contents in ``plan`` until none is known; returns what is left."""
    counts = {n: c for n, c in counts.items() if c}
    lengths = sorted(counts)
    changed = True
    while changed:
        changed = False
        for longest in lengths[::-1]:
            while counts.get(longest):
                beside = dominating(lengths, counts, longest, window)
                if beside is None:
                    break
                content = Counter([longest, *beside])
                repeats = min(counts[n] // k for n, k in content.items())
                offset = 0
                for n, k in sorted(content.items(), reverse=True):
                    plan.place(n, k, plan.windows, repeats, offset)
                    offset += n * k
                    counts[n] -= k * repeats
                    if not counts[n]:
                        del counts[n]
                        lengths.remove(n)
                plan.windows += repeats
                changed = True
    return counts


def best_fit(counts: dict[int, int], plan: Plan, window: int = WINDOW) -> None:
    """Place all pieces, longest first, each in the fullest open window it fits.

    Open windows are kept as (room, first window, windows): windows side by side with as much room.
    """
    opened: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        at = bisect_left(opened, (length, -1, -1))
        taken: list[tuple[int, int, int]] = []
        while left:
            if at < len(opened):
                room, first, windows = opened.pop(at)
            else:
                room, first, windows = window, plan.windows, -(-left // (window // length))
                plan.windows += windows
            each = room // length
            full = min(windows, left // each)
            if full:
                plan.place(length, each, first, full, window - room)
                taken.append((room - each * length, first, full))
                left -= each * full
            if full < windows and left and left < each:
                plan.place(length, left, first + full, 1, window - room)
                taken.append((room - left * length, first + full, 1))
                left, full = 0, full + 1
            if full < windows:
                taken.append((room, first + full, windows - full))
        for group in taken:
            insort(opened, group)


def plan_windows(counts: dict[int, int], window: int = WINDOW) -> Plan:
    plan = Plan()
    best_fit(reduce(counts, plan, window), plan, window)
    return plan


def pack_whole(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` with sequence_id and offset; windows are gapless from offset 0."""
    pieces = kept_table(pieces, "pieces")
    # At most one row for each length.
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = plan_windows(counts, window).table()
    lengths = np.array(sorted(counts), np.int64)
    before = np.cumsum([0, *[counts[n] for n in lengths.tolist()]])[:-1]
    # Rows that tie on all of these are the same, so a repeated task deals them alike.
    ranked = numbered(pieces, [F.col(c) for c in ("length", "id", "start", "ids_crc32", "doc_tokens")])
    columns = pieces.columns
    at = columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = np.int64(1 << 46)
        keys = table[:, 0] * span + table[:, 1]
        for batch in batches:
            length = batch.column(at).to_numpy()
            rank = batch.column(len(columns)).to_numpy() - before[np.searchsorted(lengths, length)]
            row = table[np.searchsorted(keys, length * span + rank, side="right") - 1]
            copy, slot = np.divmod(rank - row[:, 1], row[:, 2])
            placed = [pa.array(row[:, 3] + copy), pa.array(row[:, 4] + slot * length)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], *placed], [*columns, "sequence_id", "offset"]
            )

    more = [StructField(c, LongType()) for c in ("sequence_id", "offset")]
    return ranked.mapInArrow(run, StructType([*pieces.schema.fields, *more]))


def pack_whole_documents(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces."""
    packed = pack_whole(token_pieces(docs, vocabulary, id_column, text_column, window, end_id), window)
    piece = F.floor(F.col("start") / window).cast("int").alias("piece")
    return packed.select(F.col("id").alias(id_column), piece, "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_whole_documents(read(spark, folder, "documents"), vocabulary_path())
