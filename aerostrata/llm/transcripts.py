"""Transcript parsing: a hidden Markov model recovers who speaks in each line, and turns are rendered anew.

States are a role's first line and its further lines. A line is observed as its speaker marker, its length and whether it
asks; the probabilities are counted, smoothed, on labelled conversations. Viterbi gives the likeliest
states. Conversations are cut after every ``CHUNK_LINES`` lines whatever their identifiers and turns are, so that a very long
one is many tasks: every chunk gives the best score between any two states at its ends. Such tables are multiplied (the best sum over
the state between two) by ranges of ``FAN`` chunks, and the products again, up to one for the conversation. Its last state
is known then, and on the way down every range gets the states it begins and ends with, at last every chunk,
which is decoded between them. No group holds more than ``FAN`` tables, however long a conversation is.

Defined cases: null text is an empty line; null turns come first; repeated rows are lines of their own;
rows without a conversation identifier form one conversation; an unknown marker counts as none; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostrata.llm.common import held_out, kept_table, read

ROLES = ("system", "user", "assistant")
STATES = len(ROLES) * 2  # first lines of the roles, then further lines
#: Lines of a chunk at most, and tables that are multiplied at a time.
CHUNK_LINES = 4096
FAN = 64
#: Speaker markers and the role each stands for.
MARKERS = {
    "system": "system", "instruction": "system", "user": "user", "human": "user", "question": "user",
    "assistant": "assistant", "bot": "assistant", "answer": "assistant",
}
MARKER = re.compile(r"\s*(?:\W{0,3})(" + "|".join(MARKERS) + r")\W{0,2}:\s*", re.IGNORECASE)
LENGTH_BOUNDS = (20, 60, 120, 200, 400, 800)
ASKS = re.compile(r"[?¿]")
SMOOTHING = 0.5


def observe(line: str) -> tuple[int, int, int, str]:
    """(marker, length, asks, rest): 0 or 1 + role, a bucket of the length, whether it asks, the line without its marker."""
    found = MARKER.match(line)
    rest = line[found.end() :] if found else line
    marker = 1 + ROLES.index(MARKERS[found.group(1).lower()]) if found else 0
    return marker, int(np.searchsorted(LENGTH_BOUNDS, len(rest))), int(bool(ASKS.search(rest))), rest


OBSERVATIONS = (len(ROLES) + 1, len(LENGTH_BOUNDS) + 1, 2)


class Model:
    """Log probabilities of the first state, of transitions and of each kind of observation."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]):
        def share(counts: np.ndarray) -> np.ndarray:
            counts = counts + SMOOTHING
            return np.log(counts / counts.sum(axis=-1, keepdims=True))

        # A conversation opens with a role's first line, and further lines keep their role.
        n = len(ROLES)
        open_ = np.array([True] * n + [False] * n)
        allowed = np.tile(open_, (STATES, 1))
        allowed[np.arange(STATES), np.arange(STATES) % n + n] = True
        self.start = np.where(open_, share(np.where(open_, start, 0)), -np.inf)
        self.move = np.where(allowed, share(np.where(allowed, move, 0)), -np.inf)
        self.emit = [share(e) for e in emit]

    def scores(self, lines: list[tuple]) -> np.ndarray:
        return np.array([sum(e[:, o] for e, o in zip(self.emit, line)) for line in lines]).reshape(-1, STATES)


def chain(model: Model, scores: np.ndarray, first: bool) -> np.ndarray:
    """Best score of a chunk by the state before it (row 0 alone where it is the first) and its last state."""
    rows = np.full((STATES, STATES), -np.inf)
    if first:
        rows[0] = model.start + scores[0]
    else:
        rows = model.move + scores[0]
    for s in scores[1:]:
        rows = (rows[:, :, None] + model.move[None]).max(axis=1) + s
    return rows


def viterbi(model: Model, scores: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
    """The best states of a chunk after the state ``before`` (None at the start) that end in ``last`` (None: any)."""
    value = (model.start if before is None else model.move[before]) + scores[0]
    back = np.zeros((len(scores), STATES), np.int8)
    for i in range(1, len(scores)):
        through = value[:, None] + model.move
        back[i] = through.argmax(axis=0)
        value = through.max(axis=0) + scores[i]
    states = np.empty(len(scores), np.int64)
    states[-1] = value.argmax() if last is None else last
    for i in range(len(scores) - 1, 0, -1):
        states[i - 1] = back[i, states[i]]
    return states


def transcript_lines(turns: DataFrame, id_column: str, turn_column: str, text_column: str, *more: str) -> DataFrame:
    """(conv, chunk, turn, line, text, at) of every line of the turns; ``at`` is its place in its conversation."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    lines = turns.select(
        F.col(f"`{id_column}`").cast("bigint").alias("conv"), F.col(f"`{turn_column}`").cast("bigint").alias("turn"),
        F.posexplode(F.split(text, "\n")).alias("line", "text"), *[F.col(f"`{c}`") for c in more],
    )
    placed = numbered(lines).withColumn("chunk", F.floor(F.col("at") / CHUNK_LINES).cast("bigint"))
    return placed.select("conv", "chunk", "turn", "line", "text", "at", *more)


def numbered(lines: DataFrame) -> DataFrame:
    """``lines`` with their places (at) in their conversations, by turn (null first), line and text.

    All lines are sorted over the tasks, so one conversation may lie in many; each task numbers its own part, and
    the few conversations that go on from one task to the next get the counts of the tasks before.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen, head = None, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            none, conv = np.asarray(batch.column(0).is_null()), np.asarray(batch.column(0).fill_null(0))
            change = np.ones(n, bool)
            change[1:] = (conv[1:] != conv[:-1]) | (none[1:] != none[:-1])
            change[0] = key is not None and key != (conv[0], none[0])
            index = np.arange(n)
            at = index - np.maximum.accumulate(np.where(change, index, -seen))
            heads = head & (np.cumsum(change) == 0)
            key, seen, head = (conv[-1], none[-1]), int(at[-1]) + 1, bool(heads[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(heads)], [*batch.schema.names, "at", "head"])

    # Equal lines are told apart, so that they need not lie in one task.
    ordered = lines.withColumn("tie", F.monotonically_increasing_id()).orderBy("conv", "turn", "line", "text", "tie").drop("tie")
    parts = ordered.withColumn("part", F.spark_partition_id()).mapInArrow(run, schema + ", part int, at bigint, head boolean")
    parts = kept_table(parts, "lines")
    # One row at most for each task whose first conversation may go on from tasks before.
    heads = parts.where("head").select("conv").distinct().withColumnRenamed("conv", "owner")
    same = F.col("conv").eqNullSafe(F.col("owner"))
    counts = parts.join(F.broadcast(heads), same, "left_semi").groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # A conversation that begins inside a task has nothing before it.
    before = before.where("before > 0").select("part", "before")
    return (
        parts.join(F.broadcast(before), "part", "left")
        .withColumn("at", F.col("at") + F.when(F.col("head"), F.coalesce("before", F.lit(0))).otherwise(0))
        .drop("part", "head", "before")
    )


def learn(lines: DataFrame, role_column: str) -> Model:
    """A model counted over labelled lines (conv, chunk, turn, line, text, at, role)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = [observe(t)[:3] for t in frame["text"]]
            yield pd.DataFrame(
                {"state": frame["state"], "before": frame["before"], "marker": [o[0] for o in seen],
                 "length": [o[1] for o in seen], "asks": [o[2] for o in seen]}
            )

    role = F.lit(None).cast("int")
    for i, name in enumerate(ROLES):
        role = F.when(F.lower(F.col(f"`{role_column}`")) == name, i).otherwise(role)
    state = role + F.when(F.col("line") > 0, len(ROLES)).otherwise(0)
    known = lines.select("conv", "chunk", "turn", "at", "text", state.alias("state")).where("state IS NOT NULL")
    # The last line of a chunk goes before the first of the next; -1 opens a conversation.
    after = F.lead("chunk").over(Window.partitionBy("conv").orderBy("chunk"))
    last = known.groupBy("conv", "chunk").agg(F.max(F.struct("at", "state")).alias("last")).withColumn("chunk", after)
    last = last.where("chunk IS NOT NULL").select(
        "conv", "chunk", F.lit(None).cast("bigint").alias("turn"), "last.at", F.lit(None).cast("string").alias("text"), "last.state"
    )
    order = Window.partitionBy("conv", "chunk").orderBy("at")
    opens = F.when(F.coalesce("turn", F.lit(0)) <= 0, -1)
    known = known.union(last).withColumn("before", F.coalesce(F.lag("state").over(order), opens)).where("text IS NOT NULL")
    before = F.col("before")
    rows = known.select("text", "state", before.cast("int").alias("before"))
    counts = rows.mapInPandas(run, "state int, before int, marker int, length int, asks int")
    # As many rows as there are combinations, whatever the corpus holds.
    table = counts.groupBy("state", "before", "marker", "length", "asks").count().collect()
    start, move = np.zeros(STATES), np.zeros((STATES, STATES))
    emit = [np.zeros((STATES, n)) for n in OBSERVATIONS]
    for r in table:
        for e, o in zip(emit, (r.marker, r.length, r.asks)):
            e[r.state, o] += r["count"]
        if r.before == -1:
            start[r.state] += r["count"]
        elif r.before is not None:
            move[r.before, r.state] += r["count"]
    return Model(start, move, emit)


def by_chunk(names: list[str], f, schema: str, lines: DataFrame) -> DataFrame:
    """``f`` on the ordered lines of each chunk; a task streams the chunks dealt to it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = frame[["conv", "chunk"]].astype("Int64")
            change = (keys != keys.shift()) & ~(keys.isna() & keys.shift().isna())
            cuts = np.flatnonzero(change.fillna(True).any(axis=1).to_numpy())
            for a, b in zip(cuts, cuts[1:]):
                yield f(frame.iloc[a:b])
            rest = frame.iloc[cuts[-1] if len(cuts) else 0 :]
        if rest is not None and len(rest):
            yield f(rest)

    return lines.repartition("conv", "chunk").sortWithinPartitions(*names).mapInPandas(run, schema)


def product(tables: list[np.ndarray]) -> np.ndarray:
    """Best scores through chunks that follow each other, by the state before the first and the last state."""
    whole = tables[0]
    for m in tables[1:]:
        whole = (whole[:, :, None] + m[None]).max(axis=1)
    return whole


def states_between(tables: list[np.ndarray], before: int, end: int) -> list[int]:
    """The last state of each of some chunks on the best way from a state (-1: the start) to the last state ``end``."""
    value, back = tables[0][max(before, 0)], []
    for m in tables[1:]:
        through = value[:, None] + m
        back.append(through.argmax(axis=0))
        value = through.max(axis=0)
    last = [end]
    for b in reversed(back):
        last.append(int(b[last[-1]]))
    return last[::-1]


TABLES = "conv bigint, chunk bigint, matrix binary"


def chunk_ends(tables: DataFrame) -> DataFrame:
    """(conv, chunk, before, end) of chunks from their tables (conv, chunk, matrix): the states they follow and end with; -1 opens."""

    def matrices(chunks: pd.DataFrame) -> list[np.ndarray]:
        return [np.frombuffer(m).reshape(STATES, STATES) for m in chunks["matrix"]]

    def multiplied(chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values("chunk")
        row = {"conv": [chunks["conv"].iloc[0]], "chunk": [chunks["range"].iloc[0]], "matrix": [product(matrices(chunks)).tobytes()]}
        return pd.DataFrame(row).astype({"conv": "Int64"})

    def divided(chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values("chunk")
        before = int(chunks["before"].iloc[0])
        last = states_between(matrices(chunks), before, int(chunks["end"].iloc[0]))
        return pd.DataFrame({"conv": chunks["conv"], "chunk": chunks["chunk"], "before": [before, *last[:-1]], "end": last})

    above = F.floor(F.col("chunk") / FAN).cast("bigint").alias("range")
    levels = [kept_table(tables, "tables")]
    longest = levels[0].agg(F.max("chunk")).first()[0] or 0
    while longest:
        ranges = levels[-1].withColumn("range", above)
        levels.append(kept_table(ranges.groupBy("conv", "range").applyInPandas(multiplied, TABLES), "tables"))
        longest //= FAN

    def last_states(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            end = [int(m[0].argmax()) for m in matrices(whole)]
            yield pd.DataFrame({"conv": whole["conv"], "chunk": whole["chunk"], "before": -1, "end": end}).astype({"conv": "Int64"})

    schema = "conv bigint, chunk bigint, before int, end int"
    ends = levels[-1].mapInPandas(last_states, schema)
    for below in reversed(levels[:-1]):
        of = ends.toDF("owner", "part", "before", "end")
        ranges = below.withColumn("range", above)
        same = F.col("conv").eqNullSafe(F.col("owner")) & (F.col("range") == F.col("part"))
        ranges = ranges.join(of, same).select("conv", "chunk", "matrix", "range", "before", "end")
        ends = kept_table(ranges.groupBy("conv", "range").applyInPandas(divided, schema), "ends")
    return ends


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """(conv, chunk, turn, role, first_turn, n_lines, continued, rendered): the recovered turns, rendered.

    ``turn`` counts within its chunk; a turn that goes on from the chunk before is ``continued``. ``first_turn`` is the source
    turn of its first line.
    """
    lines = lines.select("conv", "chunk", "turn", "line", "text", "at")
    same = F.col("conv").eqNullSafe(F.col("owner"))
    order = ["conv", "chunk", "turn", "line", "text"]
    long = lines.groupBy("conv").agg(F.max("chunk").alias("last")).where("last > 0").select(F.col("conv").alias("owner"))
    cut = lines.join(long, same, "left_semi")

    def ends(chunk: pd.DataFrame) -> pd.DataFrame:
        scores = model.scores([observe(t)[:3] for t in chunk["text"]])
        row = chunk.iloc[0]
        matrix = chain(model, scores, bool(row["at"] == 0))
        return pd.DataFrame({"conv": [row["conv"]], "chunk": [row["chunk"]], "matrix": [matrix.tobytes()]}).astype({"conv": "Int64"})

    joints = chunk_ends(by_chunk(order, ends, TABLES, cut)).toDF("owner", "part", "before", "end")
    whole = lines.join(joints, same & (F.col("chunk") == F.col("part")), "left").drop("owner", "part")

    def decode(chunk: pd.DataFrame) -> pd.DataFrame:
        seen = [observe(t) for t in chunk["text"]]
        row = chunk.iloc[0]
        known = pd.notna(row["before"])
        before = int(row["before"]) if known and row["before"] >= 0 else None
        states = viterbi(model, model.scores([o[:3] for o in seen]), before, int(row["end"]) if known else None)
        opens = states < len(ROLES)
        starts = np.flatnonzero(opens | (np.arange(len(states)) == 0))
        rows = []
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(states)])):
            role = ROLES[states[a] % len(ROLES)]
            text = "\n".join(o[3] for o in seen[a:b])
            head = f"<|{role}|>\n" if opens[a] else "\n"
            rows.append((row["conv"], row["chunk"], k, role, chunk["turn"].iloc[a], b - a, not opens[a], head + text))
        columns = ["conv", "chunk", "turn", "role", "first_turn", "n_lines", "continued", "rendered"]
        found = pd.DataFrame(rows, columns=columns)
        return found.astype({"conv": "Int64", "first_turn": "Int64"})

    schema = (
        "conv bigint, chunk bigint, turn bigint, role string, first_turn bigint, n_lines bigint,"
        " continued boolean, rendered string"
    )
    return by_chunk(order, decode, schema, whole)


def raw_transcripts(turns: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str) -> DataFrame:
    """``turns`` with speaker markers before their texts, as loose transcripts have them.

    By the hash of conversation and turn a third of the turns has no marker and the others have
    one of two spellings.
    """
    kind = F.crc32(F.concat_ws("/", F.col(f"`{id_column}`").cast("string"), F.col(f"`{turn_column}`").cast("string")).cast("binary")) % 3
    role = F.lower(F.col(f"`{role_column}`"))
    other = F.when(role == "user", "Human").when(role == "assistant", "Bot").otherwise("Instruction")
    mark = F.when(kind == 0, "").when(kind == 1, F.concat(F.initcap(role), F.lit(": "))).otherwise(F.concat(other, F.lit(": ")))
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return turns.withColumn(text_column, F.concat(F.coalesce(mark, F.lit("")), text))


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """The recovered turns of all conversations; the model learns roles from four fifths of them."""
    turns = read(spark, folder, "conversations")
    raw = raw_transcripts(turns, "conv_id", "turn", "role", "text")
    lines = transcript_lines(raw, "conv_id", "turn", "text", "role")
    model = learn(lines.where(~held_out("conv")), "role")
    return parse(lines.drop("role"), model).withColumnRenamed("conv", "conv_id").withColumn("held_out", held_out("conv_id"))
