"""Viterbi against all state sequences, chunks against whole conversations, recovered roles against the given."""

from collections import Counter
from itertools import product

import numpy as np
import pytest

from aerostrata.llm import transcripts as op

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, chunk string, line string"


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    return op.Model(rng.integers(1, 50, 6), rng.integers(1, 50, (6, 6)), [rng.integers(1, 50, (6, n)) for n in op.OBSERVATIONS])


def lines_of(rng, n):
    return [tuple(int(rng.integers(0, k)) for k in op.OBSERVATIONS) for _ in range(n)]


def value(model, scores, states, before=None):
    v = (model.start if before is None else model.move[before])[states[0]] + scores[0][states[0]]
    return v + sum(model.move[a, b] + s[b] for a, b, s in zip(states, states[1:], scores[1:]))


def test_viterbi_finds_the_best_sequence(model):
    scores = model.scores(lines_of(np.random.default_rng(2), 5))
    best = max(value(model, scores, s) for s in product(range(6), repeat=5))
    assert value(model, scores, op.viterbi(model, scores, None, None)) == pytest.approx(best)


def test_chained_chunks_give_the_best_sequence(model):
    scores = model.scores(lines_of(np.random.default_rng(3), 40))
    whole = value(model, scores, op.viterbi(model, scores, None, None))
    first, second = op.chain(model, scores[:17], True)[0], op.chain(model, scores[17:], False)
    through = first[:, None] + second
    end = int(through.max(axis=0).argmax())
    middle = int(through[:, end].argmax())
    states = [*op.viterbi(model, scores[:17], None, middle), *op.viterbi(model, scores[17:], middle, end)]
    assert value(model, scores, states) == pytest.approx(whole)


def conversations(spark, n=60, turns=6):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(n):
        for t in range(turns):
            role = "user" if t % 2 == 0 else "assistant"
            if role == "user":
                text = " ".join(["what"] * int(rng.integers(2, 6))) + "?"
            else:
                text = "\n".join(" ".join(["answer"] * int(rng.integers(20, 60))) for _ in range(int(rng.integers(1, 4))))
            rows.append((c, t, role, text, "x", "y", "z"))
    return spark.createDataFrame(rows, SCHEMA)


def parsed(frame, raw=True):
    raw_rows = op.raw_transcripts(frame, "conv_id", "turn", "role", "text") if raw else frame
    lines = op.transcript_lines(raw_rows, "conv_id", "turn", "text", "role")
    return op.parse(lines.drop("role"), op.learn(lines, "role")).collect()


@pytest.mark.parametrize("chunk", [op.CHUNK_LINES, 4])
def test_roles_and_texts_are_recovered(spark, chunk, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_LINES", chunk)
    frame = conversations(spark)
    given = {(r.conv_id, r.turn): r for r in frame.collect()}
    found = parsed(frame)
    right = [r for r in found if not r.continued and given[(r.conv, r.first_turn)].role == r.role]
    assert len(right) >= 0.97 * len(given) and sum(not r.continued for r in found) <= 1.03 * len(given)
    whole = lambda r: r.n_lines == given[(r.conv, r.first_turn)].text.count("\n") + 1
    r = next(r for r in right if r.role == "assistant" and r.n_lines > 1 and whole(r))
    assert r.rendered == f"<|assistant|>\n{given[(r.conv, r.first_turn)].text}"
    assert sum(r.n_lines for r in found) == sum(g.text.count("\n") + 1 for g in given.values())


def test_chunks_do_not_change_the_turns(spark, monkeypatch):
    frame = conversations(spark, n=12, turns=30)
    whole = sorted((r.conv, r.first_turn, r.role) for r in parsed(frame) if not r.continued)
    lines = op.transcript_lines(op.raw_transcripts(frame, "conv_id", "turn", "role", "text"), "conv_id", "turn", "text", "role")
    learnt = op.learn(lines, "role")
    monkeypatch.setattr(op, "CHUNK_LINES", 4)
    monkeypatch.setattr(op, "FAN", 3)
    lines = op.transcript_lines(op.raw_transcripts(frame, "conv_id", "turn", "role", "text"), "conv_id", "turn", "text")
    cut = op.parse(lines, learnt).collect()
    assert sorted((r.conv, r.first_turn, r.role) for r in cut if not r.continued) == whole


def test_chunks_are_bounded_whatever_the_identifiers_and_turns(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_LINES", 8)
    turns = [(None, t % 3, "user", f"User: {t % 7}", "", "", "") for t in range(60)]
    turns += [(1, None, "user", "same", "", "", "")] * 50 + [(1, -900, "user", "a\nb", "", "", ""), (2, 0, "user", "x\n" * 40, "", "", "")]
    lines = op.transcript_lines(spark.createDataFrame(turns, SCHEMA), "conv_id", "turn", "text", "role")
    rows = lines.collect()
    for conv in (None, 1, 2):
        mine = sorted((r for r in rows if r.conv == conv), key=lambda r: r["at"])
        assert [r["at"] for r in mine] == list(range(len(mine))) and max(Counter(r.chunk for r in mine).values()) <= 8
        assert [r.chunk for r in mine] == sorted(r.chunk for r in mine)
        keys = [(r.turn is not None, r.turn or 0, r.line, r.text) for r in mine]
        assert keys == sorted(keys)
    assert len(rows) == 60 + 52 + 41
    found = op.parse(lines.drop("role"), op.learn(lines, "role")).collect()
    assert sum(r.n_lines for r in found) == len(rows) and max(r.n_lines for r in found) <= 8


def test_sparse_turns_are_one_chunk(spark):
    turns = [(1, 300 * t, "user", f"User: {t}", "", "", "") for t in range(200)]
    lines = op.transcript_lines(spark.createDataFrame(turns, SCHEMA), "conv_id", "turn", "text")
    assert [r[0] for r in lines.select("chunk").distinct().collect()] == [0]


@pytest.mark.parametrize("n", [1, 3, 4, 30, 100])
def test_ends_of_many_chunks_lie_on_the_best_way(spark, model, monkeypatch, n):
    """Products by ranges and back give each chunk the states of the whole conversation's best sequence; a group is FAN tables."""
    monkeypatch.setattr(op, "FAN", 3)
    sizes = []
    real = op.states_between
    monkeypatch.setattr(op, "states_between", lambda t, *rest: (sizes.append(len(t)), real(t, *rest))[1])
    scores = model.scores(lines_of(np.random.default_rng(5), 3 * n))
    parts = [scores[3 * k : 3 * k + 3] for k in range(n)]
    rows = [(c, k, bytearray(op.chain(model, s, k == 0).tobytes())) for c in (None, 7) for k, s in enumerate(parts)]
    found = op.chunk_ends(spark.createDataFrame(rows, op.TABLES)).collect()
    best = value(model, scores, op.viterbi(model, scores, None, None))
    for conv in (None, 7):
        mine = sorted((r for r in found if r.conv == conv), key=lambda r: r.chunk)
        assert [r.chunk for r in mine] == list(range(n)) and [r.before for r in mine] == [-1, *[r.end for r in mine[:-1]]]
        states = [x for r, s in zip(mine, parts) for x in op.viterbi(model, s, r.before if r.before >= 0 else None, r.end)]
        assert value(model, scores, states) == pytest.approx(best)
    assert max(sizes, default=0) <= 3


def test_odd_rows_and_empty_table(spark):
    rows = [(None, 0, "user", "User: hi", "", "", ""), (1, None, "user", None, "", "", ""), (1, 0, None, "Bot: a", "", "", ""),
            (1, 0, None, "Bot: a", "", "", ""), (2, 0, "judge", "word " * 50_000, "", "", "")]
    found = parsed(spark.createDataFrame(rows, SCHEMA), raw=False)
    assert sum(r.n_lines for r in found) == len(rows) and {r.conv for r in found} == {None, 1, 2}
    assert parsed(spark.createDataFrame([], SCHEMA)) == []
