"""Near vectors against all pairs, and components against a plain search."""

import numpy as np
import pytest

from aerostrata.llm import embedding as op
from aerostrata.llm.graph import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, cls bigint, key string"


def plain(rows, cosine=0.98):
    ok = {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v, np.float32).astype(float)
            ok[k] = x / np.linalg.norm(x)
    links = {k: set() for k in range(len(rows))}
    for a in ok:
        for b in ok:
            if a != b and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= cosine:
                links[a].add(b)
    out = []
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        out.append((rows[k][0], len(links[k]), min(rows[n][0] for n in seen)))
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(25):
            base = rng.standard_normal(24)
            for noise in (0, 0, 0.1, 0.15, 0.2, 0.25):
                v = base + noise * rng.standard_normal(24)
                rows.append(((n := n + 1), (v * rng.uniform(0.1, 9)).tolist() if noise else base.tolist(), label))
    good = rows[0][1]
    rows += [(900, None, 0), (901, [], 0), (902, [0.0] * 24, 0), (903, [None] + good[1:], 0), (904, [float("nan")] + good[1:], 0),
             (905, [float("inf")] + good[1:], 0), (906, good, None), (907, good[:7], 0), (908, [1e38] * 24, 1), (909, [1e38] * 24, 1),
             (1, good, 0)]
    return rows


@pytest.mark.parametrize("stripe", [op.STRIPE, 2])
def test_links_and_components(spark, vectors, stripe, monkeypatch):
    monkeypatch.setattr(op, "STRIPE", stripe)
    monkeypatch.setattr(op, "CELL_AIM", 10 if stripe == 2 else 512)
    frame = spark.createDataFrame([(*r, 0, "k") for r in vectors], SCHEMA)
    found = op.near_vectors(frame).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == plain(vectors)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_a_task_of_a_busy_cell_holds_two_stripes_at_most(spark, monkeypatch):
    monkeypatch.setattr(op, "STRIPE", 16)
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.03 * rng.standard_normal(16)).tolist(), 0) for i in range(400)]
    frame = spark.createDataFrame([(*r, 0, "k") for r in rows], SCHEMA)
    classes = op.vector_rows(frame, "vec_id", "embedding", "label").selectExpr(
        "label", "wide", "id AS cls", "raw", "1L AS copies", "length(raw) AS size", "400L AS rows"
    )
    placed = op.cells(classes, op.COSINE).cache()
    assert max(r["count"] for r in placed.groupBy("key").count().collect()) > 300
    assert max(r["count"] for r in op.dealt(placed).groupBy("key", "i", "j").count().collect()) <= 4 * op.STRIPE
    found = op.near_vectors(frame).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == plain(rows)


def test_codes_are_no_farther_off_than_they_say():
    rng = np.random.default_rng(6)
    turned = rng.standard_normal((200, 24))
    turned[0] = 0
    turned[0, 3] = 1.0
    turned /= np.linalg.norm(turned, axis=1, keepdims=True)
    about, off = op.decoded(op.pd.Series([c.tobytes() for c in op.coded(turned)]))
    assert (np.abs(about - turned) <= off[:, None]).all() and off.max() < 0.005


def test_only_vectors_with_a_likely_link_travel_with_their_components(spark, monkeypatch):
    seen = []
    real = op.kept_table
    monkeypatch.setattr(op, "kept_table", lambda df, name: (seen.append((name, real(df, name))), seen[-1][1])[1])
    apart = np.random.default_rng(7).standard_normal((200, 24))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(apart)] + [(300 + i, (v + 0.01).tolist(), 0) for i, v in enumerate(apart[:5])]
    found = op.near_vectors(spark.createDataFrame([(*r, 0, "k") for r in rows], SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == plain(rows)
    tables = dict(seen)
    assert "raw" not in tables["cells"].columns + tables["likely"].columns
    assert {r.cls for r in tables["likely"].select("cls").distinct().collect()} == {
        r.cls for r in tables["classes"].where("first >= 300 OR first < 5").collect()
    }


def test_empty_table(spark):
    assert op.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    found = {tuple(r) for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {(i, 0) for i in range(21)} | {(100 + i, 100) for i in range(30)} | {(i, 200) for i in (200, 201, 202)}
    assert found == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
