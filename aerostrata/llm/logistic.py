"""Bounded samples of labelled texts and a small logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.common import held_out, kept_table

#: Characters of sampled texts the driver takes at most, per class.
SAMPLE_CHARS = 24 << 20


def agreed_labels(labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    """(id, label) of the ids whose labels agree."""
    label = F.col(f"`{label_column}`").cast("int")
    return (
        labels.where(label.isin(0, 1)).groupBy(F.col(f"`{id_column}`").cast("bigint").alias("id"))
        .agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low = high AND id IS NOT NULL")
        .select("id", F.col("low").alias("label"))
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, rows: int
) -> tuple[list[bytes], np.ndarray, float]:
    """(texts, labels, share of label 1 among all labelled rows) outside the held-out fold.

    At most ``rows`` different texts of each class and ``SAMPLE_CHARS`` characters, whole texts in the order of their hashes;
    one that no longer fits is passed over. The first ``4 * rows`` texts of a class are looked at. Equal texts of a class
    count once. Repeated labels of an id count once if they agree; ids with labels of both kinds are left out, as are null labels and ids.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    texts = docs.where(~held_out(id_column)).select(F.col(f"`{id_column}`").cast("bigint").alias("id"), text.alias("text"))
    numbers = texts.select("id", F.xxhash64("text").alias("hash"), F.length("text").alias("chars"))
    known = kept_table(labelled(numbers, agreed_labels(labels, id_column, label_column)), "labelled")
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    picked: list[tuple[int, int]] = []
    for value in (0, 1):
        different = known.where(F.col("label") == value).groupBy("hash", "chars").agg(F.min("id").alias("id"))
        left, most = SAMPLE_CHARS, len(picked) + rows
        for r in different.orderBy("hash", "id").limit(4 * rows).select("id", "chars").collect():
            if r.chars <= left and len(picked) < most:
                left -= r.chars
                picked.append((r.id, value))
    if not picked:
        return [], np.zeros(0), 0.5
    chosen = F.broadcast(docs.sparkSession.createDataFrame(picked, "id bigint, label int"))  # at most 2 * rows rows
    found = (
        texts.join(chosen, "id").groupBy("id", "label").agg(F.min("text").alias("text"))
        .select(F.xxhash64("text").alias("hash"), "id", "label", F.col("text").cast("binary").alias("text")).collect()
    )
    found.sort(key=lambda r: (r.hash, r.id))
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return [bytes(r.text) for r in found], np.array([r.label for r in found]), share


def labelled(rows: DataFrame, agreed: DataFrame) -> DataFrame:
    """Narrow ``rows`` (id, ...) with their label. Both sides are merged by id at every size, so costs grow evenly."""
    return rows.join(agreed.hint("merge"), "id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60,
    changed: np.ndarray | None = None, penalty: float = 0.0,
) -> np.ndarray:
    """Weights of the columns and, last, the constant, by Newton's method on standardised columns.

    ``changed`` holds differences of rows whose scores should not differ: ``penalty`` times the mean square of the
    score's change over them, times the number of rows, is added to the loss.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))]).astype(np.float64)
    w = np.zeros(z.shape[1])
    extra = np.diag([*np.full(x.shape[1], ridge * len(x)), 1e-9])
    if changed is not None:
        d = changed / scale
        extra[:-1, :-1] += penalty * len(x) * (d.T @ d) / len(d)
    for _ in range(steps):
        p = sigmoid(z @ w)
        slope = z.T @ (weight * (p - y)) + extra @ w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + extra + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def fit_sparse(
    rows: list[np.ndarray], width: int, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60,
    changed: list[tuple[np.ndarray, np.ndarray]] | None = None, penalty: float = 0.0,
) -> np.ndarray:
    """``fit_logistic`` of rows that name the columns they have, ``changed`` those they gain and lose.

    Newton's steps are solved by conjugate gradients, so memory grows with the named columns alone.
    """
    n = len(rows)
    have, at = _entries(rows)
    mean = np.bincount(have, minlength=width) / n
    scale = np.where(mean > 0, np.sqrt(mean * (1 - mean)) + 1e-6, 1.0)
    gained, lost = (_entries([c[k] for c in changed or []]) for k in (0, 1))
    m = len(changed or [])

    def forth(w: np.ndarray) -> np.ndarray:
        v = w[:-1] / scale
        return np.bincount(at, v[have], n) - mean @ v + w[-1]

    def back(r: np.ndarray) -> np.ndarray:
        return np.append((np.bincount(have, r[at], width) - mean * r.sum()) / scale, r.sum())

    def extra(w: np.ndarray) -> np.ndarray:
        out = np.append(ridge * n * w[:-1], 1e-9 * w[-1])
        if m:
            v = w[:-1] / scale
            d = np.bincount(gained[1], v[gained[0]], m) - np.bincount(lost[1], v[lost[0]], m)
            spread = np.bincount(gained[0], d[gained[1]], width) - np.bincount(lost[0], d[lost[1]], width)
            out[:-1] += penalty * n / m * spread / scale
        return out

    w = np.zeros(width + 1)
    for _ in range(steps):
        p = sigmoid(forth(w))
        slope = back(weight * (p - y)) + extra(w)
        curve = weight * p * (1 - p)
        step, left = np.zeros_like(w), slope.copy()
        way, size = left.copy(), left @ left
        goal = size * 1e-8
        for _ in range(300):
            if size <= goal:
                break
            bent = back(curve * forth(way)) + extra(way) + 1e-9 * way
            far = size / (way @ bent)
            step += far * way
            left -= far * bent
            size, old = left @ left, size
            way = left + size / old * way
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-5:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def _entries(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(column, row) of every entry."""
    lengths = [len(r) for r in rows]
    columns = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return columns.astype(np.int32), np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
