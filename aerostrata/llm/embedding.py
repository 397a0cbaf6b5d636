"""Near-duplicate embeddings by a subspace pigeonhole join.

Vectors are scaled to one and rotated by a fixed random rotation, then cut into blocks of few
dimensions. Two vectors of cosine c differ by a squared distance of 2 - 2c, so in one block at
least they differ by no more than that block's share of it. Each block is range-joined on a grid over its
first coordinates: a vector stands at home in one cell and visits the later cells its range
touches. What travels is a code, one byte per rotated component: a task finds the vectors of one cell that have another one
within the block's and the whole budget as far as codes tell, whose rounding is allowed for. Only those travel again, with their
original components, on which each pair is verified in double precision. A pair counts in the first
block whose budget it meets, so links are counted once and pairs are never emitted: tasks send link
counts by vector and the links of a spanning forest.

Equal vectors of a label are one class with a count. The vectors of a busy cell are dealt to stripes of bounded
size and each pair of stripes is a task, so no task ever holds more than two of them; a cell of n vectors
sends each of them about n / ``STRIPE`` times. The grid of a label is refined as its number of vectors grows.

Defined cases: vectors that are null, zero, or hold null or non-finite components, vectors of another
length than their label's others, and null labels link with nothing; repeated identifiers are rows of their own and count
as links of each other; null identifiers count as links but never name a component; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.llm.common import kept_table, read
from aerostrata.llm.graph import components

COSINE = 0.98
BLOCK_DIMENSIONS = 8
SEED = 20029
#: Vectors of a stripe, and vectors of a label per cell the grid aims at.
STRIPE = 2048
#: Stored bytes of a stripe; long vectors have smaller stripes.
STRIPE_BYTES = 4 << 20
CELL_AIM = 512
SLACK = 1e-9


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dimensions]).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def unit(raw: pd.Series, wide: bool) -> np.ndarray:
    """Vectors of length one, in double precision; scaled first, so that no square overflows."""
    x = np.frombuffer(b"".join(raw), "<f8" if wide else "<f4").reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vector_rows(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(id, label, wide, digest, raw) of every row; digest and raw are null where a vector links with nothing.

    ``raw`` holds the components as they are stored, 4 or (``wide``) 8 bytes each.
    """
    element = vectors.schema[vector_column].dataType.elementType
    wide = not isinstance(element, T.FloatType)
    kind = np.dtype("<f8" if wide else "<f4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws, digests = [], []
            for values, label in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                x = None
                if values and label is not None and None not in values:
                    x = np.array(values, kind)
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                raws.append(None if x is None else x.tobytes())
                digests.append(None if x is None else blake2b(x.tobytes(), digest_size=16).digest())
            columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(raws, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "digest", "raw"])

    rows = vectors.select(
        F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{label_column}`").cast("string"),
        F.col(f"`{vector_column}`").cast("array<double>" if wide else "array<float>"),
    )
    return rows.mapInArrow(run, "id bigint, label string, digest binary, raw binary").withColumn("wide", F.lit(wide))


def coded(turned: np.ndarray) -> np.ndarray:
    """Rows of bytes: the largest component as four bytes, then each component in 127ths of it."""
    top = np.abs(turned).max(axis=1).astype("<f4")
    steps = np.rint(turned / np.maximum(top, 1e-30)[:, None] * 127).clip(-127, 127).astype(np.int8)
    return np.concatenate([top.view(np.uint8).reshape(-1, 4), steps.view(np.uint8)], axis=1)


def decoded(codes: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(about the rotated vectors, the most a component is off) of codes."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    top = np.ascontiguousarray(raw[:, :4]).view("<f4")[:, 0].astype(np.float64)
    return raw[:, 4:].view(np.int8) * (top / 127)[:, None], top * (0.5 / 127) * (1 + 1e-6) + 1e-7


def block_counts(dimensions: int) -> np.ndarray:
    """First dimension of each block, and the end."""
    return np.unique(np.append(np.arange(0, dimensions, BLOCK_DIMENSIONS), dimensions))


def grid_depth(rows: int, dimensions: int, side: float) -> int:
    """How many coordinates of a block its grid cuts: more as a label has more vectors."""
    spread = max(1.5, 4 / (np.sqrt(dimensions) * side))  # cells along a coordinate
    depth = int(np.ceil(np.log(max(1, rows / CELL_AIM)) / np.log(spread)))
    return int(np.clip(depth, 1, 5))


def cells(classes: DataFrame, cosine: float) -> DataFrame:
    """(key, home, cls, block, code): every class in its cell of each block and in the cells it visits."""
    distance = 2 - 2 * cosine

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (label, size, wide, rows), part in frame.groupby(["label", "size", "wide", "rows"]):
                d = size // (8 if wide else 4)
                turned = unit(part["raw"], wide) @ rotation(d)
                code = np.array([c.tobytes() for c in coded(turned)], object)
                edges = block_counts(d)
                for block, (a, b) in enumerate(zip(edges, edges[1:])):
                    radius = np.sqrt(distance * (b - a) / d) + SLACK
                    side = 2 * radius
                    depth = min(grid_depth(rows, d, side), b - a)
                    y = turned[:, a : a + depth]
                    home = np.floor(y / side).astype(np.int64)
                    low = np.floor((y - radius) / side).astype(np.int64) - home
                    high = np.floor((y + radius) / side).astype(np.int64) - home
                    # With sides of twice the radius a range touches at most two cells along a coordinate.
                    for step in np.ndindex(*[3] * depth):
                        move = np.array(step) - 1
                        first = next((m for m in move if m), 0)
                        if first < 0:
                            continue  # pairs meet in the later of their cells
                        here = ((move >= low) & (move <= high)).all(axis=1)
                        if here.any():
                            keys = [f"{label}|{size}|{block}|{','.join(map(str, c))}" for c in home[here] + move]
                            yield pd.DataFrame(
                                {"key": keys, "home": not move.any(), "cls": part["cls"].values[here], "block": block, "code": code[here]}
                            )

    return classes.mapInPandas(run, "key string, home boolean, cls bigint, block int, code binary")


def dealt(placed: DataFrame) -> DataFrame:
    """The vectors of cells, dealt to tasks (key, i, j) as pairs of stripes.

    Stripes 0 to p-1 hold the home vectors, p and later ones the visitors. Stripe i of home vectors also meets itself
    in task (i, p), which is there without visitors, too.
    """
    home = F.count(F.when(F.col("home"), 1))
    n, size = F.count(F.lit(1)), F.sum(F.length("code").cast("bigint"))
    room = F.greatest(F.lit(1), F.least(F.lit(STRIPE), F.floor(F.col("n") * STRIPE_BYTES / F.col("bytes"))))
    busy = (
        placed.groupBy("key").agg(n.alias("n"), home.alias("at_home"), size.alias("bytes")).where("n > 1 AND at_home > 0")
        .select(
            "key", F.ceil(F.col("at_home") / room).cast("int").alias("p"),
            F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("at_home")) / room)).cast("int").alias("q"),
        )
    )
    slot = F.xxhash64("cls")
    stripe = F.when(F.col("home"), F.pmod(slot, F.col("p"))).otherwise(F.col("p") + F.pmod(slot, F.col("q")))
    last = F.when(F.col("home"), F.col("p") + F.col("q") - 1).otherwise(F.col("p") - 1)
    return (
        placed.join(busy, "key").withColumn("stripe", stripe.cast("int"))
        .withColumn("partner", F.explode(F.sequence(F.lit(0), last))).where("stripe <> partner")
        .withColumn("i", F.least("stripe", "partner")).withColumn("j", F.greatest("stripe", "partner"))
        .drop("q", "partner")
    )


def candidates(cell: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """The rows of two stripes of a cell, without codes, that may have a link there which counts in the cell's block."""
    block, i, j, p = (int(cell[c].iloc[0]) for c in ("block", "i", "j", "p"))
    cell = cell.sort_values(["stripe", "cls"])
    mine = int((cell["stripe"] == i).sum())
    x, off = decoded(cell["code"])
    edges, d = block_counts(x.shape[1]), x.shape[1]
    a, b = edges[block], edges[block + 1]
    distance, found = 2 - 2 * cosine, np.zeros(len(cell), bool)
    squares, inside = (x**2).sum(axis=1), (x[:, a:b] ** 2).sum(axis=1)
    others = np.arange(0 if j == p else mine, len(cell))
    for start in range(0, mine if len(others) else 0, 256):
        rows = np.arange(start, min(start + 256, mine))
        slack = off[rows, None] + off[None, others]
        near = rows[:, None] < others[None, :]
        for low, high, budget, square in ((a, b, distance * (b - a) / d, inside), (0, d, distance, squares)):
            gap = square[rows, None] + square[None, others] - 2 * x[rows, low:high] @ x[others, low:high].T
            near &= gap <= (np.sqrt(budget) + slack * np.sqrt(high - low) + 1e-6) ** 2 + 1e-9
        found[rows] |= near.any(axis=1)
        found[others] |= near.any(axis=0)
    return cell.loc[found, ["key", "i", "j", "p", "stripe", "block", "cls"]]


def compare(cell: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Rows (cls, links, other) of two stripes of a cell: link counts of each class in them, and a forest of their links."""
    block, i, j, p = (int(cell[c].iloc[0]) for c in ("block", "i", "j", "p"))
    cell = cell.sort_values(["stripe", "cls"])
    mine = int((cell["stripe"] == i).sum())
    if not mine:
        return pd.DataFrame({"cls": [], "links": [], "other": []}).astype({"cls": "int64", "links": "int64", "other": "Int64"})
    x = unit(cell["raw"], bool(cell["wide"].iloc[0]))
    turned = x @ rotation(x.shape[1])
    edges = block_counts(x.shape[1])
    budget = (2 - 2 * cosine) * np.diff(edges) / x.shape[1] + SLACK
    cls, copies = cell["cls"].values, cell["copies"].values
    links = np.zeros(len(cell), np.int64)
    forest = Forest(len(cell))
    part = turned[:, edges[block] : edges[block + 1]]
    squares = (part**2).sum(axis=1)
    # The first stripe meets itself in its task with stripe p alone.
    others = np.arange(0 if j == p else mine, len(cell))
    step = max(1, (1 << 22) // x.shape[1])
    for start in range(0, mine, 256):
        rows = np.arange(start, min(start + 256, mine))
        gap = squares[rows, None] + squares[None, others] - 2 * part[rows] @ part[others].T
        # Rows of the first stripe lie in the order of their classes; of a pair the smaller class leads.
        near = (gap <= budget[block] + 1e-6) & (rows[:, None] < others[None, :])
        us, vs = np.nonzero(near)
        us, vs = rows[us], others[vs]
        for s in range(0, len(us), step):
            u, v = us[s : s + step], vs[s : s + step]
            close = (x[u] * x[v]).sum(axis=1) >= cosine
            u, v = u[close], v[close]
            inside = np.add.reduceat((turned[u] - turned[v]) ** 2, edges[:-1], axis=1) <= budget
            first = inside.argmax(axis=1) == block
            u, v = u[first & inside.any(axis=1)], v[first & inside.any(axis=1)]
            np.add.at(links, u, copies[v])
            np.add.at(links, v, copies[u])
            forest.join(u, v)
    hit = links > 0
    counted = pd.DataFrame({"cls": cls[hit], "links": links[hit], "other": pd.array([None] * int(hit.sum()), "Int64")})
    u, v = forest.links()
    joined = pd.DataFrame({"cls": cls[u], "links": 0, "other": pd.array(cls[v], "Int64")})
    return pd.concat([counted, joined], ignore_index=True)


class Forest:
    """Keeps the links that join parts not joined before."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.kept: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        if not len(u):
            return
        fresh = self.root[u] != self.root[v]
        for a, b in zip(u[fresh].tolist(), v[fresh].tolist()):
            ra, rb = self.find(a), self.find(b)
            if ra != rb:
                self.root[max(ra, rb)] = min(ra, rb)
                self.kept.append((a, b))
        for _ in range(8):
            self.root = self.root[self.root]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = np.array(self.kept, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector; links join vectors of a label at ``cosine`` or above."""
    rows = kept_table(vector_rows(vectors, id_column, vector_column, label_column), "vectors")
    classes = rows.where("raw IS NOT NULL").groupBy("label", "digest", "wide").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw"),
    )
    classes = kept_table(
        classes.withColumn("cls", F.monotonically_increasing_id()).withColumn("size", F.length("raw")), "classes"
    )
    sizes = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("rows"))
    placed = kept_table(cells(classes.join(sizes, ["label", "size"]), cosine), "cells")
    likely = dealt(placed).select("key", "i", "j", "p", "stripe", "block", "cls", "code").groupBy("key", "i", "j").applyInPandas(
        lambda cell: candidates(cell, cosine), "key string, i int, j int, p int, stripe int, block int, cls bigint"
    )
    likely = kept_table(likely, "likely").join(classes.select("cls", "copies", "wide", "raw"), "cls")
    found = kept_table(
        likely.groupBy("key", "i", "j").applyInPandas(
            lambda cell: compare(cell, cosine), "cls bigint, links bigint, other bigint"
        ),
        "found",
    )
    counts = found.where("other IS NULL").groupBy("cls").agg(F.sum("links").alias("links"))
    parts = components(found.where("other IS NOT NULL").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    named = (
        classes.select("cls", "label", "digest", "copies", "first").join(parts, F.col("cls") == F.col("id"), "left")
        .drop("id").withColumn("component", F.coalesce("component", "cls")).join(counts, "cls", "left")
    )
    named = kept_table(named, "named")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select("label", "digest", "copies", "links", "component_id")
    return (
        rows.drop("raw", "wide").join(named, ["label", "digest"], "left")
        .select(
            F.col("id").alias(id_column),
            F.coalesce(F.col("links") + F.col("copies") - 1, F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(id_column) == F.col("component_id"))
    )


def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(read(spark, folder, "embeddings"))


OP3_SQL = """
WITH RECURSIVE whole AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM whole a JOIN whole b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x),
reached AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION SELECT r.id, l.y FROM reached r JOIN links l ON l.x = r.other),
parts AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN parts ON id = vec_id LEFT JOIN counts ON x = vec_id
"""
