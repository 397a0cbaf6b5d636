"""Near-duplicate documents by HyperMinHash.

A document is its set of hashed word shingles. Its signature holds ``BUCKETS`` registers of a
leading-zero count and mantissa bits. Equal sets are one class. Bands of ``ROWS`` registers deal the
classes to band buckets; bands without any shingle deal nothing. Candidates from common buckets are
screened by the Jaccard estimate, corrected for chance agreement, and verified on their full sets.

Only connectivity is wanted, so the pairs of a bucket are not all tried. First every member is tried
with its bucket's smallest. Then the buckets that still hold several components are compared by
tasks, each pair in its first common bucket: the candidates of buckets with few of them are
verified. The other buckets are compared again by tasks that hold the full sets, verify every
candidate of components not joined yet, and send on the links alone. So no link is lost, and no task
sends the pairs of a large group. Large buckets are dealt out as pairs of blocks; members of the
bucket's largest component need not meet.

Defined cases: null text equals empty text; documents without words have an empty set and link with
nothing; repeated rows and identifiers count as documents with the same text or not; null identifiers never
name a component unless all of its are null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm.common import kept_table, read, shuffled, small_batches
from aerostrata.llm.exact_dedup import LOCATOR, located, scanned, without
from aerostrata.llm.graph import components
from aerostrata.llm.shingles import BUCKETS, jaccard, registers, shingle_sets

ROWS = 4
SHARE = 75
#: Standard deviations the estimate may fall short of the threshold.
MARGIN = 5.0
BLOCK = 2048
#: Members of a block that travel with their full sets.
SET_BLOCK = 512
#: Candidates for each member above which a bucket is crowded.
CANDIDATES = 4


def documents_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").cast("binary").alias("text")
    )


def signatures(docs: DataFrame) -> DataFrame:
    """(id, n_shingles, digest, registers) of (id, text) rows; the digest names the set. A place (at) is passed on."""
    placed = "at" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            sets = shingle_sets([t or b"" for t in batch.column(1).to_pylist()])
            columns = [
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns + batch.columns[2:], ["id", "n_shingles", "digest", "registers", *["at"] * placed]
            )

    schema = "id bigint, n_shingles bigint, digest binary, registers binary"
    return docs.mapInArrow(run, schema + f", at {LOCATOR}" * placed)


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, hashes) of the ``wanted`` classes (cls, id, digest), read again from their documents.

    Classes without an identifier are found by the digest of their sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            sets = [s.tobytes() for s in shingle_sets([t or b"" for t in batch.column(1).to_pylist()])]
            found = [blake2b(s, digest_size=16).digest() for s in sets]
            same = [w is None or f == w for f, w in zip(found, batch.column(2).to_pylist())]
            columns = [batch.column(0), pa.array(found, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "digest", "hashes"]).filter(pa.array(same, pa.bool_()))

    schema = "cls bigint, digest binary, hashes binary"
    named = docs.join(wanted, "id").select("cls", "text", "digest").mapInArrow(run, schema).drop("digest")
    none = docs.where("id IS NULL").select(F.lit(None).cast("bigint"), "text", F.lit(None).cast("binary"))
    found = none.mapInArrow(run, schema).drop("cls").join(wanted.where("id IS NULL").select("cls", "digest"), "digest")
    return named.union(found.select("cls", "hashes")).groupBy("cls").agg(F.first("hashes").alias("hashes"))


def passes(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, whether a pair of registers and sizes may reach ``share`` hundredths)."""
    estimate, used = jaccard(a, b, n, m)
    threshold = share / 100
    room = MARGIN * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    possible = 100 * np.minimum(n, m) >= share * np.maximum(n, m)
    return estimate, (estimate >= threshold - room) & possible


def screen(pairs: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose registers let them reach ``share``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS) for i in (2, 3))
                _, good = passes(x, y, batch.column(4).to_numpy(), batch.column(5).to_numpy(), share)
                yield batch.select([0, 1]).filter(pa.array(good))

    side = classes.select("cls", "registers", "n_shingles")
    left = side.toDF("a", "left", "n")
    right = side.toDF("b", "right", "m")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right", "n", "m").mapInArrow(
        run, "a bigint, b bigint"
    )


def verify(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose full sets have ``share`` hundredths of their union in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            same = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), share) for x, y in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(same, pa.bool_()))

    left, right = sets.toDF("a", "left"), sets.toDF("b", "right")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a bigint, b bigint"
    )


def band_rows(classes: DataFrame) -> DataFrame:
    """(key, band, cls): the classes in their band buckets."""
    width = 2 * ROWS
    part = F.expr(f"substring(registers, band * {width} + 1, {width})")
    return (
        classes.select("cls", "registers", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS // ROWS - 1))).alias("band"))
        .select("cls", "band", part.alias("part")).where(F.col("part") != F.lit(bytes(width)))
        .select(F.xxhash64("band", "part").alias("key"), "band", "cls")
    )


def bucket_members(classes: DataFrame) -> DataFrame:
    """(key, cls, band, least) of the buckets with two members or more; of buckets with the same members the first."""
    bands = band_rows(classes)
    marks = [F.bit_xor(F.xxhash64("cls", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    buckets = (
        bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("band").alias("band"), F.min("cls").alias("least"), *marks)
        .where("n > 1").groupBy("n", "mark0", "mark1").agg(F.min(F.struct("band", "key", "least")).alias("kept")).select("kept.*")
    )
    return kept_table(shuffled(bands.select("key", "cls")).join(buckets, "key"), "members")


def open_buckets(members: DataFrame, labels: DataFrame, details: DataFrame, size: int) -> DataFrame:
    """The members of buckets with several components, dealt to tasks (key, i, j) as pairs of blocks of about ``size``."""
    named = members.select("key", "band", "cls").join(shuffled(labels), "cls")
    parts = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    buckets = (
        parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("major"))
        .where("parts > 1").select(
            "key", F.col("major.comp").alias("major"),
            F.ceil((F.col("n") - F.col("major.n")) / size).cast("int").alias("p"),
            F.ceil(F.col("major.n") / size).cast("int").alias("q"),
        )
    )
    # Blocks 0 to p-1 hold the others, p to p+q-1 the largest component.
    slot = F.xxhash64("cls")
    block = F.when(F.col("comp") == F.col("major"), F.col("p") + F.pmod(slot, F.col("q"))).otherwise(F.pmod(slot, F.col("p")))
    partners = F.when(F.col("block") < F.col("p"), F.sequence(F.lit(0), F.col("p") + F.col("q") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("p") - 1)
    )
    return (
        named.join(buckets, "key").withColumn("block", block.cast("int"))
        .withColumn("partner", F.explode(partners)).where("block <> partner")
        .select("key", F.least("block", "partner").alias("i"), F.greatest("block", "partner").alias("j"),
                "band", "block", "p", "cls", "comp")
        .join(details, "cls")
    )


PAIRS = 1 << 17


def pair_chunks(first: int, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows ``first`` to ``first + n - 1``, at most about ``PAIRS`` at a time."""
    step = max(1, PAIRS // n)
    for start in range(0, n - 1, step):
        u = np.arange(start, min(start + step, n - 1))
        count = n - 1 - u
        left = np.repeat(u, count)
        right = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + left + 1
        yield first + left, first + right


def group_candidates(frame: pd.DataFrame, cuts: list[int], share: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Candidates (key, ca, cb, estimate, u, v) of the groups between ``cuts``, u and v being rows of ``frame``."""
    regs = np.frombuffer(b"".join(frame["registers"]), np.uint16).reshape(-1, BUCKETS)
    key, band, n, comp, block, i, j, p = (
        frame[c].to_numpy() for c in ("key", "band", "n_shingles", "comp", "block", "i", "j", "p")
    )

    def weigh(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, ...]:
        # A block of others meets itself once, in its task with the first block of the largest component.
        meet = (block[u] != block[v]) | ((block[u] == i[u]) & (j[u] == p[u]))
        possible = 100 * np.minimum(n[u], n[v]) >= share * np.maximum(n[u], n[v])
        ok = meet & possible & (comp[u] != comp[v])
        u, v = u[ok], v[ok]
        estimate, good = passes(regs[u], regs[v], n[u], n[v], share)
        u, v, estimate = u[good], v[good], estimate[good]
        common = ((regs[u] == regs[v]).reshape(-1, BUCKETS // ROWS, ROWS).all(axis=2)) & (
            regs[u].reshape(-1, BUCKETS // ROWS, ROWS) > 0
        ).any(axis=2)
        first = common.argmax(axis=1) == band[u]
        u, v, estimate = u[first], v[first], estimate[first]
        return key[u], np.minimum(comp[u], comp[v]), np.maximum(comp[u], comp[v]), estimate, u, v

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for first, last in zip(cuts, cuts[1:]):
        for pair in pair_chunks(first, last - first):
            waiting.append(pair)
            if sum(len(u) for u, _ in waiting[-64:]) > PAIRS or len(waiting) >= 4096:
                yield weigh(*(np.concatenate(x) for x in zip(*waiting)))
                waiting = []
    if waiting:
        yield weigh(*(np.concatenate(x) for x in zip(*waiting)))


def few_candidates(frame: pd.DataFrame, cuts: list[int], share: int, most: int) -> pd.DataFrame:
    """(a, b, ca, cb) of buckets with at most ``most`` candidates for each member; of the others a row with ``key`` alone."""
    key, cls = frame["key"].to_numpy(), frame["cls"].to_numpy()
    keys, members = np.unique(key, return_counts=True)
    count = np.zeros(len(keys), np.int64)
    found = []
    for part in group_candidates(frame, cuts, share):
        at = np.searchsorted(keys, part[0])
        count += np.bincount(at, minlength=len(keys))
        few = count[at] <= most * members[at]
        found.append(tuple(x[few] for x in (at, part[1], part[2], part[4], part[5])))
    crowded = count > most * members
    at, ca, cb, u, v = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 5
    few = ~crowded[at]
    u, v = u[few], v[few]
    pairs = {"a": np.minimum(cls[u], cls[v]), "b": np.maximum(cls[u], cls[v]), "ca": ca[few], "cb": cb[few]}
    rows = [pd.DataFrame(pairs), pd.DataFrame({"key": keys[crowded]})]
    return pd.concat([r.astype("Int64") for r in rows], ignore_index=True)


def verified_links(frame: pd.DataFrame, cuts: list[int], share: int) -> pd.DataFrame:
    """(a, b): links between components, those of a forest; candidates are verified on the full sets in ``hashes``."""
    sets = [np.frombuffer(h, np.uint64) for h in frame["hashes"]]
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    links = []
    for _, ca, cb, estimate, u, v in group_candidates(frame, cuts, share):
        for k in np.argsort(-estimate, kind="stable").tolist():
            a, b = find(int(ca[k])), find(int(cb[k]))
            if a != b and linked(sets[u[k]], sets[v[k]], share):
                root[max(a, b)] = min(a, b)
                links.append((int(ca[k]), int(cb[k])))
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def linked(x: np.ndarray, y: np.ndarray, share: int) -> bool:
    """Whether two sorted sets have ``share`` hundredths of their union in common."""
    at = np.searchsorted(y, x)
    common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * common >= share * (len(x) + len(y) - common)


def by_group(tasks: DataFrame, f, schema: str) -> DataFrame:
    """``f(frame, cuts)`` on the groups (key, i, j) of ``tasks``; a task streams those dealt to it."""
    names = ["key", "i", "j"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            ids = frame[names].to_numpy()
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist()]
            if len(cuts) > 1:
                yield f(frame, cuts)
            rest = frame.iloc[cuts[-1] :].reset_index(drop=True)
        if rest is not None and len(rest):
            yield f(rest, [0, len(rest)])

    return tasks.repartition(*names).sortWithinPartitions(*names, "cls").mapInPandas(run, schema)


def decide(docs: DataFrame, share: int) -> DataFrame:
    """(id, n_shingles, component_id, comp) of (id, text) rows; a place (at) is passed on.

    ``component_id`` is the smallest identifier of a component, which others may share; ``comp`` tells components
    apart and is null for empty sets.
    """
    signed = kept_table(signatures(docs), "signatures")
    # Rows of a digest hold the same registers, so the largest is any of them.
    classes = signed.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("id"), F.max("n_shingles").alias("n_shingles"), F.max("registers").alias("registers")
    )
    classes = kept_table(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    members = bucket_members(classes)
    active = members.select("cls").distinct()
    wanted = classes.join(active, "cls", "left_semi")
    sets = kept_table(full_sets(docs, wanted.select("cls", "id", "digest")), "sets")
    wanted = kept_table(wanted.select("cls", "registers", "n_shingles"), "wanted")

    # First every member with its bucket's smallest.
    stars = members.where("cls <> least").select(F.col("least").alias("a"), F.col("cls").alias("b")).distinct()
    labels = wanted.select("cls", F.col("cls").alias("comp"))
    labels = relabel(labels, verify(screen(stars, wanted, share), sets, share))
    # Then the candidates of the buckets with few.
    tasks = open_buckets(members, labels, wanted, BLOCK)
    schema = "a bigint, b bigint, ca bigint, cb bigint, key bigint"
    found = kept_table(by_group(tasks, lambda frame, cuts: few_candidates(frame, cuts, share, CANDIDATES), schema), "candidates")
    pairs = found.where("key IS NULL").drop("key")
    links = shuffled(pairs).join(verify(pairs.select("a", "b"), sets, share), ["a", "b"])
    labels = relabel(labels, links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    # Then those of the crowded buckets, inside their tasks.
    crowded = members.join(found.where("key IS NOT NULL").select("key").distinct(), "key", "left_semi")
    tasks = open_buckets(crowded, labels, wanted.join(sets, "cls"), SET_BLOCK)
    links = by_group(tasks, lambda frame, cuts: verified_links(frame, cuts, share), "a bigint, b bigint")
    labels = relabel(labels, links)

    named = classes.select("digest", "cls", "id").join(shuffled(labels), "cls", "left")
    named = named.withColumn("comp", F.coalesce("comp", "cls"))
    least = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    named = kept_table(named.join(least, "comp").select("digest", "component_id", "comp"), "named")
    columns = [c for c in signed.columns if c in ("id", "n_shingles", "at")]
    return signed.drop("registers").join(named, "digest", "left").select(
        *columns, F.coalesce("component_id", "id").alias("component_id"), "comp"
    )


def near_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: int = SHARE) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document."""
    return decide(documents_of(docs, id_column, text_column), share).select(
        F.col("id").alias(id_column), "n_shingles", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_representatives(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: int = SHARE) -> DataFrame:
    """One row of each component, that of the smallest identifier and place, and all rows of empty sets; all columns.

    Null identifiers come last.
    """
    docs = scanned(docs)
    content = located(docs, id_column, text_column).select("id", F.col("text").cast("binary").alias("text"), "at")
    decided = kept_table(decide(content, share).where("n_shingles > 0").select("id", "at", "comp"), "decided")
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "at")
    first = decided.groupBy("comp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").select("comp", F.col("first.at").alias("stays"))
    return without(docs, decided.join(first, "comp").where("at <> stays").select("at"))


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Component labels (cls, comp) after links (a, b) between components."""
    merged = components(links).select(F.col("id").alias("comp"), F.col("component").alias("to"))
    return kept_table(
        labels.join(merged, "comp", "left").select("cls", F.coalesce("to", "comp").alias("comp")), "labels"
    )


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(read(spark, folder, "documents"))


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
steps AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION SELECT r.id, s.y FROM reached r JOIN steps s ON s.x = r.other),
parts AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN parts ON parts.id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""
