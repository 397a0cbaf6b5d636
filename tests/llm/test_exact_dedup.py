"""Exact deduplication against grouping by the text itself."""

from collections import defaultdict
from hashlib import sha256

from aerostrata.llm import exact_dedup as op
from aerostrata.llm.near_dedup import keep_representatives
from aerostrata.session import session_setting, working_path

LONG = "wort " * 40_000
ROWS = [
    (1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "A"), (7, "a "), (8, LONG), (9, LONG + "x"), (10, LONG),
    (3, "a"), (None, "b"), (None, "only"), (11, "é"), (12, "é"),
]


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        known = [x for x in groups[t or ""] if x is not None]
        out.append((i, max(known) if known else None, len(groups[t or ""]), sha256((t or "").encode()).hexdigest()))
    return sorted(map(str, out))


def test_decisions(documents):
    found = op.exact_dedup(documents(*ROWS)).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in found) == expected(ROWS)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({t or "" for _, t in ROWS}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_unequal_texts_of_one_digest_stay_apart(documents):
    rows = [(i, f"text {i // 2}") for i in range(80)]
    found = op.decide(documents(*rows), "doc_id", "text", digest_bits=4).collect()
    assert {(r.id, r.keep_id, r.group_size) for r in found} == {(i, i | 1, 2) for i in range(80)}


def test_the_filter_of_hits_lets_go_of_single_texts_only(spark, documents):
    rows = [(i, f"text {i}" if i % 10 else f"text {i // 100}") for i in range(2000)]
    content = op.digested(op.located(documents(*rows), "doc_id", "text"), 256)
    hits = content.groupBy("digest").count().where("count > 1")
    members = {r.id for r in content.join(hits, "digest").collect()}
    found = {r.id for r in op.among(content, hits).collect()}
    assert members <= found and len(found) < len(members) + 20
    assert op.among(content, hits.limit(0)).count() == 0
    # A bitmap that is full lets all through, and the decisions are the same.
    few = op.decide(documents(*rows), "doc_id", "text", filter_bits=3).collect()
    many = op.decide(documents(*rows), "doc_id", "text").collect()
    assert {(r.id, r.keep_id, r.group_size) for r in few} == {(r.id, r.keep_id, r.group_size) for r in many}
    assert sum(r.keep_id == r.id for r in many) == len({t for _, t in rows})


def test_state_grows_over_batches_and_restarts(spark, documents):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    content = op.located(documents(*rows).repartition(6), "doc_id", "text")
    feed = op.digest_feed(content)
    checkpoint = working_path(spark, "state")
    with session_setting(spark, "spark.sql.streaming.stateStore.providerClass", op.ROCKSDB):
        op.fold_state(feed, checkpoint, max_files=1)
        states = op.fold_state(feed, checkpoint, max_files=1).collect()  # nothing new: the same states
    assert {(r["last"].id, r.copies) for r in states} == {(max(range(k, 60, 7)), len(range(k, 60, 7))) for k in range(7)}


def test_kept_rows_have_all_columns(documents):
    docs = documents(*ROWS)
    kept = op.keep_first_copies(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert sorted(str(r.text or "") for r in kept.collect()) == sorted({t or "" for _, t in ROWS})


def test_empty_table(documents):
    empty = documents((1, "a")).limit(0)
    assert op.exact_dedup(empty).count() == 0 and op.keep_first_copies(empty).count() == 0


def test_a_column_named_as_the_files_metadata(spark, documents):
    """In memory and as a file."""
    docs = documents(*ROWS).withColumn("_metadata", op.F.lit("mine"))
    path = working_path(spark, "named")
    docs.write.parquet(path)
    for frame in (docs, spark.read.parquet(path)):
        found = op.exact_dedup(frame).collect()
        assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in found) == expected(ROWS)
        kept = op.keep_first_copies(frame)
        assert kept.columns == docs.columns and {r._metadata for r in kept.collect()} == {"mine"}
        near = keep_representatives(frame)
        assert near.columns == docs.columns and near.count() <= len(ROWS)
