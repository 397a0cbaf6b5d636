"""The audit finds exactly the damage done."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aerostrata.llm import warc as op

SCHEMA = "page_id bigint, url string, html string, node string, record string, file int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "", "", 1) for r in rows], SCHEMA)


ROWS = [(i, f"http://x/{i}", f"<p>{i} é</p>" * (i % 9)) for i in range(300)]
ODD = [(None, "u", "h"), (None, "u", "h"), (-3, "u", "h"), (7, None, None), (7, "http://x/7", "<p>7 é</p>" * 7), (500, "u", "long " * 50_000)]


@pytest.fixture(scope="module")
def records(spark):
    return op.records_of(pages(spark, ROWS + ODD).repartition(3)).cache()


def placed(rows):
    """Plain index: {(id, copy): (start, end, digest)} of (id, record) rows."""
    files = defaultdict(list)
    for i, text in rows:
        files[-1 if i is None else i // 64 - (i < 0)].append((i is not None, i or 0, hashlib.sha256(text.encode()).hexdigest(), text))
    found = {}
    for file in files.values():
        at = 0
        for there, i, digest, text in sorted(file):
            key = i if there else None
            copy = sum(k == key for k, _ in found)
            found[key, copy] = (at, at + len(text.encode()), digest)
            at += len(text.encode())
    return found


def plain(ours, theirs):
    a, b = placed(ours), placed(theirs)
    out = []
    for key in a.keys() | b.keys():
        x, y = a.get(key), b.get(key)
        if x != y:
            damage = "lost" if y is None else "added" if x is None else "changed" if x[2] != y[2] else "moved"
            out.append((*key, damage, *(x or (None,) * 3), *(y or (None,) * 3)))
    return sorted(out, key=str)


def rows_of(df):
    return [(r.id, r.record) for r in df.collect()]


@pytest.fixture(scope="module")
def primary(records):
    return op.index(records)


def test_index_has_no_gaps(records, primary):
    found = primary.collect()
    assert {(r.id, r.copy): (r.start, r.end, r.digest) for r in found} == placed(rows_of(records))
    for file in {r.file for r in found}:
        assert sorted(r.n for r in found if r.file == file) == list(range(sum(r.file == file for r in found)))


def mixed(r):
    """Records that are lost, longer, repeated, added beyond all others, or moved to another identifier."""
    text = F.when(F.col("id").isin(40, 299), F.concat("record", F.lit("x"))).otherwise(F.col("record"))
    r = r.where("id IS NULL OR id NOT IN (11, 500, 7)").withColumn("record", text)
    r = r.withColumn("id", F.when(F.col("id") == 20, 130).otherwise(F.col("id")))
    return r.unionByName(r.where("id = 100 OR id IS NULL")).unionByName(r.limit(1).selectExpr("5000000000 AS id", "'new' AS record"))


REPLICAS = {
    "equal": lambda r: r,
    "all lengths differ": lambda r: r.withColumn("record", F.concat("record", F.lit("1234567"))),
    "mixed": mixed,
    "damaged": op.damaged,
    "nothing left": lambda r: r.limit(0),
}


@pytest.mark.parametrize("bits, name", [*((6, n) for n in REPLICAS), (2, "mixed")])
def test_damage_is_located(records, primary, name, bits, monkeypatch):
    monkeypatch.setattr(op, "FANOUT_BITS", bits)
    monkeypatch.setattr(op, "FANOUT", 1 << bits)
    replica = REPLICAS[name](records)
    found = op.audit(primary, op.index(replica))
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows_of(records), rows_of(replica))


def test_only_branches_that_differ_are_read(records, primary):
    """One leaf differs; no leaf of another file is compared, and none beside it is found."""
    changed = F.when(F.col("id") == 41, F.translate("record", "p", "q")).otherwise(F.col("record"))
    theirs = op.index(records.withColumn("record", changed))
    levels = op.depth(primary, theirs)
    found = op.differing_leaves(op.tree(primary, levels), op.tree(theirs, levels), levels).collect()
    assert {r.file for r in found} == {0} and 1 <= len(found) <= 2


def test_empty_archives_agree(spark):
    none = op.records_of(pages(spark, ROWS[:1]).limit(0))
    assert op.audit(op.index(none), op.index(none)).count() == 0
