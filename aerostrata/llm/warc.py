"""Merkle fixity audit of WARC archives.

Pages become WARC records; records lie in files by ranges of ``PER_FILE`` identifiers, in the order of identifier and hash, and each
replica has its own offsets. A leaf is the hash of a record's hash and of its offset range in its file; leaves are hashed by
ranges of ``FANOUT`` in order together with the range of bytes they cover, up to one digest per file, and files likewise
up to the roots, as one table per level. Two replicas are compared from the roots down, and below them only the children
of nodes that differ are read, so a replica that is whole costs one comparison. The records of the identifiers found there are matched
by identifier and number: a record is changed, lost, added, or moved if only its offsets differ, as those behind a loss in its file do.

Only hashes, lengths and identifiers are shuffled, never records; a group of the tree never has more than ``FANOUT`` rows.

Defined cases: null url and html are empty; null identifiers come first, in a file of their own; repeated rows are records
of their own, matched in order; other columns are ignored; two empty archives agree.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm.common import kept_table, read
from aerostrata.llm.ranking import numbered

FANOUT = 64
FANOUT_BITS = 6
#: Identifiers a file holds the records of.
PER_FILE = 64


def record(id_column: str, url_column: str, html_column: str) -> Column:
    """The text of a page's WARC record."""
    url, html = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (url_column, html_column))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"),
    )


def records_of(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(id, record) of every page."""
    return pages.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), record(id_column, url_column, html_column).alias("record")
    )


def index(records: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """(id, file, n, start, end, digest, copy) of every record: its file, place and byte range there, and its number among those of its id.

    Records are hashed where they lie. Places and offsets come from ranges of the order, so a file or an identifier that holds a
    third of all records is no single group.
    """
    file = F.floor(F.col("id") / per_file) - F.when(F.col("id") < 0, 1).otherwise(0)
    hashed = records.select(
        "id", F.coalesce(file, F.lit(-1)).cast("bigint").alias("file"),
        F.octet_length("record").cast("bigint").alias("length"), F.sha2("record", 256).alias("digest"),
    )
    order = [F.col("file"), F.col("id").asc_nulls_first(), F.col("digest"), F.col("length")]
    placed = kept_table(numbered(kept_table(hashed, "hashes"), order, sum_of="length"), "places")
    files = placed.groupBy("file").agg(F.min("place").alias("first"), F.min("before").alias("base"))
    ids = placed.groupBy(F.col("id").alias("id2")).agg(F.min("place").alias("first_copy"))
    found = placed.join(files, "file").join(ids, F.col("id").eqNullSafe(F.col("id2")))
    start = F.col("before") - F.col("base")
    return kept_table(
        found.select(
            "id", "file", (F.col("place") - F.col("first")).alias("n"), start.alias("start"), (start + F.col("length")).alias("end"),
            "digest", (F.col("place") - F.col("first_copy")).alias("copy"),
        ),
        "index",
    )


def depth(*indexes: DataFrame) -> tuple[int, int]:
    """(levels within files, levels above them) of the larger replica."""
    tops = [i.agg(F.max("n").alias("n"), F.max(F.abs("file")).alias("file")).first() for i in indexes]
    return _levels(max(t.n or 0 for t in tops) + 1), _levels(max(t.file or 0 for t in tops) + 1)


def _levels(n: int) -> int:
    return max(1, ceil(log(max(2, n), FANOUT) - 1e-9))


def tree(records: DataFrame, levels: tuple[int, int]) -> list[DataFrame]:
    """Tables (file, n, start, end, digest) from the leaves up to the roots; above files ``file`` is a group of them."""
    leaf = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in ("start", "end", "digest")]), 256)
    tables = [kept_table(records.select("file", "n", "start", "end", leaf.alias("digest")), "leaves")]
    for level in range(sum(levels)):
        ordered = F.sort_array(F.collect_list(F.struct("file", "n", "start", "end", "digest")))
        parents = tables[-1].groupBy(*_parent(level, levels)).agg(
            F.min("start").alias("start"), F.max("end").alias("end"), ordered.alias("children")
        )
        parts = F.transform("children", lambda c: F.concat_ws("|", *[c[x].cast("string") for x in ("file", "n", "start", "end", "digest")]))
        tables.append(kept_table(parents.select("file", "n", "start", "end", F.sha2(F.concat_ws(";", parts), 256).alias("digest")), "nodes"))
    return tables


def _parent(level: int, levels: tuple[int, int]) -> tuple[Column, Column]:
    """File and number of a node's parent."""
    if level < levels[0]:
        return F.col("file").alias("file"), F.shiftright("n", FANOUT_BITS).alias("n")
    return F.shiftright("file", FANOUT_BITS).alias("file"), F.lit(0).cast("bigint").alias("n")


def differing_leaves(primary: list[DataFrame], replica: list[DataFrame], levels: tuple[int, int]) -> DataFrame:
    """(file, n) of the leaves on which two trees of equal depth differ."""
    found = None
    for level in range(sum(levels), -1, -1):
        sides = []
        for tables, digest in ((primary, "ours"), (replica, "theirs")):
            nodes = tables[level]
            if found is not None:
                above = nodes.select("*", *[c.alias(f"up_{x}") for c, x in zip(_parent(level, levels), ("file", "n"))])
                nodes = above.join(found.toDF("up_file", "up_n"), ["up_file", "up_n"], "left_semi")
            sides.append(nodes.select("file", "n", F.col("digest").alias(digest)))
        both = sides[0].join(sides[1], ["file", "n"], "full_outer")
        found = kept_table(both.where(~F.col("ours").eqNullSafe(F.col("theirs"))).select("file", "n"), "differing")
    return found


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """What differs between two replicas' indexes: (id, copy, damage, start, end, digest, found_start, found_end, found).

    ``damage`` is changed, moved, lost (only the primary has the record) or added (only the replica has it).
    """
    levels = depth(primary, replica)
    leaves = differing_leaves(tree(primary, levels), tree(replica, levels), levels)
    # All records of the identifiers found there, as one of several equal records may stand where another one stood.
    ids = [i.join(leaves, ["file", "n"], "left_semi").select(F.col("id").alias("there")) for i in (primary, replica)]
    ids = ids[0].union(ids[1]).distinct()
    ours, theirs = (i.join(ids, F.col("id").eqNullSafe(F.col("there")), "left_semi") for i in (primary, replica))
    ours = ours.select("id", "copy", "start", "end", "digest", F.lit(True).alias("here"))
    theirs = theirs.select(
        F.col("id").alias("id2"), F.col("copy").alias("copy2"), F.col("start").alias("found_start"),
        F.col("end").alias("found_end"), F.col("digest").alias("found"), F.lit(True).alias("there"),
    )
    both = ours.join(theirs, F.col("id").eqNullSafe(F.col("id2")) & (F.col("copy") == F.col("copy2")), "full_outer")
    damage = (
        F.when(F.col("there").isNull(), "lost").when(F.col("here").isNull(), "added")
        .when(F.col("digest") != F.col("found"), "changed").otherwise("moved")
    )
    moved = (F.col("start") != F.col("found_start")) | (F.col("end") != F.col("found_end"))
    return both.where((damage != "moved") | moved).select(
        F.coalesce("id", "id2").alias("id"), F.coalesce("copy", "copy2").alias("copy"), damage.alias("damage"), "start", "end",
        "digest", "found_start", "found_end", "found",
    )


def damaged(records: DataFrame) -> DataFrame:
    """Records of a replica with damage that depends on the identifiers alone: a changed character, a lost half, a lost record, a repeated one."""
    bucket = F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), 1, 2)
    middle = (F.length("record") / 2).cast("int") + 1
    there = F.substring("record", middle, F.lit(1))
    changed = F.concat(
        F.substring("record", F.lit(1), middle - 1), F.when(there == "~", "!").otherwise("~"), F.substring("record", middle + 1, F.length("record"))
    )
    text = F.when(bucket == "00", changed).when(bucket == "01", F.substring("record", F.lit(1), middle - 1)).otherwise(F.col("record"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(bucket == "03", 2).otherwise(1))).alias("time")
    return records.where(bucket != "02").select("id", text.alias("record"), times).drop("time")


def op7_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Damage found in a replica of the archive of all pages: where it is and what was there."""
    records = records_of(read(spark, folder, "pages"))
    found = audit(index(records), index(damaged(records)))
    return found.select(
        F.col("id").alias("page_id"), "damage", F.col("start").alias("record_start"), F.col("end").alias("record_end"),
        F.col("digest").alias("sha256"), "found_start", "found_end", F.col("found").alias("found_sha256"),
    )


OP7_SQL = r"""
WITH records AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record,
    substr(md5(page_id::VARCHAR), 1, 2) AS bucket
  FROM pages),
copies AS (
  SELECT page_id, bucket, record, length(record) // 2 + 1 AS m, unnest(CASE bucket WHEN '02' THEN [] WHEN '03' THEN [1, 2] ELSE [1] END)
  FROM records),
replica AS (
  SELECT page_id, CASE bucket
      WHEN '00' THEN substr(record, 1, m - 1) || CASE substr(record, m, 1) WHEN '~' THEN '!' ELSE '~' END || substr(record, m + 1)
      WHEN '01' THEN substr(record, 1, m - 1) ELSE record END AS record
  FROM copies),
hashed AS (
  SELECT 1 AS side, page_id, strlen(record) AS bytes, sha256(record) AS digest FROM records
  UNION ALL SELECT 2, page_id, strlen(record), sha256(record) FROM replica),
numbered AS (SELECT *, row_number() OVER (PARTITION BY side, page_id ORDER BY digest) AS copy FROM hashed),
placed AS (
  SELECT side, page_id, digest, copy, bytes,
    (sum(bytes) OVER (PARTITION BY side, page_id // 64 ORDER BY page_id, copy ROWS UNBOUNDED PRECEDING))::BIGINT AS stop
  FROM numbered),
ours AS (SELECT page_id, copy, (stop - bytes)::BIGINT AS record_start, stop AS record_end, digest AS sha256 FROM placed WHERE side = 1),
theirs AS (SELECT page_id, copy, (stop - bytes)::BIGINT AS found_start, stop AS found_end, digest AS found_sha256 FROM placed WHERE side = 2)
SELECT coalesce(ours.page_id, theirs.page_id) AS page_id,
  CASE WHEN found_sha256 IS NULL THEN 'lost' WHEN sha256 IS NULL THEN 'added' WHEN sha256 <> found_sha256 THEN 'changed' ELSE 'moved' END AS damage,
  record_start, record_end, sha256, found_start, found_end, found_sha256
FROM ours FULL OUTER JOIN theirs ON ours.page_id = theirs.page_id AND ours.copy = theirs.copy
WHERE (record_start, record_end, sha256) IS DISTINCT FROM (found_start, found_end, found_sha256)
"""
