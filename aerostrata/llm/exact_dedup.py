"""Exact deduplication by a keyed streaming state that never expires.

A stream of (digest, identifier, locator) rows is folded into one state row per digest, held on disk
by the RocksDB store with its change log in the shared folder. The state keeps the digest, the
identifier that stays and the locator of its content (file and row), but no text. Digests that
are hit again are checked on full bytes: their contents are read once more and grouped by the text
itself, after a combine in each task. A bitmap of fixed size holds the digests that were hit, so this
second scan lets go of nearly all texts that have no copy before they are shuffled; what it lets
through without need is a group of its own and changes nothing.

Defined cases: null text equals empty text; of equal texts the largest identifier stays, null
identifiers come last, and among repeated identifiers the one with the largest locator stays; other
columns are ignored, so they may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm.common import kept_table, read
from aerostrata.session import ROCKSDB, session_setting, working_path

BATCH_BYTES = 64 << 30
#: 16 MB, whatever the corpus holds; at 13 million digests that were hit it lets one text of ten through.
FILTER_BITS = 1 << 27
LOCATOR = "struct<file:string,row:bigint>"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Each store would reserve megabytes of disk for its logs, however small it is.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def located(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text, at) with the place of each row; frames that are no file scan are written first."""
    docs = scanned(docs)
    return docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
        place(docs).alias("at"),
    )


def place(docs: DataFrame) -> Column:
    """File and row of a scanned row, also where a column of the data is named as the scan's metadata."""
    metadata = docs.metadataColumn("_metadata")
    return F.struct(metadata["file_path"].alias("file"), metadata["row_index"].alias("row"))


def digest_feed(content: DataFrame, digest_bits: int = 256) -> DataFrame:
    """(digest, id, at) of every row, written once; ``digest_bits`` shorter than 256 is for tests."""
    return kept_table(digested(content, digest_bits).select("digest", "id", "at"), "digests")


def fold_state(feed: DataFrame, checkpoint: str, batch_bytes: int = BATCH_BYTES, max_files: int | None = None) -> DataFrame:
    """Run the stream over all files of the feed; the newest state row of each digest.

    ``checkpoint`` holds the state: a later call with the same folder goes on from it, also with
    further files. A batch that runs twice rewrites its own folder.
    """
    spark = feed.sparkSession
    [folder] = {f.rpartition("/")[0] for f in feed.inputFiles()}
    log = f"{checkpoint}/states"
    reader = spark.readStream.schema(feed.schema).option("maxBytesPerTrigger", str(batch_bytes))
    if max_files:
        reader = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", max_files)
    states = (
        reader.parquet(folder)
        .groupBy("digest")
        .agg(F.max(F.struct("id", "at")).alias("last"), F.count(F.lit(1)).alias("copies"))
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.where("copies > 1").write.mode("overwrite").parquet(f"{log}/batch={number}")

    query = (
        states.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{checkpoint}/query")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = f"digest string, last struct<id:bigint,at:{LOCATOR}>, copies bigint, batch bigint"
    if not _exists(spark, log):
        return spark.createDataFrame([], schema).drop("batch")
    # Identifier and count only grow, so the largest of each is the newest.
    return (
        spark.read.schema(schema).parquet(log).groupBy("digest")
        .agg(F.max("last").alias("last"), F.max("copies").alias("copies"))
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def digested(content: DataFrame, digest_bits: int) -> DataFrame:
    return content.withColumn("digest", F.substring(F.sha2(F.col("text"), 256), 1, digest_bits // 4))


def among(rows: DataFrame, hits: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """All ``rows`` whose digest is one of ``hits``, and those others that share its bit; no shuffle of ``rows``."""
    place = F.pmod(F.xxhash64("digest"), F.lit(filter_bits))
    bits = (
        hits.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    bit = F.bitmap_bit_position(place)
    byte = F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1
    return rows.join(F.broadcast(bits), (F.bitmap_bucket_number(place) == F.col("part")) & is_set, "left_semi")


def decide(
    docs: DataFrame, id_column: str, text_column: str, digest_bits: int = 256, max_files: int | None = None,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per row of ``docs``: id, at, keep_id, keep_at, group_size, digest."""
    spark = docs.sparkSession
    content = located(docs, id_column, text_column)
    feed = digest_feed(content, digest_bits)
    if not feed.inputFiles():
        return feed.select("id", "at", F.col("id").alias("keep_id"), F.col("at").alias("keep_at"),
                           F.lit(1).cast("bigint").alias("group_size"), "digest")
    settings = [session_setting(spark, k, v) for k, v in STATE_SETTINGS.items()]
    for s in settings:
        s.__enter__()
    try:
        states = fold_state(feed, working_path(spark, "dedup"), max_files=max_files)
    finally:
        for s in reversed(settings):
            s.__exit__(None, None, None)
    hits = kept_table(states, "hits")
    # All members of hit digests, with their full bytes.
    texts = among(digested(content, digest_bits), hits, filter_bits)
    groups = kept_table(
        texts.groupBy("digest", "text").agg(F.max(F.struct("id", "at")).alias("last"), F.count(F.lit(1)).alias("copies"))
        .select("digest", F.sha2("text", 512).alias("full"), "last", "copies"),
        "groups",
    )
    # Equal digests of unequal bytes (never seen with 256 bits) are told apart by the bytes' groups.
    mixed = kept_table(groups.groupBy("digest").count().where("count > 1").select("digest"), "mixed")
    plain = groups.join(mixed, "digest", "left_anti").select("digest", "last", "copies")
    decided = feed.join(mixed, "digest", "left_anti").join(plain, "digest", "left")
    decided = decided.select("digest", "id", "at", "last", "copies")
    if not mixed.isEmpty():
        split = texts.join(mixed, "digest", "left_semi").select("digest", "id", "at", F.sha2("text", 512).alias("full"))
        split = split.join(groups, ["digest", "full"]).select("digest", "id", "at", "last", "copies")
        decided = decided.unionByName(split)
    return decided.select(
        "id", "at",
        F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("last.at", "at").alias("keep_at"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("group_size"),
        "digest",
    )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Decision per document: id, keep_id, group_size, kept, text_sha256."""
    return decide(docs, id_column, text_column).select(
        F.col("id").alias(id_column), "keep_id", "group_size",
        (F.col("at") == F.col("keep_at")).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have a place in files, else a written copy that has."""
    try:
        docs.select(place(docs))
    except AnalysisException:  # no file metadata below this frame
        return kept_table(docs, "content")
    return docs


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of scanned ``docs`` at other places than those of ``gone`` (at), with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, place(docs).alias("at")).join(gone, "at", "left_anti").select("row.*")


def keep_first_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = scanned(docs)
    return without(docs, decide(docs, id_column, text_column).where("at <> keep_at").select("at"))


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(read(spark, folder, "documents"))


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
