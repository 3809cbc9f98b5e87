"""Exact deduplication as a stateful stream.

1.  Arrivals.  Texts are read once; each row becomes (id, SHA-256 of the
    normalised text, locator).  The locator names the row's file and row number.
2.  State.  A Structured Streaming aggregation keyed by digest, in RocksDB on
    the executors' disks with its log in ``spark.checkpoint.dir``, keeps per
    digest the smallest id, that row's locator, and the number of rows.  There
    is no watermark, so no key expires.  Copies are combined before the shuffle:
    a digest that a third of all rows share is one row per task.
3.  Bytes.  Rows of a digest that has been hit fetch their texts by locator, and
    the full normalised texts are compared (grouping by the text itself).  A
    digest with two texts is split by text; each gets its own kept row.

Running ``update_state`` again over a folder with more arrival files goes on
from the state (the checkpoint knows which files were read).

Defined results: null text equals empty text; of equal texts the smallest id
stays, null ids last, and of repeated rows with one id exactly one; an empty
table gives an empty result; other columns are carried by ``drop_duplicates``
and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigilo.llm.common import normalised, settings, stored
from vigilo.session import scratch_dir

#: Arrival files a micro-batch takes.
FILES_PER_BATCH = 256

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # else each of the many small stores reserves megabytes of disk for its log
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def located(docs: DataFrame, *more: str) -> DataFrame:
    """Rows with their locator (file, row).  A frame that is not read straight
    from files is stored first."""
    locator = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        return docs.select(*more, *locator)
    except AnalysisException:
        return stored(docs, "dedup-content").select(*more, *locator)


def arrivals(rows: DataFrame, path: str, key: Callable[[Column], Column] = F.unhex) -> None:
    """Append the arrival log of located rows: id, digest, state key, locator."""
    log = rows.select("doc_id", F.sha2(normalised("text"), 256).alias("text_sha256"), "file", "row")
    log.withColumn("key", key(F.col("text_sha256"))).write.mode("append").parquet(path)


def update_state(spark: SparkSession, log: str, state: str, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Run the stream over all arrivals not yet read.  ``state`` holds the
    checkpoint and, per micro-batch, the keys it touched with their new state."""
    schema = spark.read.parquet(log).schema
    holder = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    keyed = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(log)
        .groupBy("key")
        .agg(F.min(holder).alias("holder"), F.count(F.lit(1)).alias("group_size"))
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{state}/changes/{number:012d}")

    with settings(spark, STATE_STORE):
        query = keyed.writeStream.outputMode("update").foreachBatch(keep).trigger(availableNow=True).option("checkpointLocation", f"{state}/checkpoint").start()
    query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """(key, holder, group_size): the latest state of every key."""
    changes = spark.read.option("recursiveFileLookup", "true").parquet(f"{state}/changes")
    latest = changes.groupBy("key").agg(F.max_by(F.struct("holder", "group_size"), "batch").alias("s"))
    return latest.select("key", "s.*")


def exact_groups(docs: DataFrame, key: Callable[[Column], Column] = F.unhex, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """file, row, doc_id, text_sha256, keep_id, group_size, kept of every row."""
    spark = docs.sparkSession
    rows = located(docs, "doc_id", "text")
    log_path, state = scratch_dir(spark, "dedup-arrivals"), scratch_dir(spark, "dedup-state")
    arrivals(rows, log_path, key)
    log = spark.read.parquet(log_path)
    if log.isEmpty():
        none = log.select("file", "row", "doc_id", "text_sha256", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
        return none
    update_state(spark, log_path, state, files_per_batch)
    groups = stored(read_state(spark, state), "dedup-groups")

    # compare the bytes of every row of a key that was hit
    hits = log.join(groups.filter("group_size > 1").select("key"), "key", "left_semi").select("key", "file", "row")
    texts = rows.select("file", "row", "doc_id", "text").join(hits, ["file", "row"]).withColumn("content", normalised("text"))
    holder = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    variants = stored(texts.groupBy("key", F.sha2("content", 256).alias("text_sha256"), "content").agg(F.min(holder).alias("holder"), F.count(F.lit(1)).alias("group_size")).drop("content"), "dedup-variants")
    split = variants.groupBy("key").count().filter("count > 1").select("key")
    found = log.join(groups, "key")
    if not split.isEmpty():  # keys that stand for several texts
        apart = variants.join(split, "key", "left_semi").select("key", "text_sha256", F.col("holder").alias("own"), F.col("group_size").alias("own_size"))
        found = (
            found.join(apart, ["key", "text_sha256"], "left")
            .withColumn("holder", F.coalesce("own", "holder"))
            .withColumn("group_size", F.coalesce("own_size", "group_size"))
        )
    kept = (F.col("file") == F.col("holder.file")) & (F.col("row") == F.col("holder.row"))
    return found.select("file", "row", "doc_id", "text_sha256", F.col("holder.doc_id").alias("keep_id"), "group_size", kept.alias("kept"))


def drop_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with all their columns."""
    content = docs
    try:
        docs.select("_metadata.file_path")
    except AnalysisException:
        content = stored(docs, "dedup-content")
    keep = exact_groups(content, **options).filter("kept").select(F.col("file").alias("keep_file"), F.col("row").alias("keep_row"))
    rows = content.select(F.struct("*").alias("doc"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.join(keep, (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row")), "left_semi").select("doc.*")
