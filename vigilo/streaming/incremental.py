"""File-incremental ingestion as a Structured Streaming query.

The stream is the landing directory's file listing (``binaryFile`` without its
content, so file bodies are never read by the listing).  The file source's
checkpoint remembers which paths were offered; ``foreachBatch`` loads each
micro-batch's files through the same reader and ledger as the batch load.
``foreachBatch`` is at-least-once; a replayed micro-batch finds its files
settled in the ledger and adds nothing, and what one left that died before it
was complete is replaced.
``trigger(availableNow=True)`` drains what is there and stops, so the same code
serves scheduled and continuous runs.  The file source offers a path once: a
file replaced under its name is found by the batch load, not by the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vigilo.sinks.batches import BatchTable
from vigilo.sources.contracts import Contract
from vigilo.sources.csv import REJECTED, _options, source_file_columns
from vigilo.sources.ingest import records


# The binaryFile source's fixed schema (a stream must declare it).
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def ingest_available(
    spark: SparkSession,
    c: Contract,
    raw_dir: str,
    table: BatchTable,
    checkpoint_location: str,
    max_files_per_trigger: int = 1000,
) -> None:
    selector = (F.lower(F.element_at(F.split("path", "/"), -1)))
    wanted = selector == F.lit(c.filename.lower()) if c.filename else selector.contains(c.keyword.lower())
    listing = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(raw_dir)
        .select("path", "length", "modificationTime")
        .filter(wanted)
    )

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        # at most max_files_per_trigger rows
        files = spark.createDataFrame(batch.collect(), batch.schema)
        table.load(table.unseen(files), lambda paths: records(spark, c, paths))

    query = (
        listing.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _glob_any_case(word: str) -> str:
    return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in word)


def stream_fixed_layout(
    spark: SparkSession,
    c: Contract,
    raw_dir: str,
    target_path: str,
    checkpoint_location: str,
    max_files_per_trigger: int = 1000,
) -> None:
    """Incremental load for a source whose column layout never changes.

    ``readStream.csv`` with the contract as schema feeds the parquet file
    sink, whose own metadata log makes each file land exactly once; no
    ``foreachBatch`` is needed.  Columns are taken by position, and each header
    is checked against the contract: a file with another column order fails
    the load and must go through ``ingest_available`` instead.  Records with
    more or fewer fields go to the folder ``rejected=1`` of the sink, with
    their text in ``rejected_record``; good rows are those of ``rejected=0``.
    """
    selector = c.filename if c.filename else f"*{c.keyword}*"
    schema = T.StructType([*c.schema.fields, T.StructField(REJECTED, T.StringType(), True)])
    rows = (
        _options(spark.readStream, c.sep, c.multi_line)
        .schema(schema)
        .option("enforceSchema", "false")  # a header in another order fails the load
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _glob_any_case(selector))
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(raw_dir)
        .select("*", *source_file_columns())
        .withColumn("source_system", F.lit(c.source))
        .withColumn("ingest_ts", F.current_timestamp())
        .withColumn("rejected", F.col(REJECTED).isNotNull().cast("int"))
    )
    query = (
        rows.writeStream.format("parquet")
        .partitionBy("rejected")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
