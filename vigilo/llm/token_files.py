"""Token-id output as Parquet list columns.

``write_tokens`` writes documents in ascending ``doc_id`` order, one row each:
``doc_id`` and ``n_tokens`` delta-encoded, the list column ``ids``
dictionary-encoded (bit-packed, as wide as the ids used), in row groups and
pages of a set size; the writer adds column and offset indexes, so a reader can
take the metadata columns alone, or the pages of a range of documents.
``read_tokens`` reads back documents or metadata, ``token_index`` gives each
document's place in the token stream from the metadata columns only.

Steps: range partitioning by ``doc_id``, a sort inside partitions, an Arrow
map that encodes batches, and Spark's own Parquet writer (any file system,
task commit protocol).  File names sort as their ranges do, so the global start
of a document is the sum of the files before plus the rows before in its file.

Defined results: a null or blank text has the end id alone; null ``doc_id``
comes first; rows with equal ids are ordered by a hash of the text; an empty
table gives an empty folder of files; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vigilo.llm.common import ship

END_ID = 2
ROW_GROUP = 32 << 20
PAGE = 64 << 10
PAGE_ROWS = 2_000


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids) per document, in the order of its rows."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from vigilo.llm.tokens import encoder

        encode = encoder(tokenizer_path)
        for batch in batches:
            at = 0
            for offsets, flat in encode.column(batch.column(1), end_id):  # a few MB of text at a time
                n = len(offsets) - 1
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view("<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(np.diff(offsets)), ids], names=["doc_id", "n_tokens", "ids"])
                at += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ship(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids array<int>")


def write_tokens(docs: DataFrame, out: str, tokenizer_path: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    key = [F.col("doc_id").asc_nulls_first()]
    rows = docs.select("doc_id", "text")
    rows = rows.repartitionByRange(partitions, *key) if partitions else rows.repartitionByRange(*key)
    rows = rows.sortWithinPartitions(*key, F.xxhash64("text"))
    (
        encode_documents(rows, tokenizer_path, end_id)
        .write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP)
        .option("parquet.page.size", PAGE)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .parquet(out)
    )


def read_tokens(spark: SparkSession, out: str, columns: list[str] | None = None, low=None, high=None) -> DataFrame:
    """Documents of the files, or of an id range (pushed down to row groups and pages)."""
    rows = spark.read.parquet(out)
    if low is not None:
        rows = rows.filter(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.filter(F.col("doc_id") <= high)
    return rows.select(*columns) if columns else rows


def token_index(spark: SparkSession, out: str) -> DataFrame:
    """(file, row, start): ids before each document, read from the metadata columns."""
    meta = spark.read.parquet(out).select("n_tokens", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = meta.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return meta.withColumn("in_file", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(files, "file").select("file", "row", (F.col("base") + F.col("in_file")).alias("start"))


def token_checksums(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, file, row, n_tokens, ids_crc32), read from the ids themselves."""

    def run(batches) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column("ids")
            offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4", copy=False)
            ends = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
            crc = [zlib.crc32(flat[a:b]) for a, b in ends]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("file"), batch.column("row"), pa.array([b - a for a, b in ends], pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "file", "row", "n_tokens", "ids_crc32"],
            )

    rows = spark.read.parquet(out).select("doc_id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, file string, row bigint, n_tokens bigint, ids_crc32 bigint")
