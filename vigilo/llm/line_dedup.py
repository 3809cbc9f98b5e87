"""Line deduplication by content-defined line chunks.

A rolling hash over the hashes of ``WINDOW`` lines makes the first of them a
border where it is 0 modulo ``DIVISOR``; so are a text's first and last line.
Blank lines are never borders and count for no window.  A chunk runs from a
border to the next one, both lines included.  A border depends on the
lines of its window alone, so a passage is cut alike wherever it stands.
With ``DIVISOR`` 1, the default, every window is a chunk: only then is a
passage of two lines always found, and a longer one found to its last line
(neighbouring chunks share a line).  A larger divisor makes fewer rows and finds
passages that hold two borders.

Rows of the index are a chunk's hash and place, without text.  Places of hashes
that occur more than once are brought back to their documents, where the text of
those chunks alone is cut out and compared byte by byte (grouped by hash and
text, combined map-side); of equal chunks the first, by (doc_id, file, row,
position), stays and the lines of the others are removed.  Every join is on the
hash or on the document, which AQE can split, so a chunk that a third of the
documents share is fine.

Defined results: null text is empty text; lines end at \\n and keep all other
bytes; a document may lose all its lines (its text is then empty) but not its
row; of repeated rows the first keeps its lines; null ids come last; an empty
table gives an empty result; other columns are carried by
``drop_repeated_chunks`` and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from vigilo.llm.common import ship, stored

WINDOW = 2
DIVISOR = 1


def cut_lines(lines: list[bytes], divisor: int = DIVISOR, window: int = WINDOW) -> list[tuple[int, int]]:
    """(first line, number of lines) of the chunks of a text."""
    import xxhash

    full = [i for i, line in enumerate(lines) if line.strip()]
    borders = full
    if divisor > 1:
        prime, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
        out, rolling, hashes = pow(prime, window, 1 << 64), 0, [xxhash.xxh64_intdigest(lines[i]) for i in full]
        borders = full[:1]
        for k, h in enumerate(hashes):
            rolling = (rolling * prime + h - (hashes[k - window] * out if k >= window else 0)) & mask
            mixed = (rolling ^ (rolling >> 29)) * 0xBF58476D1CE4E5B9 & mask
            if k >= window and (mixed >> 32) % divisor == 0:
                borders.append(full[k - window + 1])
        if full and borders[-1] != full[-1]:
            borders.append(full[-1])
    return [(a, b - a + 1) for a, b in zip(borders, borders[1:])]


def _digest(chunk: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(chunk)


def chunks_of(rows: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """(file, row, first, lines, hash) of the chunks of located rows."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]

        def batch_of(batch, found):
            at, *cols = (pa.array(c, k) for c, k in zip(zip(*found), kinds))
            return pa.RecordBatch.from_arrays([*batch.take(at).columns, *cols], names=["file", "row", "first", "lines", "hash"])

        for batch in batches:
            texts, places, found = batch.column(2).cast(pa.large_binary()), batch.select([0, 1]), []
            for at in range(batch.num_rows):
                lines = (texts[at].as_py() or b"").split(b"\n")
                found += [(at, first, n, _digest(b"\n".join(lines[first : first + n]))) for first, n in cut_lines(lines, divisor)]
                if len(found) > 1 << 17:
                    yield batch_of(places, found)
                    found = []
            if found:
                yield batch_of(places, found)

    return ship(rows.select("file", "row", "text")).mapInArrow(run, "file string, row bigint, first int, lines int, hash binary")


def _chunk_texts(rows: DataFrame) -> DataFrame:
    """(file, row, doc_id, first, lines, hash, text) of the chunks listed in
    each row's ``hits``."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string()]

        def batch_of(batch, found):
            at, *cols = (pa.array(c, k) for c, k in zip(zip(*found), kinds))
            return pa.RecordBatch.from_arrays([*batch.take(at).columns, *cols], names=["file", "row", "doc_id", "first", "lines", "hash", "text"])

        for batch in batches:
            texts, places, found, size = batch.column(3).cast(pa.large_binary()), batch.select([0, 1, 2]), [], 0
            for at in range(batch.num_rows):
                lines = (texts[at].as_py() or b"").split(b"\n")
                for first, n, digest in zip(*(batch.column("hits")[at].values.field(i).to_pylist() for i in range(3))):
                    chunk = b"\n".join(lines[first : first + n])
                    found.append((at, first, n, digest, chunk.decode("utf-8")))
                    size += len(chunk) + 64
                if size > 8 << 20:
                    yield batch_of(places, found)
                    found, size = [], 0
            if found:
                yield batch_of(places, found)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("file", "row", "doc_id", "text", "hits").mapInArrow(run, f"file string, row bigint, doc_id {kind}, first int, lines int, hash binary, text string")


def repeated_chunks(rows: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """(file, row, removed) of rows that lose chunks; ``removed`` is an array of
    (first, lines)."""
    chunks = stored(chunks_of(rows, divisor), "line-chunks")
    often = chunks.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash")
    hits = chunks.join(often, "hash", "left_semi").groupBy("file", "row").agg(F.sort_array(F.collect_list(F.struct("first", "lines", "hash"))).alias("hits"))
    # hits and removed chunks grow with the corpus: sorted joins at any size, no broadcast
    again = stored(_chunk_texts(rows.join(hits.hint("merge"), ["file", "row"])), "line-texts")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row", "first")
    equal = again.groupBy("hash", "text").agg(F.min(place).alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash", F.md5("text").alias("own"), "keeper")
    placed = again.select("file", "row", "first", "lines", "hash", F.md5("text").alias("own"), place.alias("place"))
    gone = placed.join(equal, ["hash", "own"]).filter(~F.col("place").eqNullSafe(F.col("keeper")))
    return gone.groupBy("file", "row").agg(F.sort_array(F.collect_list(F.struct("first", "lines"))).alias("removed"))


def _without(text: Column, removed: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    inside = lambda i: F.exists(removed, lambda r: (i >= r["first"]) & (i < r["first"] + r["lines"]))
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    kept = F.transform(F.filter(numbered, lambda p: ~inside(p["i"])), lambda p: p["x"])
    return F.when(F.size(removed) > 0, F.array_join(kept, "\n")).otherwise(F.coalesce(text, F.lit("")))


def _with_removed(docs: DataFrame) -> DataFrame:
    """(doc, file, row, removed): every row and the chunks it loses."""
    content = docs
    try:
        docs.select("_metadata.file_path")
    except AnalysisException:
        content = stored(docs, "line-content")
    rows = content.select(F.struct("*").alias("doc"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    gone = stored(repeated_chunks(rows.select("file", "row", "doc.doc_id", "doc.text")), "line-removed")
    none = F.array().cast(gone.schema["removed"].dataType)
    return rows.join(gone.hint("merge"), ["file", "row"], "left").withColumn("removed", F.coalesce("removed", none))


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, removed_chunks, removed_lines, removed, clean_chars,
    clean_sha256 of every row."""
    rows = _with_removed(docs).select("doc.doc_id", "doc.text", "removed", _without(F.col("doc.text"), F.col("removed")).alias("clean"))
    return rows.select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("removed_chunks"),
        # chunks share lines
        F.size(F.array_distinct(F.flatten(F.transform("removed", lambda r: F.sequence(r["first"], r["first"] + r["lines"] - 1))))).cast("long").alias("removed_lines"),
        "removed",
        F.length("clean").cast("long").alias("clean_chars"),
        F.sha2("clean", 256).alias("clean_sha256"),
    )


def drop_repeated_chunks(docs: DataFrame) -> DataFrame:
    """All rows and columns, with repeated chunks taken out of ``text``."""
    rows = _with_removed(docs)
    return rows.withColumn("doc", F.col("doc").withField("text", _without(F.col("doc.text"), F.col("removed")))).select("doc.*")
