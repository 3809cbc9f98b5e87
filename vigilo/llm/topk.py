"""Exact top-k inner products by tiled matrix products.

Vectors are whole numbers floor(scale * x).  Vectors of one dimension are dealt
by a hash of their id to shards of about ``SHARD`` rows, queries to tiles of
about ``TILE``; each tile is sent to every shard, and a task multiplies the two
matrices and keeps, per query, the k best of the shard (partial selection with
ties to the smaller id).  The lists are merged in two levels, by group of
shards and then by query.  Every query meets every row in one block product;
what a task holds is one tile, one shard and their scores.

Products are exact: in doubles while every possible sum stays under 2**53,
otherwise in 64-bit integers.

Defined results: rows without an id, and vectors that are null, or hold null or
non-finite components, take no part; rows with equal ids count once, with the
smallest vector; vectors of different lengths have no product; ties go to the
smaller vec_id; a query with fewer candidates than k gets all; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilo.llm.common import ship, stored

K = 20
SCALE = 64
SHARD = 4096
TILE = 1024
MERGE = 16


def whole_numbers(embedding: str | Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null if any is null or not finite."""
    col = F.col(embedding) if isinstance(embedding, str) else embedding
    big = F.lit(float("inf"))
    fine = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < big))
    return F.when(fine, F.transform(col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def best(scores, ids, k: int):
    """Positions of the k largest scores of each row, ties to the earlier column."""
    import numpy as np

    n = scores.shape[1]
    if n <= k:
        return np.argsort(-scores, axis=1, kind="stable")
    # everything over the k-th score, and the first of those equal to it
    bound = np.partition(scores, n - k, axis=1)[:, n - k, None]
    over = scores > bound
    tied = scores == bound
    take = over | (tied & (np.cumsum(tied, axis=1) <= k - over.sum(axis=1, keepdims=True)))
    at = np.nonzero(take)[1].reshape(len(scores), k)
    order = np.argsort(-np.take_along_axis(scores, at, axis=1), axis=1, kind="stable")
    return np.take_along_axis(at, order, axis=1)


def product(a, b):
    """Exact a @ b.T of int64 matrices."""
    import numpy as np

    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(dim, number of the block, its rows) of blocks of about ``size`` rows."""
    counts = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks"))  # a row per length
    dealt = rows.join(F.broadcast(counts), "dim").withColumn(name, F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    return dealt.groupBy("dim", name).agg(F.sort_array(F.collect_list(F.struct("vec_id", "v"))).alias(f"{name}_rows"))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, shard: int = SHARD, tile: int = TILE) -> DataFrame:
    """(query_id, rank, vec_id, score); ``vectors`` has vec_id and whole-number v."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def matrix(block):
            ids = np.asarray(block.values.field("vec_id"))[block.offsets[0].as_py() : block.offsets[-1].as_py()]
            flat = block.flatten().field("v").flatten()
            return ids, np.asarray(flat).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64)

        for batch in batches:
            for i in range(batch.num_rows):
                (q_ids, q), (v_ids, v) = (matrix(batch.column(c).slice(i, 1)) for c in (1, 2))
                scores = product(q, v)
                own = q_ids[:, None] == v_ids[None, :]
                low = np.iinfo(np.int64).min
                scores[own] = low
                at = best(scores, v_ids, k)
                got = np.take_along_axis(scores, at, axis=1)
                keep = ~np.take_along_axis(own, at, axis=1)
                n = keep.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(0)[i].as_py(), n.sum()), pa.int32()), pa.array(np.repeat(q_ids, n)), pa.array(v_ids[at][keep]), pa.array(got[keep])],
                    names=["part", "query_id", "vec_id", "score"],
                )

    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = stored(rows.select(F.col("vec_id").cast("long"), "v", F.size("v").alias("dim")), "topk-vectors")
    shards = stored(_blocks(rows, shard, "shard"), "topk-shards")
    tiles = stored(_blocks(rows.filter(is_query), tile, "tile"), "topk-tiles")
    # each tile goes to every shard of its dimension
    sent = tiles.join(F.broadcast(shards.groupBy("dim").agg(F.max("shard").alias("last"))), "dim")
    sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(0), "last")))
    pairs = sent.join(shards, ["dim", "shard"]).repartition(F.xxhash64("dim", "shard", "tile")).select((F.col("shard") / MERGE).cast("int").alias("part"), "tile_rows", "shard_rows")
    lists = ship(pairs).mapInArrow(run, "part int, query_id bigint, vec_id bigint, score bigint")
    order = [F.col("score").desc(), F.col("vec_id")]
    for by in (["query_id", "part"], ["query_id"]):  # merge by group of shards, then by query
        lists = lists.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
    return lists.select("query_id", "rank", "vec_id", "score")
