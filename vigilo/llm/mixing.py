"""Mixing sources to target weights with a multivariate-hypergeometric
splitting tree.  DataFrame functions only.

1.  Targets.  Sources in code-point order (null last) weigh ``weights``,
    repeating, and share the size of the whole corpus.  A target stops at
    ``multiple`` times its source's size; the excess is reshared by weight.
    That fixed point is ``min(cap, level * weight)``, and the level follows
    from prefix sums over the sources sorted by ``cap / weight``.
2.  Blocks.  A document belongs to a block of its source by a hash of its id,
    its text and its number among rows equal in these, about ``block_docs``
    documents each, whatever ids or texts repeat.  A source whose target is ``r`` times
    its size gives each block ``floor(r)`` times, and once more the first
    blocks, in a hashed permutation, that fit in the rest.  The one block that
    fits in part gives its documents with the smallest hashes, up to ``cut``.
3.  Tree.  A node holds the number of block draws of every source.  Half of
    them go left: the draws, a row each, are ranked by a hash of the level, and
    the first half of the ranks is left, which makes the left counts of the
    sources multivariate hypergeometric and the totals exact.  The rank that
    parts the halves is found from counts of hash ranges and a sort inside one
    range, so no task ranks a whole node.  ``levels`` levels give
    ``2 ** levels`` output shards.
4.  Draws.  The draws of a source, permuted by a hash, are dealt to the shards
    in runs as long as the shards' quotas, so every draw has one shard.
5.  Rows.  A document's draws are those of its block; rows are laid out by
    shard and ordered inside it by a hash (the local shuffle).

Every choice is a hash of ids, so reruns and retried tasks agree.  What grows
with the corpus (documents) is only scanned, pre-aggregated and joined with the
block table; sources and blocks are what windows see.

Defined results: a null or blank text has size 0 and is still drawn; a null
source is a source; rows without an id, with one id or wholly alike are drawn
each by itself, and rows equal in id, source and text may stand for one another;
a source of size 0 has target 0; an empty table gives an empty result; other
columns are carried and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilo.llm.common import WORD, stored, uniform_hash

WEIGHTS = (1, 2, 3)
MULTIPLE = 3
BLOCK_DOCS = 1024
LEVELS = 4
#: Draws made from one row, and draws of one hash range, of the splitting tree.
RUN = 4096
RANGE = 1024


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: str | Column = "source") -> list[Column]:
    """A null-safe join key for a source."""
    c = F.col(source) if isinstance(source, str) else source
    return [c.isNull().alias("no_source"), F.coalesce(c, F.lit("")).alias("source_key")]


KEY = ["no_source", "source_key"]


def source_targets(sized: DataFrame, weights=WEIGHTS, multiple: int = MULTIPLE) -> DataFrame:
    """(no_source, source_key, n_docs, source_size, weight, target) of documents
    with ``source`` and ``size``."""
    sources = sized.groupBy(*_key()).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    # one row per source: windows over all of them are small
    nth = F.row_number().over(Window.orderBy(*KEY)) - 1
    sources = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (nth % len(weights) + 1).cast("int")))
    sources = sources.withColumn("cap", F.col("source_size") * multiple)
    filled = Window.orderBy(F.col("cap") / F.col("weight"), *KEY)
    before = F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(filled.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    sources = sources.withColumn("level", (F.sum("source_size").over(everything) - before) / rest).withColumn("place", F.row_number().over(filled))
    fits = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct("place", "level"))
    sources = sources.withColumn("level", F.min(fits).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return sources.select(*KEY, "n_docs", "source_size", "weight", target.alias("target"))


def _block(n_blocks: str, seed: int) -> Column:
    return F.pmod(uniform_hash(seed, "alike", "nth"), F.col(n_blocks))


def _pick(seed: int) -> Column:
    return uniform_hash(seed + 1, "alike", "nth")


def _alike() -> Column:
    """Equal for rows of one id, source and text; made in the order of these names."""
    return uniform_hash("doc_id", "text", *_key()).alias("alike")


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``alike`` and ``part`` (any split of them, fixed in a table)
    and ``nth`` in place of ``part``: 0, 1, ... among the rows of one
    ``alike``, counted inside each part and then by the parts before."""
    parts = rows.groupBy("alike", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("alike").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("alike", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("alike", "part").orderBy("alike")) - 1
    rows = rows.withColumn("inside", inside).join(parts, ["alike", "part"])
    return rows.withColumn("nth", (F.col("inside") + F.col("base")).cast("long")).drop("inside", "base", "part")


def _told_apart(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows with ``alike`` and their ``nth``; only repeated ones are shuffled."""
    alone = rows.join(repeated, "alike", "left_anti").drop("part").withColumn("nth", F.lit(0).cast("long"))
    copies = stored(rows.join(repeated, "alike", "left_semi"), "mix-copies")
    return alone.unionByName(numbered(copies))


def block_draws(sized: DataFrame, targets: DataFrame, block_docs: int, seed: int) -> DataFrame:
    """One row per block: ``base`` full draws, whether there is one ``more``, and
    the hashes of the documents that one takes (``picks``; null: all)."""
    placed = sized.select("alike", "nth", "size", *_key()).join(targets, KEY).withColumn("block", _block("n_blocks", seed))
    blocks = placed.groupBy(*KEY, "block").agg(F.sum("size").alias("block_size"))
    blocks = blocks.join(targets, KEY)
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    permuted = Window.partitionBy(*KEY).orderBy(uniform_hash(seed + 2, *KEY, "block"), "block")
    blocks = (
        blocks.withColumn("base", base)
        .withColumn("need", F.col("target") - F.col("base") * F.col("source_size"))
        .withColumn("before", F.coalesce(F.sum("block_size").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("whole", (F.col("need") > 0) & (F.col("before") + F.col("block_size") <= F.col("need")))
        .withColumn("part", ~F.col("whole") & (F.col("before") < F.col("need")))
    )
    blocks = stored(blocks.select(*KEY, "block", "base", "need", "before", "whole", "part"), "mix-blocks")
    # the one block of a source that fits in part: in hashed order, its documents that still fit
    edge = placed.join(blocks.filter("part").select(*KEY, "block", (F.col("need") - F.col("before")).alias("room")), [*KEY, "block"])
    edge = edge.groupBy(*KEY, "block", "room", _pick(seed).alias("pick")).agg(F.sum("size").alias("size"))
    edge = edge.groupBy(*KEY, "block", "room").agg(F.array_sort(F.collect_list(F.struct("pick", "size"))).alias("docs"))  # about block_docs

    def fill(state: Column, doc: Column) -> Column:
        fits = doc["size"] <= state["room"]
        return F.struct(
            (state["room"] - F.when(fits, doc["size"]).otherwise(0)).alias("room"),
            F.when(fits, F.concat(state["picks"], F.array(doc["pick"]))).otherwise(state["picks"]).alias("picks"),
        )

    none = F.array().cast("array<bigint>")
    picks = F.aggregate("docs", F.struct(F.col("room").cast("double").alias("room"), none.alias("picks")), fill, lambda s: s["picks"])
    edge = edge.select(*KEY, "block", picks.alias("picks"))
    more = F.col("whole") | F.col("part")
    return blocks.join(edge, [*KEY, "block"], "left").select(*KEY, "block", "base", more.alias("more"), F.when(F.col("part"), F.coalesce("picks", none)).alias("picks"))


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, no_source, source_key, n) from (no_source, source_key, n): the
    splitting tree, a row per draw and level; shares of 0 have no row."""
    last = F.floor((F.col("n") - 1) / RUN)
    runs = quotas.filter("n > 0").select(*KEY, "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("run"))
    one = F.sequence(F.col("run") * RUN + 1, F.least(F.col("n"), (F.col("run") + 1) * RUN))
    draws = runs.repartition("source_key", "run").select(*KEY, F.explode(one).alias("draw"), F.lit(0).cast("long").alias("node"))
    draws = stored(draws, "mix-tree")
    for level in range(levels):
        draws = stored(_halved(draws, uniform_hash(seed, level, *KEY, "draw")), "mix-tree")
    return draws.groupBy(F.col("node").alias("shard"), *KEY).agg(F.count(F.lit(1)).alias("n"))


def _halved(draws: DataFrame, hashed: Column) -> DataFrame:
    """Every node's draws moved to its two children, the larger half (in hashed
    order) left."""
    place = F.struct(F.shiftrightunsigned(hashed, 1).alias("u"), *KEY, "draw")
    nodes = draws.groupBy("node").agg(F.count(F.lit(1)).alias("total"))
    nodes = nodes.withColumn("places", F.ceil(F.col("total") / 2)).withColumn("ranges", F.ceil(F.col("total") / RANGE))
    nth = F.least(F.floor(F.col("place.u") / float(1 << 63) * F.col("ranges")), F.col("ranges") - 1)
    ranged = draws.withColumn("place", place).join(nodes, "node").withColumn("range", nth)
    counts = ranged.groupBy("node", "range", "places").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("node").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("rest", F.col("places") - F.coalesce(F.sum("n").over(before), F.lit(0)))
    edge = counts.filter((F.col("rest") > 0) & (F.col("rest") <= F.col("n"))).select("node", "range", F.col("rest").cast("int").alias("rest"))
    # about RANGE draws, as the ranges are those of a hash
    cut = ranged.join(edge, ["node", "range"]).groupBy("node", "range", "rest").agg(F.sort_array(F.collect_list("place")).alias("places"))
    cut = cut.select("node", F.col("range").alias("edge"), F.element_at("places", F.col("rest")).alias("cut"))
    left = (F.col("range") < F.col("edge")) | ((F.col("range") == F.col("edge")) & (F.col("place") <= F.col("cut")))
    return ranged.join(cut, "node").select(*KEY, "draw", (F.col("node") * 2 + F.when(left, 0).otherwise(1)).alias("node"))


def mix_plan(sized: DataFrame, weights=WEIGHTS, multiple: int = MULTIPLE, block_docs: int = BLOCK_DOCS, levels: int = LEVELS, seed: int = 8) -> tuple[DataFrame, DataFrame]:
    """(targets, blocks): per source its target, and per block its draws as
    ``draws`` array of (copy, shard, picks) -- ``picks`` null where the whole block is drawn."""
    targets = source_targets(sized, weights, multiple).withColumn("n_blocks", F.ceil(F.col("n_docs") / block_docs).cast("long"))
    targets = stored(targets, "mix-targets")
    blocks = block_draws(sized, targets, block_docs, seed)
    whole = F.transform(F.when(F.col("base") > 0, F.sequence(F.lit(1), "base")).otherwise(F.array().cast("array<int>")), lambda i: F.struct(i.alias("copy"), F.lit(None).cast("array<bigint>").alias("picks")))
    more = F.when(F.col("more"), F.array(F.struct((F.col("base") + 1).alias("copy"), "picks"))).otherwise(F.array().cast("array<struct<copy:int,picks:array<bigint>>>"))
    draws = stored(blocks.select(*KEY, "block", F.explode(F.concat(whole, more)).alias("d")).select(*KEY, "block", "d.*"), "mix-draws")
    shards = split_quotas(draws.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")), levels, seed + 3)
    run = Window.partitionBy(*KEY).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("start", F.coalesce(F.sum("n").over(run), F.lit(0)) + 1).filter("n > 0")
    shards = shards.select(*KEY, "shard", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos"))
    dealt = Window.partitionBy(*KEY).orderBy(uniform_hash(seed + 4, *KEY, "block", "copy"), "block", "copy")
    draws = draws.withColumn("pos", F.row_number().over(dealt).cast("long")).join(shards, [*KEY, "pos"])
    plan = draws.groupBy(*KEY, "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard", "picks"))).alias("draws"))
    return targets, stored(plan, "mix-plan")


def _with_draws(docs: DataFrame, targets: DataFrame, plan: DataFrame, seed: int, how: str) -> DataFrame:
    placed = docs.join(targets.drop("n_docs"), KEY).withColumn("block", _block("n_blocks", seed)).join(plan, [*KEY, "block"], how)
    mine = F.filter(F.coalesce("draws", F.array().cast(plan.schema["draws"].dataType)), lambda d: d["picks"].isNull() | F.array_contains(d["picks"], _pick(seed)))
    return placed.withColumn("draws", mine)


def measured(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, alike, nth) of documents, written once so that
    later steps do not read texts, and the ``alike`` of repeated rows."""
    part = F.spark_partition_id().alias("part")
    sized = stored(docs.select("doc_id", "source", word_count("text").alias("size"), _alike(), part), "mix-sized")
    repeated = stored(sized.groupBy("alike").count().filter("count > 1").select("alike"), "mix-repeated")
    return stored(_told_apart(sized, repeated), "mix-numbered"), repeated


def mix_counts(docs: DataFrame, seed: int = 8, **options) -> DataFrame:
    """doc_id, size, source_size, target, copies, shards, taken of every document."""
    sized, _ = measured(docs)
    targets, plan = mix_plan(sized, seed=seed, **options)
    rows = _with_draws(sized.select("doc_id", "alike", "nth", "size", *_key()), targets, plan, seed, "left")
    copies = F.size("draws")
    return rows.select("doc_id", "size", "source_size", "target", copies.alias("copies"), F.col("draws.shard").alias("shards"), (copies * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame, seed: int = 8, with_shard: bool = False, **options) -> DataFrame:
    """The rows of the mix: a document as often as it is drawn, all its columns,
    laid out by output shard and in hashed order inside a shard."""
    sized, repeated = measured(docs)
    targets, plan = mix_plan(sized, seed=seed, **options)
    rows = docs.select(F.struct("*").alias("row"), *_key(), _alike(), F.spark_partition_id().alias("part"))
    rows = _with_draws(_told_apart(rows, repeated), targets, plan, seed, "inner").select("row", "alike", "nth", F.explode("draws").alias("d"))
    place = F.pmod(uniform_hash(seed + 5, "alike", "nth", "d.copy"), F.lit(1 << 40))
    rows = rows.select("row", F.col("d.shard").alias("shard"), place.alias("place"))
    # a shard is laid out in 16 slices of its hashed order, so that no task holds a whole shard
    rows = rows.repartition("shard", F.shiftright("place", 36)).sortWithinPartitions("shard", "place")
    return rows.select("row.*", "shard") if with_shard else rows.select("row.*")
