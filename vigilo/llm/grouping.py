"""Best-fit packing of documents by a grouping genetic algorithm.

A document's ids are one piece, or pieces of ``capacity`` ids of which the
first may be shorter.  Full pieces fill a sequence alone; the rest is packed.

**The search.**  An individual is a set of *bins* (groups of pieces), not a
string of places.  A child takes the well-filled bins of one parent whole;
bins of the other parent that share a piece with them are dissolved, which
removes the duplicates, and the displaced pieces are put back by best fit,
largest first (``crossover``).  Mutation dissolves the emptiest bins and a few
others.  Fitness is the mean of squared fills, so few full bins beat many half
full ones.

**Blocks and islands.**  Pieces are dealt by a hash of their key into blocks of
about ``BLOCK`` (more, up to ``LARGEST_BLOCK``, where they are small).  Each block is evolved on ``ISLANDS`` islands, a Spark task
each, from best-fit packings of different orders.  After every epoch the elite
of an island moves to the next one of its block (a join on block and island,
the ring); after ``EPOCHS`` the best individual of the block wins.  A block is
finished early when it meets the lower bound on its bins.  Then each block sets
aside its emptiest bins (one in ``REDUCE``, ``LOOSE`` at most), and their pieces
are dealt to new, fewer blocks, until one is left: what a block border wastes
is packed again, and no task holds more than a block.

Everything is seeded by (level, block, island, epoch), and each level's result
is stored, so a rerun and a task that is run again give the same sequences.

Defined results: a null or empty text is the end id alone; rows with equal or
null ids are packed each; an empty table gives no rows; other columns are
ignored.  ``with_ids`` adds the ids of every piece.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from vigilo.llm.common import ship, stored, uniform_hash

CAPACITY = 1024
END_ID = 2
BLOCK = 2_000
LARGEST_BLOCK = 20_000
FEWEST_BINS = 300
ISLANDS = 3
POPULATION = 6
ELITE = 2
EPOCHS = 3
CHILDREN = 12
LOOSE = 24
REDUCE = 16

#: An individual: bins, each its fill and a tuple of item indexes.
Bins = list


# ------------------------------------------------------------- the algorithm


def best_fit(sizes: list[int], items: list[int], capacity: int, bins: Bins | None = None) -> Bins:
    """Put items, in their order, into the fullest bin that has room.  Bins are
    listed by their room, and a whole number has a bit for every room there is."""
    full, rooms, bits = [], [[] for _ in range(capacity + 1)], 0
    for b in bins or []:
        rooms[capacity - b[0]].append(list(b[1]))
        bits |= 1 << (capacity - b[0])
    for item in items:
        size = sizes[item]
        fitting = bits >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            held = rooms[room].pop()
            held.append(item)
            if not rooms[room]:
                bits ^= 1 << room
        else:
            room, held = capacity, [item]
        if room > size:
            rooms[room - size].append(held)
            bits |= 1 << (room - size)
        else:
            full.append((capacity, tuple(held)))
    return full + [(capacity - room, tuple(b)) for room, bs in enumerate(rooms) for b in bs]


def fitness(bins: Bins, capacity: int) -> float:
    """Mean of squared fills; 0 for no bins."""
    return sum([b[0] * b[0] for b in bins]) / (capacity * capacity * len(bins)) if bins else 0.0


def lower_bound(sizes: list[int], capacity: int) -> int:
    """Bins that any packing needs: for each limit up to half of the capacity,
    items above capacity - limit stand alone, those above half apart, and what
    is at least the limit has to fit into the room they leave."""
    count = [0] * (capacity + 1)
    for s in sizes:
        count[s] += 1
    half = capacity // 2
    best = -(-sum(sizes) // capacity)
    alone, big, big_sum, small = 0, sum(count[half + 1 :]), sum(s * count[s] for s in range(half + 1, capacity + 1)), 0
    small_from = [0] * (half + 2)  # sum of sizes in [limit, half]
    for s in range(half, 0, -1):
        small_from[s] = small_from[s + 1] + s * count[s]
    for limit in range(1, half + 1):
        s = capacity - limit + 1
        if s > half:
            alone += count[s]
            big -= count[s]
            big_sum -= s * count[s]
        small = small_from[limit] - (big * capacity - big_sum)
        best = max(best, alone + big + max(0, -(-small // capacity)))
    return best


def crossover(sizes: list[int], giver: Bins, taker: Bins, capacity: int, rng: random.Random) -> Bins:
    """The giver's well-filled bins, the taker's bins without any of their
    items, and the displaced items by best fit."""
    order = sorted(giver, key=lambda b: (-b[0], rng.random()))
    given = order[: max(1, int(len(giver) * rng.uniform(0.2, 0.7)))]
    held = {i for b in given for i in b[1]}
    kept, displaced = given, []
    for b in taker:
        if held.isdisjoint(b[1]):
            kept.append(b)
        else:
            displaced += [i for i in b[1] if i not in held]
    displaced.sort(key=lambda i: (-sizes[i], i))
    return best_fit(sizes, displaced, capacity, kept)


def mutate(sizes: list[int], bins: Bins, capacity: int, rng: random.Random) -> Bins:
    """Dissolve the emptiest bins and a few others, and best-fit their items."""
    order = sorted(range(len(bins)), key=lambda n: (bins[n][0], rng.random()))
    few = max(1, len(bins) // 50)
    out = set(order[:few]) | {rng.randrange(len(bins)) for _ in range(few)}
    loose = [i for n in sorted(out) for i in bins[n][1]]
    loose.sort(key=lambda i: (-sizes[i] * rng.uniform(0.9, 1.1), i))
    return best_fit(sizes, loose, capacity, [b for n, b in enumerate(bins) if n not in out])


def first_population(sizes: list[int], capacity: int, rng: random.Random, n: int = POPULATION) -> list[Bins]:
    """Best-fit packings: largest first, and near that order."""
    orders = [sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))]
    orders += [sorted(range(len(sizes)), key=lambda i: -sizes[i] * rng.uniform(0.6, 1.0)) for _ in range(n - 1)]
    return [best_fit(sizes, o, capacity) for o in orders]


def evolve(sizes: list[int], population: list[Bins], capacity: int, rng: random.Random, bound: int, children: int = CHILDREN) -> list[Bins]:
    """One epoch: children of parents chosen by tournament replace the worst."""
    scored = [(fitness(p, capacity), p) for p in population]
    for _ in range(children):
        scored.sort(key=lambda x: -x[0])
        if len(scored[0][1]) <= bound:
            break
        giver, taker = (max(rng.sample(scored, min(2, len(scored))), key=lambda x: x[0])[1] for _ in range(2))
        child = crossover(sizes, giver, taker, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(sizes, child, capacity, rng)
        scored.append((fitness(child, capacity), child))
        scored = sorted(scored, key=lambda x: -x[0])[:POPULATION]  # the worst goes
    scored.sort(key=lambda x: -x[0])
    return [p for _, p in scored]


# ------------------------------------------------------------------ on Spark


def document_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """key, doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""

    def run(batches) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        from vigilo.llm.byte_level import ByteLevel, loaded

        encode = loaded(ByteLevel, tokenizer_path)
        names = ["doc", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        for batch in batches:
            cols, held = [[] for _ in names], 0
            for doc, doc_id, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encode.column(batch.column(2))):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                starts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity)]
                for at, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    for c, v in zip(cols, (doc, doc_id, at, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].astype(np.int32))):
                        c.append(v)
                held += len(ids)
                if held > 1 << 20:
                    yield record(cols, names)
                    cols, held = [[] for _ in names], 0
            if cols[0]:
                yield record(cols, names)

    def record(cols, names):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return ship(rows).mapInArrow(run, schema)


#: ``population``: the bin of every item, of one individual after the other.
_STATE = "block bigint, island int, bound int, used int, score double, lengths array<int>, population array<int>"
_COLUMNS = ["block", "island", "bound", "used", "score", "lengths", "population"]


def _labels(bins: Bins, n: int) -> list[int]:
    """The bin's number of every item."""
    out = [0] * n
    for number, (_, items) in enumerate(bins):
        for i in items:
            out[i] = number
    return out


def _bins(labels, sizes: list[int]) -> Bins:
    found: dict[int, list[int]] = {}
    for i, n in enumerate(labels):
        found.setdefault(n, []).append(i)
    return [(sum([sizes[i] for i in b]), tuple(b)) for b in found.values()]


def _epoch(capacity: int, seed: int):
    """Row by row: the population of one island after one more epoch, best
    first; where there is none yet, the first one is made."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for batch in batches:
            for at in range(batch.num_rows):
                block, island, bound = (batch.column(c)[at].as_py() for c in _COLUMNS[:3])
                lengths, before = batch.column("lengths")[at], batch.column("population")[at].values
                sizes, n = lengths.values.to_pylist(), len(lengths)
                rng = random.Random(f"{seed}/{block}/{island}")
                known = [_bins(before[i : i + n].to_pylist(), sizes) for i in range(0, len(before), n)]
                if not known:
                    bound = lower_bound(sizes, capacity)
                    known = first_population(sizes, capacity, rng)
                known = evolve(sizes, known, capacity, rng, bound)[:POPULATION]
                labels = [x for b in known for x in _labels(b, n)]
                row = (block, island, bound, len(known[0]), fitness(known[0], capacity), sizes, labels)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=_COLUMNS)

    return run


def _evolved(items: DataFrame, blocks: int, level: int, capacity: int) -> DataFrame:
    """(doc, piece, length, block, bin) of the best packing of every block."""
    block = F.pmod(uniform_hash("doc", "piece", level), F.lit(blocks)).cast("bigint")
    dealt = items.select(block.alias("block"), F.struct("doc", "piece", F.col("length").cast("int").alias("length")).alias("item"))
    grouped = stored(dealt.groupBy("block").agg(F.sort_array(F.collect_list("item")).alias("items")), "blocks")  # about BLOCK items
    start = grouped.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.lit(None).cast("int").alias("bound"), F.lit(None).cast("int").alias("used"),
        F.lit(None).cast("double").alias("score"), F.transform("items", lambda x: x["length"]).alias("lengths"), F.array().cast("array<int>").alias("population"),
    )
    state = stored(start.repartition("block", "island").mapInArrow(_epoch(capacity, level * 1000), _STATE), "islands")
    for epoch in range(1, EPOCHS):
        # a block that one island has packed as tightly as can be is done
        open_ = state.groupBy("block").agg(F.min("used").alias("least"), F.max("bound").alias("most")).filter("least > most").select("block")
        if open_.isEmpty():
            break
        # the ring: each island's elite goes to the next island of its block
        elite = state.select(
            "block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.slice("population", F.lit(1), F.size("lengths") * ELITE).alias("elite")
        )
        met = state.join(open_, "block", "left_semi").join(elite, ["block", "island"])
        met = met.withColumn("population", F.concat("population", "elite")).select(*_COLUMNS)
        moved = met.repartition("block", "island").mapInArrow(_epoch(capacity, level * 1000 + epoch), _STATE)
        state = stored(moved.unionByName(state.join(open_, "block", "left_anti")), "islands")
    winner = Window.partitionBy("block").orderBy("used", F.col("score").desc(), "island")  # ISLANDS rows a block
    won = state.withColumn("n", F.row_number().over(winner)).filter("n = 1").select("block", F.slice("population", F.lit(1), F.size("lengths")).alias("best"))
    cells = F.arrays_zip(F.col("items").alias("item"), F.col("best").alias("bin"))
    return grouped.join(won, "block").select("block", F.explode(cells).alias("x")).select("x.item.*", "block", "x.bin")


def _amount(items: DataFrame) -> tuple[int, int]:
    """Number of pieces and of their ids."""
    n, total = items.agg(F.count(F.lit(1)), F.sum("length")).first()
    return n, total or 0


def pack_groups(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset (and
    ids) of every piece."""
    pieces = stored(document_pieces(docs, tokenizer_path, end_id, capacity, with_ids), "pieces")
    zero = F.lit(0).cast("bigint")
    left = pieces.filter(F.col("length") < capacity).select("doc", "piece", "length")
    # a full piece is a sequence of its own: negative numbers
    places = pieces.filter(F.col("length") == capacity).select("doc", "piece", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), zero.alias("offset"))
    level, (n, total) = 0, _amount(left)
    while n:
        # small pieces make few bins: such blocks take more pieces
        blocks = max(-(-n // LARGEST_BLOCK), min(-(-n // BLOCK), -(-total // (capacity * FEWEST_BINS))))
        packed = stored(_evolved(left, blocks, level, capacity), "packed")
        done = packed
        if blocks > 1:
            fill = packed.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
            emptiest, all_bins = Window.partitionBy("block").orderBy("fill", "bin"), Window.partitionBy("block")  # about BLOCK bins at most
            ranked = fill.withColumns({"n": F.row_number().over(emptiest), "bins": F.count(F.lit(1)).over(all_bins)})
            loose = ranked.filter((F.col("n") <= LOOSE) & ((F.col("n") == 1) | (F.col("n") * REDUCE <= F.col("bins")))).select("block", "bin")
            left = stored(packed.join(loose, ["block", "bin"], "left_semi").select("doc", "piece", "length"), "loose")
            again, total = _amount(left)
            if 2 * again <= n:  # else the bins hold too many pieces for another round to be smaller
                done = packed.join(loose, ["block", "bin"], "left_anti")
                n = again
            else:
                n = 0
        else:
            n = 0
        before = Window.partitionBy("block", "bin").orderBy(F.col("length").desc(), "doc", "piece").rowsBetween(Window.unboundedPreceding, -1)
        number = F.shiftleft(F.lit(level).cast("bigint"), 56) + F.shiftleft("block", 16) + F.col("bin")
        places = places.unionByName(done.select(
            "doc", "piece", number.alias("sequence_id"), F.coalesce(F.sum("length").over(before), zero).cast("bigint").alias("offset")
        ))
        level += 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return pieces.join(places, ["doc", "piece"]).select(*columns)
