"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is its sequence of 5-word shingles, each labelled with its occurrence
number (the n-th time it occurs), so labelled shingles of a text are distinct.

*   Sketch.  Each of a set of hash functions samples the labelled shingles with
    the smallest hashes and keeps them in text order; the ordered tuple is one
    bucket key.  With 12 samples, texts share a key of one function with
    probability about J**12 if the shared shingles keep their order: at
    similarity 0.8, 80 functions miss a pair with probability 0.004, while texts
    that share half their shingles (a long common passage) seldom meet.  Short
    texts take fewer samples, as there one changed shingle weighs more.  A key
    does not tell which function took the sample: a text of no more shingles than
    are sampled has one key, which a text with one shingle more shares as soon as
    any function leaves that shingle out.
*   Verification.  Positions of shared labelled shingles are matched inside a
    band as wide as a pair of the required similarity can need, and the longest
    chain that keeps their order is the alignment (labels are distinct, so it
    is a longest increasing run).  Similarity = aligned / (n1 + n2 - aligned);
    0.8 or more links the pair.
*   Candidates without all pairs.  Every member of a bucket is compared with
    the bucket's centre, the member that meets the most others over all its
    buckets (an original rather than one of its copies), and keeps its outline
    against it: a bit for each of the centre's shingles that it has too, and a
    hashed bit for each other shingle.  Links are contracted to components.
    Members of one bucket that still are in different components are compared
    with one another, unless their outlines show that they share too few
    shingles: common bits, and what fell on a bit already set, bound the shared
    shingles from above, so no link is lost.  So every pair that shares a key is
    linked, joined through others, or shown to be no link, and a bucket of
    thousands of copies costs about one comparison a member.

Copies (equal word sequences) are one node: the first row stands for them.
Rows are exploded, counted and joined by key; hot keys are pre-aggregated
(the first member) and their join is one AQE can split.  Texts are fetched by
file and row for the nodes in a candidate pair only.

Defined results: null, empty and punctuation-only texts are equal copies of
each other; texts of under five words are one shingle; the smallest doc_id of a
class names it and stays (null ids last, of repeated rows one); an empty table
gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from vigilo.llm.common import ship, stored
from vigilo.llm.components import components
from vigilo.llm.exact_dedup import located

K = 5
SIMILARITY = 0.8
#: (fewest shingles, most, hash functions, samples of each): tiers overlap so far
#: that two texts of the required similarity have one in common.
TIERS = ((1, 14, 48, 4), (11, 64, 48, 6), (50, 1 << 62, 80, 12))
#: Bits of an outline for shingles that the centre has not, by shingle of the centre.
OTHER_BITS = 2
_CHUNK = 4096


def order_sketch(shingles, sampled: int, sketches: int, salt: int):
    """Distinct uint64 keys of the ordered samples of labelled shingles."""
    import numpy as np

    from vigilo.llm.words import mixed

    n = len(shingles)
    if n <= sampled:  # every function samples all of them
        rows = shingles[None, :]
    else:
        seeds = mixed(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))
        odd = mixed(seeds) | np.uint64(1)
        lowest, order = None, None
        for a in range(0, n, _CHUNK):
            hashes = (shingles[None, a : a + _CHUNK] ^ seeds[:, None]) * odd[:, None]
            if hashes.shape[1] > sampled:
                at = np.argpartition(hashes, sampled - 1, axis=1)[:, :sampled]
                hashes = np.take_along_axis(hashes, at, axis=1)
            else:
                at = np.broadcast_to(np.arange(hashes.shape[1]), hashes.shape)
            at = at + a
            if lowest is not None:
                hashes, at = np.concatenate([lowest, hashes], axis=1), np.concatenate([order, at], axis=1)
                best = np.argpartition(hashes, sampled - 1, axis=1)[:, :sampled]
                hashes, at = np.take_along_axis(hashes, best, axis=1), np.take_along_axis(at, best, axis=1)
            lowest, order = hashes, at
        rows = shingles[np.sort(order, axis=1)]
    key = np.full(len(rows), 1000 * sampled + salt, dtype=np.uint64)
    for i in range(rows.shape[1]):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return np.unique(key)


def shingles_of(text: bytes | None):
    from vigilo.llm.words import kmers, labelled, word_hashes

    return labelled(kmers(word_hashes(text), K))


def keys_of(shingles):
    import numpy as np

    n = len(shingles)
    parts = [order_sketch(shingles, sampled, functions, sampled) for low, high, functions, sampled in TIERS if low <= n <= high]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def longest_chain(positions) -> int:
    """Length of the longest increasing run in a sequence of distinct numbers."""
    from bisect import bisect_left

    ends: list[int] = []
    for p in positions:
        at = bisect_left(ends, p)
        ends[at : at + 1] = [p]
    return len(ends)


def shared_positions(a, b):
    """Positions in a and in b of the labelled shingles that both have."""
    import numpy as np

    return np.intersect1d(a, b, assume_unique=True, return_indices=True)[1:]


def similarity(a, b, least: float = SIMILARITY, shared=None) -> float:
    """Aligned similarity of two labelled sequences; 0 where it would be under ``least``."""
    import math

    import numpy as np

    at_a, at_b = shared_positions(a, b) if shared is None else shared
    total, both = len(a) + len(b), len(at_a)
    if both < least / (1 + least) * total - 1e-9:
        return 0.0
    band = max(len(a), len(b)) - math.ceil(least / (1 + least) * total - 1e-9)
    near = np.abs(at_a - at_b) <= band
    path = at_b[near][np.argsort(at_a[near])]
    aligned = len(path) if (np.diff(path) > 0).all() else longest_chain(path.tolist())
    found = aligned / (total - aligned) if total > aligned else 1.0
    return found if found >= least else 0.0


def outline(centre, other, shared=None):
    """(words of 64 bits, shingles without a bit of their own) of a member seen
    from its centre.  Two members share at most as many shingles as their words
    have common bits, and the lesser count of shingles without a bit."""
    import numpy as np

    at_c, at_o = shared_positions(centre, other) if shared is None else shared
    words = max(1, -(-len(centre) // 64))
    bits = np.zeros(64 * words * (1 + OTHER_BITS), dtype=bool)
    bits[at_c] = True
    rest = np.delete(other, at_o)
    slots = np.unique(rest % np.uint64(64 * words * OTHER_BITS)).astype(np.int64)
    bits[64 * words + slots] = True
    return np.packbits(bits).view(np.int64), len(rest) - len(slots)


def sketches(rows: DataFrame) -> DataFrame:
    """(uid, doc_id, file, row, digest, n, keys) of located rows, stored."""

    def run(batches) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        from vigilo.llm.words import kmers, labelled, word_hashes

        for batch in batches:
            digest, n, keys = [], [], []
            for text in batch.column(4).cast(pa.large_binary()):
                words = word_hashes(text.as_py())
                s = labelled(kmers(words, K))
                digest.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
                n.append(len(s))
                keys.append(keys_of(s).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *keys])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["uid", "doc_id", "file", "row", "digest", "n", "keys"],
            )

    rows = ship(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "file", "row", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(run, f"uid bigint, doc_id {kind}, file string, row bigint, digest binary, n bigint, keys array<bigint>"), "sketches")


def verified(pairs: DataFrame, rows: DataFrame, where: DataFrame, least: float, outlines: bool = False) -> DataFrame:
    """(u, v, aligned, outline, spare) of stored pairs (u, v) of nodes, stored; the
    outline is that of v seen from u, if asked for."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        held: dict[int, object] = {}  # parsed texts, up to 2**21 shingles
        room = [1 << 21]

        def parsed(uid, text):
            if uid not in held:
                if room[0] < 0:
                    held.clear()
                    room[0] = 1 << 21
                held[uid] = shingles_of(text.as_py())
                room[0] -= len(held[uid])
            return held[uid]

        for batch in batches:
            aligned, lines, spare = [], [], []
            a_texts, b_texts = batch.column(2).cast(pa.large_binary()), batch.column(3).cast(pa.large_binary())
            for i, (u, v) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                a, b = parsed(u, a_texts[i]), parsed(v, b_texts[i])
                shared = shared_positions(a, b)
                aligned.append(similarity(a, b, least, shared))
                words, without = outline(a, b, shared) if outlines else (None, None)
                lines.append(words)
                spare.append(without)
            arrays = [batch.column(0), batch.column(1), pa.array(aligned, pa.float64()), pa.array(lines, pa.list_(pa.int64())), pa.array(spare, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["u", "v", "aligned", "outline", "spare"])

    nodes = pairs.select(F.col("u").alias("uid")).unionByName(pairs.select(F.col("v").alias("uid"))).distinct()
    wanted = where.select("uid", "file", "row").join(nodes, "uid", "left_semi")
    texts = stored(rows.select("file", "row", "text").join(wanted, ["file", "row"]).select("uid", "text"), "candidate-texts")
    both = pairs.join(texts.select(F.col("uid").alias("u"), F.col("text").alias("a")), "u").join(texts.select(F.col("uid").alias("v"), F.col("text").alias("b")), "v")
    kinds = "u bigint, v bigint, aligned double, outline array<bigint>, spare bigint"
    return stored(ship(both.select("u", "v", "a", "b")).mapInArrow(run, kinds), "verified-pairs")


def may_link(least: float):
    """Whether two members (columns, and those with a 2) can share enough shingles."""
    common = F.aggregate(F.zip_with("outline", "outline2", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda total, x: total + x)
    return common + F.least("spare", "spare2") >= least / (1 + least) * (F.col("n") + F.col("n2")) - 1e-9


def near_groups(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """file, row, doc_id, class_id, class_size, kept of every row."""
    rows = located(docs, "doc_id", "text")
    marked = sketches(rows)
    nodes = stored(marked.groupBy("digest").agg(F.min("uid").alias("node")), "near-nodes")
    unique = marked.join(nodes.select(F.col("node").alias("uid")), "uid", "left_semi")
    members = stored(unique.select("uid", "n", F.explode("keys").alias("key")), "near-members")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = stored(members.join(sizes, "key"), "near-shared")  # members of buckets that hold several
    weight = shared.groupBy("uid").agg(F.sum("size").alias("w"))
    weighed = stored(shared.join(weight, "uid").select("key", "uid", "n", "w"), "near-weighed")

    # everyone with the centre of the bucket
    centres = weighed.groupBy("key").agg(F.max(F.struct("w", (-F.col("uid")).alias("minus"))).alias("m")).select("key", (-F.col("m.minus")).alias("u"))
    rest = stored(weighed.join(centres, "key").filter("uid <> u").select("key", "uid", "n", "u"), "near-rest")
    met = verified(stored(rest.select("u", F.col("uid").alias("v")).distinct(), "near-pairs"), rows, marked, least, outlines=True)
    links = met.filter("aligned > 0").select("u", "v")
    joined = stored(components(links), "near-components")

    # the rest with one another, where a bucket has several components
    placed = rest.join(joined, F.col("uid") == F.col("node"), "left").select("key", "uid", "n", "u", F.coalesce("component", "uid").alias("c"))
    apart = placed.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select("key")
    seen = met.select("u", F.col("v").alias("uid"), "outline", "spare")
    placed = stored(placed.join(apart, "key").join(seen, ["u", "uid"]).drop("u"), "near-open")
    other = placed.select("key", *[F.col(c).alias(f"{c}2") for c in ("uid", "n", "c", "outline", "spare")])
    apart = (F.col("uid") < F.col("uid2")) & (F.col("c") != F.col("c2"))
    pairs = placed.join(other, "key").filter(apart & (F.least("n", "n2") >= least * F.greatest("n", "n2")) & may_link(least))
    pairs = pairs.select(F.col("uid").alias("u"), F.col("uid2").alias("v")).distinct()
    before = met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    pairs = stored(pairs.join(before, ["u", "v"], "left_anti"), "near-pairs")
    if not pairs.isEmpty():
        links = verified(pairs, rows, marked, least).filter("aligned > 0").select("u", "v")
        # what is joined already is a star: one link a node
        joined = stored(components(links.unionByName(joined.select(F.col("node").alias("u"), F.col("component").alias("v")))), "near-components")

    placed = marked.select("file", "row", "doc_id", "uid", "digest").join(nodes, "digest").join(joined.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left")
    placed = placed.select("file", "row", "doc_id", "uid", F.coalesce("component", "node").alias("component"))
    holder = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    classes = placed.groupBy("component").agg(F.min(holder).alias("holder"), F.count(F.lit(1)).alias("class_size"))
    return placed.join(classes, "component").select(
        "file", "row", "doc_id", F.col("holder.doc_id").alias("class_id"), "class_size", (F.col("uid") == F.col("holder.uid")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of each class, with all its columns."""
    from pyspark.errors import AnalysisException

    content = docs
    try:
        docs.select("_metadata.file_path")
    except AnalysisException:
        content = stored(docs, "near-content")
    keep = near_groups(content, **options).filter("kept").select(F.col("file").alias("keep_file"), F.col("row").alias("keep_row"))
    rows = content.select(F.struct("*").alias("doc"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.join(keep, (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row")), "left_semi").select("doc.*")
