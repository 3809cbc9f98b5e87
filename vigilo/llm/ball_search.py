"""Ranked lexical search by exact inner products over sparse ball trees.

A document is a sparse vector of whole numbers, ``(10^9 * tf) div (1000 * tf +
8 * m)`` per term, where ``m`` grows with the document's length; a query is a
sparse vector of term weights times repeats; the score is their inner product.

**Index.**  Terms are counted once, in shards of at most ``SHARD_DOCS``
documents and ``SHARD_TERMS`` entries; the corpus figures (documents, terms) are
sums over the shards.  Then every shard becomes a ball tree: a node's documents
lie within an integer ``radius`` of its ``centre`` (the mean of its documents,
its ``CENTRE`` heaviest terms, in whole numbers); a node of more than ``LEAF``
documents is split at the median along the line through two far members.  Both
tables are Parquet under ``spark.checkpoint.dir``, one row a shard and a row
group each, so that a task holds one shard at a time, however many it works on.

**Search.**  Queries are taken in tiles of about ``TILE``, a bounded number the
driver holds and ships; a tile's document frequencies are summed over the
shards, then each shard's tree is searched best-first for all queries of the
tile: the node with the greatest promise is opened next, a query leaves a node
whose bound ``<query, centre> + |query| * radius`` is below its tenth best
score so far, and leaves are scored exactly.  Norm and radius are taken in the
asked terms that the node holds, where both are smallest.  They are rounded up
to whole numbers, so a bound is never too low; equality is kept, so ties are
whole.
The shards' lists (ten rows a query each) are merged by a window per query.

Whole numbers are 64-bit.  A node that holds a document of more than
``WIDEST`` distinct terms has no finite radius and is always opened.

Defined results: a text that is null or without a term is in no list and not
counted; an item without a term (or with only unknown ones) has no rows; rows
with equal or null item ids are items of their own, equal scores are ordered by
doc_id with nulls last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from vigilo.llm.common import settings, ship, stored, uniform_hash
from vigilo.session import scratch_dir

TOP = 10
SHARD_DOCS = 4_096
SHARD_TERMS = 1_500_000
LEAF = 64
CENTRE = 256
TILE = 256
WIDEST = 4_000_000
_NO_BOUND = 1 << 62
#: Rows at once of the texts, and of the tables that hold a shard in a row.
_TEXT_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_SHARD_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "1"}
_ROW_GROUP = {"parquet.block.row.count.limit": "1"}

#: ASCII letters and digits and all bytes of other characters are kept, letters in lower case; the rest are spaces.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text, with repeats."""
    return text.translate(_TERM_BYTES).split() if text else []


# ---------------------------------------------------------------- tree


def _take(starts, lengths):
    """Indexes of the runs ``start .. start + length`` one after the other."""
    import numpy as np

    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Rows:
    """Sparse rows: run lengths, columns and values (all rows hold an entry)."""

    def __init__(self, lengths, columns, values):
        import numpy as np

        self.np, self.lengths, self.columns, self.values = np, lengths, columns, values
        self.starts = np.cumsum(lengths) - lengths

    def __len__(self):
        return len(self.lengths)

    def pick(self, rows) -> Rows:
        at = _take(self.starts[rows], self.lengths[rows])
        return Rows(self.lengths[rows], self.columns[at], self.values[at])

    def dot(self, dense):
        return self.np.add.reduceat(dense[self.columns] * self.values, self.starts)

    def norms(self):
        return self.np.add.reduceat(self.values * self.values, self.starts)

    def row(self, i: int):
        run = slice(self.starts[i], self.starts[i] + self.lengths[i])
        return self.columns[run], self.values[run]


def build_tree(rows: Rows, width: int) -> tuple:
    """(order of the rows, nodes); a node is (low, high, left, right, radius,
    centre's columns, centre's values), with children -1 for a leaf."""
    import numpy as np

    dense = np.zeros(width, dtype=np.int64)  # cleared after each use
    order: list[int] = []
    nodes: list[list] = []

    def distances(x: Rows, norms, columns, values):
        dense[columns] = values
        d = norms - 2 * x.dot(dense) + int((values * values).sum())
        dense[columns] = 0
        return d

    def centre_of(x: Rows):
        columns, place = np.unique(x.columns, return_inverse=True)
        total = np.zeros(len(columns), dtype=np.int64)
        np.add.at(total, place, x.values)
        mean = total // len(x)
        if len(columns) > CENTRE:
            heavy = np.sort(np.argpartition(-mean, CENTRE)[:CENTRE])
            columns, mean = columns[heavy], mean[heavy]
        return columns, mean

    todo = [(np.arange(len(rows)), -1, 0)] if len(rows) else []
    # depth first, left before right, so that a node's rows are a run of the order
    while todo:
        ids, parent, side = todo.pop()
        x = rows.pick(ids)
        norms = x.norms()
        columns, values = centre_of(x)
        far = distances(x, norms, columns, values)
        radius = _NO_BOUND if x.lengths.max() > WIDEST else math.isqrt(int(far.max())) + 1
        at = len(nodes)
        nodes.append([len(order), len(order) + len(ids), -1, -1, radius, columns, values])
        if parent >= 0:
            nodes[parent][2 + side] = at
        if len(ids) <= LEAF or not far.any():
            order.extend(ids.tolist())
            continue
        one = int(far.argmax())
        to_one = distances(x, norms, *x.row(one))
        two = int(to_one.argmax())
        along = np.argsort(to_one - distances(x, norms, *x.row(two)), kind="stable")
        half = len(ids) // 2
        todo += [(ids[along[half:]], at, 1), (ids[along[:half]], at, 0)]
    return np.array(order, dtype=np.int64), nodes


class Tree:
    """A shard's tree, and the search of it."""

    def __init__(self, doc_ids, rows: Rows, nodes: list):
        self.doc_ids, self.rows, self.nodes, self.scored = doc_ids, rows, nodes, 0  # scored: leaves so far

    def search(self, column_of, queries, top: int = TOP) -> list[list[tuple[int, object]]]:
        """The best (score, doc_id) of each query, best first.  ``queries`` is a
        matrix (terms x queries) and ``column_of`` the matrix row of each of
        the shard's terms, or -1."""
        import heapq

        import numpy as np

        n = queries.shape[1]
        best: list[list] = [[] for _ in range(n)]  # heaps of (score, order key, place)
        least = np.ones(n, dtype=np.int64)  # a score below it is of no use
        # the documents in the space of the asked terms
        own = np.flatnonzero(column_of[self.rows.columns] >= 0)
        place, value = column_of[self.rows.columns[own]], self.rows.values[own]
        doc = np.repeat(np.arange(len(self.rows)), self.rows.lengths)[own]
        edge = np.searchsorted(doc, np.arange(len(self.rows) + 1))
        squares, dense = queries**2, np.zeros(queries.shape[0], dtype=np.int64)

        def firsts(run):
            """Where each document's entries begin in a run of entries."""
            d = doc[run]
            return np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))

        def bounds(node, active):
            """No document of the node scores more.  Norm and radius are those
            in the asked terms that the node holds: both can only be smaller
            than in all terms."""
            low, high, _, _, radius, columns, values = node
            run = slice(edge[low], edge[high])
            if run.start == run.stop:
                return np.zeros(len(active), dtype=np.int64)
            held = np.unique(place[run])
            norm = np.floor(np.sqrt(squares[np.ix_(held, active)].sum(axis=0))).astype(np.int64) + 1
            known = column_of[columns] >= 0
            at, middle = column_of[columns[known]], values[known]
            if radius == _NO_BOUND:
                return np.full(len(active), _NO_BOUND, dtype=np.int64)
            dense[at] = middle
            gaps = np.add.reduceat(value[run] * (value[run] - 2 * dense[place[run]]), firsts(run)) + int((middle * middle).sum())
            dense[at] = 0
            return middle @ queries[np.ix_(at, active)] + norm * min(radius, math.isqrt(int(gaps.max())) + 1)

        def score(low: int, high: int, active):
            """Exact scores of a leaf's documents."""
            self.scored += 1
            run = slice(edge[low], edge[high])
            if run.start == run.stop:
                return
            first = firsts(run)
            step = max(1, (4 << 20) // (run.stop - run.start))
            for at in range(0, len(active), step):
                some = active[at : at + step]
                found = np.add.reduceat(queries[np.ix_(place[run], some)] * value[run][:, None], first, axis=0)
                for d, q in zip(*np.nonzero(found >= least[some])):
                    keep(int(some[q]), int(found[d, q]), int(doc[run][first[d]]))

        def keep(q: int, total: int, at: int):
            doc_id = self.doc_ids[at]
            entry = (total, (doc_id is not None, -(doc_id or 0)), at)
            if len(best[q]) < top:
                heapq.heappush(best[q], entry)
            elif entry > best[q][0]:
                heapq.heapreplace(best[q], entry)
            if len(best[q]) == top:
                least[q] = max(1, best[q][0][0])

        def offer(number: int, active):
            bound = bounds(self.nodes[number], active)
            going = bound >= least[active]
            if going.any():
                promise = bound[going] - least[active[going]]
                heapq.heappush(heap, (-int(promise.max()), number, active[going], bound[going]))

        heap: list = []
        if self.nodes:
            offer(0, np.arange(n))
        while heap:
            _, number, active, bound = heapq.heappop(heap)
            active = active[bound >= least[active]]  # scores have risen since
            if not len(active):
                continue
            low, high, left, right = self.nodes[number][:4]
            if left < 0:
                score(low, high, active)
            else:
                offer(left, active)
                offer(right, active)
        return [[(total, self.doc_ids[at]) for total, _, at in sorted(b, reverse=True)] for b in best]


# ------------------------------------------------------------------ on Spark

_SHARD = "shard bigint, doc_ids array<bigint>, n array<int>, lengths array<int>, columns array<int>, tf array<int>, terms array<binary>, df array<int>"
_TREE = (
    "doc_ids array<bigint>, lengths array<int>, columns array<int>, vals array<bigint>, terms array<binary>, low array<int>, high array<int>, "
    "left_child array<int>, right_child array<int>, radius array<bigint>, centre_lengths array<int>, centre_columns array<int>, centre_values array<bigint>"
)


def _schema(text: str):
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in text.split(", ")])


def _batch(row: dict, schema):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


def term_shards(docs: DataFrame) -> DataFrame:
    """Term counts of the documents that hold a term, a row a shard."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = _schema(_SHARD)
        number, columns = 0, {}
        ids, sizes, lengths, parts = [], [], [], []

        def shard():
            cols = np.concatenate([c for c, _ in parts])
            return _batch({
                "shard": number, "doc_ids": ids, "n": sizes, "lengths": lengths, "columns": cols, "tf": np.concatenate([t for _, t in parts]),
                "terms": list(columns), "df": np.bincount(cols, minlength=len(columns)),
            }, schema)

        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                found = terms(text.as_py())
                if not found:
                    continue
                codes, tf = np.unique(np.array([columns.setdefault(w, len(columns)) for w in found]), return_counts=True)
                ids.append(doc_id)
                sizes.append(len(found))
                lengths.append(len(codes))
                parts.append((codes, tf))
                held += len(codes)
                if len(ids) >= SHARD_DOCS or held >= SHARD_TERMS:
                    yield shard()
                    number, held, columns = number + 1, 0, {}
                    ids, sizes, lengths, parts = [], [], [], []
        if ids:
            yield shard()

    return ship(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).mapInArrow(run, _SHARD)


def impact(tf, n, n_docs: int, n_terms: int):
    """Value of a term that occurs ``tf`` times among a document's ``n``."""
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def shard_trees(shards: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    def run(batches) -> Iterator:
        import numpy as np

        schema = _schema(_TREE)
        for batch in batches:
            for at in range(batch.num_rows):
                get = lambda c: np.asarray(batch.column(c)[at].values.to_numpy(zero_copy_only=False))
                lengths = get("lengths").astype(np.int64)
                n = np.repeat(get("n").astype(np.int64), lengths)
                rows = Rows(lengths, get("columns").astype(np.int64), impact(get("tf").astype(np.int64), n, n_docs, n_terms))
                words = batch.column("terms")[at].as_py()
                order, nodes = build_tree(rows, len(words))
                rows, ids = rows.pick(order), batch.column("doc_ids")[at].as_py()
                low, high, left, right, radius, cols, values = zip(*nodes)
                yield _batch({
                    "doc_ids": [ids[i] for i in order], "lengths": rows.lengths, "columns": rows.columns, "vals": rows.values, "terms": words, "low": low, "high": high,
                    "left_child": left, "right_child": right, "radius": radius, "centre_lengths": [len(c) for c in cols],
                    "centre_columns": np.concatenate(cols), "centre_values": np.concatenate(values),
                }, schema)

    return shards.select("doc_ids", "n", "lengths", "columns", "tf", "terms").mapInArrow(run, _TREE)


def _frequencies(shards: DataFrame, wanted: list[bytes]) -> dict[bytes, int]:
    """Documents that hold each of a tile's terms."""

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        look = pa.array(wanted, pa.binary())
        for batch in batches:
            for words, df in zip(batch.column("terms"), batch.column("df")):
                own = pc.is_in(words.values, value_set=look)
                yield pa.RecordBatch.from_arrays([words.values.filter(own), df.values.filter(own)], names=["term", "df"])

    counted = shards.select("terms", "df").mapInArrow(run, "term binary, df int").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in counted.collect()}  # the terms of one tile


def _search(trees: DataFrame, wanted: list[bytes], keys: list[int], cells: list[tuple[int, int, int]], top: int) -> DataFrame:
    """(item, doc_id, score) of each shard's best documents for a tile."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        queries = np.zeros((len(wanted), len(keys)), dtype=np.int64)
        for t, q, w in cells:
            queries[t, q] = w
        look = pa.array(wanted, pa.binary())
        for batch in batches:
            for at in range(batch.num_rows):
                get = lambda c: np.asarray(batch.column(c)[at].values.to_numpy(zero_copy_only=False)).astype(np.int64)
                column_of = np.asarray(pc.fill_null(pc.index_in(batch.column("terms")[at].values, value_set=look), -1)).astype(np.int64)
                cut = np.cumsum(get("centre_lengths"))[:-1]
                nodes = list(zip(*[get(c).tolist() for c in ("low", "high", "left_child", "right_child", "radius")], np.split(get("centre_columns"), cut), np.split(get("centre_values"), cut)))
                tree = Tree(batch.column("doc_ids")[at].as_py(), Rows(get("lengths"), get("columns"), get("vals")), nodes)
                found = [(k, d, s) for k, best in zip(keys, tree.search(column_of, queries, top)) for s, d in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), (), ()))], names=["item", "doc_id", "score"]
                )

    return trees.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's best documents."""
    spark = docs.sparkSession
    with settings(spark, _TEXT_ROWS):
        shards = stored(term_shards(docs), "terms", _ROW_GROUP)
        items = stored(items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("bigint").alias("item_id"), "text"), "items")
    with settings(spark, _SHARD_ROWS):
        lists = _ranked_lists(shards, items, top)
    if lists is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    merged = spark.read.schema("item bigint, doc_id bigint, score bigint").parquet(lists).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return merged.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _ranked_lists(shards: DataFrame, items: DataFrame, top: int) -> str | None:
    """Where the shards' lists are, if there are any."""
    spark = shards.sparkSession
    totals = shards.select(F.size("doc_ids").alias("docs"), F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("terms")).agg(F.sum("docs"), F.sum("terms")).first()
    if not totals[0]:
        return None
    trees = stored(shard_trees(shards, *totals), "trees", _ROW_GROUP)
    tiles = max(1, -(-items.count() // TILE))
    lists, searched = scratch_dir(spark, "ranked"), False
    for tile in range(tiles):
        rows = items.filter(F.pmod(uniform_hash("item"), F.lit(tiles)) == tile).select("item", "text").collect()  # about TILE rows
        counted = [(r["item"], Counter(terms((r["text"] or "").encode()))) for r in rows]
        counted = [(k, c) for k, c in counted if c]
        wanted = sorted({t for _, c in counted for t in c})
        if not wanted:
            continue
        df = _frequencies(shards, wanted)
        cells = [
            (t, q, weight(df[word], totals[0]) * c[word]) for t, word in enumerate(wanted) if word in df for q, (_, c) in enumerate(counted) if word in c
        ]
        _search(trees, wanted, [k for k, _ in counted], cells, top).write.mode("append").parquet(lists)
        searched = True
    return lists if searched else None
