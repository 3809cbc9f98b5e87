"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max
inverted index.

1.  Examples.  At most ``EXAMPLES`` labelled rows of the training fold (the
    smallest hashes of their ids): the bounded sample the model is fitted on.
2.  Terms.  Of the examples' words, the ``TERMS`` at most that go with the
    toxic label most clearly: in ``MIN_DOCS`` examples or more, with odds of toxic
    against clean ``ODDS`` times those of all examples and chi-square over
    ``CHI2``.  Odds have no upper end, so this can be met at any share of toxic
    examples.  (Words of a language in which toxic examples are somewhat more
    frequent do not reach it.)
3.  Vectors.  Every document's counts of those terms, from its whole text; the
    terms' document frequencies are counted over all documents.  Weight is
    (1 + ln tf) * idf, vectors have length 1.
4.  Index.  Postings of the examples, in blocks of ``BLOCK`` examples with the
    largest weight of each term in each block.  A query adds up its blocks'
    largest possible scores, opens blocks from the highest down, and stops when
    no block can reach its ``NEIGHBOURS``-th best: the result is exact.  Ties go
    to the smaller example number.  A document is never its own neighbour.
5.  Score.  Neighbours vote with weight s / (1.05 - s), s the cosine, shrunk to
    the base rate; votes are calibrated by a logistic curve fitted to the
    examples' own leave-one-out votes.  A document with no term at all gets the
    rate of such examples.  ``evidence`` lists the nearest neighbours.

The model (terms, weights, index) is bounded by EXAMPLES and TERMS whatever the
corpus, and is the only thing collected and broadcast.

Defined results: null and empty texts have no term; null or other labels than
0 and 1 are not used, of repeated labels the larger counts; without labels the
score is 0.1; null ids are not held out; an empty table gives an empty result;
other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from vigilo.llm.common import ship, stored

EXAMPLES = 20_000
TERMS = 4_000
MIN_DOCS = 5
CHI2 = 10.83
ODDS = 4.0
BLOCK = 64
NEIGHBOURS = 25
EVIDENCE = 5
REJECT = 0.3


def held_out(doc_id: str | Column = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def examples(labels: DataFrame, size: int = EXAMPLES) -> DataFrame:
    """(doc_id, toxic): the bounded sample of training labels."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    one = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def term_table(texts: DataFrame, terms: int = TERMS) -> list[str]:
    """The terms that go with the label, of texts with ``toxic``."""

    def run(batches) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        from vigilo.llm.words import plain

        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            rows = Counter()
            for text, toxic in zip(batch.column(0).cast(pa.large_binary()), batch.column(1).to_pylist()):
                rows[toxic] += 1
                seen[toxic].update({plain(p) for p in set((text.as_py() or b"").split())} - {""})
            for toxic, counts in seen.items():
                words = ["", *counts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array([toxic] * len(words), pa.int32()), pa.array([rows[toxic], *counts.values()], pa.int64())],
                    names=["term", "toxic", "n"],
                )

    counted = ship(texts.select("text", "toxic")).mapInArrow(run, "term string, toxic int, n bigint")
    one = F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0))
    counts = stored(counted.groupBy("term").agg(one.alias("a"), (F.sum("n") - one).alias("b")), "toxic-terms")  # "" counts the rows
    totals = counts.filter("term = ''").select(F.col("a").alias("p"), F.col("b").alias("q")).first()
    if totals is None or not totals["p"] or not totals["q"]:
        return []
    p, q = float(totals["p"]), float(totals["q"])
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    gap = a * (q - b) - b * (p - a)
    chi2 = (p + q) * gap * gap / ((a + b) * (p + q - a - b) * p * q)
    found = counts.filter((F.col("term") != "") & (F.col("a") + F.col("b") >= MIN_DOCS) & (F.col("a") + F.col("b") < p + q))
    odds = a * q >= ODDS * b * p
    found = found.withColumn("chi2", chi2).filter((F.col("chi2") >= CHI2) & odds).orderBy(F.col("chi2").desc(), "term").limit(terms)
    return [r["term"] for r in found.select("term").collect()]


class TermCounter:
    """Counts of the model's terms in whole texts; pieces seen are remembered."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> dict[int, int]:
        from collections import Counter

        from vigilo.llm.words import LONGEST, REMEMBERED, plain

        pieces = text.split() if text else []
        known = self.known
        got = [known.get(p, -2) for p in pieces]
        if -2 in got:
            for i, g in enumerate(got):
                if g == -2:
                    got[i] = self.number.get(plain(pieces[i]), -1)
                    if len(pieces[i]) <= LONGEST:
                        known[pieces[i]] = got[i]
            if len(known) > REMEMBERED:
                known.clear()
        if max(got, default=-1) < 0:
            return {}
        return dict(sorted(Counter(g for g in got if g >= 0).items()))


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, terms, counts) of every document, stored."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        count = TermCounter(held.value)
        for batch in batches:
            mine = [count(text.as_py()) for text in batch.column(1).cast(pa.large_binary())]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(m) for m in mine])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array([x for m in mine for x in part(m)], pa.int32())) for part in (dict.keys, dict.values)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(ship(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, terms array<int>, counts array<int>"), "toxic-vectors")


def unit(terms, counts, idf):
    """The weighted vector of one document, of length 1."""
    import numpy as np

    w = (1 + np.log(np.asarray(counts, dtype=float))) * idf[terms]
    return w / math.sqrt(float(w @ w))


@dataclass
class BlockMaxIndex:
    """Postings of unit vectors in blocks; ``search`` is exact."""

    size: int
    block: int = BLOCK
    #: per term: example numbers, weights, and the blocks with their largest weights
    postings: dict = field(default_factory=dict)

    @classmethod
    def build(cls, rows: list, block: int = BLOCK) -> BlockMaxIndex:
        """Of (terms, weights) vectors, numbered as they come."""
        import numpy as np

        lists: dict = {}
        for number, (terms, weights) in enumerate(rows):
            for t, w in zip(terms, weights):
                lists.setdefault(int(t), ([], []))
                lists[int(t)][0].append(number)
                lists[int(t)][1].append(float(w))
        index = cls(len(rows), block)
        for t, (numbers, weights) in lists.items():
            numbers, weights = np.array(numbers), np.array(weights)
            blocks, start = np.unique(numbers // block, return_index=True)
            index.postings[t] = (numbers, weights, blocks, np.maximum.reduceat(weights, start), np.append(start, len(numbers)))
        return index

    def search(self, terms, weights, k: int, never: int = -1):
        """Numbers and cosines of the k nearest with a cosine over 0."""
        import numpy as np

        blocks = -(-self.size // self.block)
        mine = [(self.postings[int(t)], w) for t, w in zip(terms, weights) if int(t) in self.postings]
        most = np.zeros(blocks)
        for p, w in mine:
            most[p[2]] += w * p[3]
        order = np.argsort(-most, kind="stable")
        order = order[most[order] > 0]
        numbers, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        step, at = 8, 0
        while at < len(order):
            if len(scores) == k and most[order[at]] < scores[-1] - 1e-12:
                break  # no block left can reach the k-th best
            opened = np.sort(order[at : at + step])
            at, step = at + step, 2 * step
            got = np.zeros((len(opened), self.block))
            for p, w in mine:
                where = np.searchsorted(p[2], opened)
                for row, j in enumerate(where):
                    if j < len(p[2]) and p[2][j] == opened[row]:
                        a, b = p[4][j], p[4][j + 1]
                        got[row, p[0][a:b] - opened[row] * self.block] += w * p[1][a:b]
            new = (opened[:, None] * self.block + np.arange(self.block)).ravel()
            numbers, scores = np.append(numbers, new), np.append(scores, got.ravel())
            keep = (scores > 0) & (numbers != never)
            numbers, scores = numbers[keep], scores[keep]
            best = np.lexsort((numbers, -np.round(scores, 12)))[:k]
            numbers, scores = numbers[best], scores[best]
        return numbers, scores


@dataclass
class Model:
    terms: list[str]
    idf: object
    index: BlockMaxIndex
    ids: list
    toxic: object
    number: dict
    base: float  # rate of the examples that have a term
    none: float  # rate of those that have none
    curve: tuple = (1.0, 0.0)

    def vote(self, terms, counts, doc_id=None, k: int = NEIGHBOURS):
        """(share of toxic votes, neighbours' numbers, cosines)."""
        import numpy as np

        numbers, near = self.index.search(terms, unit(terms, counts, self.idf), k, self.number.get(doc_id, -1))
        weight = near / (1.05 - np.minimum(near, 1.0))
        return (float(weight @ self.toxic[numbers]) + self.base) / (float(weight.sum()) + 1.0), numbers, near

    def score(self, share: float) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-(a * _logit(share) + b)))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def logistic_curve(x, y) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a x + b))), by Newton steps with smoothed
    targets and a small pull to a = 1, b = 0."""
    import numpy as np

    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    if len(x) < 20 or y.min() == y.max():
        return 1.0, 0.0
    up, down = y.sum(), len(y) - y.sum()
    goal = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    design, theta = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (p - goal) + (theta - [1.0, 0.0])
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + np.eye(2), slope)
        theta = theta - step
        if np.abs(step).max() < 1e-9:
            break
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, sample_size: int = EXAMPLES, terms: int = TERMS) -> tuple[Model, DataFrame]:
    """The model, and the vectors of all documents it was counted over."""
    import numpy as np

    sample = stored(examples(labels, sample_size), "toxic-examples")
    known = F.broadcast(sample)  # at most sample_size rows of two numbers
    words = term_table(docs.select("doc_id", "text").join(known, "doc_id"), terms)
    rows = vectors(docs, words)
    n = rows.count()
    df = np.zeros(len(words))
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per term
        df[r["t"]] = r["count"]
    idf = np.log((1 + n) / (1 + df)) + 1
    labelled = rows.join(known, "doc_id").groupBy("doc_id").agg(F.min(F.struct("terms", "counts", "toxic")).alias("v"))
    labelled = sorted(((r["doc_id"], *r["v"]) for r in labelled.collect()), key=lambda r: r[0])  # at most sample_size rows
    empty = [r for r in labelled if not r[1]]
    full = [r for r in labelled if r[1]]
    rate = lambda rows: (sum(r[3] for r in rows) + 0.1) / (len(rows) + 1)
    index = BlockMaxIndex.build([(t, unit(t, c, idf)) for _, t, c, _ in full])
    model = Model(words, idf, index, [r[0] for r in full], np.array([r[3] for r in full], dtype=float), {r[0]: i for i, r in enumerate(full)}, rate(full), rate(empty))
    own = score_rows(rows.join(known.select(F.col("doc_id").alias("sampled"), "toxic"), F.col("doc_id") == F.col("sampled")), model, "toxic")
    votes = own.filter("share is not null").select("share", "toxic").collect()  # the examples' own leave-one-out votes
    model.curve = logistic_curve([_logit(r["share"]) for r in votes], [r["toxic"] for r in votes])
    return model, rows


class Scorer:
    """Scores of documents; equal vectors are searched once."""

    def __init__(self, model: Model):
        self.model, self.seen = model, {}

    def __call__(self, doc_id, terms, counts) -> tuple:
        """(score, share, evidence); share is None without a term."""
        m = self.model
        if not terms:
            return m.none, None, []
        key = (tuple(terms), tuple(counts))
        own = doc_id in m.number  # an example, which is not its own neighbour
        if not own and key in self.seen:
            return self.seen[key]
        share, numbers, near = m.vote(terms, counts, doc_id)
        evidence = [{"doc_id": m.ids[i], "cosine": float(s), "toxic": int(m.toxic[i])} for i, s in zip(numbers[:EVIDENCE].tolist(), near)]
        got = (m.score(share), share, evidence)
        if not own and len(self.seen) < 50_000:
            self.seen[key] = got
        return got


def score_rows(rows: DataFrame, model: Model, *more: str) -> DataFrame:
    """doc_id, score, share, evidence (and int columns ``more``) of vectors."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator:
        import pyarrow as pa

        score = Scorer(held.value)
        for batch in batches:
            out = [score(*row) for row in zip(*[batch.column(i).to_pylist() for i in range(3)])]
            cols = list(zip(*out)) or [[], [], []]
            evidence = pa.array(cols[2], pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.float64()), evidence, *batch.columns[3:]],
                names=["doc_id", "score", "share", "evidence", *more],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    extra = "".join(f", {c} int" for c in more)
    chosen = ship(rows.select("doc_id", "terms", "counts", *more))
    return chosen.mapInArrow(run, f"doc_id {kind}, score double, share double, evidence array<struct<doc_id bigint, cosine double, toxic int>>{extra}")


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every document."""
    model, rows = fit(docs, labels, **options)
    scored = score_rows(rows, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows that score under ``REJECT``, with all their columns; one scan,
    nothing shuffled."""
    model, _ = fit(docs, labels, **options)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")

    def run(batches) -> Iterator:
        import pyarrow as pa

        score, count = Scorer(held.value), TermCounter(held.value.terms)
        for batch in batches:
            clean = []
            for doc_id, text in zip(batch.column(at).to_pylist(), batch.column(text_at).cast(pa.large_binary())):
                found = count(text.as_py())
                clean.append(score(doc_id, list(found), list(found.values()))[0] < REJECT)
            yield batch.filter(pa.array(clean, pa.bool_()))

    return ship(docs).mapInArrow(run, docs.schema)
