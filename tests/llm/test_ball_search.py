"""Ball-tree search against every score."""

import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from vigilo.llm import ball_search as bs

DOCS = "doc_id bigint, text string, item_id string, rank string, score string"
ITEMS = "item_id bigint, text string, doc_id string, item string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    """The contract: (item's place, doc_id, score) lists of every item."""
    found = [(i, Counter(words(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(w for _, c, _ in found for w in c)
    out = []
    for item_id, text in items:
        asked, scored = Counter(words(text)), []
        for doc_id, c, n in found:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w, k in asked.items() if w in c
            )
            if score > 0:
                scored.append((doc_id, score))
        scored.sort(key=lambda x: (-x[1], x[0] is None, x[0]))
        out += [(item_id, rank, d, s) for rank, (d, s) in enumerate(scored[:10], 1)]
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abAZ09 .-_\x00\x7f\x80é\xa0ſK"), st.characters(codec="utf-8")), max_size=30))
def test_terms_are_the_patterns_matches(text):
    assert [t.decode() for t in bs.terms(text.encode())] == words(text)


def rows_of(vectors):
    return bs.Rows(
        np.array([len(v) for v in vectors]), np.array([c for v in vectors for c in sorted(v)]), np.array([v[c] for v in vectors for c in sorted(v)], dtype=np.int64)
    )


@settings(max_examples=120, deadline=None)
@given(
    st.lists(st.dictionaries(st.integers(0, 30), st.integers(1, 10**6), min_size=1, max_size=8), min_size=1, max_size=60),
    st.lists(st.dictionaries(st.integers(0, 30), st.integers(0, 40_000), max_size=5), min_size=1, max_size=4),
    st.integers(1, 5),
)
def test_bounds_hold_and_lists_are_whole(vectors, asked, top):
    leaf, bs.LEAF, centre, bs.CENTRE = bs.LEAF, 3, bs.CENTRE, 5
    try:
        rows = rows_of(vectors)
        order, nodes = bs.build_tree(rows, 31)
    finally:
        bs.LEAF, bs.CENTRE = leaf, centre
    assert sorted(order.tolist()) == list(range(len(vectors)))
    for low, high, left, right, radius, columns, values in nodes:
        middle = dict(zip(columns.tolist(), values.tolist()))
        for i in order[low:high].tolist():
            gap = sum((vectors[i].get(c, 0) - middle.get(c, 0)) ** 2 for c in {*vectors[i], *middle})
            assert gap <= radius**2
        assert left < 0 or (nodes[left][0], nodes[left][1], nodes[right][1]) == (low, nodes[right][0], high)
    matrix = np.zeros((31, len(asked)), dtype=np.int64)
    for q, a in enumerate(asked):
        for c, w in a.items():
            matrix[c, q] = w
    ids = [(i * 7) % 1000 for i in range(len(vectors))]
    got = bs.Tree([ids[i] for i in order], rows.pick(order), nodes).search(np.arange(31), matrix, top)
    for a, found in zip(asked, got):
        scores = [(sum(w * v.get(c, 0) for c, w in a.items()), i) for v, i in zip(vectors, ids)]
        assert found == [(s, i) for s, i in sorted(scores, key=lambda x: (-x[0], x[1])) if s > 0][:top]


def test_subtrees_are_pruned():
    """Copies and far clusters: most leaves are never scored."""
    r = random.Random(3)
    vectors = [{c * 10 + r.randrange(10): r.randint(400_000, 600_000) for _ in range(6)} for c in range(60) for _ in range(50)]
    rows = rows_of(vectors)
    order, nodes = bs.build_tree(rows, 600)
    tree = bs.Tree(order.tolist(), rows.pick(order), nodes)
    matrix = np.zeros((600, 1), dtype=np.int64)
    matrix[50:60, 0] = 9_000
    tree.search(np.arange(600), matrix)
    leaves = sum(n[2] < 0 for n in nodes)
    assert 0 < tree.scored < leaves / 4, (tree.scored, leaves)


def test_ranked_search_equals_every_score(spark, monkeypatch):
    monkeypatch.setattr(bs, "SHARD_DOCS", 150)
    monkeypatch.setattr(bs, "LEAF", 8)
    monkeypatch.setattr(bs, "TILE", 15)
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs += [(None, None), (7001, ""), (7002, "... --"), (None, docs[3][1]), docs[4], (7003, docs[5][1]), (7004, "Ünïcode 日本 x1 " * 20_000)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(None, docs[3][1]), (9001, None), (9002, "zzzznone"), (9003, "日本 X1 x1"), (9004, docs[4][1]), (9004, docs[4][1]), (9005, "")]
    got = bs.ranked_search(
        spark.createDataFrame([(i, t, "a", "b", "c") for i, t in docs], DOCS).repartition(3), spark.createDataFrame([(i, t, "d", "e") for i, t in items], ITEMS)
    ).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(plain(docs, items), key=key)


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b", "", "", "")], DOCS)
    assert bs.ranked_search(none, spark.createDataFrame([(1, "a", "", "")], ITEMS)).count() == 0
    assert bs.ranked_search(some, spark.createDataFrame([], ITEMS)).count() == 0


def test_a_task_holds_one_shard_at_a_time(spark, monkeypatch):
    """Many shards from one task: a row group each, read and sent to Python one by one."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(bs, "SHARD_DOCS", 4)
    limits = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before, tables, stored = [spark.conf.get(k, None) for k in limits], {}, bs.stored

    def noted(df, name, *more):
        out = stored(df, name, *more)
        files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in out.inputFiles()]
        tables[name] = (sorted(m.row_group(g).num_rows for m in files for g in range(m.num_row_groups)), [spark.conf.get(k, None) for k in limits])
        return out

    monkeypatch.setattr(bs, "stored", noted)
    docs = [(i, f"a b{i} c{i % 3}", "", "", "") for i in range(40)]
    got = bs.ranked_search(spark.createDataFrame(docs, DOCS).coalesce(1), spark.createDataFrame([(1, "c1 b7", "", "")], ITEMS)).collect()
    assert sorted(map(tuple, got)) == sorted(plain([d[:2] for d in docs], [(1, "c1 b7")]))
    assert tables["terms"][0] == tables["trees"][0] == [1] * 10
    assert tables["trees"][1] == ["1", "1"] and int(tables["terms"][1][0]) <= 500
    assert [spark.conf.get(k, None) for k in limits] == before
