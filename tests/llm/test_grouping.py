"""Grouping genetic packing: the search, and the packing of whole tables."""

import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from vigilo.llm import grouping as g
from vigilo.llm.queries import byte_tokenizer

SCHEMA = "doc_id bigint, text string, piece string, length string, doc string"
SIZES = st.lists(st.integers(1, 50), min_size=1, max_size=60)


def check(sizes, bins, capacity):
    assert sorted(i for _, b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) == fill <= capacity for fill, b in bins)


def fewest(sizes, capacity):
    """The least number of bins, by trying every place for every item."""
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for n in range(len(rooms)):
            if rooms[n] >= sizes[k] and rooms[n] not in rooms[:n]:
                place(k + 1, rooms[:n] + [rooms[n] - sizes[k]] + rooms[n + 1 :])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(SIZES, st.integers(0, 99))
def test_children_are_packings_that_keep_the_givers_bins(sizes, seed):
    rng = random.Random(seed)
    a, b = g.first_population(sizes, 50, rng, 2)
    child = g.crossover(sizes, a, b, 50, rng)
    check(sizes, child, 50)
    assert any(set(x) <= set(y) for _, x in a for _, y in child)
    check(sizes, g.mutate(sizes, child, 50, rng), 50)
    evolved = g.evolve(sizes, [a, b], 50, rng, 0)
    check(sizes, evolved[0], 50)
    assert g.fitness(evolved[0], 50) >= max(g.fitness(x, 50) for x in (a, b))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_and_search_against_every_packing(sizes):
    least = fewest(sorted(sizes, reverse=True), 20)
    rng = random.Random(1)
    bound = g.lower_bound(sizes, 20)
    assert bound <= least
    assert len(g.evolve(sizes, g.first_population(sizes, 20, rng), 20, rng, bound)[0]) <= least + 1


def test_search_beats_best_fit_decreasing():
    """Triples that fill bins exactly: best fit alone does not find them."""
    rng = random.Random(5)
    sizes = []
    for _ in range(40):
        a = rng.randint(260, 480)
        b = rng.randint(260, 1000 - a - 250)
        sizes += [a, b, 1000 - a - b]
    first = g.first_population(sizes, 1000, rng)
    plain = len(first[0])
    best = first
    for _ in range(4):
        best = g.evolve(sizes, best, 1000, rng, 40, children=60)
    assert len(best[0]) < plain and g.lower_bound(sizes, 1000) == 40


def verify(rows, docs, capacity):
    """Every contract of the result; returns the number of sequences."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(byte_tokenizer())
    wanted, found, sequences = defaultdict(int), defaultdict(int), defaultdict(list)
    for doc_id, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids), capacity), len(ids)]
        for at, (a, b) in enumerate(zip(edges, edges[1:])):
            wanted[(doc_id, at, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    for r in rows:
        found[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert found == wanted
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents_are_packed_whole(spark, monkeypatch):
    """Several blocks and levels, on small blocks."""
    monkeypatch.setattr(g, "BLOCK", 120)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    docs += [(None, None), (None, ""), (5, "twice"), (5, "twice"), (7, "a <|endoftext|> b"), (8, "word " * 5000)]
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in docs], SCHEMA).repartition(3)
    rows = g.pack_groups(df, byte_tokenizer()).collect()
    n = verify(rows, docs, 1024)
    bound = sum(r.length == 1024 for r in rows) + g.lower_bound([r.length for r in rows if r.length < 1024], 1024)
    assert n <= bound * 1.01 + 1, (n, bound)
    again = g.pack_groups(df, byte_tokenizer()).collect()
    place = lambda rows: sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset) for r in rows)
    assert [r[:5] for r in place(rows)] == [r[:5] for r in place(again)] and len({r[5] for r in place(again)}) == n


def test_many_tiny_documents_end(spark, monkeypatch):
    monkeypatch.setattr(g, "BLOCK", 50)
    monkeypatch.setattr(g, "LARGEST_BLOCK", 130)
    docs = [(i, "") for i in range(400)]
    rows = g.pack_groups(spark.createDataFrame([(i, t, "", "", "") for i, t in docs], SCHEMA), byte_tokenizer(), with_ids=True).collect()
    assert verify(rows, docs, 1024) <= 4 and all(r.ids == [2] for r in rows)


def test_empty_table(spark):
    assert g.pack_groups(spark.createDataFrame([], SCHEMA), byte_tokenizer()).count() == 0


def test_a_column_of_texts_has_the_ids_of_the_tokenizer_and_looks_words_up_once():
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    from vigilo.llm.byte_level import ByteLevel

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [
        "", None, " ", "a", " a", "a ", "a b", "a  b", "a \nb", "a\n b", "a\n\nb c\td", "a\xa0b \xa0c", "a \x85b", "a \x1cb c", "it's 's don't 've x 12 3.4 (y) -- z",
        "Élève à l'école ß", "日本 語", "x <|endoftext|> y", "a <|endoftext|>", "w " * 3000 + "end", "\n", "\n a", "a b\r\nc d",
    ]
    encoder, plain = ByteLevel(path), Tokenizer.from_file(path)
    found = [x.tolist() for x in encoder.column(pa.array(texts, pa.string()))]
    assert found == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.column(pa.array([], pa.string()))] == []

    fast, seen = encoder.fast, []

    class Counted:
        def encode_ordinary(self, text):
            seen.append(text)
            return fast.encode_ordinary(text)

    encoder.fast = Counted()
    texts = ["a b a b a b a b"] * 5
    assert [x.tolist() for x in encoder.column(pa.array(texts))] == [fast.encode_ordinary(t) for t in texts]
    assert sum(map(len, seen)) <= len(" a b") + 5  # each word with its space, and the first of each text
