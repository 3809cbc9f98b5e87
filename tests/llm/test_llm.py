"""Each operator of vigilo.llm against a plain version, on small tables with
nulls, empty and long texts, ties, repeated rows and clashing column names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, file string, size int"
WORDS = ["alpha", "beta", "Gamma,", "delta.", "été", "straße", "x1", "42!", "<s>", "naïve", "tree", "house", "river", "stone"]


def make(n=60, seed=1):
    r = random.Random(seed)
    texts = [" ".join(r.choice(WORDS) + str(r.randint(0, 300)) for _ in range(r.choice([0, 1, 4, 30, 90]))) for _ in range(n)]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t), "clash", 1) for i, t in enumerate(texts)]
    rows += [(i, None, None, None, None, None, None) for i in (900, 901)] + [(None, "no id here", "en", "s1", 1, "f", 2)]
    rows += [(1000 + i, rows[i][1], "en", "s0", 1, "f", 2) for i in range(0, n, 5)]  # copies
    rows += [(2000, "  ".join(texts[3].split(" ")), "en", "s0", 1, "f", 2), rows[3], rows[3]]
    long = " ".join(r.choice(WORDS) for _ in range(30_000))
    changed = long.split(" ")
    changed[700] = "other"
    return rows + [(3000, long, "de", "s9", 1, "f", 2), (3001, " ".join(changed), "de", "s9", 1, "f", 2)]


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    return P.path("word_bpe_49k.json")


def ids_of(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [2]


# ------------------------------------------------------------ exact dedup


def expected_groups(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted((str(r[0]), str(keep[norm(r[1])]), len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(docs, rows, weak):
    from vigilo.llm.exact_dedup import exact_groups

    # a weak key makes different texts share their state: bytes decide
    found = exact_groups(docs, key=lambda c: F.substring(c, 1, 1)) if weak else exact_groups(docs, files_per_batch=1)
    got = found.collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expected_groups(rows)
    assert sum(r.kept for r in got) == len({norm(r[1]) for r in rows})


def test_state_goes_on_with_new_files(spark, docs, tmp_path):
    from vigilo.llm.exact_dedup import arrivals, located, read_state, update_state

    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    located_rows = located(docs, "doc_id", "text")
    for part in (F.col("doc_id") < 1000, F.col("doc_id") >= 1000):
        arrivals(located_rows.filter(part), log)
        update_state(spark, log, state)
    assert read_state(spark, state).agg(F.sum("group_size")).first()[0] == docs.filter("doc_id is not null").count()


def test_drop_duplicates_keeps_columns(docs, empty, rows):
    from vigilo.llm.exact_dedup import drop_duplicates

    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len({norm(r[1]) for r in rows})
    assert drop_duplicates(empty).count() == 0


# -------------------------------------------------------- near-duplicates


def test_near_groups_against_all_pairs(spark, docs, rows):
    from vigilo.llm import near_dedup as N

    r = random.Random(5)
    base = [f"w{r.randint(0, 400)}" for _ in range(120)]
    more = []
    for i in range(40):
        t = list(base)
        for _ in range(i % 5):
            t[r.randrange(len(t))] = f"z{r.randint(0, 9)}"
        more.append((5000 + i, " ".join(t), "en", "s", 1, "f", 1))
    every = rows + more
    got = N.near_groups(docs.unionByName(spark.createDataFrame(more, SCHEMA))).collect()
    parsed = [N.shingles_of((x[1] or "").encode()) for x in every]
    parent = list(range(len(every)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(every)):
        for j in range(i):
            if (len(parsed[i]) == len(parsed[j]) == 0) or (len(parsed[i]) and len(parsed[j]) and N.similarity(parsed[i], parsed[j]) > 0):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    classes = {}
    for i, x in enumerate(every):
        classes.setdefault(root(i), []).append(str(x[0]))
    found = {}
    for x in got:
        found.setdefault((x.class_id, x.class_size), []).append(str(x.doc_id))
    assert sorted(sorted(v) for v in classes.values()) == sorted(sorted(v) for v in found.values())
    assert sum(x.kept for x in got) == len(classes)


def test_alignment_needs_order():
    from vigilo.llm import near_dedup as N

    a = np.arange(100, dtype=np.uint64)
    assert N.similarity(a, a) == 1.0
    assert N.similarity(a, a[::-1].copy()) == 0.0
    assert N.similarity(a, np.concatenate([a[50:], a[:50]])) == 0.0
    assert N.longest_chain([3, 1, 2, 9, 4, 5]) == 4


def test_short_texts_with_one_word_more_share_a_key():
    from vigilo.llm import near_dedup as N

    r = random.Random(11)
    pairs = linked = 0
    for n in range(8, 31):
        for _ in range(40):
            words = [f"w{r.randint(0, 10**6)}" for _ in range(n)]
            more = ["added", *words] if r.random() < 0.5 else [*words, "added"]
            a, b = (N.shingles_of(" ".join(w).encode()) for w in (words, more))
            assert N.similarity(a, b) >= 0.8
            pairs += 1
            linked += bool(set(N.keys_of(a).tolist()) & set(N.keys_of(b).tolist()))
            assert len(set(N.keys_of(b).tolist())) == len(N.keys_of(b))
    assert linked == pairs


def test_short_pairs_are_grouped(spark):
    from vigilo.llm.near_dedup import near_groups

    r = random.Random(12)
    rows = []
    for i in range(60):
        words = [f"w{r.randint(0, 10**6)}" for _ in range(8)]
        rows += [(2 * i, " ".join(words), "en", "s", 1, "f", 1), (2 * i + 1, " ".join([*words, "added"]), "en", "s", 1, "f", 1)]
    got = {x.doc_id: (x.class_id, x.class_size) for x in near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (i - i % 2, 2) for i in range(120)}


def test_outlines_bound_what_is_shared():
    from vigilo.llm import near_dedup as N

    rng = np.random.default_rng(7)
    for n in (1, 5, 64, 65, 400):
        pool = rng.integers(0, 1 << 63, 3 * n).astype(np.uint64)
        centre = pool[:n]
        for _ in range(20):
            a, b = (rng.choice(pool, rng.integers(1, 2 * n + 1), replace=False) for _ in range(2))
            (x, x_spare), (y, y_spare) = N.outline(centre, a), N.outline(centre, b)
            bound = sum(int(i).bit_count() for i in (x & y).view(np.uint64)) + min(x_spare, y_spare)
            assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def test_components_of_a_chain(spark):
    from vigilo.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20], "u bigint, v bigint")
    assert {(r.node, r.component) for r in components(links).collect()} == {(i, 0 if i <= 20 else 21) for i in range(41)}


# ------------------------------------------------------------------ top-k


def test_top_k_against_brute_force(spark):
    from vigilo.llm.topk import top_k, whole_numbers

    r = np.random.RandomState(0)
    vs = {i: (r.randint(-3, 4, 6) / 8).tolist() for i in range(150)}
    rows = [(i, v) for i, v in vs.items()] + [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [0.1] * 6), (204, [0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").select("vec_id", whole_numbers("embedding").alias("v"))
    got = {(x.query_id, x.rank, x.vec_id, x.score) for x in top_k(df, F.col("vec_id") % 20 == 0, k=7, shard=16, tile=4).collect()}
    q = {i: np.floor(64 * np.array(v)).astype(int) for i, v in vs.items()}
    want = set()
    for a in range(0, 150, 20):
        order = sorted(((-int(q[a] @ q[b]), b) for b in q if b != a))[:7]
        want |= {(a, n + 1, b, -s) for n, (s, b) in enumerate(order)}
    assert got == want
    assert top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_products_beyond_doubles():
    from vigilo.llm.topk import product

    a = np.array([[2**40, 3]], dtype=np.int64)
    assert product(a, np.array([[2**20, 1]], dtype=np.int64))[0, 0] == 2**60 + 3


# ------------------------------------------------------- tokens, packing


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    from vigilo.llm.tokens import Encoder

    path = tokenizer()
    e, t, r = Encoder(path), Tokenizer.from_file(path), random.Random(2)
    alphabet = list("abZQ'.,!?;:-_19éÉ̱ßΣσ  \x1c\x85\t\n\r\x0b漢😀<|>İ\0“") + ["'s", "<|endoftext|>", "don't", "Word, "]
    for _ in range(3000):
        s = "".join(r.choice(alphabet) for _ in range(r.randint(0, 25)))
        assert e(s.encode()) == np.asarray(t.encode(s, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_encoder_columns(monkeypatch):
    """Runs of texts: every letter beside a word, nulls, white space, a border inside a text."""
    import pyarrow as pa

    from vigilo.llm import tokens

    e = tokens.encoder(tokenizer())
    monkeypatch.setattr(tokens, "RUN", 5_000)
    texts = [None, "", " \x0b ", "a\tb\x0bc\x0cd\r\n", "x" * 20_000, "The END, the end.\n(the) end***"] * 2
    texts += [f"Ab{chr(c)} {chr(c)}Cd{chr(c)}!?" for c in [*range(0x600), *range(0x1E00, 0x2200)]]
    got = []
    for offsets, ids in e.column(pa.array(texts), 2):
        got += [ids[a:b].tolist() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    assert got == [e.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_token_files(spark, docs, rows, tmp_path):
    import pyarrow.parquet as pq

    from vigilo.llm import token_files as T

    path, out = tokenizer(), str(tmp_path / "tokens")
    T.write_tokens(docs, out, path, partitions=3)
    got = T.token_checksums(spark, out).join(T.token_index(spark, out), ["file", "row"]).orderBy("start").collect()
    start, by_id = 0, {}
    for r in rows:
        by_id.setdefault(r[0], []).append(np.asarray(ids_of(path, r[1]), dtype="<u4").tobytes())
    order = [g.doc_id for g in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0)) and len(got) == len(rows)
    for g in got:
        assert g.start == start and g.ids_crc32 in {zlib.crc32(b) for b in by_id[g.doc_id]}
        start += g.n_tokens
    meta = pq.ParquetFile(next((tmp_path / "tokens").glob("part-*"))).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema.split(".")[0]: meta.column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "RLE_DICTIONARY" in columns["ids"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    assert T.read_tokens(spark, out, ["n_tokens"], 10, 20).count() == 11


def test_packing(docs, empty, rows):
    from vigilo.llm.packing import pack_documents

    path = tokenizer()
    got = pack_documents(docs, path).collect()
    sequences, pieces = {}, {}
    for g in got:
        sequences.setdefault(g.sequence_id, []).append((g.offset, g.length))
        pieces.setdefault(g.doc_id, []).append((g.start, g.length, g.ids_crc32))
    for parts in sequences.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:i]) for i, (o, _) in enumerate(parts))
        total = sum(n for _, n in parts)
        assert total == 4096 or (total < 4096 and total & (total - 1) == 0)
    for r in rows[:50]:
        ids = np.asarray(ids_of(path, r[1]), dtype="<u4")
        for start, n, crc in pieces[r[0]]:
            assert crc == zlib.crc32(ids[start : start + n].tobytes())
    assert sum(g.length for g in got) == sum(len(ids_of(path, r[1])) for r in rows)
    assert pack_documents(empty, path).count() == 0


def test_sum_of_squares_choice():
    from vigilo.llm.packing import SumOfSquares

    s, r = SumOfSquares(50), random.Random(4)
    for _ in range(400):
        size = r.randint(1, 49)
        options = []
        for h in range(0, 50 - size + 1):
            if h == 0 or s.level[h]:
                n = s.level.copy()
                if h:
                    n[h] -= 1
                if h + size < 50:
                    n[h + size] += 1
                options.append((int((n[:50] ** 2).sum()), -h))
        assert s.choose(size) == -min(options)[1]
        s.put(size, (0, 0, b"", 0))


# ----------------------------------------------------------------- mixing


def test_mixing(docs, empty, rows):
    from vigilo.llm.mixing import mix, mix_counts

    a, b = mix_counts(docs, block_docs=4).collect(), mix_counts(docs.repartition(2), block_docs=4).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken, r.target, sorted(r.shards))
    assert sorted(map(key, a)) == sorted(map(key, b)) and len(a) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums = {}
    for r in rows:
        sums[r[3]] = sums.get(r[3], 0) + size(r[1])
    names = sorted((s for s in sums if s is not None)) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, fixed = {}, set()
    while True:
        free = [s for s in names if s not in fixed]
        rest = sum(sums.values()) - sum(3 * sums[s] for s in fixed)
        target = {s: 3 * sums[s] if s in fixed else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        over = [s for s in free if target[s] > 3 * sums[s]]
        if not over:
            break
        fixed |= set(over)
    assert {round(r.target, 4) for r in a} == {round(float(t), 4) for t in target.values()}
    assert all(r.taken <= 3 * r.size and r.taken == r.size * len(r.shards) for r in a)
    mixed = mix(docs, with_shard=True, block_docs=4)
    assert mixed.columns == docs.columns + ["shard"]
    assert mixed.count() == sum(len(r.shards) for r in a)
    assert mix(empty).count() == 0 and mix_counts(empty).count() == 0


def test_split_quotas_are_exact(spark):
    from vigilo.llm.mixing import split_quotas

    quotas = spark.createDataFrame([(False, "a", 40), (False, "b", 25), (True, "", 7)], "no_source boolean, source_key string, n bigint")
    got = split_quotas(quotas, 3, 1).collect()
    by_shard, by_source = {}, {}
    for r in got:
        by_shard[r.shard] = by_shard.get(r.shard, 0) + r.n
        by_source[r.source_key] = by_source.get(r.source_key, 0) + r.n
    assert by_source == {"a": 40, "b": 25, "": 7} and set(by_shard.values()) == {9}


def test_split_quotas_spread_as_random_draws(spark):
    """Left shares of 300 equal sources: mean and variance of a hypergeometric count."""
    from vigilo.llm.mixing import split_quotas

    quotas = spark.createDataFrame([(False, f"s{i:03}", 50) for i in range(300)], "no_source boolean, source_key string, n bigint")
    left = [r.n for r in split_quotas(quotas, 1, 5).filter("shard = 0").collect()]
    assert sum(left) == 7_500 and len(left) == 300
    variance = sum((n - 25) ** 2 for n in left) / 300  # expected 12.5 * (15000 - 50) / 14999
    assert 9 < variance < 16
    assert split_quotas(quotas.filter("n < 0"), 2, 5).count() == 0


def test_mixing_tells_rows_without_an_id_apart(spark):
    """Rows without an id, alike or not, beside rows with ids: both sources meet
    their targets, within a document of 10 words."""
    from vigilo.llm.mixing import mix, mix_counts

    same, ten = "a b c d e f g h i j", "a b c d e f g h i "
    for first in ([(None, same, "x")] * 3_000, [(None, ten + str(i), "x") for i in range(3_000)]):
        rows = first + [(i, ten + str(i), "y") for i in range(3_000)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
        # sizes 30,000 each: targets 20,000 and 40,000
        got = mix_counts(docs, block_docs=64).groupBy((F.col("target") < 30_000).alias("x")).agg(F.sum("taken").alias("taken"), F.count("*").alias("n"))
        assert {(r.x, r.taken, r.n) for r in got.collect()} == {(True, 20_000, 3_000), (False, 40_000, 3_000)}
        mixed = mix(docs, block_docs=64).groupBy("source").count().collect()
        assert {tuple(r) for r in mixed} == {("x", 2_000), ("y", 4_000)}


# ------------------------------------------------------------------ lines


def without_repeats(texts):
    """Lines left of each text when runs of two lines (blank ones between them
    included) that stand earlier somewhere are taken out; written without
    chunks or hashes."""
    seen, left = set(), []
    for t in texts:
        lines, gone = (t or "").split("\n"), set()
        full = [i for i, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        for a, b in zip(full, full[1:]):
            run = "\n".join(lines[a : b + 1])
            if run in seen:
                gone.update(range(a, b + 1))
            seen.add(run)
        left.append([x for i, x in enumerate(lines) if i not in gone])
    return left


def test_line_chunks(spark, empty):
    from vigilo.llm.line_dedup import drop_repeated_chunks, line_report

    r = random.Random(3)
    number = iter(range(10**6))
    line = lambda: " ".join(r.choice(WORDS) for _ in range(5)) + f" {next(number)}"
    own = lambda n: [line() for _ in range(n)]
    passages = {n: own(n) for n in range(2, 13)}
    texts = []
    for n, passage in passages.items():  # each in changing surroundings, once with a blank line in all its copies
        passage[1:1] = [""] * (n == 5)
        texts += ["\n".join(own(k) + passage + own(2 - k)) for k in range(3)]
    single = line()
    texts += [None, "", "one line", "one line", f"{single}\n{line()}", f"{single}\n{line()}", "x\n\n\n\ny1", "x\n\n\n\ny2", "a\nb\na\nb", "a\r\nb"]
    texts += ["\n".join(own(20_000) + passages[12]), texts[0], texts[0]]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, texts[1], "x", "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, hash string, file string").repartition(3)
    got = {x.doc_id: x for x in line_report(df).collect()}
    want = without_repeats([t for _, t, *_ in rows])
    for (i, t, *_), left in zip(rows, want):
        assert got[i].clean_sha256 == hashlib.sha256("\n".join(left).encode()).hexdigest(), (i, t[:80])
        assert got[i].n_lines - got[i].removed_lines == len(left)
    assert all(got[3 * (n - 2) + k].removed_lines == len(p) for n, p in passages.items() for k in (1, 2))
    kept = {x.doc_id: x.text for x in drop_repeated_chunks(df).collect()}
    assert kept[4] == "\n".join(want[4]) and drop_repeated_chunks(df).columns == df.columns
    assert line_report(empty).count() == 0


def test_borders_depend_on_their_window_only():
    from vigilo.llm.line_dedup import cut_lines

    r = random.Random(4)
    passage = [b"p%d" % r.randrange(10**9) for _ in range(60)]
    inner = set()
    for k in (0, 3, 7):
        around = [b"o%d" % r.randrange(10**9) for _ in range(k)]
        chunks = cut_lines(around + passage + around, divisor=4)
        inner.add(tuple((a - k, n) for a, n in chunks if a - k >= 2 and a + n - k <= 58))
    assert len({x[1:-1] for x in inner}) == 1 and all(len(x) > 5 for x in inner)


# --------------------------------------------------------------- toxicity


def test_index_is_exact():
    from vigilo.llm.toxicity import BlockMaxIndex

    r = np.random.RandomState(1)
    rows = []
    for _ in range(500):
        terms = np.sort(r.choice(40, r.randint(1, 6), replace=False))
        w = r.rand(len(terms)) + 0.1
        rows.append((terms, w / np.sqrt(w @ w)))
    index = BlockMaxIndex.build(rows, block=16)
    dense = np.zeros((500, 40))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    for terms, w in rows[:60]:
        scores = dense[:, terms] @ w
        want = [i for i in sorted(range(500), key=lambda i: (-round(scores[i], 12), i)) if scores[i] > 0][:9]
        assert index.search(terms, w, 9)[0].tolist() == want


def test_toxicity_learns_and_keeps_clean(spark, docs, empty):
    from vigilo.llm.toxicity import drop_toxic, toxicity

    r = random.Random(7)
    rows, marks = [], []
    for i in range(600):
        words = [f"w{r.randint(0, 200)}" for _ in range(30)]
        bad = i % 6 == 0
        if bad:
            words[r.randrange(30)] = r.choice(["Vile,", "rotten"])
        rows.append((i, " ".join(words), "en", "s", 1, "f", 1))
        marks.append((i, int(bad)))
    table = spark.createDataFrame(rows + [(9000, None, None, None, None, None, None)], SCHEMA)
    labels = spark.createDataFrame(marks + [(None, 1), (5, None), (7000, 1)], "doc_id bigint, toxic int")
    got = {x.doc_id: x for x in toxicity(table, labels).collect()}
    truth = dict(marks)
    assert all(got[i].predicted == truth[i] for i in truth)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    assert got[9000].predicted == 0 and all(0 <= x.score <= 1 for x in got.values())
    assert all(e.doc_id != x.doc_id for x in got.values() for e in x.evidence)
    clean = drop_toxic(table, labels)
    assert clean.columns == table.columns and clean.count() == 501
    assert toxicity(empty, labels).count() == 0
    assert toxicity(docs, labels.limit(0)).agg(F.max("score")).first()[0] == pytest.approx(0.1)


@pytest.mark.parametrize("share", [0.3, 0.5, 0.8])
def test_toxicity_learns_at_any_base_rate(spark, share):
    from vigilo.llm.toxicity import drop_toxic, toxicity

    r = random.Random(8)
    rows, marks = [], []
    for i in range(600):
        words = [f"w{r.randint(0, 200)}" for _ in range(30)]
        bad = i % 10 < 10 * share
        if bad:
            words[r.randrange(30)] = r.choice(["Vile,", "rotten"])
        rows.append((i, " ".join(words), "en", "s", 1, "f", 1))
        marks.append((i, int(bad)))
    table = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    assert {x.doc_id: x.predicted for x in toxicity(table, labels).collect()} == dict(marks)
    assert {x.doc_id for x in drop_toxic(table, labels).collect()} == {i for i, bad in marks if not bad}


# --------------------------------------------------------------- licenses


def test_license_scan(spark, empty):
    from vigilo.llm.license_scan import scan
    from vigilo.llm.license_texts import TEMPLATES

    r = random.Random(9)
    rows, want = [(0, None), (1, ""), (2, "no template here " * 50)], set()
    for i, (name, text) in enumerate(TEMPLATES.items()):
        words = text.split()
        if len(words) > 30:
            for _ in range(len(words) // 20):
                words[r.randrange(len(words))] = "changed"
        before = " ".join(f"p{r.randint(0, 99)}" for _ in range(i * 7))
        rows.append((10 + i, f"{before} {' '.join(words)} tail"))
        want.add((10 + i, name))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = scan(df).collect()
    assert want <= {(x.doc_id, x.license) for x in got} and all(x.coverage >= 0.8 for x in got)
    assert {x.doc_id for x in got} == {d for d, _ in want}
    text = dict(rows)
    for x in got:
        assert text[x.doc_id][x.start : x.end].split()[-1].strip('."') in TEMPLATES[x.license] or x.coverage < 1
    assert scan(empty).count() == 0


# ------------------------------------------------------------------- chat


def test_chat_round_trip(spark):
    from vigilo.llm.chat import digests, expand

    odd = "a </s> \\ [INST]x[/INST] \\\\</s> <<SYS>> <s>\n"
    rows = [(1, 0, "system", odd), (1, 1, "user", None), (1, 2, "assistant", odd), (1, 3, "user", "q"), (1, 4, "assistant", "r"), (1, 5, "user", "open"),
            (2, 0, "user", "only"), (3, 0, "assistant", ""), (4, None, None, "x"), (4, 1, "assistant", "y"), (4, 1, "assistant", "y"), (5, 0, "as[INST]k", odd)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    examples = expand(df)
    assert not examples.filter(F.regexp_count("formatted", F.lit("</s>")) > 6).count()
    got = {x.conv_id: x for x in digests(examples).collect()}
    for c in {r[0] for r in rows}:
        mine = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        every = "".join(f"{role}\n{text}\n" for _, _, role, text in mine)
        loss = "".join(text for _, _, role, text in mine if role == "assistant")
        assert got[c].n_turns == len(mine) and got[c].turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    lone = spark.createDataFrame([(None, 0, "user", "a"), (None, 0, "user", "b")], df.schema)
    assert expand(lone).count() == 2 and digests(expand(df.limit(0))).count() == 0


def test_chat_rows_without_conv_id(spark, monkeypatch):
    from vigilo.llm import chat

    monkeypatch.setattr(chat, "COPIES", 2, raising=False)
    rows = [(None, 0, "user", "a"), (None, 0, "user", "b"), (None, None, None, None), (None, 3, "assistant", "a"), (1, 0, "user", "a")] + [(None, 1, "assistant", "same")] * 5
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    want = sorted(
        (c is not None, 1, hashlib.sha256(f"{role or ''}\n{text or ''}\n".encode()).hexdigest(), len(text or "") if role == "assistant" else 0)
        for c, _, role, text in rows
    )
    examples = chat.expand(df)
    got = sorted((x.conv_id is not None, x.n_turns, x.turns_sha256, x.loss_chars) for x in chat.digests(examples).collect())
    assert got == want
    names = lambda e: sorted((x.conv_id or 0, x.lone or "") for x in e.collect())
    assert len(set(names(examples))) == len(rows) and names(examples) == names(chat.expand(df.repartition(5)))


# ------------------------------------------------- registered queries, SQL


def test_sql_queries_match(spark):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))
    from oracle_check import compare

    from vigilo.llm import sql

    assert compare(spark, "/root/testdata/sf0.001", list(sql.statements())) == {k: "OK" for k in sql.statements()}


def test_pipeline_runs(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
