"""Alignment of two tokenizers against a brute-force version."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from vigilo.llm import alignment as al
from vigilo.llm.queries import byte_tokenizer, piece_tokenizer

SCHEMA = "doc_id bigint, text string, extra string, n_a string, doc string"


@pytest.fixture(scope="module")
def coders():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(byte_tokenizer())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=piece_tokenizer())


def plain_tokens(text, coders):
    """[(id, end)] of both tokenizers, or None."""
    from vigilo.llm.tokens import byte_letters

    a, b = coders
    if not text:
        return None
    letters = {chr(v): k for k, v in byte_letters().items()}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return None
    out = []
    for ids, raw in ((ids_a, raw_a), (ids_b, raw_b)):
        end, found = 0, []
        for i, r in zip(ids, raw):
            end += len(r)
            found.append((i, end))
        out.append(found)
    return out


def plain(texts, coders):
    """The contract, row by row."""
    docs, links = [], Counter()
    for text in texts:
        both = plain_tokens(text, coders)
        if both is None:
            docs.append(None)
            continue
        a, b = both
        linked = [(i, j) for i, e in a for j, f in b if e == f] if len(a) < 300 else [(dict((e, i) for i, e in a)[f], j) for j, f in b if f in {e for _, e in a}]
        ends = sorted({e for _, e in a} & {f for _, f in b})
        groups, low = [], 0
        for high in ends:
            groups.append(",".join(str(i) for i, e in a if low < e <= high) + "|" + ",".join(str(j) for j, f in b if low < f <= high))
            low = high
        docs.append((len(a), len(b), groups, linked))
        links.update(linked)
    best = Counter()
    for (_, j), n in links.items():
        best[j] = max(best[j], n)
    rows = []
    for d in docs:
        if d is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, linked = d
            rows.append((
                n_a, n_b, len(groups), len(linked), sum(links[x] == best[x[1]] for x in linked), sum(links[x] for x in linked),
                hashlib.sha256(";".join(groups).encode()).hexdigest(),
            ))
    return rows


ODD = [
    None, "", " ", "a", "a", "  two  spaces ", "<|endoftext|> </s> <s> <0x0A>", "▁ already", "line\nline\r\n\ttab", "naïve café ﬁ é", "日本語 のテキスト 𝒳",
    "don't we'll 'tis", "\x00\x01 control", "x" * 500, "1234567 12.5%", "emoji 👍🏽 done", "nbsp here", "end ", "—“quoted”…",
]


def columns(row):
    return (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups_sha256)


def test_alignment_equals_brute_force(spark, coders):
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows = [(i if i % 5 else None, t, "x", "clash", "clash") for i, t in enumerate(texts)]
    got = al.align_documents(spark.createDataFrame(rows, SCHEMA), byte_tokenizer(), piece_tokenizer()).collect()
    assert sorted(((r.doc_id, *columns(r)) for r in got), key=str) == sorted(((i, *w) for (i, *_), w in zip(rows, plain(texts, coders))), key=str)


def test_long_documents_are_composed_across_tasks(spark, coders, monkeypatch):
    """Pieces of a few hundred characters, ranges of 64 bytes, three levels."""
    words = "thrould the  estion — ﬁned, naïve\nre 'tis don't <|endoftext|> 12 x".split(" ")
    texts = [" ".join(words[(i * j) % len(words)] for i in range(900)) for j in (1, 3, 5)] + ["y" * 5000, "▁ " + "bad one " * 500, "short text"]
    monkeypatch.setattr(al, "LONG", 2000)
    monkeypatch.setattr(al, "PIECE", 60)
    got = al.align_documents(spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], SCHEMA), byte_tokenizer(), piece_tokenizer())
    assert [columns(r) for r in got.orderBy("doc_id").collect()] == plain(texts, coders)


def test_empty_table(spark):
    assert al.align_documents(spark.createDataFrame([], SCHEMA), byte_tokenizer(), piece_tokenizer()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab' \n1é."), st.characters(codec="utf-8")), max_size=60), st.lists(st.integers(0, 60), max_size=4))
def test_fragments_are_a_monoid(coders, text, cuts):
    import numpy as np

    both = plain_tokens(text, coders)
    if both is None:
        return
    (a, ends_a), (b, ends_b) = [(np.array([i for i, _ in x], dtype=np.uint32), np.array([e for _, e in x])) for x in both]
    edges = sorted({0, *[c for c in cuts if c < ends_a[-1]], int(ends_a[-1])})
    parts = [al.fragment(a, b, ends_a, ends_b, low, high) for low, high in zip(edges, edges[1:])]
    left, right = al.Fragment(), al.Fragment()
    for p in parts:
        left = al.compose(left, p)
    for p in reversed(parts):
        right = al.compose(p, right)
    one = al.fragment(a, b, ends_a, ends_b, 0, int(ends_a[-1]))
    assert left == right == one == al.compose_all(parts)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab' \n\t1é.,—“\x1c\x85\xa0½²"), st.characters(max_codepoint=0x2100, codec="utf-8")), max_size=40))
def test_fast_ids_are_the_tokenizers(text):
    from vigilo.llm.byte_level import ByteLevel, loaded

    path = byte_tokenizer()
    for is_plain in (True, False):
        own = loaded(ByteLevel, path, plain=is_plain)
        reference = _reference(path, is_plain)
        for t in (text, text + "<|endoftext|>" + text):
            assert own(t).tolist() == reference.encode(t, add_special_tokens=False).ids


_REFERENCES = {}


def _reference(path, is_plain):
    from tokenizers import Tokenizer

    if is_plain not in _REFERENCES:
        _REFERENCES[is_plain] = Tokenizer.from_file(path)
        _REFERENCES[is_plain].encode_special_tokens = is_plain
    return _REFERENCES[is_plain]


def test_texts_are_cut_where_both_tokenizers_begin_anew(coders):
    text = "one two  three\nfour don't é ü — x y " * 50
    pieces = al.text_pieces(text, 40)
    assert " ".join(pieces) == text and len(pieces) > 10
    a, b = coders
    assert [i for p in pieces for i in a.encode(" " + p, add_special_tokens=False).ids] == a.encode(" " + text, add_special_tokens=False).ids
    assert [i for p in pieces for i in b.encode(p)] == b.encode(text)
