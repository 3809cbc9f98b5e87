"""Cross-tokenizer alignment: where two tokenizers' tokens end together.

Every text is encoded by a byte-level tokenizer (A, on a space and the text)
and a piece tokenizer (B, which adds that space).  Byte offsets at which tokens
of both end cut the two id streams into groups.  The last A and the last B
token of a group end together: they are linked.

**Fragments.**  ``Fragment`` is an associative summary of a byte range of one
document: the ids before its first common end (*open prefix*: the group may
have begun before the range), its closed groups, and the ids after its last
common end (*open suffix*).  ``compose`` joins neighbours, an empty fragment is
its identity, and any bracketing gives the same result.  A document is cut into
byte ranges of at most ``RANGE``; the fragments of a range are composed in the
task that encoded it.  A text above ``LONG`` bytes is also encoded in pieces:
its pieces (cut before a single space between two ordinary characters, where
neither vocabulary has a token that goes on) are dealt to different tasks, and
their fragments are composed by a tree of group-bys, ``FAN`` neighbours a
level.  A long text without such a place is one piece.

**Corpus counts.**  Links need no order, so each document stores its distinct
linked id pairs with their numbers; pairs are counted over the corpus by a
group-by (combined map-side, so a pair that is a third of all links is small),
and a document's figures come from a join back on the pair.  The pair table is
broadcast while it holds at most ``BROADCAST_PAIRS`` rows, and beyond that it
is a shuffle join.

Defined results: a text that is null, empty, or whose joined A or B bytes are
not a space and the text has no tokens: zeros and an empty digest, and it adds
no links.  Equal rows (also with equal or null ids) are documents of their own.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from vigilo.llm.common import ship, stored

LONG = 256 << 10
PIECE = 64 << 10
RANGE = 16 << 10
FAN = 8
BROADCAST_PAIRS = 2_000_000
#: Text encoded at a time.
SLICE = 1 << 20

#: Before a space that stands alone between characters of these kinds (letters, digits and ASCII signs).
_CUT = re.compile("(?<=[\x21-\x7eÀ-ɏ]) (?=[\x21-\x7eÀ-ɏ])")


@dataclass(frozen=True)
class Fragment:
    """Alignment of a byte range.  Without a common end (``cut`` false) all ids
    are in the head."""

    cut: bool = False
    head_a: tuple = ()
    head_b: tuple = ()
    body: bytes = b""  # closed groups, each ending in ';'
    n_body: int = 0
    tail_a: tuple = ()
    tail_b: tuple = ()


def group_text(a, b) -> bytes:
    return b",".join(b"%d" % i for i in a) + b"|" + b",".join(b"%d" % i for i in b) + b";"


def compose(x: Fragment, y: Fragment) -> Fragment:
    if not x.cut:
        return Fragment(y.cut, x.head_a + y.head_a, x.head_b + y.head_b, y.body, y.n_body, y.tail_a, y.tail_b)
    if not y.cut:
        return Fragment(True, x.head_a, x.head_b, x.body, x.n_body, x.tail_a + y.head_a, x.tail_b + y.head_b)
    between = group_text(x.tail_a + y.head_a, x.tail_b + y.head_b)
    return Fragment(True, x.head_a, x.head_b, x.body + between + y.body, x.n_body + 1 + y.n_body, y.tail_a, y.tail_b)


def compose_all(fragments: list[Fragment]) -> Fragment:
    """Neighbours pairwise, level by level."""
    while len(fragments) > 1:
        pairs = [compose(*fragments[i : i + 2]) for i in range(0, len(fragments) - 1, 2)]
        fragments = pairs + fragments[2 * len(pairs) :]
    return fragments[0] if fragments else Fragment()


def whole(x: Fragment) -> tuple[int, bytes]:
    """(number of groups, their text) of a fragment that spans a document."""
    if not x.cut:
        return 0, b""
    return x.n_body + 1, (group_text(x.head_a, x.head_b) + x.body)[:-1]


def fragment(a, b, ends_a, ends_b, low: int, high: int) -> Fragment:
    """Fragment of the tokens that end in ``(low, high]``."""
    import numpy as np

    i, j = np.searchsorted(ends_a, [low, high], side="right")
    k, m = np.searchsorted(ends_b, [low, high], side="right")
    a, b, ends_a, ends_b = a[i:j], b[k:m], ends_a[i:j], ends_b[k:m]
    common, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    if not len(common):
        return Fragment(False, tuple(a.tolist()), tuple(b.tolist()))
    first, last = slice(0, at_a[0] + 1), slice(0, at_b[0] + 1)
    body_a, body_b = a[at_a[0] + 1 : at_a[-1] + 1], b[at_b[0] + 1 : at_b[-1] + 1]
    return Fragment(
        True, tuple(a[first].tolist()), tuple(b[last].tolist()),
        _groups(body_a, body_b, at_a[1:] - at_a[0] - 1, at_b[1:] - at_b[0] - 1), len(common) - 1,
        tuple(a[at_a[-1] + 1 :].tolist()), tuple(b[at_b[-1] + 1 :].tolist()),
    )


_WORDS: dict[int, list[bytes]] = {}


def _groups(a, b, last_a, last_b) -> bytes:
    """Text of closed groups: ids and the indexes of each group's last token."""
    import numpy as np

    if not len(last_a):
        return b""
    top = int(max(a.max(), b.max())) + 1
    words = _WORDS.setdefault(0, [])
    while len(words) < 4 * top:  # id with ',', '|' or ';' behind it
        n = len(words) >> 2
        words.extend((b"%d," % n, b"%d|" % n, b"%d;" % n, b""))
    code_a, code_b = a.astype(np.int64) * 4, b.astype(np.int64) * 4
    code_a[last_a] += 1
    code_b[last_b] += 2
    # a group's A ids, then its B ids
    place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[np.searchsorted(last_a, np.arange(len(a)))]
    out = np.empty(len(a) + len(b), dtype=np.int64)
    out[place_a] = code_a
    free = np.ones(len(out), dtype=bool)
    free[place_a] = False
    out[free] = code_b
    return b"".join([words[i] for i in out.tolist()])


@dataclass
class Aligned:
    """Encoded and aligned text (a document, or a piece of one)."""

    n_a: int
    n_b: int
    fragment: Fragment
    pairs: object  # distinct linked pairs a * len(B) + b
    counts: object


class Aligner:
    """A worker's pair of encoders."""

    def __init__(self, path_a: str, path_b: str):
        import numpy as np

        from vigilo.llm.byte_level import ByteLevel, Pieces, loaded

        self.a, self.b = loaded(ByteLevel, path_a, plain=True), loaded(Pieces, path_b)
        self.len_a = np.array([len(x) for x in self.a.bytes_of], dtype=np.int64)
        self.len_b = np.array([len(x) for x in self.b.bytes_of], dtype=np.int64)

    def align(self, texts: list[str]) -> list[Aligned | None]:
        """``None`` for a text without tokens."""
        import numpy as np

        found = []
        bytes_a, bytes_b, size_b = self.a.bytes_of, self.b.bytes_of, len(self.b.bytes_of)
        for text, b in zip(texts, self.b.many(texts)):
            a, raw = self.a(" " + text), (" " + text).encode("utf-8", "replace")
            if not text or b"".join([bytes_b[i] for i in b.tolist()]) != raw or b"".join([bytes_a[i] for i in a.tolist()]) != raw:
                found.append(None)
                continue
            # tokens without bytes cannot be placed; vocabularies have none that encode
            ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
            _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
            pairs, counts = np.unique(a[at_a].astype(np.int64) * size_b + b[at_b], return_counts=True)
            ranges = [fragment(a, b, ends_a, ends_b, low, low + RANGE) for low in range(0, len(raw), RANGE)]
            found.append(Aligned(len(a), len(b), compose_all(ranges), pairs, counts))
        return found


def text_pieces(text: str, size: int = PIECE) -> list[str]:
    """Pieces of about ``size`` characters; joined by one space they are the text."""
    pieces, start = [], 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if not cut:
            break
        pieces.append(text[start : cut.start()])
        start = cut.end()
    return [*pieces, text[start:]]


_DOC = "doc bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, counts array<int>"
_PART = (
    "doc bigint, doc_id bigint, part int, valid boolean, n_a bigint, n_b bigint, cut boolean, head_a array<int>, head_b array<int>, "
    "body binary, n_body bigint, tail_a array<int>, tail_b array<int>, pairs array<bigint>, counts array<int>"
)


def _arrow(schema: str):
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
             "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


def _slices(batches, column: str) -> Iterator:
    """Parts of Arrow batches with at most about SLICE bytes of text."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > SLICE:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def _row(x: Aligned | None) -> dict:
    import hashlib

    if x is None:
        return {"n_a": 0, "n_b": 0, "n_groups": 0, "groups_sha256": "", "pairs": [], "counts": []}
    n, text = whole(x.fragment)
    return {"n_a": x.n_a, "n_b": x.n_b, "n_groups": n, "groups_sha256": hashlib.sha256(text).hexdigest(), "pairs": x.pairs, "counts": x.counts}


def _record(rows: list[dict], schema):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def _short(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    def run(batches):
        aligner, schema = Aligner(path_a, path_b), _arrow(_DOC)
        for batch in _slices(batches, "text"):
            found = aligner.align([t or "" for t in batch.column("text").to_pylist()])
            yield _record([
                {"doc": d, "doc_id": i, **_row(x)}
                for d, i, x in zip(batch.column("doc").to_pylist(), batch.column("doc_id").to_pylist(), found)
            ], schema)

    return docs.mapInArrow(run, _DOC)


def _long(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents encoded in pieces by different tasks and composed by a tree."""

    def split(batches):
        import pyarrow as pa

        whole_text = not Aligner(path_a, path_b).b.cuts_at_spaces
        names = ["doc", "doc_id", "part", "text"]
        for batch in batches:
            for row in batch.to_pylist():
                parts = [row["text"]] if whole_text else text_pieces(row["text"])
                for at, text in enumerate(parts):
                    yield pa.RecordBatch.from_arrays([pa.array([row["doc"]], pa.int64()), pa.array([row["doc_id"]], pa.int64()), pa.array([at], pa.int32()), pa.array([text])], names=names)

    def encode(batches):
        aligner, schema = Aligner(path_a, path_b), _arrow(_PART)
        for batch in _slices(batches, "text"):
            found = aligner.align(batch.column("text").to_pylist())
            yield _record([
                {"doc": r[0], "doc_id": r[1], "part": r[2], "valid": x is not None, "n_a": x.n_a if x else 0, "n_b": x.n_b if x else 0,
                 **vars(x.fragment if x else Fragment()), "pairs": x.pairs if x else [], "counts": x.counts if x else []}
                for r, x in zip(zip(*[batch.column(c).to_pylist() for c in ("doc", "doc_id", "part")]), found)
            ], schema)

    def merge(rows: list[dict]) -> dict:
        from collections import Counter

        total = Counter()
        for r in rows:
            total.update(dict(zip(r["pairs"], r["counts"])))
        parts = [
            Fragment(r["cut"], tuple(r["head_a"]), tuple(r["head_b"]), r["body"], r["n_body"], tuple(r["tail_a"]), tuple(r["tail_b"])) for r in rows
        ]
        return {
            "doc": rows[0]["doc"], "doc_id": rows[0]["doc_id"], "part": rows[0]["part"] // FAN, "valid": all(r["valid"] for r in rows),
            "n_a": sum(r["n_a"] for r in rows), "n_b": sum(r["n_b"] for r in rows), **vars(compose_all(parts)),
            "pairs": list(total), "counts": list(total.values()),
        }

    def level(key, frames):  # at most FAN neighbouring fragments of one document
        import pyarrow as pa

        rows = sorted((r for b in frames for r in b.to_pylist()), key=lambda r: r["part"])
        yield _record([merge(rows)], _arrow(_PART))

    def finish(batches):
        schema = _arrow(_DOC)
        for batch in batches:
            for r in batch.to_pylist():
                x = Fragment(r["cut"], tuple(r["head_a"]), tuple(r["head_b"]), r["body"], r["n_body"], tuple(r["tail_a"]), tuple(r["tail_b"]))
                row = _row(Aligned(r["n_a"], r["n_b"], x, r["pairs"], r["counts"]) if r["valid"] else None)
                yield _record([{"doc": r["doc"], "doc_id": r["doc_id"], **row}], schema)

    pieces = docs.mapInArrow(split, "doc bigint, doc_id bigint, part int, text string")
    parts = stored(pieces.repartition(F.col("doc"), F.col("part")).mapInArrow(encode, _PART), "fragments")
    last = parts.agg(F.max("part")).first()[0]  # one number
    while last:
        parts = parts.groupBy("doc", F.expr(f"part div {FAN}")).applyInArrow(level, _PART)
        last //= FAN
    return parts.mapInArrow(finish, _DOC)


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256 of every document."""
    numbered = docs.select(F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    numbered = ship(numbered)
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    aligned = _short(numbered.filter(size <= LONG), path_a, path_b).union(_long(numbered.filter(size > LONG), path_a, path_b))
    aligned = stored(aligned, "aligned")
    links = aligned.select("doc", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("doc", F.col("x.pairs").alias("pair"), F.col("x.counts").cast("bigint").alias("n"))
    counts = links.groupBy("pair").agg(F.sum("n").alias("total"))
    vocabulary = F.lit(_size(path_b)).cast("bigint")
    best = counts.groupBy(F.pmod("pair", vocabulary).alias("b")).agg(F.max("total").alias("most"))
    pairs = stored(
        counts.withColumn("b", F.pmod("pair", vocabulary)).join(best, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best")), "pairs"
    )
    if pairs.count() <= BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    figures = links.join(pairs, "pair").groupBy("doc").agg(
        F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")
    )
    zero = F.lit(0).cast("bigint")
    return aligned.select("doc", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(figures, "doc", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")], "groups_sha256"
    )


def _size(path_b: str) -> int:
    from vigilo.llm.byte_level import Pieces, loaded

    return len(loaded(Pieces, path_b).bytes_of)
