"""Token ids of whole texts by a public tokenizer, for Arrow batches.

The tokenizer drops white space and cuts words at it, so a text's ids are the
ids of its white-space-free pieces one after the other.  A run of texts is split
in Arrow and its pieces are dictionary-encoded; only distinct pieces are looked
up, and the texts' ids are gathered from theirs by offsets.

The tokenizer lower-cases, and it cuts between a letter and the punctuation
after it, so a piece of Latin letters and closing ASCII punctuation has the ids
of its lower-case word and then those of the punctuation.  Both go to the same
merges in tiktoken, with a byte that stands for the end of a word
(``word_merges``).  All other pieces go through the whole tokenizer, many in one
call, with a NUL between them (whose one id marks the borders); these are
remembered up to a bound, as most of them return soon.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

#: Pieces remembered by one Python worker, and the longest of them in characters.
REMEMBERED = 200_000
LONGEST = 48
#: Bytes of text whose pieces are looked up together.
RUN = 8 << 20

#: A piece, lower-cased, of Latin letters (each its own NFC form) and ASCII
#: punctuation after them; any other piece has two empty groups.
_SIMPLE = re.compile(r"^(?:([a-zß-öø-ɏ]+)([!-/:-@\[-`{-~]*)|.*)$", re.M)


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself
    if it is printable Latin-1, else the next one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 0x100 + i for i, b in enumerate(rest)}


#: Stands for the end of a word; no word holds it.
WORD_END = "\0"


def word_merges(path: str):
    """A tiktoken encoding of the merges of a vocabulary with word ends, the id
    of each of its ranks, and the rank of the line break between pieces;
    ``None`` for a vocabulary of another kind.  Ranks: bytes, bytes that end a
    word (which so are joined first), merges."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix")
    letters = {b: chr(c) for b, c in byte_letters().items()}
    if not suffix or not all(x in vocabulary and x + suffix in vocabulary for x in letters.values()):
        return None
    byte_of = {x: b for b, x in letters.items()}
    end = WORD_END.encode()

    def raw(token: str) -> bytes:
        stem = token.removesuffix(suffix)
        return bytes([byte_of[c] for c in stem]) + end * (stem != token)

    ranks, ids = {}, []
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    for token in [*letters.values(), *[x + suffix for x in letters.values()], *["".join(m) for m in merges]]:
        if ranks.setdefault(raw(token), len(ids)) == len(ids):
            ids.append(vocabulary[token])
    fast = tiktoken.Encoding(os.path.basename(path), pat_str=r"[^\x00\n]+\x00|\n", mergeable_ranks=ranks, special_tokens={})
    return fast, ids, ranks[b"\n"]


_PROBE = ("a", "word", "wörter.", "élève,", "CAFÉ!", "řeč", "straße?!", "Don", "x...", "y(")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import pyarrow as pa
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, object] = {}
        border = self.tokenizer.encode("\0", add_special_tokens=False).ids
        self.border = border[0] if len(border) == 1 else None
        merges = word_merges(path)
        self.direct = merges is not None
        if merges:
            self.merges, by_rank, self.line = merges
            self.by_rank = np.array(by_rank, dtype="<u4")
            start, length, ids = self._distinct(pa.array(_PROBE))
            self.direct = all(ids[a : a + n].tolist() == self._whole(p).tolist() for p, a, n in zip(_PROBE, start, length))

    def _whole(self, text: str):
        import numpy as np

        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _others(self, pieces: list[str]) -> list:
        """The ids of pieces by the whole tokenizer."""
        import numpy as np

        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        fresh = [p for p in pieces if p not in known]
        joint = [p for p in fresh if self.border is not None and len(p) <= LONGEST and "\0" not in p]
        found = {}
        if joint:
            ids = self._whole(" \0 ".join(joint))
            ends = np.flatnonzero(ids == self.border).tolist()
            if len(ends) == len(joint) - 1:  # else the border's id came from a piece as well
                found = {p: ids[a:b].copy() for p, a, b in zip(joint, [0, *[e + 1 for e in ends]], [*ends, len(ids)])}
        known.update(found)
        found.update((p, self._whole(p)) for p in fresh if p not in found)
        return [found[p] if p in found else known[p] for p in pieces]

    def _distinct(self, pieces):
        """(start, length, ids): where the ids of each piece of an Arrow array
        lie in ``ids``."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        n = len(pieces)
        start, length, ids = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(0, dtype="<u4")
        rest = range(n)
        if self.direct and n:
            line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pieces), "\n")[0].as_py()
            parts = _SIMPLE.findall(line.lower())
            marked = "".join([f"{w}\0{c}\0\n" if c else f"{w}\0\n" if w else "\n" for w, c in parts])
            ranks = self.merges.encode_to_numpy(marked, disallowed_special=())
            border = ranks == self.line
            ends = np.flatnonzero(border) - np.arange(n)
            length = np.diff(ends, prepend=0)
            start, ids = ends - length, self.by_rank[ranks[~border]]
            rest = [i for i, (w, _) in enumerate(parts) if not w]
        if len(rest):
            more = self._others(pieces.take(pa.array(rest, pa.int64())).to_pylist())
            sizes = np.array([len(m) for m in more], dtype=np.int64)
            start[rest], length[rest] = len(ids) + np.cumsum(sizes) - sizes, sizes
            ids = np.concatenate([ids, *more])
        return start, length, ids

    def _run(self, texts, end_id: int | None):
        import numpy as np
        import pyarrow.compute as pc

        lists = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        start, length, ids = self._distinct(coded.dictionary)
        codes = coded.indices.to_numpy()
        if end_id is not None:  # one piece more a text
            codes = np.insert(codes, np.cumsum(counts), len(start))
            start, length, ids, counts = np.append(start, len(ids)), np.append(length, 1), np.append(ids, np.array(end_id, dtype="<u4")), counts + 1
        sizes = length[codes]
        ends = np.cumsum(sizes)
        out = ids[np.repeat(start[codes] - (ends - sizes), sizes) + np.arange(sizes.sum())]
        return np.append(0, ends)[np.append(0, np.cumsum(counts))], out

    def column(self, texts, end_id: int | None = None) -> Iterator[tuple]:
        """(offsets, ids) of runs of texts of an Arrow column, about ``RUN``
        bytes each: text i of a run has ids[offsets[i]:offsets[i + 1]], little-endian
        unsigned 32-bit integers, ``end_id`` last.  A null text has no others."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + RUN, side="right")))
            yield self._run(texts.slice(at, stop - at), end_id)
            at = stop

    def __call__(self, text: bytes | None) -> bytes:
        """The ids of one UTF-8 text."""
        import pyarrow as pa

        return next(self.column(pa.array([text], pa.large_binary())))[1].tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
