"""Ids of whole texts by byte-level and piece vocabularies, for Python workers.

``ByteLevel`` reads a byte-level BPE file of the tokenizers library.  Texts of
letters whose classes no Unicode version has changed go through tiktoken on the
same vocabulary, which gives the same ids several times faster; all others, and
texts that hold an added token's string where those count, go through the
library itself.  ``Pieces`` reads a sentencepiece model.  Both tell the bytes
of every id, so that token borders can be found as byte offsets.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

from vigilo.llm.tokens import RUN, byte_letters

# Fixed value: the word pattern of byte-level BPE (contractions, letters,
# digits, other signs, white space).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Outside Latin letters, common punctuation and currency signs.
_OTHER = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-€]")


class ByteLevel:
    def __init__(self, path: str, plain: bool = False):
        """``plain``: strings of added tokens inside texts are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte_of = {chr(letter): b for b, letter in byte_letters().items()}
        self.bytes_of = [b""] * (max([*spec["model"]["vocab"].values(), *added.values()]) + 1)
        for token, i in spec["model"]["vocab"].items():
            self.bytes_of[i] = token.encode() if token in added else bytes(byte_of[c] for c in token)
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.lengths = np.array([len(x) for x in self.bytes_of])
        ranks = {self.bytes_of[i]: i for token, i in spec["model"]["vocab"].items() if token not in added}
        self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = None if plain or not added else re.compile("|".join(map(re.escape, added)))

    def _odd(self, text: str) -> bool:
        return bool(_OTHER.search(text) or (self.added and self.added.search(text)))

    def __call__(self, text: str):
        """uint32 ids of a text."""
        import numpy as np

        if self._odd(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)

    def column(self, texts) -> Iterator:
        """uint32 ids of each text of an Arrow column, in order; a null text is
        empty.

        The pattern cuts before a space between two other characters that are
        no white space.  So where each space of a text is such a one, its ids
        are those of its first word and of each other word with its space; a
        run of texts is split in Arrow, and its distinct words looked up in one call."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + RUN, side="right")))
            yield from self._run(texts.slice(at, stop - at))
            at = stop

    def _run(self, texts) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words = pc.split_pattern(texts.cast(pa.string()), " ")
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(counts) - counts
        coded = words.flatten().dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        beside = pc.not_equal(pc.utf8_trim_whitespace(distinct), distinct).to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        beside |= sizes == 1
        # all words with their spaces in one call: their bytes tell where each ends
        sizes[beside] = 0
        plain = distinct.filter(pa.array(~beside))
        n = len(plain)
        line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), plain), " ")[0].as_py()
        ids = np.array(self.fast.encode_ordinary(f" {line}" if n else ""), dtype=np.uint32)
        ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes), side="right")
        length = np.diff(ends, prepend=0)
        # the first word of a text has no space
        first = [self.fast.encode_ordinary(w) for w in distinct.take(pa.array(codes[firsts])).to_pylist()]
        spaced = np.add.reduceat(beside[codes], firsts) == 0 if len(firsts) else []
        codes[firsts] = len(distinct) + np.arange(len(firsts))
        length = np.append(length, [len(x) for x in first])
        ids = np.concatenate([ids, *[np.array(x, dtype=np.uint32) for x in first]])
        start = np.cumsum(length) - length
        sizes = length[codes]
        ends = np.cumsum(sizes)
        out = ids[np.repeat(start[codes] - (ends - sizes), sizes) + np.arange(sizes.sum())]
        ends = np.append(0, ends)
        for text, ok, a, b in zip(texts.to_pylist(), spaced, ends[firsts], ends[firsts + counts]):
            yield out[a:b] if ok and not self._odd(text) else self(text)


class Pieces:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        #: a piece never goes on behind a space inside it, so words can be taken alone
        self.cuts_at_spaces = not any(re.search("[^▁]▁", p) for p in pieces)

    def many(self, texts: list[str]) -> list:
        import numpy as np

        return [np.array(ids, dtype=np.uint32) for ids in self.model.encode(texts, num_threads=1)]


_LOADED: dict[tuple, object] = {}


def loaded(kind, path: str, **options):
    """This worker's encoder of a file."""
    key = (kind.__name__, path, *sorted(options.items()))
    if key not in _LOADED:
        _LOADED[key] = kind(path, **options)
    return _LOADED[key]
