"""Words of whole texts as 64-bit hashes, for Arrow batches.

A word is a run of non-white-space, lower-cased, without punctuation at its
ends; runs of punctuation alone are no words.  Hashes of words seen are
remembered, up to a bound, by each Python worker.
"""

from __future__ import annotations

REMEMBERED = 500_000
LONGEST = 64

_KNOWN: dict[bytes, int] = {}


def plain(piece: bytes) -> str:
    """A piece of text lower-cased and without punctuation at its ends."""
    word = piece.decode("utf-8", "replace").lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def _hash(piece: bytes) -> int:
    import xxhash

    word = plain(piece)
    # 0 marks "no word"
    value = xxhash.xxh64_intdigest(word.encode("utf-8")) or 1 if word else 0
    if len(piece) <= LONGEST:
        if len(_KNOWN) >= REMEMBERED:
            _KNOWN.clear()
        _KNOWN[piece] = value
    return value


def word_hashes(text: bytes | None):
    """uint64 array of the words of a UTF-8 text; of null, none."""
    import numpy as np

    pieces = text.split() if text else []
    known = _KNOWN.get
    got = [known(p) for p in pieces]
    if None in got:
        got = [_hash(p) if h is None else h for p, h in zip(pieces, got)]
    out = np.array(got, dtype=np.uint64)
    return out[out != 0]


def mixed(x):
    """A bijective scramble of uint64 values."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(words, k: int):
    """Hashes of the runs of k words (of all words, if there are fewer)."""
    import numpy as np

    k = min(k, len(words))
    if not k:
        return words
    h = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - k + 1 + i]
    return mixed(h)


def labelled(h):
    """Hashes made distinct by the number of equal ones before them."""
    import numpy as np

    order = np.argsort(h, kind="stable")
    same = np.zeros(len(h), dtype=bool)
    same[1:] = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return h
    at = np.arange(len(h))
    nth = np.zeros(len(h), dtype=np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(same, 0, at))
    return np.where(nth > 0, mixed(h + nth * np.uint64(0xD6E8FEB86659FD93)), h)
