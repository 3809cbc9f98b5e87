"""License scan: winnowed template fingerprints in an inverted index, then
banded alignment.

Words are compared lower-cased and without punctuation at their ends.  Of each
template's ``GRAM``-word hashes, the smallest of every ``WINDOW`` in a row is a
fingerprint.  The index maps a fingerprint to its templates and positions.  All
grams of a document are looked up, so every run of GRAM + WINDOW - 1 template
words in a document hits the index.  A copy with at most ``1 - COVERAGE`` of its
words replaced, left out or put in keeps a run of a certain length; templates
whose sure run is shorter have shorter grams or windows, so none is missed.

Hits of one template on nearby diagonals (document position minus template
position) are one candidate; the template is aligned with that stretch of the
document inside a band around its diagonals, maximising matched words.
Coverage is matched / template words; matches of ``COVERAGE`` or more are
reported with their span in code points.  The band is wide enough that
``1 - COVERAGE`` of the template may be replaced, missing or inserted.  A
template may have required phrases (a name, a version): a match without one of
them is another license and is not reported.

Documents are scanned once, whole, with no shuffle; the index is as large as
the templates.  A template that occurs often in one document is one candidate
per occurrence.

Defined results: null and empty texts, and texts without a template, give no
row; overlapping templates are all reported, but for one inside the span of
another that is covered as well or better by as many words or more, and better
in one of the two (a variant or a part of it); of
overlapping matches of one template the one with the most matched words (ties:
the first) is reported; repeated rows
are reported each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from vigilo.llm.common import ship
from vigilo.llm.license_texts import REQUIRED, TEMPLATES

GRAM = 3
WINDOW = 2
COVERAGE = 0.8
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def winnow(grams, window: int = WINDOW) -> list[int]:
    """Positions of the smallest hash of every window (the last of equal ones)."""
    n, picked = len(grams), set()
    for a in range(max(1, n - window + 1)):
        picked.add(max(range(a, min(n, a + window)), key=lambda i: (-int(grams[i]), i)))
    return sorted(picked)


def align(template, words, low: int, high: int) -> tuple[int, int, int]:
    """(matched, first, last) of the best in-order match of template words with
    ``words`` where word position - template position is in [low, high]; the
    tightest span of the most matches, the first of equal ones."""
    width = high - low + 1
    # best[d]: (matched, -(span start), ...) of alignments that end at or before template row i on diagonal low + d
    none = (0, 1 << 60, -1)
    best = [none] * width
    top = none
    n = len(words)
    for i, t in enumerate(template):
        row = [none] * width
        for d in range(width):
            j = i + low + d
            above = best[d + 1] if d + 1 < width else none  # template word left out
            left = row[d - 1] if d else none  # document word left out
            here = above if _better(above, left) else left
            if 0 <= j < n and words[j] == t:
                m, first, _ = best[d]
                got = (m + 1, first if m else j, j)
                if _better(got, here):
                    here = got
            row[d] = here
        best = row
        for x in row:
            if _better(x, top):
                top = x
    return top


def _better(a, b) -> bool:
    """More matches, then a tighter span, then an earlier one."""
    if a[0] != b[0]:
        return a[0] > b[0]
    return (a[2] - a[1], a[1]) < (b[2] - b[1], b[1]) if a[0] else False


def sizes(n: int, coverage: float = COVERAGE) -> tuple[int, int]:
    """(gram, window) for a template of n words: one after the other they are no
    longer than the run that (1 - coverage) * n changes cannot break."""
    changes = int((1 - coverage) * n + 1e-9)
    run = max(1, -(-(n - changes) // (changes + 1)))
    gram = min(GRAM, run)
    return gram, min(WINDOW, run - gram + 1)


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE, required: dict = REQUIRED):
        import numpy as np

        from vigilo.llm.words import kmers, word_hashes

        self.names, self.words, self.gram, self.phrases, index = [], [], [], [], {}
        for name, text in templates.items():
            words = word_hashes(text.encode("utf-8"))
            if not len(words):
                continue
            gram, window = sizes(len(words), coverage)
            for at in winnow(grams := kmers(words, gram), window):
                index.setdefault(int(grams[at]), []).append((len(self.names), at))
            self.gram.append(gram)
            self.names.append(name)
            self.words.append(words)
            self.phrases.append([[word_hashes(p.encode("utf-8")) for p in spellings] for spellings in required.get(name, [])])
        self.coverage, self.index = coverage, index
        self.grams = sorted(set(self.gram))
        self.keys = np.array(sorted(index), dtype=np.uint64)

    def hits(self, words) -> dict[int, list[tuple[int, int]]]:
        """Per template: (document position, template position) of index hits."""
        import numpy as np

        from vigilo.llm.words import kmers

        found: dict[int, list[tuple[int, int]]] = {}
        for k in self.grams:
            if len(words) < k or not len(self.keys):
                continue
            grams = kmers(words, k)
            place = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
            for at in np.flatnonzero(self.keys[place] == grams).tolist():
                for template, pos in self.index[int(grams[at])]:
                    if self.gram[template] == k:
                        found.setdefault(template, []).append((at, pos))
        return found

    def named(self, template: int, words, first: int, last: int) -> bool:
        """Whether the required phrases stand in words first to last (one that
        begins or ends there may go on outside)."""
        import numpy as np

        def stands(phrase) -> bool:
            n = len(phrase)
            part = words[max(0, first - n + 1) : last + n]
            return len(part) >= n and bool((np.lib.stride_tricks.sliding_window_view(part, n) == phrase).all(axis=1).any())

        return all(any(map(stands, spellings)) for spellings in self.phrases[template])

    def matches(self, words) -> list[tuple[int, int, int, int]]:
        """(template, matched, first word, last word)."""
        import numpy as np

        out = []
        for template, hits in sorted(self.hits(words).items()):
            body = self.words[template]
            band = max(2, round((1 - self.coverage) * len(body)))
            hits.sort(key=lambda h: h[0] - h[1])  # by diagonal
            groups: list[list[int]] = []
            for at, pos in hits:
                if groups and at - pos - groups[-1][1] <= band:
                    groups[-1][1] = at - pos
                else:
                    groups.append([at - pos, at - pos])
            found = []
            for low, high in groups:
                # diagonals that run on are cut into stretches of one template each, which overlap
                for a in range(low, high + 1, band + 1):
                    base = max(0, a - band)
                    part = words[base : a + 2 * band + len(body) + 1]
                    least = self.coverage * len(body) - 1e-9
                    if np.isin(body, part).sum() < least:
                        continue  # the words of that stretch cannot be enough in any order
                    m, first, last = align(body.tolist(), part.tolist(), a - band - base, a + 2 * band - base)
                    if m >= least and self.named(template, words, first + base, last + base):
                        found.append((m, first + base, last + base))
            found.sort(key=lambda f: (-f[0], f[2] - f[1], f[1]))
            kept: list[tuple[int, int, int]] = []
            for f in found:
                if all(f[2] < k[1] or f[1] > k[2] for k in kept):
                    kept.append(f)
            out += [(template, *f) for f in sorted(kept, key=lambda f: f[1])]
        share = lambda f: f[1] / len(self.words[f[0]])
        inside = lambda f, g: g[2] <= f[2] and f[3] <= g[3]
        better = lambda g, f: share(g) >= share(f) and g[1] >= f[1] and (share(g), g[1]) != (share(f), f[1])
        return [f for f in out if not any(inside(f, g) and better(g, f) for g in out)]

    def __call__(self, text: bytes | None) -> list[tuple]:
        """(license, coverage, matched, template words, start, end) of a text;
        offsets in code points, end exclusive."""
        from vigilo.llm.words import plain, word_hashes

        words = word_hashes(text)
        found = self.matches(words) if len(words) else []
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(text.decode("utf-8")) if plain(m.group().encode("utf-8"))]
        return [(self.names[t], m / len(self.words[t]), m, len(self.words[t]), spans[a][0], spans[b][1]) for t, m, a, b in found]


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE, required: dict = REQUIRED) -> DataFrame:
    """doc_id, license, coverage, matched, template_words, start, end of every
    match; templates (by name) and their required phrases can be given."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(templates, coverage, required)
        names = ["doc_id", "license", "coverage", "matched", "template_words", "start", "end"]
        kinds = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                rows += [(doc_id, *found) for found in scanner(text.as_py())]
            cols = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    docs = ship(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"))
    return docs.mapInArrow(run, "doc_id bigint, license string, coverage double, matched int, template_words int, start bigint, end bigint")
