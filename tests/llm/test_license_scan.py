"""License scan against brute force, near misses, and odd rows."""

import random

import pytest

from vigilo.llm.license_scan import COVERAGE, Scanner, scan
from vigilo.llm.license_texts import TEMPLATES, TEXTS


def names(text):
    return {x[0] for x in Scanner()(text.encode("utf-8"))}


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_against_longest_common_subsequences():
    """Copies with words replaced, left out and put in, around the coverage asked for."""
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(600)]
    templates = {f"t{n}": " ".join(r.choice(vocabulary) for _ in range(n)) for n in (5, 8, 13, 20, 33, 60, 90)}
    scanner, seen = Scanner(templates, required={}), {True: 0, False: 0}
    for trial in range(250):
        name = r.choice(list(templates))
        words, rate = templates[name].split(), r.uniform(0, 0.3)
        copy, changes = [], 0
        for w in words:
            kind = r.random()
            changes += kind < rate
            if kind < rate / 2:
                copy.append("changed")
            elif kind >= rate:
                copy.append(w)
            if len(copy) % 17 == 16:
                copy.append("inserted")
                changes += 1
        text = [f"p{trial}"] * r.randint(0, 30) + copy + ["after"] * r.randint(0, 30)
        want = {n for n, t in templates.items() if longest_common(t.split(), text) >= COVERAGE * len(t.split()) - 1e-9}
        got = scanner(" ".join(text).encode())
        found = {g[0] for g in got}
        assert found <= want and (found == want or changes > (1 - COVERAGE) * len(words)), (trial, name)
        assert all(g[2] == longest_common(templates[g[0]].split(), text) for g in got)
        seen[name in want] += 1
    assert min(seen.values()) > 40


@pytest.mark.parametrize("name", TEMPLATES)
def test_each_template_is_told_from_all_others(name):
    assert names(f"before it {TEMPLATES[name]} and after") == {name}


@pytest.mark.parametrize(
    "text, want",
    [
        ("Released under the BSD License.", {"bsd notice"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"gpl-2.0 notice"}),
        ("This work is licensed under the GNU General Public License, version 1.", set()),
        ("This work is licensed under the GNU General Public License, version 3.0.", {"gpl-3.0 notice"}),
        ("Licensed under CC BY-ND 4.0.", {"cc-by-nd-4.0 notice"}),
        ("Licensed under CC BY-NC 3.0.", set()),
        ("Licensed under the MIT License, Version 2.0.", {"mit notice"}),
        ("Licensed under the Apache License, Version 1.1.", set()),
        (TEXTS["gpl-3.0 header"].replace("GNU General", "GNU Library General"), set()),
        (TEXTS["agpl-3.0 header"].replace("version 3 ", "version 2 "), set()),
    ],
)
def test_names_and_versions_must_match(text, want):
    assert names(f"A file. {text} The rest of it.") == want


def test_odd_rows(spark):
    """Nulls, repeated rows, ties, a very long text, clashing column names, other templates."""
    notice = "Released under the MIT License."
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [(1, notice, "x"), (1, notice, "x"), (None, notice, "y"), (2, None, None), (3, "", ""), (4, f"{long} {notice} {long}", "z"), (5, f"{notice} {notice}", "z")]
    got = scan(spark.createDataFrame(rows, "doc_id int, text string, license string")).collect()
    assert sorted((x.doc_id or 0, x.license) for x in got) == [(d, "mit notice") for d in (0, 1, 1, 4, 5, 5)]
    assert {(x.start, x.end) for x in got if x.doc_id == 5} == {(0, 31), (32, 63)}
    assert next(x.start for x in got if x.doc_id == 4) == len(long) + 1
    own = scan(spark.createDataFrame(rows, "doc_id int, text string, license string"), {"own": "under the mit"}, required={"own": [("mit",)]})
    assert own.count() == 6
