import textwrap
from math import ceil

import edges
import pytest

from tocsin.llm import license_scan

MORE = [
    (300, "Licensed under the Apache License, Version 2.0."), (301, "cc BY, cc by"), (302, "xcc by GNU General\nPublic License."),
    (303, "Released under MIT License then\nmit\nlicense"), (304, "word " * 70 + "Licensed under CC BY-NC 4.0 " + "tail " * 70),
    (305, "this software source code form is subject to terms of the Mozilla Public License v 2 0"), (306, "mIt license"), (307, "WK mit  LICENSE"),
]


def brute(rows, threshold=0.9, size=64):
    sets = [(label, set(license_scan.tokens(t))) for label, t in license_scan.TEMPLATES]
    out = []
    for i, t in rows:
        w = edges.lower_words(t)
        places, base, labels, best = [], set(), set(), 0.0
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for line in (t or "").split("\n"):
            lw = edges.lower_words(line)
            for s in range(0, max(len(lw) - size // 2 - 1, 0) + 1, size // 2):
                block = set(lw[s : s + size])
                for label, ts in sets:
                    if len(ts & block) >= ceil(round(100 * threshold) * len(ts) / 100):
                        labels.add(label)
                        best = max(best, len(ts & block) / len(ts))
        both = sorted(base | labels)
        out.append((i, len(w), len(places), min(places, default=None), max(places, default=None), sorted(base), both, 1.0 if places else best))
    return sorted(out, key=str)


def found(docs):
    rows = license_scan.scan(docs).collect()
    return sorted(((None if r["__id"] == -(2**63) else r["__id"], r.n_words, r.n_base, r.first_word, r.last_word, r.base, r.labels, r.score) for r in rows), key=str)


def test_edges(spark):
    rows = [r[:2] for r in edges.rows()] + MORE
    got = found(edges.frame(spark, [(r + (None,) * 5)[:7] for r in rows]))
    # Row 11 is there twice with one text; its two results are equal.
    assert got == brute(rows)
    assert next(r for r in got if r[0] == 304)[6] == ["cc-by", "cc-by-nc"]


def test_given_table(documents):
    assert found(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_no_python_and_no_cross_join(documents):
    plan = license_scan.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_table(spark):
    assert found(edges.empty(spark)) == []


@pytest.mark.parametrize("lead", ["", "# ", " * "])
def test_notices_wrapped_over_lines(spark, lead):
    """Each template at 72 columns behind other text, with the comment signs of programs."""
    before = "\n".join(["some other words of a file"] * 9) + "\n"
    rows = [(n, before + textwrap.fill(t + " and further words of the file follow here until the notice ends", 72, initial_indent=lead, subsequent_indent=lead), label) for n, (label, t) in enumerate(license_scan.TEMPLATES)]
    assert sum(t.count("\n") > 10 for _, t, _ in rows) >= 6
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["__id"]: r for r in license_scan.scan(docs).collect()}
    for n, _, label in rows:
        assert label in got[n].labels and got[n].score == 1.0


def test_words_too_far_apart_are_no_notice(spark):
    half = "Redistribution and use in source and binary forms, with or without"
    rest = "modification, are permitted provided that the following conditions are met"
    texts = [f"{half}\n" + "x\n" * 64 + rest, f"{half}\n" + "x\n" * 3 + rest]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["__id"]: r.labels for r in license_scan.scan(docs).collect()} == {0: [], 1: ["bsd"]}
