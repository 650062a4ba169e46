from collections import defaultdict
from types import SimpleNamespace

import edges
import numpy as np
import pyarrow as pa
import pytest

from tocsin.llm import substring_dedup
from tocsin.llm.common import NO_ID


def brute(rows, width=20):
    """(id, text) -> (words, removed, kept), by a table of every window."""
    docs = sorted({(NO_ID if i is None else i, t or "") for i, t in rows}, key=lambda r: r[0])
    first, out = {}, {}
    for i, t in docs:
        w = edges.words(t)
        for s in range(len(w) - width + 1):
            first.setdefault(tuple(w[s : s + width]), (i, t, s))
    for i, t in docs:
        w = edges.words(t)
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if first[tuple(w[s : s + width])] != (i, t, s):
                gone[s : s + width] = [True] * width
        out[i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()] = 1
    return sorted(out)


def found(docs, width=20):
    rows = substring_dedup.remove_repeats(docs, width).collect()
    for r in rows:
        assert sum(s["length"] for s in r.spans) == r.n_removed
    return sorted({(r["__id"], r.n_words, r.n_removed, r.kept) for r in rows}), len(rows)


@pytest.mark.parametrize("width", [20, 5, 1])
def test_edges(spark, width):
    # Rows 11 differ in text under one id: which comes first is the hash's choice.
    some = [r for r in edges.rows() if r[1] != "other text " + edges.RUN and not (r[0] is None and "line" in r[1])]
    rows, n = found(edges.frame(spark, some), width)
    assert rows == brute([(r[0], r[1]) for r in some], width) and n == len(some)


def test_equal_ids_keep_apart(spark):
    rows = {(r["__id"], r.n_words): r.n_removed for r in substring_dedup.remove_repeats(edges.frame(spark)).collect()}
    assert rows[11, 2] == 0 and rows[11, 32] == 30


def test_given_table(documents):
    rows, n = found(documents)
    assert rows == brute([(r.doc_id, r.text) for r in documents.collect()]) and n == documents.count()


def test_partitioning_does_not_matter(spark, documents):
    assert found(documents.repartition(7))[0] == found(documents.coalesce(1))[0]


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(edges.empty(spark)).collect() == []


def test_no_bucket_is_hot():
    """Twenty tasks of equal texts: what is known to go spreads over the documents' buckets."""
    text, buckets, parts = " ".join(f"w{i}" for i in range(120)).encode(), 30, 20
    words = substring_dedup.WordHashes().of(text.split())
    held = defaultdict(int)
    for task in range(20):
        every = SimpleNamespace(holds=lambda h: np.ones(len(h), bool))
        chunk = substring_dedup._Chunk(20, 8, buckets, parts, every)
        ids = pa.array(range(task * 200, task * 200 + 200), pa.int64())
        chunk.add(pa.RecordBatch.from_arrays([ids, pa.array([1] * 200, pa.int32()), pa.array([text] * 200)], ["a", "b", "c"]))
        for row in chunk.send():
            held[row.column(0)[0].as_py()] += len(row.column(5)[0].as_py()) // 4
    known = [held[-1 - p] for p in range(parts)]
    assert sum(known) == 20 * 199 * (len(words) - 19)
    assert max(known) < 2 * np.median(known)
    # A window of all documents costs its bucket one entry for each task.
    assert sum(n for b, n in held.items() if b >= 0) == 20 * (len(words) - 19)
