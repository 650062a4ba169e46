import random
from collections import Counter

import edges
from pyspark.sql import functions as F

from tocsin.llm import line_dedup


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def brute(rows, min_docs, min_chars=1):
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    gone = {k for k, n in held.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(docs, min_docs, min_chars=1, **more):
    rows = line_dedup.drop_frequent_lines(docs, min_docs, min_chars, **more).collect()
    return sorted(((None if r["__id"] == -(2**63) else r["__id"], r.n_lines, r.n_dropped, r.kept) for r in rows), key=str)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edges.rows()]
    for min_docs, min_chars in ((2, 1), (10, 1), (2, 5)):
        assert found(edges.frame(spark), min_docs, min_chars) == brute(rows, min_docs, min_chars)


def test_given_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(documents, 10) == brute(rows, 10)
    assert found(documents, 3, batches=6) == brute(rows, 3)


def test_runs_part_new_lines_from_known_ones_and_compact(spark):
    r = random.Random(1)
    store, total, seen = line_dedup.LineRuns(spark, buckets=3, fanout=2), Counter(), set()
    for _ in range(5):
        batch = [r.randrange(60) for _ in range(80)]
        run = store.add(spark.createDataFrame([(x,) for x in batch], "line long"))
        if store.levels[0] == [run]:
            assert {x.line for x in store.fresh(run).collect()} == set(batch) - seen
        seen |= set(batch)
        total.update(batch)
        assert all(len(level) < 2 for level in store.levels)
    assert {x.line for x in store.frequent(9).collect()} == {k for k, n in total.items() if n >= 9}
    store.close()


def test_merging_runs_moves_no_rows(spark):
    store = line_dedup.LineRuns(spark, buckets=3)
    names = [store.add(spark.createDataFrame([(x,) for x in range(n, n + 50)], "line long")) for n in (0, 25)]
    joined = spark.table(names[1]).join(spark.table(names[0]).hint("merge"), "line", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    store.close()


def test_clean_keeps_rows_and_columns(spark):
    docs = edges.frame(spark)
    out = line_dedup.clean(docs, min_docs=2)
    assert out.columns == docs.columns and out.count() == docs.count()
    kept = {(i, t) for i, _, _, t in brute([(r[0], r[1]) for r in edges.rows()], 2)}
    assert {(r.doc_id, r.text or "") for r in out.collect()} == kept
    assert out.filter("text IS NULL").count() == 1
    assert {r["__text"] for r in out.collect()} == {"clash"}


def test_empty_table(spark):
    assert found(edges.empty(spark), 2) == [] and line_dedup.clean(edges.empty(spark)).collect() == []


def test_totals_and_compaction_decide_the_rows(spark, documents, monkeypatch):
    seen = []
    close = line_dedup.LineRuns.close

    def look(store):
        runs = store.runs().groupBy("line").agg(F.sum("n").alias("n"), F.max("total").alias("total"))
        again = sum(spark.table(n).groupBy("line").count().filter("count > 1").count() for level in store.levels for n in level)
        seen.append(([len(level) for level in store.levels], runs.filter("n != total").count() + again, runs.count()))
        close(store)

    monkeypatch.setattr(line_dedup.LineRuns, "close", look)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(documents, 10) == brute(rows, 10)
    (levels, off, lines), = seen
    assert levels == [1, 1] and off == 0 and lines
