import hashlib
import re
from collections import Counter, defaultdict

import edges
import pytest

from tocsin.llm import fair_mix


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows, share=1.5, most=2, weights=(5, 2, 1)):
    """(doc_id, size, source_size, target, taken) with plain lists and one sort."""
    own = defaultdict(int)
    for _, text, source in rows:
        own[source] += size(text)
    names = sorted(own, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, capped = share * sum(own.values()), set()
    while True:
        rest = sum(weight[s] for s in names if s not in capped)
        level = (budget - sum(most * own[s] for s in capped)) / rest if rest else 0.0
        more = {s for s in names if s in capped or weight[s] * level > most * own[s]}
        if more == capped or not rest:
            break
        capped = more
    target = {s: float(most * own[s]) if s in capped or not rest else weight[s] * level for s in names}
    turns, cum, out = [], defaultdict(int), []
    order = sorted(rows, key=lambda r: (hashlib.md5(f"0:{'' if r[0] is None else r[0]}".encode()).hexdigest(), size(r[1])))
    for k, (i, text, source) in enumerate(order):
        cum[source] += size(text)
        out.append([i, size(text), own[source], target[source], 0])
        if size(text):
            turns += [((cum[source] + c * own[source]) / target[source], names.index(source), cum[source] + c * own[source], k) for c in range(most)]
    total = 0
    for *_, k in sorted(turns):
        total += out[k][1]
        if total > budget:
            break
        out[k][4] += out[k][1]
    return [tuple(r) for r in out]


def found(df):
    rows = fair_mix.accounts(fair_mix.plan(df)).select("doc_id", "size", "source_size", "target", "taken").collect()
    return Counter(tuple(r) for r in rows)


def test_equals_brute_force(spark, documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    assert found(documents) == Counter(brute(rows))


def test_awkward_rows_and_many_ranges(spark, monkeypatch):
    # Two thirds of all rows are of one source, equal rows among them.
    rows = [(i, t, None if k % 3 == 0 else "hot" if k % 3 == 1 else f"s{k % 5}", 1) for k, (i, t, *_) in enumerate(edges.rows())]
    rows += [(7, "a b c", "hot", 0)] * 40 + [(None, "x y", "hot", 0)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, finish int").repartition(3)
    want = Counter(brute([r[:3] for r in rows]))
    assert found(df) == want
    monkeypatch.setattr(fair_mix, "ranges", lambda n: n // 7 + 1)
    assert found(df) == want and found(df) == want


def test_sources_come_near_their_targets(spark, documents):
    rows = fair_mix.accounts(fair_mix.plan(documents)).collect()
    taken, target, longest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        longest[r.source] = max(longest[r.source], r.size)
    total = sum(r.size for r in rows)
    assert sum(target.values()) == pytest.approx(1.5 * total)
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)
    assert sum(taken.values()) <= 1.5 * total < sum(taken.values()) + max(longest.values())


def test_excess_is_shared_until_none_is_above(spark):
    rows = [("a", 10, 5), ("b", 1000, 2), ("c", 30, 1), ("d", 400, 5)]
    df = spark.createDataFrame(rows, "source string, source_size long, weight int")
    got = {r.source: r.target for r in fair_mix.targets(df, 1.5 * 1440, 2).collect()}
    assert got["a"] == 20.0 and got["d"] == 800.0 and got["c"] == 60.0 and got["b"] == pytest.approx(1280.0)
    assert {r.target for r in fair_mix.targets(df, 9e9, 2).collect()} == {20.0, 2000.0, 60.0, 800.0}


def test_sequence_holds_each_taken_copy_with_all_columns(spark):
    rows = [(i, t, f"s{i % 2}" if i else None, 1.5, "k") for i, t, *_ in edges.rows()]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, finish double, __key0 string")
    mix = fair_mix.plan(df)
    out = fair_mix.mixed(df, mix)
    assert out.columns == [*df.columns, "finish_"]
    sequence = out.collect()
    assert [r.finish_ for r in sequence] == sorted(r.finish_ for r in sequence)
    copies = Counter()
    for r in fair_mix.accounts(mix).collect():
        copies[(r.doc_id, r.source, r.size)] += r.copies
    assert Counter((r.doc_id, r.source, size(r.text)) for r in sequence) == +copies


def test_empty_tables(spark):
    df = edges.empty(spark)
    assert fair_mix.accounts(fair_mix.plan(df)).count() == 0
    assert fair_mix.mixed(df, fair_mix.plan(df)).columns == [*df.columns, "finish"]
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert found(blank) == Counter([(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])
