import edges

from tocsin.llm import phrase_index

ITEMS = [
    (1, " ".join(f"w{i}" for i in range(5, 17))), (2, "same text"), (3, None), (4, "..."), (2, "One"), (None, "own"),
    (7, "É é ß x y"), (8, " ".join(["a"] * 12)), (9, "absent words of no document at all in this table here"),
]


def brute(rows, items, width=10):
    windows = {}
    for item, text in items:
        w = edges.lower_words(text)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[s : s + width]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w, hit, found = edges.lower_words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                of = windows.get(tuple(w[s : s + n]))
                if of:
                    hit |= set(range(s, s + n))
                    found |= of
        out.append((i, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=str)


def found(docs, items, width=10):
    rows = phrase_index.contamination(docs, items, width).collect()
    return sorted(((None if r["__id"] == -(2**63) else r["__id"], r.n_words, r.n_hit, tuple(r["items"])) for r in rows), key=str)


def test_edges(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for width in (10, 3, 1):
        # Row 11 is there twice with one text: both get the result.
        assert found(edges.frame(spark), items, width) == brute([(r[0], r[1]) for r in edges.rows()], ITEMS, width)


def test_given_tables(spark, documents, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(documents, items) == want and any(r[2] for r in want)


def test_clean_keeps_what_has_no_hit(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = edges.frame(spark)
    out = phrase_index.clean(docs, items, 10)
    rows = [(r[0], r[1]) for r in edges.rows()]
    clean = sorted((i for i, _, n, _ in brute(rows, ITEMS) if not n), key=str)
    assert out.columns == docs.columns and sorted((r.doc_id for r in out.collect()), key=str) == clean


def test_proximity_in_any_order(spark):
    docs = spark.createDataFrame([(1, "red x fox y quick"), (2, "quick red fox"), (3, "red " + "z " * 9 + "fox quick"), (4, "red fox")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "quick red fox")], "item_id long, text string")
    windows = phrase_index.item_windows(items, 3)
    index = phrase_index.PhraseIndex(docs, windows)
    near = {r["__id"]: (r.start, r.end) for r in index.near(windows, slop=2).collect()}
    assert near == {1: (0, 4), 2: (0, 2)}
    assert {r["__id"] for r in index.phrases(windows).collect()} == {2}
    index.close()


def test_index_is_looked_up_without_dealing_it_out_again(spark, documents, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    windows = phrase_index.item_windows(items, 10)
    index = phrase_index.PhraseIndex(documents, windows)
    with phrase_index._local_joins(spark):
        asked = index.postings().select(*phrase_index.KEYS, "term", "pos")
        plan = index.postings().join(asked.hint("shuffle_hash"), [*phrase_index.KEYS, "term", "pos"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    index.close()


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(edges.empty(spark), items) == []
    assert {r[2] for r in found(edges.frame(spark), items.limit(0))} == {0}
