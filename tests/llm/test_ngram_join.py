import random

import edges

from tocsin.llm import ngram_join


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def brute(rows):
    """(id, text) -> (id, size, smallest id reachable), by comparing all pairs that share a shingle."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = {}
    for k, (_, s) in enumerate(sets):
        for h in s:
            held.setdefault(h, []).append(k)
    for a, b in {(m[x], m[y]) for m in held.values() for x in range(len(m)) for y in range(x)}:
        if 100 * len(sets[a][1] & sets[b][1]) >= 75 * len(sets[a][1] | sets[b][1]):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)), key=str)


def found(docs):
    out = ngram_join.link_groups(docs)
    rows = out.collect()
    return sorted(((None if r["__id"] == -(2**63) else r["__id"], r.n, r.component_id) for r in rows), key=str)


def test_edges(spark):
    assert found(edges.frame(spark)) == brute([(r[0], r[1]) for r in edges.rows()])


def test_given_table(documents):
    assert found(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_chains_and_sizes(spark):
    """Near copies at every distance, short and long, in long chains and around hubs."""
    r = random.Random(3)
    texts = []
    for size in (4, 6, 8, 9, 12, 20, 44, 90, 300):
        base = [f"v{r.randrange(10**6)}" for _ in range(size)]
        for _ in range(14):
            base = list(base)
            for _ in range(1 + size // 60):
                base[r.randrange(size)] = f"v{r.randrange(10**6)}"
            texts.append(" ".join(base if r.random() < 0.5 else base[: -r.randrange(1, 4)]))
    rows = list(enumerate(texts))
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs) == brute(rows)


def test_large_group_that_does_not_link_as_a_whole(spark):
    """Pairs lie around the threshold, so no hub reaches all members."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(150):
        own = list(base)
        for at in r.sample(range(100), 3):
            own[at] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def near_copies(seed, many, edits, size=400):
    """Copies of one text with so many words changed in each."""
    r = random.Random(seed)
    rows = []
    for i in range(many):
        own = [f"w{k}" for k in range(size)]
        for at in r.sample(range(size), r.choice(edits)):
            own[at] = f"x{r.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    return rows


def test_group_of_many_lists_with_pairs_on_both_sides_of_the_threshold(spark):
    rows = near_copies(7, 80, range(4, 9))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_copies_too_far_apart_make_few_pairs_in_the_last_join(spark, monkeypatch):
    """Nearly none of the 100 copies link (about 0.68), but they share most of their lists."""
    made = []
    left = ngram_join._left

    def counted(*args):
        out = left(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_left", counted)
    rows = near_copies(11, 100, [8])
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert len(made) == 1 and made[0] < 1000, made


def test_boundary_follows_cost():
    assert ngram_join.boundary(1, 0.75) < ngram_join.boundary(20, 0.75)


def test_empty_table(spark):
    assert found(edges.empty(spark)) == []
