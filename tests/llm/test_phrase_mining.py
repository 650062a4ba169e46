import random
import re
from collections import Counter, defaultdict

import edges
import numpy as np
import pytest

from tocsin.llm import phrase_mining
from tocsin.llm.phrase_trie import Trie


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, min_count, most=5, top=2000):
    """Rows (lang, text) to (lang, rank, phrase, a, l, r, n, score), all phrases counted."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for m in range(1, most + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
        inside = set()
        for g, a in found.items():
            for m in range(2, len(g)):
                inside |= {g[i : i + m] for i in range(len(g) - m + 1) if 100 * a >= 100 * f[g[i : i + m]]}
        ranked = []
        for g, a in found.items():
            if g not in inside:
                score, _, left, right = min((1000 * a * n[lang] // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, g, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df, min_count, top=2000):
    out = phrase_mining.top(phrase_mining.mine(df, min_count), top)
    return sorted(tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equals_brute_force(spark, documents):
    rows = [(r.lang, r.text) for r in documents.collect()]
    want = brute(rows, 4)
    assert len(want) > 100 and found(documents, 4) == want


def hot_rows():
    pick = random.Random(1)
    words = ["the", "The", "of", "é", "ß", "x1", "rare"]
    rows = [("en" if k % 3 else None, " ".join(pick.choices(words, [9, 3, 5, 2, 2, 1, 1], k=40)) + pick.choice([".", "\n", " ; a\x0bb", ""])) for k in range(300)]
    return rows + [("de", "same five words in here. same")] * 50 + [("und", "the of the")] * 5


@pytest.mark.parametrize("small", [False, True])
def test_many_slices_and_several_tries(spark, monkeypatch, small):
    if small:  # a slice for every few texts, a trie for every few phrases
        monkeypatch.setattr(phrase_mining, "SLICE", 500)
        monkeypatch.setattr(phrase_mining, "SUMMED", 7)
        plain = phrase_mining.counted
        monkeypatch.setattr(phrase_mining, "counted", lambda ids, c: plain(ids, c, trie_size=40))
    rows = hot_rows()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    want = brute(rows, 5)
    assert len(want) > 50 and found(df, 5) == want
    assert found(df, 5, top=3) == brute(rows, 5, top=3)


def test_awkward_rows(spark):
    rows = [(t and "en", t) for _, t, *_ in edges.rows()] + [(None, "a\tb a b"), ("en", "q " * 20_000)]
    df = spark.createDataFrame([(*r, 1, "w", [1], "c") for r in rows], "lang string, text string, id int, w string, ids array<int>, word string")
    assert found(df.repartition(3), 2) == brute(rows, 2)


def test_empty_table_and_no_frequent_phrase(spark):
    assert found(edges.empty(spark), 2) == []
    assert found(spark.createDataFrame([("en", "a b c d")], "lang string, text string"), 2) == []


def test_products_beyond_64_bits(spark, monkeypatch):
    """Scores of counts as of a very large corpus, through the same expressions."""
    a, n, low, high = 3_000_000_019, 9_000_000_000_000_011, 4_000_000_007, 5_000_000_029
    above = phrase_mining._exact(phrase_mining.F.lit(1000)) * phrase_mining._exact("a") * phrase_mining._exact("n")
    df = spark.createDataFrame([(a, n, low, high)], "a long, n long, l long, r long").withColumn("above", above)
    df = df.withColumn("below", phrase_mining._exact("l") * phrase_mining._exact("r"))
    assert df.select(phrase_mining.F.expr("above div below")).first()[0] == 1000 * a * n // (low * high)


def test_trie_counts_all_phrases():
    pick = np.random.default_rng(2)
    ids = pick.integers(0, 30, 5000).astype(np.int32)
    rows = {tuple(ids[i : i + m]) for i in range(0, 4000, 3) for m in (1, 2, 3, 5) if ids[i : i + m].all()}
    rows |= {(40, 41), (1, 99)}
    words = np.zeros((len(rows), 5), np.int32)
    for k, row in enumerate(sorted(rows)):
        words[k, : len(row)] = row
    trie = Trie.of(words)
    counts = np.zeros(len(trie.base), np.int64)
    trie.count(ids[:2500], counts)
    trie.count(ids[2500:], counts)
    plain = Counter()
    for half in (ids[:2500], ids[2500:]):
        for m in range(1, 6):
            plain.update(map(tuple, np.lib.stride_tricks.sliding_window_view(half, m).tolist()))
    cells = np.flatnonzero(trie.phrase >= 0)
    assert len(cells) == len(rows)
    for cell in cells:
        row = tuple(int(w) for w in trie.words[trie.phrase[cell]] if w)
        assert counts[cell] == plain[row]
    empty = Trie.of(np.zeros((0, 5), np.int32))
    empty.count(ids, np.zeros(len(empty.base), np.int64))


def test_only_the_first_rows_of_a_language_meet(spark):
    df = spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long")
    assert "WindowGroupLimit" in phrase_mining.top(df.repartition(3), 5)._jdf.queryExecution().executedPlan().toString()
