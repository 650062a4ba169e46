"""Learned operators: held-out accuracy, and the awkward rows."""

import edges
import numpy as np
import pytest
from pyspark.sql import functions as F

from tocsin.llm import line_crf, pu_toxicity, subword_quality, url_filter

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")


def auc(scores, truth):
    order = np.argsort(scores)
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    n = truth.sum()
    return (rank[truth == 1].sum() - n * (n + 1) / 2) / (n * (len(truth) - n))


def held_out(docs, labels, module, parts, at, column):
    learn = pu_toxicity.fold("doc_id", parts) != at
    model = module.train(docs, labels, learn)
    rows = docs.join(labels.filter(~learn), "doc_id")
    found = module.score(rows, model).withColumnRenamed("__id", "doc_id").join(labels, "doc_id").select("score", column).toPandas()
    return auc(found.score.values, found[column].values)


def test_toxicity_on_held_out_rows(big):
    assert held_out(*big, pu_toxicity, 3, 1, "toxic") > 0.85


def test_quality_on_held_out_rows(big):
    assert held_out(*big, subword_quality, 5, 0, "quality") > 0.98


def test_risk_is_not_driven_below_zero():
    """Without the correction the weight of a shared feature would grow without end."""
    r = np.random.default_rng(0)
    positive = [np.unique(np.append(r.integers(10, 40, 8), 1)) for _ in range(80)]
    clean = [np.unique(r.integers(10, 40, 8)) for _ in range(360)]
    weights, bias = pu_toxicity.fit(positive, clean + positive[:40], 0.1)
    assert 1 in weights and weights[1] + bias > 0 > bias and abs(weights[1]) < 50


@pytest.mark.parametrize("module", [pu_toxicity, subword_quality])
def test_edges_get_a_score(spark, module):
    docs = edges.frame(spark)
    column = "toxic" if module is pu_toxicity else "quality"
    shape = f"doc_id long, {column} int"
    some = spark.createDataFrame([(4, 1), (6, 0), (6, 1), (None, 1), (9, None), (12, 0), (10, 0)], shape)
    everything = F.lit(True)
    for labels in (some, spark.createDataFrame([], shape), spark.createDataFrame([(4, 0)], shape)):
        scores = module.score(docs, module.train(docs, labels, everything)).collect()
        assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert module.score(edges.empty(spark), module.train(edges.empty(spark), some, everything)).collect() == []


def test_keep_leaves_columns_alone(spark):
    docs = edges.frame(spark)
    model = ({f: 9.0 for f in pu_toxicity.features(b"w3")[:1]}, -1.0)
    out = pu_toxicity.keep(docs, model, 0.7)
    assert out.columns == docs.columns
    want = sum("w3" not in (r[1] or "").lower().split() for r in edges.rows())
    assert out.count() == want


def test_viterbi_equals_all_markings():
    import itertools

    r = np.random.default_rng(2)
    field = line_crf.Field(r.normal(size=len(line_crf.NAMES)), r.normal(size=(2, 2)))
    for n in range(1, 7):
        lines = [sorted(r.choice(len(line_crf.NAMES), 3, replace=False).tolist()) for _ in range(n)]
        s = field.scores(lines)

        def value(marks, s=s):
            return sum(x for x, m in zip(s, marks, strict=True) if m) + sum(field.step[a, b] for a, b in itertools.pairwise(marks))

        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert value(field.decode(lines)) == pytest.approx(value(best))


def test_field_learns_what_is_boilerplate(big):
    docs, labels = big
    out = line_crf.judge(docs, line_crf.train(docs, labels)).withColumnRenamed("__id", "doc_id").join(labels, "doc_id")
    right = out.filter("NOT base_failed").select((F.col("kept") == (F.col("quality") == 1)).cast("int").alias("x")).agg(F.avg("x")).first()[0]
    assert right > 0.98


def test_field_learns_from_lines_behind_the_first_200(spark):
    plain, junk = [f"The {i} th plain sentence ends here." for i in range(200)], [f"menu | {i} # >>" for i in range(200)]
    texts = [(i, "\n".join(plain + (junk if i % 2 else plain[::-1]))) for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(20)], "doc_id long, quality int")
    field = line_crf.train(docs, labels)
    content = {r["__id"]: r.content for r in line_crf.judge(docs, field).collect()}
    assert max(content[i] for i in range(1, 20, 2)) < min(content[i] for i in range(0, 20, 2))


def repeat_words(w):
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = {j for i, run in enumerate(runs) if runs.count(run) > 1 for j in (i, i + 1, i + 2)}
    return len(hit)


def test_rule_counts_equal_plain_ones(spark):
    rows = [r for r in edges.rows() if r[0] != 10] + [(50, "a|b <c> #*\na|b <c> #*\n \n \nx y z x y z q", None, None, None, None, None)]
    got = line_crf.judge(edges.frame(spark, rows), line_crf.Field()).collect()
    want = []
    for i, t, *_ in rows:
        w = edges.words(t)
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        dup = sum(x in lines[:k] for k, x in enumerate(lines))
        rep = repeat_words(w)
        failed = len(w) < 50 or 100 * rep > 50 * len(w)
        chars = sum(len(x.decode()) for x in w)
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        want.append((-(2**63) if i is None else i, len(w), chars, symbols, dup, rep, failed))
    names = ["__id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(want)
    assert line_crf.judge(edges.empty(spark), line_crf.Field()).collect() == []


URLS = [
    None, "", "no scheme", "http://A.COM", "http://a.com/", "https://Example.com/en/x?q#f", "http://www.example.com/en/", "http://m.www.example.com/en/y",
    "http://b.net/es/1", "http://b.net/fr/", "http://bnet/es/", "http://x.net?/es/", "ftp://notexample.com/en/", "a://b://c/d", "http://example.com/en", "http://é.COM/É",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [t for _, t in url_filter.RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/"):])]
    return host, path, max(fits, key=len, default=None)


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(3, URLS[3], None), (None, URLS[4], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, t string")
    got = {(r.page_id, r.host, r.path, r.rule) for r in url_filter.judge(pages).collect()}
    assert got == {(i, *plain(u)) for i, u, _ in rows}
    verdicts = dict((t, v) for v, t in url_filter.RULES)
    assert all(r.verdict == verdicts[r.rule] for r in url_filter.judge(pages).collect() if r.rule)
    assert url_filter.judge(pages.limit(0)).collect() == []


def test_chances_of_a_context_add_up():
    grams = {}
    for text in ("\x02abab\x03", "\x02abc\x03"):
        for n in range(1, 4):
            for i in range(len(text) - n + 1):
                a, r = grams.get(text[i : i + n], (0, 0))
                grams[text[i : i + n]] = (a + 1, r)
    model = url_filter.Model(grams, 2)
    assert model.score("abab") > 0 > model.score("zzzz") - 1 and model.score("") == 0


def test_models_tell_held_out_urls_apart(spark):
    pages = spark.read.parquet(f"{BIG}/pages.parquet")
    known = url_filter.known(pages, url_filter.RULES)
    model = url_filter.fit(known, 4, 2, 400_000)
    found = url_filter.scored(known.filter("apart"), model, ["y"]).toPandas()
    assert auc(found.score.values, found.y.values) > 0.95


def brute_scores(spark, pages, order=4, least=2):
    """The score of every text by the model in memory, over all runs seen ``least`` times."""
    seen = {}
    for r in url_filter.known(pages, url_filter.RULES).filter("NOT apart").collect():
        marked = "\x02" + r.t.lower() + "\x03"
        for n in range(1, order + 2):
            for i in range(len(marked) - n + 1):
                seen.setdefault(marked[i : i + n], [0, 0])[1 - r.y] += 1
    grams = {g: tuple(v) for g, v in seen.items() if sum(v) >= least}
    return url_filter.Model(grams, order), len(grams)


def url_scores(pages):
    return [(r.url.split("://", 1)[1] if "://" in (r.url or "") else "", r.score) for r in url_filter.judge(pages).join(pages, "page_id").collect()]


def test_url_scores_equal_the_model_in_memory(spark, sf):
    odd = spark.createDataFrame([(10**9 + i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").unionByName(odd)
    model, _ = brute_scores(spark, pages)
    assert all(abs(score - model.score(t)) < 1e-9 for t, score in url_scores(pages))


def test_no_run_of_characters_is_lost_with_more_pages(spark):
    random = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789"))
    tails = ["".join(row) for row in letters[random.integers(0, 36, (7000, 100))]]
    urls = [f"http://{('a.com', 'b.net/es')[i % 2]}/{t}" for i, t in enumerate(tails)] * 2 + [f"http://c.org/{t[:40]}" for t in tails[:200]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    model, size = brute_scores(spark, pages)
    assert size > 400_000
    assert all(abs(score - model.score(t)) < 1e-9 for t, score in url_scores(pages) if t.startswith("c.org"))
