"""Contract queries against their SQL on the smallest tables, and the pipeline by hand."""

import os
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from test_line_dedup import brute as lines_brute
from test_ngram_join import brute as near_brute
from test_phrase_index import brute as leaks_brute
from tocsin.llm import pu_toxicity, queries


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in os.listdir(sf):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, sf, name):
    df = driver.queries()[name](spark, sf)
    answer = duck.execute(driver.oracle_sql()[name])
    columns = sorted(c[0] for c in answer.description)
    assert columns == sorted(df.columns)
    names = [c[0] for c in answer.description]
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in answer.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in df.collect()) == want


def test_all_are_registered():
    names = list(driver.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_pipeline_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    # The learned stage is taken from the operator; all others are done anew.
    kept = corpus_pipeline.drop_toxic(spark, docs, sf)
    assert kept.columns == docs.columns
    model = pu_toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"), pu_toxicity.fold("doc_id", 3) != 1)
    low = {r["__id"] for r in pu_toxicity.score(docs, model).filter("score < 0.7").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in low]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows)
    rows = [(i, t) for i, _, _, t in lines_brute(rows, 10)]
    least = {(i, c) for i, n, c in near_brute(rows)}
    rows = [(i, t) for i, t in rows if (i, i) in least]
    hit = {i for i, _, n, _ in leaks_brute(rows, items) if n}
    rows = [(i, t) for i, t in rows if i not in hit]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*plain.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}
    found = defaultdict(list)
    for p in corpus_pipeline.run(spark, sf).collect():
        found[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    assert set(found) == set(want)
    for i, pieces in found.items():
        at = 0
        for start, length, crc, total in sorted(pieces):
            assert start == at and total == len(want[i])
            assert crc == zlib.crc32(np.array(want[i][start : start + length], "<u4").tobytes())
            at += length
        assert at == len(want[i])


def test_stages_take_awkward_and_empty_tables(spark, sf):
    import edges

    shape = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([r[:5] for r in edges.rows()], shape)
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf)
            assert out.columns == docs.columns and out.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, table, sf).count() >= table.count()


CLASHING = ["__id", "__mark", "__row", "__frequent", "frequent", "__text", "group", "sig", "key", "window", "term", "item", "pos", "n"]


def test_columns_with_clashing_names_stay(spark, sf):
    """The stages that keep documents hand on further columns whatever they are called."""
    import edges

    shape = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    rows = [(*r[:5], *[f"{c} of {k}" for c in CLASHING]) for k, r in enumerate(edges.rows())]
    docs = spark.createDataFrame(rows, shape)
    given = {tuple(r[i] for i in range(len(r)) if i != 1) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        kept = [tuple(r[i] for i in range(len(r)) if i != 1) for r in out.collect()]
        assert out.columns == docs.columns and kept and set(kept) <= given, name
