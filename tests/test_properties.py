"""Random small tables against plain Python."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import rows_of
from tocsin.operators import quality, ranking, tables

few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
KEY = st.sampled_from(["a", "b", "c", None])
ROW = st.tuples(KEY, st.integers(0, 3), st.sampled_from(["x", "y", None]))
DDL = "k string, o int, v string"


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


def rank_of(row):
    return [(v is not None, "" if v is None else v) for v in row[1:]]


@few
@given(st.lists(ROW, max_size=12), st.lists(ROW, max_size=12))
def test_upsert(spark, old, batch):
    target = {r[0]: r for r in sorted(old, key=rank_of) if r[0] is not None}
    loose = [r for r in old if r[0] is None]
    before = spark.createDataFrame(list(target.values()) + loose, DDL)
    expected = dict(target)
    expected.update({r[0]: r for r in sorted(batch, key=rank_of) if r[0] is not None})
    loose += [r for r in batch if r[0] is None]
    got = tables.upsert(before, spark.createDataFrame(batch, DDL), ["k"], ["o"])
    assert rows_of(got) == in_order(list(expected.values()) + loose)


@few
@given(st.lists(ROW, max_size=20))
def test_duplicates(spark, rows):
    df = spark.createDataFrame(rows, DDL)
    assert quality.duplicate_count(df, ["k", "o"]).first()[0] == len(rows) - len({r[:2] for r in rows})


@few
@given(st.lists(ROW, max_size=12), st.lists(ROW, max_size=12))
def test_row_changes(spark, before, after):
    b, a = Counter(before), Counter(after)
    expected = [(*row, b[row], a[row]) for row in set(b) | set(a) if b[row] != a[row]]
    got = tables.row_changes(spark.createDataFrame(before, DDL), spark.createDataFrame(after, DDL))
    assert rows_of(got) == in_order(expected)


@few
@given(st.lists(st.sampled_from([None, 1.5, 2.5, 2.5, -3.0, 1e300]), max_size=15), st.integers(2, 40))
def test_rank(spark, values, buckets):
    def smaller(x, y):
        return y is not None and (x is None or x < y)

    expected = [(v, 1 + sum(smaller(w, v) for w in values)) for v in values]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert rows_of(ranking.rank_by(df, "v", "r", buckets)) == in_order(expected)


@pytest.mark.parametrize("share", [0.34, 0.9])
def test_one_key_with_a_large_share_stays_whole(spark, share):
    from pyspark.sql import functions as F

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") < int(n * share), "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("o"),
        F.lit("v").alias("v"),
    )
    cold = n - int(n * share)
    assert quality.duplicate_count(df, ["k"]).first()[0] == n - cold - 1
    last = tables.latest_per_key(df, ["k"], ["o"])
    assert last.count() == cold + 1
    assert last.filter("k = 'hot'").first()["o"] == int(n * share) - 1
    assert tables.upsert(df.limit(0), df, ["k"], ["o"]).count() == cold + 1
