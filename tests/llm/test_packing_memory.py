"""Tokenising keeps within a small share of a worker's memory."""

import random
import tracemalloc

import pyarrow as pa

from tocsin.llm import packing
from tocsin.llm.queries import VOCABULARY


def test_a_batch_is_tokenised_in_small_slices(spark, monkeypatch):
    monkeypatch.setattr(packing, "map_arrow", lambda rows, make, schema: make)
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    make = packing.tokenised(docs, VOCABULARY, 1, "source", "doc_id", "text")
    words = [w.strip() for w in "the quick brown fox jumps over a lazy dog and then it goes home".split()]
    texts = [" ".join(random.Random(i).choices(words, k=2000)).encode() for i in range(400)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(400), pa.int64()), pa.array([0] * 400, pa.int32()), pa.array(texts, pa.binary()), pa.array(["web"] * 400)],
        [packing.ID, packing.MARK, packing.TEXT, "mix"],
    )
    packing.WordTokens.of(VOCABULARY)
    tracemalloc.start()
    try:
        rows = sum(len(part) for part in make(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 400
    assert peak < 30 << 20, peak
