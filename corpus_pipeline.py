"""From raw documents to packed training sequences, one written stage after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tocsin.llm import line_dedup, ngram_join, packing, phrase_index, pu_toxicity
from tocsin.llm.common import stored
from tocsin.llm.queries import VOCABULARY, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it learns from the rows that
    the operator's own query learns from."""
    model = pu_toxicity.train(docs, table(spark, sf_dir, "labels"), pu_toxicity.fold("doc_id", 3) != 1)
    return pu_toxicity.keep(docs, model, 0.7)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    return line_dedup.clean(docs, min_docs=10)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.75."""
    return ngram_join.one_of_each(docs, width=5, threshold=0.75)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item."""
    return phrase_index.clean(docs, table(spark, sf_dir, "benchmark"), width=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.digest(packing.pack(docs, VOCABULARY, window=2048))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near duplicates", dedup_near),
    ("decontamination", decontaminate),
    ("packing", pack),
]
#: Learned and tokenised stages have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
