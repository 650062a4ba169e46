"""Connected components of a table of links, without gathering any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` with the smallest node each one is connected to.

    In each round a node takes the smallest label among its neighbours and itself
    and then the label of that label, so long chains shrink by halves. Rounds are
    written, which cuts the lineage. ``links`` has columns ``a`` and ``b``.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.toDF("other", "near"), "other").groupBy("node").agg(F.min("near").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("lower"))
        jump = labels.toDF("lower", "jump")
        after = lower.join(jump, "lower", "left").select(
            "node", F.least("lower", "jump").alias("label"), (F.least("lower", "jump") != F.col("label")).alias("moved")
        )
        after = stored(after, "labels")
        labels = after.select("node", "label")
        if after.filter("moved").isEmpty():
            return labels
