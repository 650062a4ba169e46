"""Mix sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order (a hash of the id), gone
through up to ``most`` times. A copy's virtual finish time is the source's words up to
and with it, divided by the source's target; at time 1 each source has had its target.
All copies are sorted by finish time over all sources and the sequence is cut where the
total budget ends, so each source comes within about a document of its target.

Targets share the budget by weight; a target stops at ``most`` times its source's words
and the excess is shared anew among the others, until none is above.

No source is ever in one task: positions in a queue are running totals over a table
that is range-sorted by source and shuffled order, and the budget's end is found by the
totals of ranges of finish time. The driver gets one number for each round of sharing
and the one copy at which the budget ends. Texts are read once and not shuffled.

Defined results: a null or empty text has no words and is never taken; a null source is
a source of its own, the last; rows that repeat an id are queued as they are, ordered by
length and text hash; equal rows are interchangeable; an empty table gives an empty
result. A copy is taken whole or not at all, however long its text. Further columns,
whatever their names, are not looked at; ``mixed`` hands them on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import stored, unused
from tocsin.llm.ranged import first_beyond, ranges, running

#: Fixed by the contract.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


@dataclass
class Mix:
    """``queues`` has a row for each document: id, source, size, source_size, target, cum
    (the source's words up to and with it), mark. ``edge`` is the first copy beyond the budget."""

    queues: DataFrame
    edge: dict | None
    most: int

    def taken(self, copy: int) -> Column:
        """Whether the document's copy of that number, from 0, lies before the edge."""
        if self.edge is None:
            return F.col("size") > 0
        end = F.struct(F.lit(self.edge["finish"]), F.lit(self.edge["place"]), F.lit(self.edge["at"]))
        mine = F.struct(finish(copy).alias("col1"), F.col("place").alias("col2"), reached(copy).alias("col3"))
        return (F.col("size") > 0) & (mine < end)


def reached(copy: int) -> Column:
    return F.col("cum") + copy * F.col("source_size")


def finish(copy: int) -> Column:
    """Virtual finish time; documents without words have none."""
    return F.when(F.col("size") > 0, reached(copy).cast("double") / F.col("target"))


def targets(sources: DataFrame, budget: float, most: int) -> DataFrame:
    """Add ``target``: the budget by ``weight``, at most ``most`` times ``source_size``."""
    level, capped = None, F.lit(False)
    while True:
        cap = most * F.col("source_size")
        sums = sources.agg(
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if not sums["weight"]:
            return sources.withColumn("target", cap.cast("double"))
        found = (budget - sums["full"]) / sums["weight"]
        if found == level:
            return sources.withColumn("target", F.when(capped, cap.cast("double")).otherwise(F.col("weight") * level))
        level, capped = found, F.col("weight") * found > cap


def plan(
    docs: DataFrame,
    share: float = 1.5,
    most: int = 2,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    """Queue all documents and find where the budget, ``share`` of all words, ends."""
    queue = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("shuffled"),
        F.xxhash64(text_col).alias("mark"),
        F.monotonically_increasing_id().alias("row"),
    )
    queue = stored(queue, "queue")
    sources = stored(queue.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")), "sources")
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("docs").alias("docs"), F.count("*").alias("sources")).first()
    by_source = F.col("source").asc_nulls_last()
    ordered = running(sources, [by_source], {"place": F.lit(1), "start": F.col("source_size")}, ranges(whole["sources"]), "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ordered = stored(ordered.withColumn("start", F.col("start") - F.col("source_size")).withColumn("weight", weight), "sources")
    budget = share * (whole["size"] or 0)
    ordered = targets(ordered, budget, most).select("source", "source_size", "place", "start", "target")
    parts = ranges(whole["docs"] or 0)
    order = [by_source, F.col("shuffled"), F.col("size"), F.col("mark"), F.col("row")]
    summed = running(queue, order, {"cum": F.col("size")}, parts, "queue").drop("row", "shuffled")
    known = ordered.withColumnRenamed("source", "known")
    queues = summed.join(known, summed["source"].eqNullSafe(known["known"])).drop("known").withColumn("cum", F.col("cum") - F.col("start"))
    queues = stored(queues.drop("start"), "queues")
    copies = F.explode(F.array(*[F.struct(finish(k).alias("finish"), F.col("place"), reached(k).alias("at")) for k in range(most)])).alias("c")
    turns = queues.filter("size > 0").select(copies, "size").select("c.*", "size")
    edge = first_beyond(turns, [F.col("finish"), F.col("place"), F.col("at")], F.col("size"), budget, most * parts, "turns")
    return Mix(queues, edge, most)


def accounts(mix: Mix) -> DataFrame:
    """A row for each document: what it has, its source's target and what the mix takes."""
    copies = sum((mix.taken(k).cast("long") for k in range(1, mix.most)), mix.taken(0).cast("long"))
    return mix.queues.select(
        "doc_id", "source", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), finish(0).alias("finish")
    )


def mixed(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The training sequence: all columns of the documents, a row for each copy taken,
    sorted by the added column ``finish`` (with underscores behind it if that name is taken)."""
    name = unused(docs, "finish")
    keys = [unused(docs, f"__key{k}") for k in range(3)]
    times = [F.when(mix.taken(k), finish(k)) for k in range(mix.most)]
    taken = mix.queues.select(
        F.col("doc_id").alias(keys[0]), F.col("source").alias(keys[1]), F.col("mark").alias(keys[2]), F.explode(F.array_compact(F.array(*times))).alias(name)
    )
    rows = docs.withColumns({keys[0]: F.col(id_col), keys[1]: F.col(source_col).cast("string"), keys[2]: F.xxhash64(text_col)})
    # Equal documents are interchangeable: one of them stands for all their copies.
    rows = rows.dropDuplicates(keys)
    same = [rows[k].eqNullSafe(taken[k]) for k in keys]
    joined = rows.join(taken, same[0] & same[1] & same[2])
    return joined.select(*[rows[c] for c in docs.columns], name).orderBy(name)
