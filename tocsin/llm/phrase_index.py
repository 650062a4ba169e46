"""Benchmark passages in training text, found through a positional inverted index.

The index is a table of postings ``(document, term, pos)`` of the terms that the test
items use, bucketed by document: building it deals every text out once, and all that
follows is local to a bucket. A test window is looked up from its rarest term: its
postings, less the term's offset, are the candidate starts; they are intersected with
the offset-adjusted postings of the next rarest term, and what is left with those of
all others. Frequent terms are so only looked up where rare ones have met.

Everything is DataFrame operations. Terms are told apart by 64-bit hashes.

Defined results: null or empty texts have no words and no hits; an item of fewer words
than a window is one window; an item without words is never found; rows equal in id
and text get equal results; items of one id are one item, an item without an id
counts for the words it hits, not among the items.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tocsin.llm.common import ID, KEYS, MARK, ROW, row_id, stored, text_bytes, text_mark, with_keys
from tocsin.session import new_path

#: Fixed by the contract: a word of the text as it is before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most rows of test terms or windows that are broadcast; beyond, Spark shuffles them.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def folded(word: Column) -> Column:
    """A-Z lower-cased and nothing else; the slow way only where a word isn't ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast what was counted and is small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@contextmanager
def _local_joins(spark: SparkSession) -> Iterator[None]:
    """Let joins on document, term and place use buckets by document."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def item_windows(items: DataFrame, width: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``window, item, len, off, term``: a row for each word of each window."""
    own = items.select(F.col(item_col).alias("item"), F.transform(words(F.col(text_col)), folded).alias("w")).filter(F.size("w") > 0)
    starts = own.select("item", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)))).alias("s"))
    cut = starts.select("item", F.slice("w", F.col("s") + 1, width).alias("w"))
    return cut.select(
        F.xxhash64("w").alias("window"), "item", F.size("w").alias("len"), F.posexplode("w").alias("off", "word")
    ).select("window", "item", "len", "off", F.xxhash64("word").alias("term"))


class PhraseIndex:
    """Postings of the given terms in all documents, written and bucketed by document.

    The last word of each document is kept too, under a null term, so that the index
    also knows the words of each document.
    """

    def __init__(self, docs: DataFrame, terms: DataFrame, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text"):
        self.spark = docs.sparkSession
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        self.buckets = buckets or min(most, max(12, text_bytes(docs, text_col) // (16 << 20)))
        known = stored(terms.select(F.col("term").alias("known")).distinct(), "terms")
        dealt = docs.select(row_id(id_col).alias(ID), text_mark(text_col).alias(MARK), F.col(text_col).alias("t")).repartition(self.buckets, *KEYS)
        split = dealt.select(*KEYS, words(F.col("t")).alias("w"))
        placed = split.select(*KEYS, (F.size("w") - 1).alias("last"), F.posexplode("w").alias("pos", "word"))
        placed = placed.select(*KEYS, "last", "pos", F.xxhash64(folded(F.col("word"))).alias("term"))
        found = placed.join(small(known, known.count()), F.col("term") == F.col("known"), "left")
        self.name = f"postings_{uuid.uuid4().hex}"
        self.path = new_path(self.spark, self.name)
        (
            found.filter("known IS NOT NULL OR pos = last")
            .select(*KEYS, F.col("known").alias("term"), "pos", (F.col("pos") == F.col("last")).alias("ends"))
            .write.bucketBy(self.buckets, *KEYS)
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def postings(self) -> DataFrame:
        return self.spark.table(self.name).filter("term IS NOT NULL").select(*KEYS, "term", "pos")

    def sizes(self) -> DataFrame:
        """Words of each document that has any."""
        return self.spark.table(self.name).filter("ends").select(*KEYS, (F.col("pos") + 1).alias("n")).distinct()

    def close(self) -> None:
        """Drop the table and delete its files; frames over the index can't be read any more."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def ranked(self, windows: DataFrame) -> DataFrame:
        """Each window's terms, the rarest of the corpus first; windows with an absent term are left out."""
        often = self.postings().groupBy("term").agg(F.count("*").alias("df"))
        each = windows.select("window", "len", "off", "term").distinct().join(often, "term")
        by = Window.partitionBy("window")
        each = each.withColumn("there", F.count("*").over(by)).filter(F.col("there") == F.col("len"))
        return stored(each.withColumn("rank", F.row_number().over(by.orderBy("df", "off"))).drop("there", "df"), "ranked")

    def _seeds(self, ranked: DataFrame) -> tuple[DataFrame, int]:
        n = ranked.count()
        first = small(ranked.filter("rank = 1").select("window", "len", F.col("off").alias("at"), "term"), n)
        return self.postings().join(first, "term").select(*KEYS, "window", "len", (F.col("pos") - F.col("at")).alias("start")), n

    def phrases(self, windows: DataFrame) -> DataFrame:
        """``document, window, len, start`` of every exact occurrence, written."""
        with _local_joins(self.spark):
            ranked = self.ranked(windows)
            seeds, n = self._seeds(ranked)
            starts = seeds.filter("start >= 0").distinct()
            terms = ranked.select("window", "off", "term", "rank")

            def there(starts: DataFrame, terms: DataFrame) -> DataFrame:
                """The starts, once for each of the terms that stands at its offset."""
                asked = starts.join(small(terms.drop("rank"), n), "window").withColumn("pos", F.col("start") + F.col("off"))
                held = self.postings().join(small(terms.select("term").distinct(), n), "term", "left_semi")
                return held.join(asked.hint("shuffle_hash"), [*KEYS, "term", "pos"])

            columns = [*KEYS, "window", "len", "start"]
            # A row that the table holds twice has its postings twice.
            second = there(starts.filter("len > 1"), terms.filter("rank = 2")).select(*columns).distinct()
            rest = there(second.filter("len > 2"), terms.filter("rank > 2")).select(*columns, "pos").distinct()
            whole = rest.groupBy(*columns).agg(F.count("*").alias("m")).filter("m = len - 2").select(*columns)
            found = starts.filter("len = 1").select(*columns).union(second.filter("len = 2")).union(whole)
            return stored(found, "phrases")

    def near(self, windows: DataFrame, slop: int) -> DataFrame:
        """``document, window, start, end`` around each rarest term with all others close.

        Proximity: in any order, every word of the window has a posting at most
        ``len + slop - 1`` words from the rarest one. ``start`` and ``end`` bound the
        closest posting of each word.
        """
        with _local_joins(self.spark):
            ranked = self.ranked(windows)
            seeds, n = self._seeds(ranked)
            first = ranked.filter("rank = 1").select("window", F.col("off").alias("at"))
            seeds = seeds.join(small(first, n), "window").withColumn("seed", F.col("start") + F.col("at"))
            asked = seeds.join(small(ranked.select("window", "rank", "term"), n), "window").withColumn("reach", F.col("len") + slop - 1)
            met = self.postings().join(asked.hint("shuffle_hash"), [*KEYS, "term"]).filter("abs(pos - seed) <= reach")
            closest = met.groupBy(*KEYS, "window", "len", "seed", "rank").agg(F.min_by("pos", F.abs(F.col("pos") - F.col("seed"))).alias("pos"))
            whole = closest.groupBy(*KEYS, "window", "len", "seed").agg(
                F.count("*").alias("m"), F.min("pos").alias("start"), F.max("pos").alias("end")
            )
            return stored(whole.filter("m = len").select(*KEYS, "window", "start", "end"), "near")


def contamination(
    docs: DataFrame, items: DataFrame, width: int = 10, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Row keys, ``n_words``, ``n_hit`` and the sorted ``items`` (as strings) of every row."""
    windows = stored(item_windows(items, width, item_col), "windows")
    index = PhraseIndex(docs, windows, id_col=id_col, text_col=text_col)
    hits, sizes = index.phrases(windows), stored(index.sizes(), "sizes")
    index.close()
    by = Window.partitionBy(*KEYS).orderBy("start", "len")
    ends = hits.select(*KEYS, "start", "len").distinct().withColumn("end", F.col("start") + F.col("len"))
    seen = F.coalesce(F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = ends.withColumn("fresh", F.greatest(F.col("end") - F.greatest(F.col("start"), seen), F.lit(0)))
    covered = fresh.groupBy(*KEYS).agg(F.sum("fresh").alias("n_hit"))
    of = windows.select("window", F.col("item").cast("string").alias("item")).distinct()
    named = hits.select(*KEYS, "window").distinct().join(of, "window").groupBy(*KEYS).agg(F.array_sort(F.collect_set("item")).alias("items"))
    rows = docs.select(row_id(id_col).alias(ID), text_mark(text_col).alias(MARK))
    return (
        rows.join(sizes, KEYS, "left").join(covered, KEYS, "left").join(named, KEYS, "left")
        .select(
            *KEYS,
            F.coalesce("n", F.lit(0)).cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that hold no window of any item, with their columns as they are."""
    hit = contamination(docs, items, width, id_col=id_col, text_col=text_col).filter("n_hit > 0").select(*KEYS).distinct()
    return with_keys(docs, id_col, text_col).join(hit, KEYS, "left_anti").select(f"{ROW}.*")
