"""Phrase collocation mining by broadcast tries of Apriori-safe candidates.

Texts are read once: slices of a few megabytes of one language become the places of
their words among the distinct ones of the slice. Those go, packed, to the buckets of
their hashes, where they are counted; the frequent ones get numbers for the whole corpus, and
each slice is told the numbers of its words. Zero stands for a break and for all other words.

A phrase can only be frequent if both phrases without its first and without its last
word are. Level by level, windows whose two parts passed the level before are hashed
and counted in buckets, which gives a Bloom filter of hashes found ``min_count`` times;
windows that pass all levels are the candidates, a superset of the frequent phrases.

Double-array tries of the candidates are broadcast, one after the other, each of at most
about ``TRIE`` phrases. In a task numpy moves the states of all positions of a slice on,
level by level, and adds a bincount of the cells reached; the tasks' counts are summed.

What is broadcast is bounded: two filters of 16 MB a level, fuller ones letting more
through, and one trie at a time. Vocabulary and phrases are never gathered whole.

Defined results: a null text is empty, a null language is ``und`` and one with it;
equal rows count each; texts have no length limit; an empty table gives an empty
result. Further columns are not looked at, whatever their names. Phrases of equal score
and count come in the order of their UTF-8 bytes.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import BASE, bounded_batches, mixed, stored, text_bytes
from tocsin.llm.phrase_trie import Trie
from tocsin.llm.repeated import Filter, bucket_of, buckets_for, repeated

#: Fixed by the contract: what ends a piece, and the lower-casing of A-Z. Tabs are spaces.
BREAKS = b".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
PLAIN = bytes.maketrans(BREAKS + b"\t" + UPPER, b"\n" * len(BREAKS) + b" " + LOWER)
#: Bytes of text of one language that become one slice, and that a task holds at most.
SLICE, HELD = 4 << 20, 12 << 20
#: Bytes of text whose distinct words meet in a bucket.
BUCKET = 64 << 20
#: Words of the corpus whose candidates meet in a bucket.
LISTED = 10_000_000
#: Phrases of one trie, about.
TRIE = 1_000_000
#: Phrases whose counts travel and are summed together.
SUMMED = 20_000


def numbered(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of the texts, their counts, and all words in turn as places
    among the distinct ones, -1 where a piece ends."""
    data = np.frombuffer(b"\n".join(texts).translate(PLAIN), np.uint8)
    ends_piece = data == 10
    inside = ~ends_piece & (data != 32)
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
    places = np.asarray(words.indices).astype(np.int32)
    piece = np.cumsum(ends_piece, dtype=np.int32)[starts]
    shift = np.cumsum(np.diff(piece, prepend=piece[:1]) > 0)
    codes = np.full(len(places) + (int(shift[-1]) if len(shift) else 0), -1, np.int32)
    codes[np.arange(len(places)) + shift] = places
    return words.dictionary.cast(pa.binary()), np.bincount(places, minlength=len(words.dictionary)), codes


SLICED = "slice long, lang string, bucket int, words array<binary>, counts array<long>, at binary, codes binary"
NAMED = "slice long, at binary, ids binary, lang string, word binary, f long, id int"


def _sliced(number: int, lang: str, texts: list[bytes], buckets: int) -> pa.RecordBatch:
    """A slice as ``SLICED``: a row with its codes, and one for each bucket with its words,
    their counts and their places."""
    words, counts, codes = numbered(texts)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
    bucket = bucket_of(hashed, buckets).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    offsets = pa.array([0, *starts, len(order)], pa.int32())  # the first row has no words
    n = len(found) + 1
    places = [x.astype(np.int32).tobytes() for x in np.split(order, starts[1:])][: n - 1]
    columns = [
        pa.array([number] * n, pa.int64()), pa.array([lang] * n), pa.array([None, *found], pa.int32()),
        pa.ListArray.from_arrays(offsets, words.take(pa.array(order))), pa.ListArray.from_arrays(offsets, pa.array(counts[order].astype(np.int64))),
        pa.array([None, *places], pa.binary()), pa.array([codes.tobytes(), *[None] * (n - 1)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["slice", "lang", "bucket", "words", "counts", "at", "codes"])


def _slices(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)
    numbers = itertools.count(TaskContext.get().partitionId() << 32)

    def cut(lang: str) -> pa.RecordBatch:
        del size[lang]
        return _sliced(next(numbers), lang, held.pop(lang), buckets)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[lang].append(text)
            size[lang] += len(text)
            if size[lang] >= SLICE:
                yield cut(lang)
            elif sum(size.values()) >= HELD:
                yield cut(max(size, key=size.get))
    for lang in list(held):
        yield cut(lang)


def _named(table: pa.Table, buckets: int, min_count: int) -> pa.Table:
    """The words of a bucket that are frequent, with their counts and numbers, and for
    each slice the places of those it has."""
    table = table.combine_chunks()
    lists, langs = table.column("words").combine_chunks(), table.column("lang").to_pylist()
    sizes = np.asarray(lists.value_lengths())
    words = lists.flatten().dictionary_encode()
    counts = np.asarray(table.column("counts").combine_chunks().flatten())
    of_lang = {lang: k for k, lang in enumerate(sorted(set(langs)))}
    kinds = np.repeat(np.array([of_lang[lang] for lang in langs], np.int64), sizes)
    keys, back = np.unique(kinds << 32 | np.asarray(words.indices).astype(np.int64), return_inverse=True)
    order = np.argsort(back, kind="stable")
    sums = np.add.reduceat(counts[order], np.searchsorted(back[order], np.arange(len(keys)))) if len(keys) else counts
    frequent = np.flatnonzero(sums >= min_count)
    names, plain = sorted(of_lang, key=of_lang.get), words.dictionary
    rows = sorted((names[keys[k] >> 32], plain[int(keys[k] & 0xFFFFFFFF)].as_py(), int(sums[k]), int(k)) for k in frequent)
    bucket = table.column("bucket")[0].as_py()
    ids = np.zeros(len(keys), np.int32)
    for rank, row in enumerate(rows):
        ids[row[3]] = 1 + bucket + buckets * rank
    own = np.split(ids[back], np.cumsum(sizes)[:-1])
    at = [np.frombuffer(x, np.int32) for x in table.column("at").to_pylist()]
    told = [(s, a[i > 0].tobytes(), i[i > 0].tobytes()) for s, a, i in zip(table.column("slice").to_pylist(), at, own, strict=True) if i.any()]
    none = [None]
    columns = [
        [t[0] for t in told] + none * len(rows), [t[1] for t in told] + none * len(rows), [t[2] for t in told] + none * len(rows),
        none * len(told) + [r[0] for r in rows], none * len(told) + [r[1] for r in rows], none * len(told) + [r[2] for r in rows],
        none * len(told) + [int(ids[r[3]]) for r in rows],
    ]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.int64(), pa.int32()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["slice", "at", "ids", "lang", "word", "f", "id"])


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices' codes and the frequent words' places and numbers to numbers, runs of zeros as one."""
    for batch in batches:
        for codes, told in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            codes = np.frombuffer(codes, np.int32)
            of = np.zeros(codes.max(initial=-1) + 2, np.int32)
            for part in told or []:
                of[np.frombuffer(part["at"], np.int32)] = np.frombuffer(part["ids"], np.int32)
            found = of[codes]  # the last place, that of breaks, is zero
            keep = (found > 0) | np.append(found[1:] > 0, False)
            yield pa.RecordBatch.from_arrays([pa.array([found[keep].tobytes()])], ["ids"])


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for ids in batch.column(batch.num_columns - 1):
            yield np.frombuffer(ids.as_buffer(), np.int32)


def hashes(ids: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    value = np.zeros(len(at), np.uint64)
    for k in range(width):
        value = value * BASE + ids[at + k].astype(np.uint64)
    return mixed(value)


def safe(ids: np.ndarray, filters: list[Filter]) -> Iterator[np.ndarray]:
    """For widths 2, 3 and so on the starts of windows whose two parts pass; then those
    that pass themselves count for the next width. One more width than there are filters."""
    passes = ids > 0
    for width in range(2, len(filters) + 3):
        both = passes[:-1] & passes[1:]
        at = np.flatnonzero(both)
        if width - 2 < len(filters):
            at = at[filters[width - 2].holds(hashes(ids, at, width))]
        passes = np.zeros(len(both), bool)
        passes[at] = True
        yield at


def distinct_rows(rows: np.ndarray) -> np.ndarray:
    """The distinct rows of numbers under 2**31, by numbering ever longer beginnings."""
    code = np.zeros(len(rows), np.int64)
    first = np.arange(len(rows))
    for column in rows.T:
        _, first, code = np.unique(code << 32 | column, return_index=True, return_inverse=True)
    return rows[first]


def encode(docs: DataFrame, min_count: int, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words frequent enough (``lang, word, f, id``), word counts (``lang, n``), and the
    corpus in their numbers (``ids``, a row for each slice)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")), F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    buckets = max(24, text_bytes(docs, text_col) // BUCKET)
    slices = stored(texts.mapInArrow(lambda batches: _slices(batches, buckets), SLICED), "slices")
    each = slices.filter("bucket IS NOT NULL").drop("codes")
    named = stored(each.groupBy("bucket").applyInArrow(lambda table: _named(table, buckets, min_count), NAMED), "words")
    words = named.filter("slice IS NULL").select("lang", "word", "f", "id")
    sizes = each.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    told = named.filter("slice IS NOT NULL").groupBy("slice").agg(F.collect_list(F.struct("at", "ids")).alias("told"))
    both = slices.filter("codes IS NOT NULL").select("slice", "codes").join(told, "slice", "left").select("codes", "told")
    return words, stored(sizes, "sizes"), stored(both.mapInArrow(_coded, "ids binary"), "numbers")


def candidates(ids: DataFrame, words: int, min_count: int, most_words: int) -> DataFrame:
    """Distinct windows that may be frequent (``w1`` and so on, 0 behind the last word)."""
    context = ids.sparkSession.sparkContext
    filters: list[Filter] = []
    texts = ids.select(F.lit(0).alias("a"), F.lit(0).alias("b"), "ids")
    for width in range(2, most_words + 1):
        shared = context.broadcast(filters)

        def hashed(batch: pa.RecordBatch, width: int = width, shared=shared) -> np.ndarray:
            found = [np.empty(0, np.uint64)]
            for numbers in _numbers([batch]):
                *_, at = safe(numbers, shared.value)
                found.append(hashes(numbers, at, width))
            return np.concatenate(found)

        _, often, _ = repeated(texts, hashed, buckets_for(words), min_count, min_count)
        filters.append(often)
    shared = context.broadcast(filters)
    columns = [f"w{k + 1}" for k in range(most_words)]

    buckets = max(24, words // LISTED)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct candidates of a slice, packed by the bucket of their hash."""
        for numbers in _numbers(batches):
            found = [np.zeros((0, most_words), np.int32)]
            for width, at in zip(range(2, most_words + 1), safe(numbers, shared.value), strict=False):
                rows = distinct_rows(numbers[at[:, None] + np.arange(width)])
                found.append(np.pad(rows, ((0, 0), (0, most_words - width))))
            rows = np.concatenate(found)
            bucket = bucket_of(hashes(rows.ravel(), np.arange(0, rows.size, most_words), most_words), buckets).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            some, starts = np.unique(bucket[order], return_index=True)
            parts = np.split(rows[order], starts[1:])[: len(some)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["bucket", "rows"])

    def united(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), np.int32).reshape(-1, most_words) for x in table.column("rows")]
        rows = distinct_rows(np.concatenate(parts))
        return pa.table([pa.array(np.ascontiguousarray(c)) for c in rows.T], columns)

    return ids.mapInArrow(listed, "bucket int, rows binary").groupBy("bucket").applyInArrow(united, ", ".join(f"{c} int" for c in columns))


def counted(ids: DataFrame, found: DataFrame, trie_size: int = TRIE) -> DataFrame:
    """Exact counts ``f`` of the candidates, by as many tries as they need, each in a pass of its own."""
    context, columns = ids.sparkSession.sparkContext, found.columns
    total = found.count()
    groups = total // trie_size + 1
    shape = ", ".join(f"{c} int" for c in columns) + ", f long"
    out = ids.sparkSession.createDataFrame([], shape)
    for group in range(groups):
        # Phrases that begin with the same two words share a trie.
        own = found.filter(F.pmod(F.xxhash64(*columns[:2]), F.lit(groups)) == group).toArrow()
        trie = Trie.of(np.stack([own.column(c).to_numpy() for c in columns], 1))
        shared = context.broadcast(trie)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            """What a task has counted: a row for each ``SUMMED`` phrases, in the trie's order."""
            trie = shared.value
            counts = np.zeros(len(trie.base), np.int64)
            for numbers in _numbers(batches):
                trie.count(numbers, counts)
            cells = np.flatnonzero((counts > 0) & (trie.phrase >= 0))
            cells = cells[np.argsort(trie.phrase[cells])]
            rows = trie.phrase[cells]
            chunks, starts = np.unique(rows // SUMMED, return_index=True)
            for chunk, some in zip(chunks, np.split(np.arange(len(rows)), starts[1:]), strict=False):
                packed = [pa.array([rows[some].tobytes()], pa.binary()), pa.array([counts[cells[some]].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *packed], ["chunk", "rows", "counts"])

        def add(table: pa.Table) -> pa.Table:
            words = shared.value.words
            chunk = table.column("chunk")[0].as_py()
            sums = np.zeros(SUMMED, np.int64)
            for rows, counts in zip(table.column("rows"), table.column("counts"), strict=True):
                sums[np.frombuffer(rows.as_buffer(), np.int32) - chunk * SUMMED] += np.frombuffer(counts.as_buffer(), np.int64)
            at = np.flatnonzero(sums)
            found = words[at + chunk * SUMMED]
            return pa.table([*[pa.array(np.ascontiguousarray(c)) for c in found.T], pa.array(sums[at])], [*columns, "f"])

        shards = ids.mapInArrow(count, "chunk int, rows binary, counts binary")
        sums = stored(shards.groupBy("chunk").applyInArrow(add, shape), "counts")
        shared.unpersist()
        out = out.unionByName(sums)
    return out


def _exact(column: str | Column) -> Column:
    return F.col(column).cast("decimal(20,0)") if isinstance(column, str) else column.cast("decimal(20,0)")


def mine(docs: DataFrame, min_count: int = 100, most_words: int = 5, cover: int = 100, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Frequent phrases with their scores: ``lang, phrase, a, l, r, n, score, cut``.

    ``score`` is ``floor(1000 * a * n / (l * r))`` of the lowest cut, the first of equal ones.
    A phrase inside a longer one with at least ``cover`` percent of its count is dropped.
    It is enough to look at phrases of one word more: all between are as frequent.
    """
    words, sizes, ids = encode(docs, min_count, lang_col, text_col)
    whole = sizes.agg(F.sum("n")).first()[0] or 0
    found = stored(candidates(ids, whole, min_count, most_words), "candidates")
    columns = found.columns
    w = F.filter(F.array(*columns), lambda x: x > 0)
    phrases = stored(counted(ids, found).filter(F.col("f") >= min_count).select(w.alias("w"), "f"), "phrases")
    size = F.size("w")
    longer = phrases.filter(size > 2)
    parts = [longer.select(F.slice("w", start, size - 1).alias("w"), "f") for start in (1, 2)]
    covered = parts[0].union(parts[1]).groupBy("w").agg(F.max("f").alias("longer"))
    kept = phrases.join(covered, "w", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("f")))
    known = phrases.union(words.select(F.array(F.col("id").cast("int")), "f"))
    cuts = kept.select("w", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select("*", F.slice("w", F.lit(1), F.col("cut")).alias("left"), F.slice("w", F.col("cut") + 1, F.size("w") - F.col("cut")).alias("right"))
    cuts = cuts.join(known.toDF("left", "l"), "left").join(known.toDF("right", "r"), "right")
    langs = words.select(F.col("id").cast("int").alias("first"), "lang").join(sizes, "lang")
    cuts = cuts.withColumn("first", F.element_at("w", 1)).join(langs, "first")
    cuts = cuts.withColumn("above", _exact(F.lit(1000)) * _exact("a") * _exact("n")).withColumn("below", _exact("l") * _exact("r"))
    scored = cuts.withColumn("score", F.expr("above div below"))
    least = scored.groupBy("w", "lang", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    spelled = kept.select("w", F.posexplode("w").alias("at", "id")).join(words.select(F.col("id").cast("int").alias("id"), F.col("word").cast("string").alias("word")), "id")
    spelled = spelled.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    out = least.join(spelled, "w")
    return out.select("lang", F.array_join(F.col("words.word"), " ").alias("phrase"), "a", "least.l", "least.r", "n", "least.score", "least.cut")


def top(phrases: DataFrame, most: int) -> DataFrame:
    """The first ``most`` phrases of each language by score, then count, then bytes; ``rank`` from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("long"))
