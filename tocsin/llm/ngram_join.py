"""Jaccard self-join on word shingles by a size-aware heavy-light method.

Sets are ordered by one global order: shingles known to be unique, then others,
then frequent ones, by hash within each. Two sets with Jaccard t or more overlap in
at least ``need = ceil(t n)`` shingles, so that they share one of the first
``n - need + 1`` shingles of both, and k of the first ``n - need + k``.

- **Light** sets enumerate all 2-subsets of their prefix; two light sets meet in an
  equal subset, whose lists are far shorter than those of single shingles.
- **Heavy** sets scan inverted lists: their prefix shingles are posted one by one, and
  those of light sets whose size lets them link with a heavy one.
- The boundary is the size at which a set's subsets cost more rows than its postings
  and the list entries these meet, by the mean list length measured in the corpus.

Shingles that no other set has are known from a filter (see ``repeated``): a set with
more than ``n - need`` of them links with nothing and posts nothing, and two sets whose
other shingles are too few are no candidates. Equal sets are
one class, found by the set's hash, and lists of equal members are one list. A list
isn't expanded into pairs: in each round every set is compared with at most two
others of its lists, the first in an order over all sets, so that a group meets around
the same few. One order prefers sets with few shingles of their own, as the text that all
copies were made from has, the other is at random. Links are folded into components, and
only lists of several components go on. When that no longer helps, the pairs of different components that are left are
compared, so no link that joins components is lost. There a sketch of the parities of
their hashes gives a lower bound on their difference, which rules out most pairs that
don't link, inside the join.

A posting tells how many of its set's shared shingles come before it in the order. Where
a list is the first that two sets have in common, none of those is in both, which bounds
their overlap; most of the later lists two near copies share are passed over by it.

Shingles and sets are told apart by 64-bit hashes.

Defined results: null and empty texts have empty sets and link with nothing; a text of
fewer words than a shingle is one shingle; equal sets always link; rows without an id
take part, and a component's id is the smallest id in it, null if none has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import ID, KEYS, MARK, NO_ID, ROW, WordHashes, keyed, map_arrow, mixed, rolling, slices, stored, text_bytes, with_keys
from tocsin.llm.components import components
from tocsin.llm.repeated import buckets_for, repeated

#: A shingle of so many sets comes last in the order; one task tells of so many at most.
FREQUENT, COPIES = 12, 4
#: Entries of a list that a posting meets, at most, in the cost of a size.
LIST = 4
ROUNDS = 10
#: Rounds go on while they leave less than this share of the pairs.
GAIN = 0.8
#: Bits of the parity sketch that bounds how much two sets differ.
BITS = 2048


def shingle_sets(batch: pa.RecordBatch, width: int, cache: WordHashes) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    out = []
    for text in batch.column(2).to_pylist():
        words = cache.of(text.lower().split())
        if len(words) >= width:
            out.append(np.unique(rolling(words, width)))
        elif len(words):
            out.append(mixed(rolling(words, len(words)) + np.uint64(len(words))))
        else:
            out.append(words)
    return out


def boundary(mean_list: float, threshold: float, most: int = 400) -> int:
    """The largest set size at which subsets cost no more than postings and their scan."""
    light = 0
    for n in range(1, most):
        prefix = n - ceil(threshold * n) + 1
        if prefix * (prefix + 1) / 2 <= prefix * (1 + mean_list):
            light = n
    return light


def _keys(prefix1: np.ndarray, prefix2: np.ndarray, n: int, light: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """List keys, and how many shingles of the prefix two sets can't share if they meet there first."""
    keys, before = ([prefix1], [np.arange(len(prefix1))]) if n > threshold * light else ([], [])
    if n <= light:
        a, b = np.triu_indices(len(prefix2), 1)
        keys.append(mixed(prefix2[a] * np.uint64(0x9E3779B97F4A7C15) + prefix2[b]))
        before.append(b - 1)
    return np.concatenate(keys), np.concatenate(before)


def _parities(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def described(docs: DataFrame, width: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """Row keys, size and hash of each set and how many of its shingles others may have
    (``rest``); its list keys, what comes ``before`` each, and these shingles if it may link."""
    rows = keyed(docs, id_col, text_col)

    def every(batch: pa.RecordBatch, cache: WordHashes = WordHashes()) -> np.ndarray:
        sets = shingle_sets(batch, width, cache)
        return np.concatenate(sets) if sets else np.empty(0, np.uint64)

    shingles = text_bytes(docs, text_col) / 6
    twice, often, met = repeated(rows, every, buckets_for(shingles), FREQUENT, COPIES, 64 << 20)
    light = boundary(min(met, LIST), threshold)
    shared = docs.sparkSession.sparkContext.broadcast((twice, often))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, often = shared.value
        cache = WordHashes()
        for batch in (part for whole in batches for part in slices(whole)):
            sets = shingle_sets(batch, width, cache)
            h = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            kind = np.ones(len(h), np.int8)
            kind[~twice.holds(h)] = 0
            look = np.nonzero(kind)[0]
            kind[look[often.holds(h[look])]] = 2
            sizes, rests, sigs, keys, before, kept, odd, at = [], [], [], [], [], [], [], 0
            for s in sets:
                n, own = len(s), kind[at : at + len(s)]
                at += n
                sizes.append(n)
                sigs.append(_signed(xxhash.xxh3_64_intdigest(s.tobytes())))
                slack, lone = n - ceil(threshold * n), int((own == 0).sum())
                rests.append(n - lone)
                if not n or lone >= slack + (1 if n > light else 2):
                    keys.append(None)
                    before.append(None)
                    kept.append(None)
                    odd.append(None)
                    continue
                order = s[np.argsort(own, kind="stable")]
                found, ahead = _keys(order[lone : slack + 1], order[lone : slack + 2], n, light, threshold)
                keys.append(found.view(np.int64) if len(found) else None)
                before.append(ahead.astype(np.int32) if len(found) else None)
                kept.append(s[own > 0].tobytes() if len(found) else None)
                odd.append(_parities(s) if len(found) else None)
            arrays = [
                pa.array(sizes, pa.int64()),
                pa.array(rests, pa.int64()),
                pa.array(sigs, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(before, pa.list_(pa.int32())),
                pa.array(kept, pa.binary()),
                pa.array(odd, pa.list_(pa.int64())),
            ]
            names = [ID, MARK, "n", "rest", "sig", "keys", "before", "shared", "odd"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)

    return map_arrow(rows, make, f"{ID} long, {MARK} int, n long, rest long, sig long, keys array<long>, before array<int>, shared binary, odd array<long>")


def _near(threshold: float, odd: list[Column], other_odd: list[Column], n: Column, other_n: Column) -> Column:
    """Whether the sketches leave room for a link."""
    per = round(100 * threshold)
    apart = reduce(add, (F.bit_count(x.bitwiseXOR(y)) for x, y in zip(odd, other_odd, strict=True)))
    # 100 * same >= per * union, and same = (na + nb - difference) / 2
    return (100 + per) * (n + other_n - apart) >= 2 * per * (n + other_n)


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the threshold."""
    per = round(100 * threshold)
    whole = sets.select("sig", "n", "shared")
    both = pairs.join(whole.toDF("b", "nb", "setb"), "b").join(whole.toDF("a", "na", "seta"), "a")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for _, _, na, nb, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(x, y)
                same = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * same >= per * (na + nb - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(both.select("a", "b", "na", "nb", "seta", "setb"), make, "a long, b long")


def _fits(threshold: float, n: Column, rest: Column, other_n: Column, other_rest: Column) -> Column:
    """Whether two sets of these sizes can overlap enough if their first common list is this
    one: no more than either's ``rest`` from there on is shared."""
    per = round(100 * threshold)
    return (100 + per) * F.least(rest, other_rest) >= per * (n + other_n)


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``sig, group`` after joining the groups that links connect."""
    of = classes.select("sig", "group")
    edges = (
        links.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b")).filter("a != b")
    )
    edges = stored(edges.distinct(), "edges")
    if edges.isEmpty():
        return classes
    joined = of.join(components(edges).toDF("group", "label"), "group", "left")
    return stored(joined.select("sig", F.coalesce("label", "group").alias("group")), "groups")


def _open(lists: DataFrame, classes: DataFrame) -> tuple[DataFrame, float]:
    """The lists that hold more than one group, written, and the pairs across groups in them."""
    tagged = stored(lists.join(classes, "sig").select("key", "sig", "n", "rest", "before", "group"), "tagged")
    several = tagged.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo != hi").select("key")
    left = stored(tagged.join(several, "key"), "open")
    sizes = left.groupBy("key", "group").agg(F.count("*").alias("m")).groupBy("key")
    sizes = sizes.agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("within"))
    return left, float(sizes.agg(F.sum((F.col("m") * F.col("m") - F.col("within")) / 2)).first()[0] or 0)


def _folded(posted: DataFrame) -> DataFrame:
    """The lists of two or more sets; of those with equal members the one that is first in the
    order. It is so for each member, so that no pair's first common list is put off."""
    members = [F.bit_xor(F.xxhash64("sig", F.lit(k))).alias(f"x{k}") for k in range(2)]
    known = posted.groupBy("key").agg(F.count("*").alias("m"), F.sum("before").alias("o"), *members).filter("m > 1")
    return posted.join(known.groupBy("m", "x0", "x1").agg(F.min(F.struct("o", "key")).alias("first")).select("first.key"), "key")


def _met(lists: DataFrame, threshold: float, turn: int) -> DataFrame:
    """Pairs ``a, b`` of each set with the first of another group, in two orders over
    all sets, among the firsts of its lists."""
    own, after = F.floor(F.log2(F.col("n") - F.col("rest") + 1)).cast("int"), F.col("rest") - F.col("before")
    ranks = [own, F.lit(0)]
    orders = [F.struct(rank.alias("own"), F.xxhash64("sig", F.lit(turn * len(ranks) + i)).alias("h")).alias("o") for i, rank in enumerate(ranks)]
    firsts = [F.min(F.struct(o, "sig", "n", after.alias("after"), "group")).alias(f"h{i}") for i, o in enumerate(orders)]
    joined = lists.join(lists.groupBy("key").agg(*firsts), "key")
    chosen = []
    for i in range(len(orders)):
        hub = [F.col(f"h{i}.{c}") for c in ("o", "sig", "n", "after", "group")]
        fits = (hub[4] != F.col("group")) & _fits(threshold, F.col("n"), after, hub[2], hub[3])
        chosen.append(F.min(F.when(fits, F.struct(hub[0].alias("o"), hub[1].alias("t")))).alias(f"c{i}"))
    met = joined.groupBy("sig").agg(*chosen)
    met = met.select("sig", F.explode(F.array_compact(F.array(*[F.col(f"c{i}.t") for i in range(len(orders))]))).alias("t"))
    return met.select(F.greatest("sig", "t").alias("a"), F.least("sig", "t").alias("b")).distinct()


def _left(lists: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """All pairs of different groups in the lists whose sizes and sketches leave room for a
    link; a pair may come once for each list."""
    words = [f"o{k}" for k in range(BITS // 64)]
    sketch = sets.select("sig", *[F.coalesce(F.get("odd", F.lit(k)), F.lit(0)).alias(w) for k, w in enumerate(words)])
    one = lists.join(sketch, "sig").select("key", F.col("sig").alias("s"), F.col("n").alias("sn"), (F.col("rest") - F.col("before")).alias("sr"), F.col("group").alias("sg"), *words)
    others = [f"t{k}" for k in range(BITS // 64)]
    other = one.toDF("key", "t", "tn", "tr", "tg", *others)
    room = _fits(threshold, *[F.col(c) for c in ("sn", "sr", "tn", "tr")]) & _near(threshold, [F.col(c) for c in words], [F.col(c) for c in others], F.col("sn"), F.col("tn"))
    met = one.join(other, "key").filter((F.col("s") < F.col("t")) & (F.col("sg") != F.col("tg")) & room)
    return met.select(F.col("t").alias("a"), F.col("s").alias("b"))


def _grouped(sets: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """``sig, group``: components of the classes that occur in lists of two or more."""
    classes = stored(lists.groupBy("sig").agg(F.col("sig").alias("group")), "groups")
    before = float("inf")
    for turn in range(ROUNDS + 1):
        lists, left = _open(lists.select("key", "sig", "n", "rest", "before"), classes)
        if not left:
            break
        last = turn == ROUNDS or left > GAIN * before
        before = left
        pairs = _left(lists, sets, threshold).distinct() if last else _met(lists, threshold, turn)
        classes = _merged(classes, stored(_linked(pairs, sets, threshold), "linked"))
        if last:
            break
    return classes


def link_groups(
    docs: DataFrame, width: int = 5, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Row keys, set size ``n``, ``group`` and ``component_id`` of every row.

    Rows are of one group if links join them; the group of an empty set is null.
    """
    rows = stored(described(docs, width, threshold, id_col, text_col), "shingles")
    sets = rows.filter(F.col("keys").isNotNull()).groupBy("sig").agg(F.first("n").cast("int").alias("n"), F.first("rest").cast("int").alias("rest"), F.first("keys").alias("keys"), F.first("before").alias("before"), F.first("shared").alias("shared"), F.first("odd").alias("odd"))
    sets = stored(sets, "sets")
    each = F.arrays_zip("keys", "before")
    posted = sets.select(F.explode(each).alias("p"), "sig", "n", "rest").select("p.keys", "sig", "n", "rest", "p.before").toDF("key", "sig", "n", "rest", "before").distinct()
    groups = _grouped(sets.select("sig", "n", "shared", "odd"), stored(_folded(posted), "lists"), threshold)
    own = F.when(F.col(ID) != NO_ID, F.col(ID))
    classes = rows.filter("n > 0").groupBy("sig").agg(F.min(own).alias("least"))
    classes = classes.join(groups, "sig", "left").select("sig", "least", F.coalesce("group", "sig").alias("group"))
    least = classes.groupBy("group").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "group").select("sig", "group", "component_id")
    return rows.select(*KEYS, "n", "sig").join(named, "sig", "left").select(
        *KEYS, "n", F.when(F.col("n") > 0, F.col("group")).alias("group"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(own).alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, the one with the smallest id, with its columns as they are.

    A row without an id stays only if no row of its group has one. Of rows equal in id
    and text one stays. Rows with an empty set are in no group and all stay.
    """
    found = stored(link_groups(docs, width, threshold, id_col, text_col), "components")
    first = F.min(F.struct((F.col(ID) == NO_ID).alias("o"), F.col(ID).alias("i"), F.col(MARK).alias("m")))
    stay = found.filter("group IS NOT NULL").groupBy("group").agg(first.alias("s")).select(F.col("s.i").alias(ID), F.col("s.m").alias(MARK))
    rows = with_keys(docs, id_col, text_col)
    empty = found.filter("group IS NULL").select(*KEYS).distinct()
    kept = rows.join(stay, KEYS).dropDuplicates(KEYS)
    return kept.unionByName(rows.join(empty, KEYS, "left_semi")).select(f"{ROW}.*")
