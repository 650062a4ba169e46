"""Removal of word runs that occurred earlier in the corpus.

Every window of ``width`` words has a Rabin-Karp hash. Windows of one hash meet in
one bucket, where all but the earliest (by id, then by place) are told to go;
overlapping windows of a document then merge into maximal intervals. Most windows
never leave their task: a window that holds a shorter run found nowhere else (see
``repeated``) is unique. Of equal windows in one task only the earliest is compared
with others, so a window that half of all documents hold costs one entry per task; its
later copies are known to go and are sent to their documents' buckets, not to the
window's. Answers are packed by document bucket, and a document gets one row of them.

Equality is that of 64-bit hashes. Windows are judged on the input alone.

Defined results: a null or empty text has no words; rows with a repeated id and
another text are documents of their own, in the order of a hash of their text; rows
equal in id and text are one document and all get its result; a text shorter than
the window keeps everything; a row whose id is null comes before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import ID, KEYS, MARK, TEXT, WordHashes, keyed, map_arrow, mixed, rolling, slices, text_bytes
from tocsin.llm.repeated import Filter, bucket_of, buckets_for, repeated

GRAM, RATE = 8, 4
#: Windows held in a task and counted in a bucket, and words in a bucket of documents.
HELD, EACH, WORDS = 500_000, 500_000, 2_000_000
PACKED = ["ids", "marks", "counts", "starts"]
#: ``bucket`` is that of the window's hash; or, from -1 downwards, that of the document.
SENT = "bucket int, hashes binary, ids binary, marks binary, counts binary, starts binary"
TOLD = "part int, ids binary, marks binary, counts binary, starts binary"


def _words(texts: list[bytes], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one behind the other, and the words of each."""
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    return cache.of([w for words in split for w in words]), sizes


def _inside(sizes: np.ndarray, width: int) -> np.ndarray:
    """Places where a run of ``width`` words ends in the document it starts in."""
    total = int(sizes.sum())
    ends = np.repeat(np.cumsum(sizes), sizes)
    return (np.arange(total) + width <= ends)[: max(0, total - width + 1)]


def _sampled(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint64(40) & np.uint64(RATE - 1) == 0


def _planes(x: np.ndarray) -> bytes:
    """Small numbers byte by byte: first all low bytes, then all next ones."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _part(ids: np.ndarray, marks: np.ndarray, parts: int) -> np.ndarray:
    """The bucket of a document."""
    return bucket_of(mixed(ids.view(np.uint64) ^ marks.astype(np.uint64) << np.uint64(32)), parts).astype(np.int64)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.nonzero(new)[0]


def _pack(ids: np.ndarray, marks: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """Places, documents one behind the other, as one row of ``PACKED``."""
    heads = _runs(ids, marks)
    values = [ids[heads].tobytes(), marks[heads].astype("<i4").tobytes(), np.diff(np.append(heads, len(ids))).astype("<u4").tobytes(), _planes(starts)]
    return [pa.array([v], pa.binary()) for v in values]


def _unpack(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, marks and starts of all rows."""
    ids, marks, starts = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.uint32)]
    for row in rows:
        counts = np.frombuffer(row["counts"], "<u4")
        ids.append(np.repeat(np.frombuffer(row["ids"], np.int64), counts))
        marks.append(np.repeat(np.frombuffer(row["marks"], "<i4"), counts))
        starts.append(_unplaned(row["starts"]))
    return np.concatenate(ids), np.concatenate(marks), np.concatenate(starts)


class _Chunk:
    """Documents of one task, held until their windows are sent."""

    def __init__(self, width: int, gram: int, buckets: int, parts: int, shared: Filter):
        self.width, self.gram, self.buckets, self.of_parts, self.shared = width, gram, buckets, parts, shared
        self.cache = WordHashes()
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, batch: pa.RecordBatch) -> None:
        """Keep the hash and the place of each window that may occur elsewhere."""
        ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        words, sizes = _words(batch.column(2).to_pylist(), self.cache)
        if len(words) < self.width:
            return
        grams = rolling(words, self.gram)
        lone = _sampled(grams)
        lone[lone] = ~self.shared.holds(grams[lone])
        before = np.concatenate([[0], np.cumsum(lone)])
        inner = self.width - self.gram + 1
        at = np.nonzero(_inside(sizes, self.width) & (before[inner:] == before[:-inner]))[0]
        doc = np.repeat(np.arange(len(sizes)), sizes)[at]
        starts = at - (np.cumsum(sizes) - sizes)[doc]
        self.parts.append((rolling(words, self.width)[at], ids[doc], marks[doc], starts))
        self.n += len(at)

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        h, ids, marks, starts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((starts, marks, ids))
        h, ids, marks, starts = h[order], ids[order], marks[order], starts[order]
        first = np.zeros(len(h), bool)
        first[np.unique(h, return_index=True)[1]] = True
        # A later copy in this task goes whatever the others hold. A repeated row isn't later.
        same = np.zeros(len(h), bool)
        same[1:] = (ids[1:] == ids[:-1]) & (marks[1:] == marks[:-1]) & (starts[1:] == starts[:-1])
        buckets = (bucket_of(h, self.buckets).astype(np.int64), -1 - _part(ids, marks, self.of_parts))
        for known, chosen in ((False, first), (True, ~first & ~same)):
            at = np.nonzero(chosen)[0]
            if not len(at):
                continue
            bucket = buckets[known]
            at = at[np.argsort(bucket[at], kind="stable")]
            for group in np.split(at, _runs(bucket[at])[1:]):
                head = [pa.array([bucket[group[0]]], pa.int32()), pa.array([None if known else h[group].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([*head, *_pack(ids[group], marks[group], starts[group])], ["bucket", "hashes", *PACKED])
        self.clear()


def _later(table: pa.Table, parts: int) -> pa.Table:
    """Of the windows of a bucket, all that occur earlier elsewhere, packed by document
    bucket. What is sent to a document bucket is known to go."""
    rows = table.to_pylist()
    i, m, s = _unpack(rows)
    if rows[0]["bucket"] < 0:
        at = np.arange(len(i))
    else:
        h = np.concatenate([np.frombuffer(row["hashes"], np.uint64) for row in rows])
        order = np.argsort(h, kind="stable")
        sorted_h = h[order]
        twin = np.zeros(len(h), bool)
        twin[1:] = sorted_h[1:] == sorted_h[:-1]
        twin[:-1] |= twin[1:]
        order = order[twin]
        order = order[np.lexsort((s[order], m[order], i[order], h[order]))]
        at = order
        if len(order):
            head = np.append(True, h[order][1:] != h[order][:-1])
            lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
            equal = (i[order] == i[lead]) & (m[order] == m[lead]) & (s[order] == s[lead])
            at = order[~equal]
    del rows
    part = _part(i[at], m[at], parts)
    order = np.lexsort((s[at], m[at], i[at], part))
    at, part = at[order], part[order]
    groups = np.split(at, _runs(part)[1:]) if len(at) else []
    packed = [_pack(i[g], m[g], s[g]) for g in groups]
    columns = [pa.chunked_array([p[k] for p in packed], pa.binary()) for k in range(len(PACKED))]
    heads = pa.array([int(p) for p in part[_runs(part)]] if len(at) else [], pa.int32())
    return pa.table([heads, *columns], ["part", *PACKED])


def _gathered(table: pa.Table) -> pa.Table:
    """All answers for the documents of a bucket, a row each."""
    i, m, s = _unpack(table.to_pylist())
    order = np.lexsort((s, m, i))
    i, m, s = i[order], m[order], s[order]
    heads = _runs(i, m)
    starts = [g.astype("<u4").tobytes() for g in np.split(s, heads[1:])]
    return pa.table({ID: pa.array(i[heads], pa.int64()), MARK: pa.array(m[heads], pa.int32()), "starts": pa.array(starts, pa.binary())})


def _covered(n: int, width: int, starts: bytes | None) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    if starts:
        at = np.unique(np.frombuffer(starts, "<u4")).astype(np.int64)
        step[at] += 1
        np.subtract.at(step, at + width, 1)
    return np.cumsum(step)[:n] > 0


def remove_repeats(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row keys, ``n_words``, ``n_removed``, the removed ``spans`` (first word, number
    of words) and the ``kept`` words joined by a space, for every row."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    words = text_bytes(docs, text_col) / 6
    gram = min(GRAM, width)

    def grams(batch: pa.RecordBatch, cache: WordHashes = WordHashes()) -> np.ndarray:
        hashed, sizes = _words(batch.column(2).to_pylist(), cache)
        found = rolling(hashed, gram)
        return found[_inside(sizes, gram) & _sampled(found)] if len(found) else found

    shared = spark.sparkContext.broadcast(repeated(rows, grams, buckets_for(words / RATE), 1 << 30)[0])
    buckets, parts = buckets_for(words / RATE, EACH), buckets_for(words, WORDS)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(width, gram, buckets, parts, shared.value)
        for batch in batches:
            for part in slices(batch):
                chunk.add(part)
                if chunk.n >= HELD:
                    yield from chunk.send()
        yield from chunk.send()

    later = map_arrow(rows, windows, SENT).groupBy("bucket").applyInArrow(lambda table: _later(table, parts), TOLD)
    told = later.groupBy("part").applyInArrow(_gathered, f"{ID} long, {MARK} int, starts binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (some for whole in batches for some in slices(whole)):
            total, removed, spans, kept = [], [], [], []
            for text, starts in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                own = text.split()
                gone = _covered(len(own), width, starts)
                edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                begin, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
                total.append(len(own))
                removed.append(int(gone.sum()))
                spans.append([{"start": int(b), "length": int(e - b)} for b, e in zip(begin, end, strict=True)])
                kept.append(b" ".join(own if not removed[-1] else [own[i] for i in np.nonzero(~gone)[0]]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            arrays = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *arrays], [ID, MARK, "n_words", "n_removed", "spans", "kept"]
            )

    joined = rows.join(told, KEYS, "left").select(*KEYS, TEXT, "starts")
    schema = f"{ID} long, {MARK} int, n_words long, n_removed long, spans array<struct<start: long, length: long>>, kept binary"
    return map_arrow(joined, cut, schema).withColumn("kept", F.col("kept").cast("string"))
