"""Which short runs of words occur more than once in the whole corpus.

One pass sends 32 bits of every sampled hash to the bucket that its other bits
choose; a bucket counts its hashes and answers with a Bloom filter of the repeated
ones. Buckets grow with the corpus, so 32 bits are enough at any size: a false
match makes a run look repeated, never the other way round. The filters together
never exceed ``cap_bytes``, which bounds what is gathered and broadcast; a fuller
filter lets more through and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tocsin.llm.common import slices

LOW = np.uint64(0xFFFFFFFF)
SPREAD = [np.uint64(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
FLUSH = 1_000_000


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _bits(keys: np.ndarray, size: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
    for factor in SPREAD:
        yield (((keys * factor) & LOW) * size) >> np.uint64(32)


@dataclass
class Filter:
    """Bloom filters of all buckets, one behind the other."""

    offsets: np.ndarray
    sizes: np.ndarray
    bits: np.ndarray

    def holds(self, h: np.ndarray) -> np.ndarray:
        bucket = bucket_of(h, len(self.sizes)).astype(np.int64)
        size, offset = self.sizes[bucket], self.offsets[bucket]
        found = np.ones(len(h), bool)
        for at in _bits(h & LOW, size):
            at = at + offset
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _filter(slices: dict[int, bytes], buckets: int) -> Filter:
    empty = bytes(8)
    parts = [slices.get(n) or empty for n in range(buckets)]
    sizes = np.array([8 * len(p) for p in parts], np.uint64)
    return Filter(np.cumsum(sizes, dtype=np.uint64) - sizes, sizes, np.frombuffer(b"".join(parts), np.uint8))


def _slice(keys: np.ndarray, most: int) -> bytes:
    size = 8 * min(most, max(8, -(-10 * len(keys) // 8)))
    bits = np.zeros(size, np.uint8)
    for at in _bits(keys.astype(np.uint64), np.uint64(size)):
        bits[at.astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def packed(parts: list[np.ndarray], buckets: int, most_copies: int) -> Iterator[pa.RecordBatch]:
    """Rows ``bucket, keys``: the low 32 bits of the hashes, each up to so many times."""
    h = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    values, counts = np.unique(bucket_of(h, buckets) << np.uint64(32) | (h & LOW), return_counts=True)
    values = np.repeat(values, np.minimum(counts, most_copies))
    bucket, starts = np.unique(values >> np.uint64(32), return_index=True)
    keys = [x.astype("<u4").tobytes() for x in np.split(values & LOW, starts[1:])] if len(bucket) else []
    yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(keys, pa.binary())], ["bucket", "keys"])


def repeated(
    texts: DataFrame,
    hashes: Callable[[pa.RecordBatch], np.ndarray],
    buckets: int,
    frequent: int,
    most_copies: int = 2,
    cap_bytes: int = 32 << 20,
) -> tuple[Filter, Filter, float]:
    """Filters of the hashes found at least twice and at least ``frequent`` times,
    and the mean number of copies that a repeated occurrence meets."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            for part in slices(batch):
                held.append(hashes(part))
                n += len(held[-1])
                if n >= FLUSH:
                    yield from packed(held, buckets, most_copies)
                    held, n = [], 0
        yield from packed(held, buckets, most_copies)

    most = max(8, cap_bytes // (2 * buckets))

    def count(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("keys").to_pylist()])
        values, counts = np.unique(keys, return_counts=True)
        twice, often = values[counts > 1], values[counts >= frequent]
        shared = counts[counts > 1].astype(float)
        return pa.table(
            {
                "bucket": table.column("bucket").slice(0, 1),
                "twice": pa.array([_slice(twice, most)], pa.binary()),
                "often": pa.array([_slice(often, most)], pa.binary()),
                "met": pa.array([float((shared**2).sum())]),
                "copies": pa.array([float(shared.sum())]),
            }
        )

    sent = texts.mapInArrow(send, "bucket int, keys binary")
    found = sent.groupBy("bucket").applyInArrow(count, "bucket int, twice binary, often binary, met double, copies double").collect()
    met, copies = sum(r.met for r in found), sum(r.copies for r in found)
    return (
        _filter({r.bucket: bytes(r.twice) for r in found}, buckets),
        _filter({r.bucket: bytes(r.often) for r in found}, buckets),
        met / copies if copies else 1.0,
    )


def buckets_for(n: float, each: int = 4_000_000, least: int = 24) -> int:
    return max(least, int(n // each) + 1)
