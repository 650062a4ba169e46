"""Quality classes from supervised subword embeddings.

Every word has a hashed vector of its own, and one for each run of three letters in
it, ends marked; a word that repeats the one before it also has the vector of
repetition. A document is the mean of all these vectors, and a softmax layer gives
its class. Vectors and layer are trained together with numpy by stochastic gradient
descent, one document at a time, at a rate that falls to zero.

The model is fitted on about ``per_class`` documents of each class, chosen by a hash of
the id; every document's whole text is scored. As the layer is linear, a word's share
of the score is one number, kept per word.

Defined results: null and empty texts are the zero vector; of labels that repeat the
highest counts; if one class has no example the score is that of the other for all;
without labels it is 1 for all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import ID, MARK, TEXT, keyed, map_arrow, slices

BUCKETS, SIZE, GRAM = 1 << 17, 8, 3
AGAIN = b"\x00again"


def features(word: bytes) -> list[int]:
    """Vectors of a word: its own and those of its letter runs."""
    if word == AGAIN:
        parts = [word]
    else:
        shown = "<" + word.decode("utf-8", "replace") + ">"
        parts = [word] + ["#".encode() + shown[i : i + GRAM].encode() for i in range(len(shown) - GRAM + 1)]
    return [xxhash.xxh3_64_intdigest(p) % BUCKETS for p in parts]


def tokens(text: bytes) -> Iterator[bytes]:
    """Words, and a mark after each that repeats the one before."""
    before = None
    for word in text.split():
        yield word
        if word == before:
            yield AGAIN
        before = word


class Parts(dict):
    def __missing__(self, word: bytes) -> list[int]:
        value = self[word] = features(word)
        return value


class Shares(dict):
    """The sum of a word's numbers and how many there are, kept until there are too many."""

    def __init__(self, share: np.ndarray, limit: int = 300_000):
        super().__init__()
        self.share, self.limit = share, limit

    def __missing__(self, word: bytes) -> tuple[float, int]:
        if len(self) >= self.limit:
            self.clear()
        at = features(word)
        value = self[word] = (float(self.share[at].sum()), len(at))
        return value


def _bags(rows: DataFrame) -> DataFrame:
    """``label`` and each chosen document's vectors with their weights in the mean."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 0)):
            cache = Parts()
            ats, weights = [], []
            for text in batch.column(0).to_pylist():
                count: Counter[int] = Counter()
                for word, n in Counter(tokens(text)).items():
                    for at in cache[word]:
                        count[at] += n
                ats.append(np.fromiter(count.keys(), np.int32, len(count)).tobytes())
                weights.append((np.fromiter(count.values(), np.float32, len(count)) / max(1, sum(count.values()))).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(ats, pa.binary()), pa.array(weights, pa.binary())], ["label", "at", "weight"])

    return map_arrow(rows.select(TEXT, "label"), make, "label int, at binary, weight binary")


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 12, rate: float = 2.0, seed: int = 1) -> tuple[np.ndarray, float]:
    """Each vector's share in the log odds of class 1, and the log odds of no vector."""
    r = np.random.default_rng(seed)
    vectors = r.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    layer, bias = np.zeros((2, SIZE)), np.zeros(2)
    steps = epochs * len(bags)
    for step in range(steps):
        if step % len(bags) == 0:
            order = r.permutation(len(bags))
        label, at, weight = bags[order[step % len(bags)]]
        now = rate * (1 - step / steps)
        own = vectors[at]
        mean = weight @ own
        z = layer @ mean + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        back = p @ layer
        layer -= now * np.outer(p, mean)
        bias -= 0.1 * now * p
        vectors[at] = own - now * np.outer(weight, back).astype(np.float32)
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 2500,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> tuple[np.ndarray, float]:
    """A model from the labelled rows for which ``learn`` (over the id column) holds."""
    marked = labels.filter(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).cast("long").alias(ID)).agg(F.max(label_col).cast("int").alias("label"))
    counts = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    if set(counts) != {0, 1}:
        return np.zeros(BUCKETS), float("-inf") if 0 in counts else float("inf")
    share = F.when(F.col("label") == 1, per_class / counts[1]).otherwise(per_class / counts[0])
    chosen = marked.filter(F.pmod(F.xxhash64(ID, F.lit(6)), F.lit(1 << 24)) < share * (1 << 24))
    # At most about 2 * per_class ids, so the broadcast is bounded by the parameter.
    rows = keyed(docs, id_col, text_col).join(F.broadcast(chosen), ID)
    bags = [(r.label, np.frombuffer(r.at, np.int32), np.frombuffer(r.weight, np.float32)) for r in _bags(rows).collect()]
    bags.sort(key=lambda b: (b[0], len(b[1]), b[1].tobytes()))
    shares, bias = fit(bags) if bags else (np.zeros(BUCKETS), 0.0)
    # Classes were drawn alike; their own shares go back into the bias.
    drawn = [min(per_class, counts[c]) for c in (0, 1)]
    return shares, bias + float(np.log(counts[1] / counts[0]) - np.log(drawn[1] / drawn[0]))


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row keys and ``score``, the probability of class 1, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, bias = shared.value
        cache = Shares(share)
        for batch in (part for whole in batches for part in slices(whole)):
            z = []
            for text in batch.column(2).to_pylist():
                total = n = 0
                for word, times in Counter(tokens(text)).items():
                    value, parts = cache[word]
                    total += value * times
                    n += parts * times
                z.append(total / max(1, n) + bias)
            p = 1 / (1 + np.exp(-np.clip(np.array(z), -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p)], [ID, MARK, "score"])

    return map_arrow(keyed(docs, id_col, text_col), make, f"{ID} long, {MARK} int, score double")
