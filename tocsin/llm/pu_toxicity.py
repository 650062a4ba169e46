"""Toxicity by non-negative positive-unlabelled learning.

A document is the set of its words; a word's features are the word and its first
four to six letters. A linear model is trained with numpy from confirmed toxic
documents P and a sample U of all text, whose labels are never looked at. With the
class prior p of toxic text the risk is

    p E_P[l(+)] + max(0, E_U[l(-)] - p E_P[l(-)]),    l logistic.

The second part estimates the risk on clean text and cannot be negative; when a
batch drives it below zero, the step goes the other way (it would only fit noise).
Only features whose shares of P and U differ beyond chance have weights, so that long
documents gather no noise.

The model is fitted on at most about ``positives`` + ``unlabelled`` documents, chosen
by a hash of the id; every document's whole text is scored.

Defined results: null and empty texts get the score of no words; labels that repeat
count as toxic if one says so, labels that are null are none; without a confirmed
example the score is the prior 0 for all; rows without an id are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import ID, MARK, TEXT, keyed, map_arrow, slices

#: ASCII that is no letter or digit parts words.
APART = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
LENGTHS = (4, 5, 6)


def words(text: bytes) -> set[bytes]:
    return set(text.lower().translate(APART).split())


def features(word: bytes) -> list[int]:
    shown = word.decode("utf-8", "replace")
    parts = [word + b"$"] + [shown[:n].encode() for n in LENGTHS if len(shown) > n]
    return [xxhash.xxh3_64_intdigest(p) >> 1 for p in parts]


class Features(dict):
    def __missing__(self, word: bytes) -> list[int]:
        value = self[word] = features(word)
        return value


class Weights(dict):
    """The sum of a word's weights, kept until there are too many."""

    def __init__(self, weight: dict[int, float], limit: int = 400_000):
        super().__init__()
        self.weight, self.limit = weight, limit

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = sum(self.weight.get(f, 0.0) for f in features(word))
        return value


def _vectors(rows: DataFrame) -> DataFrame:
    """``positive`` and the feature hashes of each chosen document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 0)):
            cache = Features()
            found = []
            for text in batch.column(0).to_pylist():
                found.append(np.unique(np.array([f for w in words(text) for f in cache[w]], np.int64)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["positive", "features"])

    return map_arrow(rows.select(TEXT, "positive"), make, "positive boolean, features binary")


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _telling(positive: list[np.ndarray], unlabelled: list[np.ndarray], sure: float, lift: float = 2.0) -> np.ndarray:
    """Features whose shares of P and of U differ by ``sure`` standard errors or more
    and by the factor ``lift``, which longer texts alone don't reach.

    At zero weights the risk's gradient is the prior times this difference, so these
    are the features that the soft threshold would let through at first.
    """
    p, in_p = np.unique(np.concatenate(positive), return_counts=True)
    u, in_u = np.unique(np.concatenate(unlabelled), return_counts=True)
    names = np.union1d(p, u)
    share = np.zeros((2, len(names)))
    share[0, np.searchsorted(names, p)] = in_p / len(positive)
    share[1, np.searchsorted(names, u)] = in_u / len(unlabelled)
    error = np.sqrt(share[0] / len(positive) + share[1] / len(unlabelled))
    apart = share.max(axis=0) > lift * share.min(axis=0)
    return names[apart & (np.abs(share[0] - share[1]) > sure * error)]


def _descend(
    docs: list[np.ndarray], n_p: int, names: np.ndarray, prior: float, steps: int, rate: float, decay: float
) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the non-negative risk; the first ``n_p`` documents are P."""
    docs = [np.intersect1d(d, names, assume_unique=True) for d in docs]
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    col = np.searchsorted(names, np.concatenate(docs))
    n, n_u = len(docs), len(docs) - n_p
    w, b = np.zeros(len(names)), float(np.log(prior / (1 - prior)))
    mean, square = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, w[col], minlength=n) + b
        zp, zu = z[:n_p], z[n_p:]
        clean = _softplus(zu).mean() - prior * _softplus(zp).mean()
        g = np.empty(n)
        if clean >= 0:
            g[:n_p] = -prior / n_p
            g[n_p:] = _sigmoid(zu) / n_u
        else:
            g[:n_p] = prior * _sigmoid(zp) / n_p
            g[n_p:] = -_sigmoid(zu) / n_u
        grad = np.append(np.bincount(col, g[row], minlength=len(w)) + decay * w, g.sum())
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad**2 - square)
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 300, rate: float = 0.05, decay: float = 3e-5, sure: float = 4.0, weak: float = 0.15
) -> tuple[dict[int, float], float]:
    """Weights by feature and the bias.

    With few examples even what all of them share is no ``sure`` errors from chance,
    so less is asked for. Features whose weight is under ``weak`` of the largest are
    dropped and the rest is fitted anew, since a long text has many of them.
    """
    names = _telling(positive, unlabelled, min(sure, len(positive) ** 0.5 / 2))
    docs = positive + unlabelled
    for _ in range(2):
        w, _ = _descend(docs, len(positive), names, prior, steps, rate, decay)
        names = names[np.abs(w) >= weak * np.abs(w).max(initial=0)]
    w, b = _descend(docs, len(positive), names, prior, 3 * steps, rate, decay)
    return dict(zip(names.tolist(), w.tolist(), strict=True)), float(b)


def _hash_share(column: str, wanted: int, total: int) -> Column:
    """About so many of all rows, the same ones each time."""
    return F.pmod(F.xxhash64(F.col(column), F.lit(5)), F.lit(1 << 24)) < int((1 << 24) * min(1.0, wanted / max(total, 1)))


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, positives: int = 2000, unlabelled: int = 4000, prior: float | None = None,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> tuple[dict[int, float], float] | None:
    """A model from the rows for which ``learn`` (over the id column) holds."""
    marked = labels.filter(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    marked = marked.groupBy(id_col).agg((F.max(label_col) == 1).alias("toxic"))
    seen, toxic = marked.agg(F.count("*"), F.coalesce(F.sum(F.col("toxic").cast("int")), F.lit(0))).first()
    if not toxic:
        return None
    prior = prior or min(0.5, max(0.001, toxic / seen))
    chosen = marked.filter("toxic").filter(_hash_share(id_col, positives, toxic)).select(F.col(id_col).cast("long").alias(ID))
    rows = keyed(docs.filter(learn), id_col, text_col)
    # At most about `positives` ids, so the broadcast is bounded by the parameter.
    known = rows.join(F.broadcast(chosen), ID).withColumn("positive", F.lit(True))
    some = rows.filter(_hash_share(ID, unlabelled, docs.filter(learn).count())).withColumn("positive", F.lit(False))
    found = _vectors(known.unionByName(some)).collect()
    split: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for r in found:
        split[r.positive].append(np.frombuffer(r.features, np.int64))
    if not split[True] or not split[False]:
        return None
    return fit(split[True], split[False], prior)


def score(docs: DataFrame, model: tuple[dict[int, float], float] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row keys and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = shared.value or ({}, -np.inf)
        cache = Weights(weight)
        for batch in (part for whole in batches for part in slices(whole)):
            z = np.array([sum(map(cache.__getitem__, words(t))) + bias for t in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_sigmoid(z))], [ID, MARK, "score"])

    return map_arrow(keyed(docs, id_col, text_col), make, f"{ID} long, {MARK} int, score double")


def keep(docs: DataFrame, model: tuple[dict[int, float], float] | None, reject: float, text_col: str = "text") -> DataFrame:
    """The rows that score under ``reject``, with their columns as they are. Nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = shared.value or ({}, -np.inf)
        cache = Weights(weight)
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            z = np.array([sum(map(cache.__getitem__, words(t or b""))) + bias for t in texts], float)
            yield batch.filter(pa.array(_sigmoid(z) < reject))

    return docs.mapInArrow(make, docs.schema)


def fold(id_col: str, parts: int) -> Column:
    """The contract's fold of a row: crc32 of the id as text, modulo ``parts``; 0 without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts, F.lit(0))
