"""Retention by how much of a document is content, line by line.

A linear-chain conditional random field marks every line as content or boilerplate:
each line's features speak for a mark, and marks of neighbouring lines for each other.
Viterbi decoding finds the best marks of a document together; a document is kept if
its content lines hold at least ``share`` of its words.

The field is trained with numpy by stochastic gradient ascent on the likelihood of the
marks, by forward-backward sums, on about ``per_class`` documents of each quality label,
chosen by a hash of the id: lines of good documents are taken for content, those of
bad ones for boilerplate. Without labels of both kinds fixed weights are used, by
which symbols, capitals, repetition and lists speak for boilerplate.

Some counts of plain rules come along; a document that fails these is never kept.

Defined results: a null or empty text has no words and fails; lines without a word are
not marked; rows that repeat are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import ID, MARK, TEXT, WordHashes, keyed, map_arrow, rolling, slices

#: Fixed by the contract.
SYMBOLS = b"#*$%&|<>"
CONTENT, BOILERPLATE = 0, 1
NAMES = [
    "always", "up to 2 words", "up to 7 words", "no sentence end", "symbols over 1 in 50", "symbols over 1 in 8",
    "capitals over 1 in 3", "digits over 1 in 5", "bars", "words repeat", "neighbours equal", "seen above", "notice",
]
NOTICE = {b"license", b"licensed", b"copyright", b"cookie", b"cookies", b"rights", b"subscribe"}
#: Used without labels: how much each feature speaks for boilerplate.
PLAIN = np.array([-1.5, 0.5, 0.2, 0.3, 2.0, 2.0, 2.5, 1.0, 2.0, 2.5, 3.0, 1.5, 1.0])


def features(line: bytes, words: list[bytes], above: set[bytes]) -> list[int]:
    """The features that hold for a line with words."""
    n, size = len(words), sum(map(len, words))
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    upper = len(line) - len(line.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(line) - len(line.translate(None, b"0123456789"))
    pairs = sum(map(bytes.__eq__, words, words[1:]))
    tests = (
        True, n <= 2, n <= 7, words[-1][-1:] not in b".!?:;\"'", symbols * 50 > size, symbols * 8 > size, upper * 3 > size,
        digits * 5 > size, line.count(b"|") >= 2, len(set(words)) * 2 < n, pairs * 4 > n, line in above,
        not NOTICE.isdisjoint(w.strip(b".,:;").lower() for w in words) if n < 40 else False,
    )
    return [i for i, held in enumerate(tests) if held]


def described(text: bytes) -> tuple[list[list[int]], list[int], int]:
    """Features and words of each line that has words, and how many repeat an earlier line."""
    above: set[bytes] = set()
    found, sizes, repeats = [], [], 0
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            found.append(features(line, words, above))
            sizes.append(len(words))
            repeats += line in above
            above.add(line)
    return found, sizes, repeats


class Field:
    """Weights of the chain: by feature for boilerplate, and of each step between marks."""

    def __init__(self, weight: np.ndarray | None = None, step: np.ndarray | None = None):
        self.weight = PLAIN.copy() if weight is None else weight
        self.step = np.array([[0.5, -0.5], [-0.5, 0.5]]) if step is None else step

    def scores(self, lines: list[list[int]]) -> list[float]:
        weight = self.weight.tolist()
        return [sum(weight[f] for f in line) for line in lines]

    def decode(self, lines: list[list[int]]) -> list[int]:
        """Viterbi: the best marks of all lines together; content wins ties."""
        (cc, cb), (bc, bb) = self.step.tolist()
        c = b = 0.0
        back: list[tuple[int, int]] = []
        for i, s in enumerate(self.scores(lines)):
            if i:
                to_c, to_b = (c + cc >= b + bc), (c + cb >= b + bb)
                back.append((CONTENT if to_c else BOILERPLATE, CONTENT if to_b else BOILERPLATE))
                c, b = (c + cc if to_c else b + bc), (c + cb if to_b else b + bb) + s
            else:
                b = s
        marks = [CONTENT if c >= b else BOILERPLATE] if lines else []
        for pair in reversed(back):
            marks.append(pair[marks[-1]])
        return marks[::-1]

    def learn(self, lines: list[list[int]], mark: int, rate: float) -> None:
        """One step up the likelihood of all lines having this mark."""
        s = np.array(self.scores(lines))
        n = len(s)
        node = np.stack([np.zeros(n), s], axis=1)
        ahead, behind = node.copy(), np.zeros((n, 2))
        for i in range(1, n):
            ahead[i] += np.logaddexp(ahead[i - 1, 0] + self.step[0], ahead[i - 1, 1] + self.step[1])
        for i in range(n - 2, -1, -1):
            after = node[i + 1] + behind[i + 1]
            behind[i] = np.logaddexp(self.step[:, 0] + after[0], self.step[:, 1] + after[1])
        total = np.logaddexp(*ahead[-1])
        boiler = np.exp(ahead[:, 1] + behind[:, 1] - total)
        for line, p in zip(lines, boiler, strict=True):
            self.weight[line] += rate / n * ((mark == BOILERPLATE) - p)
        if n > 1:
            pair = np.exp(ahead[:-1, :, None] + self.step + (node + behind)[1:, None, :] - total).sum(axis=0)
            want = np.zeros((2, 2))
            want[mark, mark] = n - 1
            self.step += rate / n * (want - pair)


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = 600, epochs: int = 4, rate: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Field:
    """A field from all lines of the labelled documents chosen, about ``per_class`` of each label."""
    marked = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).cast("long").alias(ID)).agg(F.max(label_col).cast("int").alias("label"))
    counts = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    if set(counts) != {0, 1}:
        return Field()
    share = F.when(F.col("label") == 1, per_class / counts[1]).otherwise(per_class / counts[0])
    chosen = marked.filter(F.pmod(F.xxhash64(ID, F.lit(7)), F.lit(1 << 24)) < share * (1 << 24))
    # At most about 2 * per_class ids, so the broadcast is bounded by the parameter.
    rows = keyed(docs, id_col, text_col).join(F.broadcast(chosen), ID)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [described(t)[0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.list_(pa.list_(pa.int32())))], ["label", "lines"])

    found = map_arrow(rows.select("label", TEXT), make, "label int, lines array<array<int>>").collect()
    examples = sorted((r.label, r.lines) for r in found if r.lines)
    field, r = Field(np.zeros(len(NAMES)), np.zeros((2, 2))), np.random.default_rng(1)
    for epoch in range(epochs):
        for i in r.permutation(len(examples)):
            label, lines = examples[i]
            field.learn(lines, CONTENT if label == 1 else BOILERPLATE, rate / (1 + epoch))
    return field


def repeated_words(words: list[bytes], cache: WordHashes, width: int = 3) -> int:
    """Words in runs of ``width`` words that the text has at least twice."""
    runs = rolling(cache.of(words), width)
    if len(runs) < 2:
        return 0
    _, at, times = np.unique(runs, return_inverse=True, return_counts=True)
    again = np.nonzero(times[at] > 1)[0]
    step = np.zeros(len(words) + 1, np.int64)
    step[again] += 1
    np.subtract.at(step, again + width, 1)
    return int((np.cumsum(step)[:-1] > 0).sum())


def judge(docs: DataFrame, field: Field, share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row keys, the counts of the rules, ``content`` (share of words in content lines),
    the marks of the lines with words, and ``kept``, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((field.weight, field.step))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = Field(*shared.value), WordHashes()
        for batch in (part for whole in batches for part in slices(whole)):
            rows, contents, marks = [], [], []
            for text in batch.column(2).to_pylist():
                words = text.split()
                lines, sizes, repeats = described(text)
                marks.append(own.decode(lines))
                symbols = len(text) - len(text.translate(None, SYMBOLS))
                rows.append((len(words), len(b"".join(words).decode("utf-8", "replace")), symbols, repeats, repeated_words(words, cache)))
                good = sum(n for n, m in zip(sizes, marks[-1], strict=True) if m == CONTENT)
                contents.append(good / len(words) if words else 0.0)
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
            more = [pa.array(contents, pa.float64()), pa.array(marks, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, *more], [ID, MARK, *names, "content", "marks"])

    schema = f"{ID} long, {MARK} int, " + ", ".join(f"{n} long" for n in names) + ", content double, marks array<int>"
    out = map_arrow(keyed(docs, id_col, text_col), make, schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("content") >= share))
