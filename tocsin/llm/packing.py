"""Packing of tokenised documents into windows whose mixture is controlled.

Documents are dealt to parts by a hash of the row, so that every part holds a share
of every source, whatever the sources' sizes. A part has a queue for each source and
fills its windows by deficit round-robin: a window grants each source its target
share of tokens on top of what it is still owed; the source owed most is served
first, up to what it is owed; what is then free goes to those owed most, who owe it
back. What a source is owed is carried from window to window, and from part to part:
after a part all its tokens are placed, so that the debts before any part follow from
sums of token counts, and parts can be packed at the same time.

Targets default to the sources' shares of all tokens. A window is full until a part's
tokens end; the rest is cut into windows of falling powers of two, which need no
padding.

Defined results: a null or empty text is the end token alone; a null source is a
source; rows that repeat are packed each; an empty table gives no piece; a target
for a source without rows grants nothing.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import ID, MARK, NO_ID, TEXT, bounded_batches, map_arrow, row_id, slices, stored, text_bytes, text_mark
from tocsin.llm.word_merges import Merges, spans

#: Bytes of text tokenised at once; the words and ids of a slice take many times that.
SLICE = 1 << 20
#: Tokens of the pieces that are handed back at a time.
BLOCK = 1 << 18
#: A source is served in a window if so many tokens, or a document's end, are granted.
LEAST = 64
#: All but ASCII signs other than the stop and the comma, and runs of these two.
SAFE = bytes(b for b in range(256) if b > 127 or chr(b).isalnum() or b in b" \t\n\x0b\x0c\r.,")
SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
SIGN = np.isin(np.arange(256), np.frombuffer(SIGNS, np.uint8))
RUNS = (b"..", b".,", b",.", b",,")
#: Characters whose lower-case form is letters alone. Any other beyond ASCII, such as a quote,
#: an emoji or a combining mark, makes one piece with the stop or comma that it touches.
LATIN = "À-ÖØ-öø-įı-ɏ"
JOINED = re.compile(rf"[.,](?:(?<=[^\x00-\x7F{LATIN}].)|(?=[^\x00-\x7F{LATIN}]))")
PIECES = f"{ID} long, {MARK} int, mix string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordTokens(dict):
    """The ids of each word as bytes of 32-bit numbers.

    The vocabulary parts text at white space first, so a text's ids are those of its
    words. Words of Latin letters, with signs behind them or not, are merged as arrays and
    not kept. All else goes through the whole tokenizer; what was met lately is kept, in
    two generations of at most ``half`` words.
    """

    held: dict[str, WordTokens] = {}

    def __init__(self, path: str, half: int = 30_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer, self.half, self.old = Tokenizer.from_file(path), half, {}
        self.merges = Merges(self.tokenizer)
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in special]

    @classmethod
    def of(cls, path: str) -> WordTokens:
        """One per Python worker, so that tasks find the words of earlier ones."""
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def __missing__(self, word: bytes) -> bytes:
        value = self.old.pop(word, None) or self._encode(word)
        if len(self) >= self.half:
            self.old.clear()
            self.old.update(self)
            self.clear()
        self[word] = value
        return value

    def _encode(self, word: bytes) -> bytes:
        shown = word.decode("utf-8", "replace")
        if shown.isalpha() and max(shown) < "ɐ" and "İ" not in shown and unicodedata.is_normalized("NFC", shown):
            # With Ⱥ or Ⱦ, whose lower case takes more bytes.
            low = np.frombuffer(shown.lower().encode(), np.uint8)
            return self.merges.of(low, np.array([0]), np.array([len(low)]))[0].astype("<u4").tobytes()
        return self._ids(self.tokenizer.encode(shown, add_special_tokens=False).ids)

    def all(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one behind the other, and the ids of each."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
        raw = words.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[: offsets[-1]] if len(words) and raw else np.zeros(0, np.uint8)
        starts, ends = offsets[:-1], offsets[1:]
        low, good = self.merges.lowered(data, ends)
        # Letters with signs behind them are two pieces, any other word is one.
        clear = np.append(-1, np.where(SIGN[data], -1, np.arange(len(data))))
        stem = np.maximum.accumulate(clear)[ends] + 1
        bad = np.append(0, np.cumsum(~good))
        ours = (stem > starts) & (bad[np.maximum(stem, starts)] == bad[starts])
        cut = ours & (stem < ends)
        pieces = 1 + cut
        own = np.cumsum(pieces) - pieces
        begin, end, plain = np.repeat(starts, pieces), np.repeat(ends, pieces), np.repeat(ours, pieces)
        tail = own[cut] + 1
        begin[tail] = end[tail - 1] = stem[cut]
        plain[tail] = False
        merged, counts = self.merges.of(low, begin[plain], (end - begin)[plain])
        held, other = memoryview(data), np.flatnonzero(~plain)
        rest = [self[bytes(held[a:b])] for a, b in zip(begin[other].tolist(), end[other].tolist(), strict=True)]
        sizes = np.empty(len(begin), np.int64)
        sizes[plain], sizes[other] = counts, np.fromiter(map(len, rest), np.int64, len(rest)) // 4
        first, flat = np.cumsum(sizes) - sizes, np.empty(sizes.sum(), np.uint32)
        flat[spans(first[plain], counts)] = merged
        flat[spans(first[other], sizes[other])] = np.frombuffer(b"".join(rest), "<u4")
        return flat, np.add.reduceat(sizes, own) if len(own) else sizes

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _apart(self, text: bytes) -> bytes:
        """The text with its stops and commas apart from its words, where that changes no id."""
        plain = not text.translate(None, SAFE) and not any(run in text for run in RUNS)
        if plain and (text.isascii() or not JOINED.search(text.decode("utf-8", "replace"))):
            # Every stop and comma is a token of its own, so words come without them.
            text = text.lower().replace(b".", b" . ").replace(b",", b" , ")
        return text

    def _split(self, texts: list[bytes]) -> pa.ListArray:
        """The words of each text; a text with a special token can't be parted and is one.
        Space at a text's ends gives empty words, which have no ids."""
        if any(s in t for t in texts for s in self.special):
            return pa.array([[t] if any(s in t for s in self.special) else self._apart(t).split() for t in texts], pa.list_(pa.binary()))
        return pc.ascii_split_whitespace(pa.array(map(self._apart, texts), pa.binary()).view(pa.string()))

    def texts(self, texts: list[bytes], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and the ids of each. Every distinct
        word is looked up once; the rest is array work."""
        split = self._split(texts)
        words = split.values.view(pa.binary()).dictionary_encode()
        flat, sizes = self.all(words.dictionary)
        at = words.indices.to_numpy()
        long = sizes[at]
        first = (np.cumsum(sizes) - sizes)[at] if len(at) else at
        found = flat[spans(first, long)]
        whole = np.append(0, np.cumsum(long))[split.offsets.to_numpy()]
        if end is not None:
            found = np.insert(found, whole[1:], end)
            whole = whole + np.arange(len(whole))
        return found, np.diff(whole)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, mix_col: str, id_col: str, text_col: str) -> DataFrame:
    """Row keys, ``mix``, ``n`` and the ids (16 or 32 bits each) of every row, with the end token."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        row_id(id_col).alias(ID), text_mark(text_col).alias(MARK),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(TEXT), F.col(mix_col).cast("string").alias("mix"),
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens.of(tokenizer)
        kind = _kind(words.tokenizer.get_vocab_size())
        for batch in (part for whole in batches for part in slices(whole, most=SLICE)):
            ids, sizes = words.texts(batch.column(2).to_pylist(), end_id)
            cuts = np.cumsum(sizes)[:-1]
            arrays = [
                batch.column(0), batch.column(1), batch.column(3), pa.array(sizes),
                pa.array([x.tobytes() for x in np.split(ids.astype(kind), cuts)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [ID, MARK, "mix", "n", "ids"])

    return map_arrow(rows, make, f"{ID} long, {MARK} int, mix string, n long, ids binary")


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class _Queue:
    """The documents of a source, cut from the front."""

    def __init__(self, share: float, owed: float):
        self.share, self.owed = share, owed
        self.docs: deque[tuple[tuple[int, int, str | None], np.ndarray]] = deque()
        self.at = self.left = 0

    def take(self, most: int) -> Iterator[tuple]:
        """Pieces of up to so many tokens together: key, start, ids, tokens of the document."""
        while most and self.docs:
            key, ids = self.docs[0]
            total = len(ids)
            n = min(most, total - self.at)
            yield key, self.at, ids[self.at : self.at + n], total
            self.at += n
            self.left -= n
            self.owed -= n
            most -= n
            if self.at == total:
                self.docs.popleft()
                self.at = 0

    def ready(self) -> int:
        """What may be taken now: what is owed, if that is a piece worth cutting."""
        owed = min(int(self.owed), self.left)
        if owed < LEAST and self.docs and owed < len(self.docs[0][1]) - self.at:
            return 0
        return max(0, owed)


def fill(queues: list[_Queue], window: int) -> Iterator[tuple]:
    """Pieces with the number of their window and their place in it."""
    number, left = 0, sum(q.left for q in queues)
    while left:
        size = window if left >= window else 1 << (left.bit_length() - 1)
        place = 0
        for q in queues:
            q.owed += q.share * size
        live = sorted((q for q in queues if q.left), key=lambda q: -q.owed)
        for asked in (_Queue.ready, lambda q: q.left):
            for q in live:
                if place < size:
                    for piece in q.take(min(size - place, asked(q))):
                        yield (*piece, number, place)
                        place += len(piece[2])
        left -= size
        number += 1


def enqueue(texts: pa.Table, queues: dict[str | None, _Queue]) -> None:
    """Put a part's documents into their queues, by id and mark. Their ids stay where Arrow
    has them; only the keys are copied."""
    keys = [texts.column(c).to_numpy() for c in (ID, MARK)]
    mixes, n = texts.column("mix").to_pylist(), texts.column("n").to_numpy()
    ids = []
    for chunk in texts.column("ids").cast(pa.binary()).chunks:
        at = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset :][: len(chunk) + 1].tolist()
        held = memoryview(chunk.buffers()[2] or b"")
        ids += [held[a:b] for a, b in zip(at, at[1:], strict=False)]
    for k in np.lexsort(keys[::-1]).tolist():
        queue = queues[mixes[k]]
        kind = "<u4" if len(ids[k]) == 4 * n[k] else "<u2"
        queue.docs.append(((int(keys[0][k]), int(keys[1][k]), mixes[k]), np.frombuffer(ids[k], kind)))
        queue.left += int(n[k])


def piece_table(part: int, found: list[tuple]) -> pa.Table:
    """Pieces as rows."""
    sizes = np.array([len(p[2]) for p in found], np.int64)
    ids = np.concatenate([np.zeros(0, "<u4"), *(p[2] for p in found)], dtype="<u4")
    offsets = np.append(0, np.cumsum(4 * sizes)).astype(np.int32)
    return pa.table(
        {
            ID: pa.array([p[0][0] for p in found], pa.int64()),
            MARK: pa.array([p[0][1] for p in found], pa.int32()),
            "mix": pa.array([p[0][2] for p in found], pa.string()),
            "start": pa.array([p[1] for p in found], pa.int64()),
            "length": pa.array(sizes, pa.int64()),
            "ids": pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
            "doc_tokens": pa.array([p[3] for p in found], pa.int64()),
            "sequence_id": pa.array([(part << 32) + p[4] for p in found], pa.int64()),
            "offset": pa.array([p[5] for p in found], pa.int64()),
        }
    )


def in_blocks(part: int, pieces: Iterator[tuple]) -> pa.Table:
    """All pieces, a block of tokens behind the other, so that each goes back by itself."""
    blocks, found, size = [], [], 0
    for piece in pieces:
        found.append(piece)
        size += len(piece[2])
        if size >= BLOCK:
            blocks.append(piece_table(part, found))
            found, size = [], 0
    return pa.concat_tables([*blocks, piece_table(part, found)] if found or not blocks else blocks)


def owed_before(counts: DataFrame, targets: dict[str | None, float] | None) -> DataFrame:
    """``part, mix, share, owed``: each source's target and its debt when a part begins.

    ``counts`` has the tokens of each part and source: a row for some millions of them.
    """
    if targets is None:
        whole = counts.agg(F.sum("n").alias("all"))
        shares = counts.groupBy("mix").agg(F.sum("n").alias("own")).join(whole, F.lit(True)).select("mix", (F.col("own") / F.col("all")).alias("share"))
    else:
        shares = counts.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items()], "mix string, share double")
    named = shares.withColumnRenamed("mix", "named")
    rows = counts.join(named, F.col("mix").eqNullSafe(F.col("named")), "left").select("part", "mix", "n", F.coalesce("share", F.lit(0.0)).alias("share"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n").alias("t")).select("part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("granted"))
    of_mix = Window.partitionBy("mix").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("own", F.coalesce(F.sum("n").over(of_mix), F.lit(0)))
    return rows.join(parts, "part").select("part", "mix", "share", (F.col("share") * F.col("granted") - F.col("own")).alias("owed"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    targets: dict[str | None, float] | None = None,
    end_id: int = 1,
    part_bytes: int = 16 << 20,
    mix_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every piece of every row: keys, ``mix``, its place in the document and in its
    sequence, its ``ids`` (32 bits each, low byte first) and the document's tokens."""
    parts = max(1, text_bytes(docs, text_col) // part_bytes)
    split = F.pmod(F.xxhash64(ID, MARK, F.lit(3)), F.lit(parts)).cast("int")
    rows = stored(tokenised(docs, tokenizer, end_id, mix_col, id_col, text_col).withColumn("part", split), "tokens")
    owed = stored(owed_before(rows.groupBy("part", "mix").agg(F.sum("n").alias("n")), targets), "owed")

    def make(texts: pa.Table, debts: pa.Table) -> pa.Table:
        queues = {d["mix"]: _Queue(d["share"], d["owed"]) for d in sorted(debts.to_pylist(), key=lambda d: d["mix"] or "")}
        part = texts.column("part")[0].as_py() if len(texts) else 0
        enqueue(texts, queues)
        return in_blocks(part, fill(list(queues.values()), window))

    return rows.groupBy("part").cogroup(owed.groupBy("part")).applyInArrow(make, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """The contract's columns of each piece."""
    return pieces.select(
        F.when(F.col(ID) != NO_ID, F.col(ID)).alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )
