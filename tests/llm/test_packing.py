import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import edges
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tocsin.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, rows, window=2048, **more):
    """Pieces give every document's ids back, and every sequence is gapless and full."""
    plain = Tokenizer.from_file(PATH)
    want = Counter((i, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in rows)
    pieces = packing.pack(docs, PATH, window, **more).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = tuple(np.frombuffer(p.ids, "<u4").tolist())
        assert len(ids) == p.length > 0
        by_doc[p["__id"], p["__mark"]].append((p.start, ids, p.doc_tokens))
        by_seq[p.sequence_id].append((p.offset, p.length, p.mix))
    got = Counter()
    for (i, _), found in by_doc.items():
        # Rows that repeat may be cut in different places.
        whole = []
        for start, ids, _ in sorted(found):
            if start:
                next(w for w in whole if len(w) == start).extend(ids)
            else:
                whole.append(list(ids))
        assert {n for _, _, n in found} == {len(w) for w in whole}
        for w in whole:
            got[None if i == -(2**63) else i, tuple(w)] += 1
    assert got == want
    for places in by_seq.values():
        places.sort()
        at = 0
        for offset, length, _ in places:
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
    return pieces, by_seq


def test_edges(spark):
    rows = edges.rows() + [(200, "a <|endoftext|> b"), (201, "don't STOP... Été é İ ΣΣ 中文 x.y, (z)"), (202, " nb sp")]
    rows = [(r + (None,) * 5)[:7] for r in rows]
    check(edges.frame(spark, rows), [(r[0], r[1]) for r in rows], window=64)


def test_given_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    check(documents, rows, part_bytes=100_000)
    pieces, by_seq = check(documents, rows)
    # One part: every full window is near the mixture of the table.
    total = Counter()
    for p in pieces:
        total[p.mix] += p.length
    share = {s: n / sum(total.values()) for s, n in total.items()}
    off = []
    for places in by_seq.values():
        if sum(n for _, n, _ in places) == 2048:
            own = Counter()
            for _, n, mix in places:
                own[mix] += n
            off += [abs(own[s] / 2048 - w) for s, w in share.items()]
    assert np.mean(off) < 0.02


def test_targets_are_met_and_debts_carried(spark):
    rows = [(i, "word " * 400, "a" if i % 4 else "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces, by_seq = check(docs, [(i, t) for i, t, _ in rows], 256, targets={"a": 0.5, "b": 0.5}, part_bytes=1 << 18)
    both = [p for p in by_seq.values() if len({m for _, _, m in p}) == 2]
    shares = [sum(n for _, n, m in p if m == "b") / 256 for p in both]
    assert both and abs(np.mean(shares) - 0.5) < 0.1


def test_debts_add_up(spark):
    counts = spark.createDataFrame([(0, "a", 10), (0, "b", 30), (1, "a", 30), (1, "b", 10), (2, "a", 5)], "part int, mix string, n long")
    owed = {(r.part, r.mix): r.owed for r in packing.owed_before(counts, {"a": 0.5, "b": 0.5}).collect()}
    assert owed == {(0, "a"): 0, (0, "b"): 0, (1, "a"): 10, (1, "b"): -10, (2, "a"): 0}


def test_empty_table(spark):
    assert packing.pack(edges.empty(spark), PATH).collect() == []


@pytest.mark.parametrize("text", ["Straße ÅÅ KK", "x́ ǅ ẞ", "a.b, c,. d'll I'M", "!!? ...", "tab\x1csep \x85 nel"])
def test_words_apart_equal_the_whole_text(text):
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert packing.WordTokens.of(PATH).texts([b"", text.encode(), b""])[0].tolist() == whole


@pytest.mark.parametrize(
    "text",
    ["er said”.", "ok 😀. end", "so…, then", "end.” Then", "完了。, next", "की, और", "हिंदी. है", "نعم،. لا", "e\u0301. a.\u0301", "İ. i̇, İ!", "\u0958. \u0958!", "a\u00a0. ×, ÷.", "été. Çà, et ñ.ö"],
)
def test_signs_beyond_ascii_join_a_stop_or_comma(text):
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert packing.WordTokens(PATH).texts([text.encode(), b"plain, words.", text.encode()])[0].tolist()[: len(whole)] == whole


def test_every_character_next_to_a_stop_or_comma():
    plain, words = Tokenizer.from_file(PATH), packing.WordTokens(PATH)
    signs = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3200 or c % 97 == 0)]
    for form in ("a{}.", "a{},b", "x.{}y", "a{}!"):
        texts = [form.format(c) for c in signs]
        ids, sizes = words.texts([t.encode() for t in texts])
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert [c for c, g, w in zip(signs, got, want, strict=True) if g != w] == []


def test_accented_words_go_straight_to_the_merges():
    """Calls of the pre-tokenizer and the whole tokenizer took much of the time."""
    text = "été Çà niño straße ÆØÅ ȺȾ žluťoučký kůň"
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    words = packing.WordTokens(PATH)
    words.tokenizer = words.as_bytes = None
    assert words.texts([text.encode()])[0].tolist() == whole


def test_words_are_merged_together_as_one_by_one():
    """Merging each new word by itself, and holding many, took much of the time and memory."""
    rng, plain, words = random.Random(3), Tokenizer.from_file(PATH), packing.WordTokens(PATH)
    parts = "the ing er tion schlüß é ñ Ça Ø st heit x zz A THE ı ſ ʀ Ʀ o ł".split()
    made = ["".join(rng.choices(parts, k=rng.randint(1, 9))) + rng.choice(["", "", ".", "###", "..."]) for _ in range(20_000)]
    made += ["it's", "e" * 300, "ab" * 90, "é" * 70, "a1b2", "日本é", "é\u0301x", "e\u0301x"]
    tokenizer, calls = words.tokenizer, []

    class Counted:
        def encode(self, text, **more):
            calls.append(text)
            return tokenizer.encode(text, **more)

    words.tokenizer = Counted()
    ids, sizes = words.texts([w.encode() for w in made])
    got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    want = [e.ids for e in plain.encode_batch(made, add_special_tokens=False)]
    assert [w for w, g, e in zip(made, got, want, strict=True) if g != e] == []
    assert len(words) + len(words.old) == len(calls) < len(set(made)) / 4


def test_broken_utf8_is_read_as_replaced():
    plain, words = Tokenizer.from_file(PATH), packing.WordTokens(PATH)
    for text in (b"caf\xc3 \xa9t", b"a\xc3", b"\xa9a b\xc3\xa9\xa9 \xc3\xc3\xa9"):
        want = plain.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        assert words.texts([text])[0].tolist() == want


def test_pieces_are_made_from_the_documents_own_bytes():
    """A part's ids were copied wide for its queues, again for its pieces and again for its table."""
    rng = np.random.default_rng(0)
    n, long = 4000, 1000
    ids = [rng.integers(2, 40_000, long).astype("<u2").tobytes() for _ in range(n)]
    texts = pa.table({
        packing.ID: pa.array(range(n), pa.int64()), packing.MARK: pa.array([0] * n, pa.int32()), "mix": pa.array(["ab"[k % 2] for k in range(n)]),
        "n": pa.array([long] * n, pa.int64()), "ids": pa.array(ids, pa.binary()), "part": pa.array([5] * n, pa.int32()),
    })
    tracemalloc.start()
    try:
        queues = {m: packing._Queue(0.5, 0.0) for m in "ab"}
        packing.enqueue(texts, queues)
        before = tracemalloc.get_traced_memory()[0]
        found = packing.in_blocks(5, packing.fill(list(queues.values()), 2048))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert before < 4 << 20 and peak < 28 << 20, (before, peak)
    assert max(b.nbytes for b in found.to_batches()) < 2 << 20
    whole = {}
    for i, start, x in sorted(zip(*(found.column(c).to_pylist() for c in (packing.ID, "start", "ids")), strict=True)):
        whole[i] = whole.get(i, b"") + x
    assert [np.frombuffer(whole[i], "<u4").astype("<u2").tobytes() for i in range(n)] == ids
