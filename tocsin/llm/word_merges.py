"""Byte-pair merges of many words at once, as array work.

A word starts as one symbol for each of its bytes; the neighbours that the vocabulary
merges earliest become one symbol, the leftmost first, until none are left to merge.
Here every word of an array takes its next step at the same time. Words of like length
go together, so that few wait for others.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

#: Rank of neighbours that are never merged, and the bytes that words of a group are within.
NEVER = 1 << 30
GROUPS = (4, 6, 8, 10, 13, 16, 24, 1 << 31)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one behind the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Merges:
    """Merges of a vocabulary that marks the last symbol of each word."""

    def __init__(self, tokenizer: Tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        vocab, last = model["vocab"], model["end_of_word_suffix"]
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The symbol of each byte that characters up to U+D7FF are made of, inside and at the end of a word.
        some = map(chr, [*range(0x800), *range(0x800, 0xD800, 0x800)])
        signs = {b: s for c in some for b, s in zip(c.encode(), as_bytes.pre_tokenize_str(c)[0][0], strict=True)}
        self.inner, self.final = np.zeros((2, 256), np.int64)
        for byte, sign in signs.items():
            self.inner[byte], self.final[byte] = vocab[sign], vocab[sign + last]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        # Ranks of two bytes; the second is one of 256 inside a word or of 256 at its end.
        both = np.concatenate([self.inner, self.final])
        self.opening = self._rank(np.repeat(self.inner, 512), np.tile(both, 256))
        # Lower case of each byte, and of each character of two bytes; 0: not of a word that is merged here.
        self.low = np.arange(256, dtype=np.uint8)
        self.low[65:91] += 32
        self.letter = np.zeros(256, bool)
        self.letter[97:123] = self.letter[65:91] = True
        self.low_pair = np.zeros(1 << 16, np.uint16)
        for c in map(chr, range(0x80, 0x250)):
            low = c.lower().encode()
            if c.isalpha() and len(low) == 2 and unicodedata.is_normalized("NFC", c):
                self.low_pair[int.from_bytes(c.encode())] = int.from_bytes(low)

    def lowered(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of words in lower case, and which of them belong to a Latin letter."""
        good, low = self.letter[data], self.low[data]
        pair = (data >= 0xC2) & (data <= 0xC9)
        pair[ends[ends > 0] - 1] = False
        lead = np.flatnonzero(pair)
        found = self.low_pair[data[lead].astype(np.uint16) << 8 | data[lead + 1]]
        lead, found = lead[found > 0], found[found > 0]
        good[lead] = good[lead + 1] = True
        low[lead], low[lead + 1] = found >> 8, found & 255
        return low, good

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        asked = left * self.width + right
        near = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[near] == asked, self.by_key[near], NEVER)

    def of(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places, one behind the other, and the ids of each."""
        order = np.argsort(sizes, kind="stable")
        edges = np.searchsorted(sizes[order], GROUPS, "right").tolist()
        ids, counts = [], np.zeros(len(sizes), np.int64)
        for a, b in zip([0, *edges], edges, strict=False):
            if b > a:
                some = order[a:b]
                found, counts[some] = self._group(data[spans(starts[some], sizes[some])], sizes[some])
                ids.append(found)
        flat, ordered = np.concatenate([np.zeros(0, np.int64), *ids]), counts[order]
        first = np.empty(len(sizes), np.int64)
        first[order] = np.cumsum(ordered) - ordered
        return flat[spans(first, counts)], counts

    def _group(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, ends = len(data), np.cumsum(sizes)
        starts = ends - sizes
        symbol = np.append(self.inner[data], 0)
        symbol[ends - 1] = self.final[data[ends - 1]]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        first, last, there = np.zeros(n, bool), np.zeros(n, bool), np.ones(n, bool)
        first[starts] = last[ends - 1] = True
        # Each symbol's rank with the next one, and its place behind it: the least is the leftmost of the earliest.
        code = data + (last.astype(np.int64) << 8)
        pair = np.append(self.opening[data[:-1].astype(np.int64) << 9 | code[1:]], NEVER) << 32 | np.arange(n)
        pair[last] = NEVER << 32
        while True:
            least = np.minimum.reduceat(pair, starts)
            least = least[least < NEVER << 32]
            if not len(least):
                return symbol[:-1][there], np.add.reduceat(there, starts, dtype=np.int64)
            at = least & 0xFFFFFFFF
            gone = after[at]
            symbol[at] = self.made[least >> 32]
            there[gone] = False
            pair[gone] = NEVER << 32
            after[at] = right = after[gone]
            before[right] = at
            last[at] = last[gone]
            # The new symbol's pairs with its right and its left neighbour.
            inside, beyond = at[~last[at]], at[~first[at]]
            pair[at] = NEVER << 32
            left = np.concatenate([inside, before[beyond]])
            pair[left] = self._rank(symbol[left], symbol[after[left]]) << 32 | left
