"""Double-array tries of phrases of word numbers, walked from all positions at once.

A state ``s`` and a symbol ``c`` lead to cell ``base[s] + c``, if ``check`` of that cell is
``s``. Symbols are the places of a trie's own words among each other, so the size of
a trie is bounded by its phrases, not by the vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROOT = 0
TRY = 256


class _Cells:
    """Free cells. Nodes of about the same size are placed one behind the other, so that
    each stretch of cells is tried once for each size."""

    def __init__(self, room: int):
        self.used = np.zeros(room, bool)
        self.used[0] = True
        self.next: dict[int, int] = {}

    def place(self, symbols: np.ndarray) -> int:
        """A base at which the cells of all symbols are free; they are taken."""
        least, reach = int(symbols[0]), symbols - symbols[0]
        size = len(symbols).bit_length()
        start = self.next.get(size, 1)
        start = max(start, least + 1)
        while True:
            if start + reach[-1] + TRY >= len(self.used):
                self.used = np.concatenate([self.used, np.zeros(len(self.used) + int(reach[-1]) + TRY, bool)])
            firsts = start + np.flatnonzero(~self.used[start : start + TRY])
            for symbol in reach[1:]:
                if not len(firsts):
                    break
                firsts = firsts[~self.used[firsts + symbol]]
            if len(firsts):
                base = int(firsts[0]) - least
                self.used[base + symbols] = True
                self.next[size] = max(self.next.get(size, 1), start)
                return base
            start += TRY


@dataclass
class Trie:
    """``words``: the phrases, a row each, zeros behind the last word; ``phrase``: cell to row, or -1."""

    words: np.ndarray
    symbols: np.ndarray
    base: np.ndarray
    check: np.ndarray
    phrase: np.ndarray

    @staticmethod
    def of(words: np.ndarray) -> Trie:
        """A trie of distinct phrases of at least one word, numbers from 1."""
        words = np.asarray(words, np.int64)
        symbols = np.unique(words[words > 0])
        coded = np.where(words > 0, np.searchsorted(symbols, words) + 1, 0)
        cells = _Cells(2 * len(symbols) + 2 * words.size + 2 * TRY)
        lengths = (words > 0).sum(1)
        at = np.zeros(len(words), np.int64)
        bases: list[tuple[np.ndarray, np.ndarray]] = []
        checks: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(words.shape[1]):
            rows = np.flatnonzero(lengths > level)
            edges, back = np.unique(at[rows] << 32 | coded[rows, level], return_inverse=True)
            parents, starts, sizes = np.unique(edges >> 32, return_index=True, return_counts=True)
            base = np.zeros(len(parents), np.int64)
            for k in np.argsort(-sizes, kind="stable"):
                base[k] = cells.place(edges[starts[k] : starts[k] + sizes[k]] & 0xFFFFFFFF)
            reached = np.repeat(base, sizes) + (edges & 0xFFFFFFFF)
            bases.append((parents, base))
            checks.append((reached, np.repeat(parents, sizes)))
            at[rows] = reached[back]
        size = int(max([ROOT, *[int(c.max()) for c, _ in checks if len(c)]])) + 2
        out = Trie(words.astype(np.int32), symbols.astype(np.int32), np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32))
        for cell, value in bases:
            out.base[cell] = value
        for cell, value in checks:
            out.check[cell] = value
        out.phrase[at[lengths > 0]] = np.flatnonzero(lengths > 0)
        return out

    def code(self, ids: np.ndarray) -> np.ndarray:
        """Symbols of word numbers; 0 for words that no phrase has."""
        if not len(self.symbols):
            return np.zeros(len(ids), np.int64)
        at = np.minimum(np.searchsorted(self.symbols, ids), len(self.symbols) - 1)
        return np.where(self.symbols[at] == ids, at + 1, 0)

    def count(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Add to ``counts``, one for each cell, how often each is reached from any position."""
        symbols, last = self.code(ids), len(self.base) - 1
        at = np.flatnonzero(symbols)
        state = np.full(len(at), ROOT, np.int64)
        for level in range(self.words.shape[1]):
            inside = at + level < len(symbols)
            at, state = at[inside], state[inside]
            symbol = symbols[at + level]
            cell = np.minimum(self.base[state] + symbol, last)
            goes = (self.check[cell] == state) & (symbol > 0)
            at, state = at[goes], cell[goes]
            if not len(at):
                return
            counts += np.bincount(state, minlength=len(counts))
