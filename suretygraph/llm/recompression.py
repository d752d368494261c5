"""Rounds that name runs and pairs of words, the same way wherever they stand.

A round gives a run of one symbol, then pairs of neighbours, a new name. The name is a 64-bit hash of what it
stands for, so all executors give equal parts the same one and no dictionary has to be shuffled. Whether two
neighbours join depends only on the two: half of all symbols, by a bit of their name, may stand on the left
and the others on the right, and a joint symbol holds at most ``longest`` words.

Each symbol carries its context, the words that had to be seen to name and to bound it. Two texts that agree
on a symbol's context have the same symbol there, whatever stands outside. At the edge of a text the context
lies beyond the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from suretygraph.llm.tokens import U, mix

_LEFT, _RUN = U(0x9FB21C651E98DF25), U(0xD1B54A32D192ED03)


@dataclass
class Symbols:
    name: np.ndarray
    start: np.ndarray  # words covered: start to end
    end: np.ndarray
    low: np.ndarray  # words of the context: low to high
    high: np.ndarray
    text: np.ndarray  # number of the text

    def __len__(self) -> int:
        return len(self.name)


def of_words(hashes: np.ndarray, first: np.ndarray) -> Symbols:
    at = np.arange(len(hashes))
    return Symbols(hashes, at, at + 1, at, at + 1, np.repeat(np.arange(len(first) - 1), np.diff(first)))


def _contexts_beside(s: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """The context's low end of the symbol before and the high end of the one after, or beyond the text."""
    same = s.text[1:] == s.text[:-1]
    low, high = s.start - 1, s.end + 1
    low[1:][same] = s.low[:-1][same]
    high[:-1][same] = s.high[1:][same]
    return low, high


def _name_runs(s: Symbols, longest: int) -> Symbols:
    low, high = _contexts_beside(s)
    new = np.ones(len(s), bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | (s.text[1:] != s.text[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(s)))
    last = begin + size - 1
    joined = (size > 1) & (s.end[last] - s.start[begin] <= longest)
    run = np.repeat(np.arange(len(begin)), size)
    keep = new | ~joined[run]
    run = run[keep]
    name, end = s.name[keep], s.end[keep]
    name = np.where(joined[run], mix(name * _RUN + size[run].astype(U)), name)
    end = np.where(joined[run], s.end[last][run], end)
    return Symbols(name, s.start[keep], end, low[begin][run], high[last][run], s.text[keep])


def _name_pairs(s: Symbols, longest: int, number: int) -> Symbols:
    low, high = _contexts_beside(s)
    right = (mix(s.name + U(number + 1)) >> U(40)) & U(1) == 1
    fits = (s.text[1:] == s.text[:-1]) & (s.end[1:] - s.start[:-1] <= longest)
    pair = np.zeros(len(s), bool)
    pair[:-1] = ~right[:-1] & right[1:] & fits
    second = np.zeros(len(s), bool)
    second[1:] = pair[:-1]
    low = np.where(right & ~second, low, s.low)
    high = np.where(right | pair, s.high, high)
    name, end = s.name.copy(), s.end.copy()
    at = np.flatnonzero(pair)
    name[at] = mix(s.name[at] * _LEFT + s.name[at + 1])
    end[at], high[at] = s.end[at + 1], s.high[at + 1]
    keep = ~second
    return Symbols(name[keep], s.start[keep], end[keep], low[keep], high[keep], s.text[keep])


def recompress(hashes: np.ndarray, first: np.ndarray, rounds: int, longest: int) -> Symbols:
    """Symbols of the texts whose words lie from first[i] to first[i + 1]."""
    s = of_words(hashes, first)
    for number in range(rounds):
        if number < 2:  # longer symbols seldom repeat at once, and looking for it would widen every context
            s = _name_runs(s, longest)
        s = _name_pairs(s, longest, number)
    return s
