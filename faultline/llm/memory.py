"""Remembered encodings of words, bounded, for tokenizers that treat words one by one."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType

import numpy as np

# About 40 MB: a word, its dictionary entry and its numbers take some 250 bytes.
MAX_WORDS = 160_000
# New words go to the tokenizer so many at a time, unless the caller says otherwise.
ENCODE_WORDS = 4096

Encode = Callable[[list], tuple[list[np.ndarray], np.ndarray]]


def of_process(key: str, make: Callable):
    """What ``make`` made in this process under ``key``: tasks that share a worker share it."""
    kept = sys.modules.setdefault("_faultline_kept", ModuleType("_faultline_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


class _Numbers(dict):
    """Numbers for words, given out on first sight; ``new`` holds words not yet encoded."""

    def __init__(self, known=()):
        super().__init__(zip(known, range(len(known))))
        self.new: list = []

    def __missing__(self, word) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordMemory:
    """Columns of numbers per word, looked up for many words at once.

    ``encode(words)`` gives ``width`` arrays with the entries of all words in a row, and how many
    entries each word has. A group of texts is answered whole; if more than ``max_words`` words
    are known after it, the half that came most often stays.
    """

    def __init__(self, encode: Encode, width: int, max_words: int = MAX_WORDS, batch: int = ENCODE_WORDS):
        self.encode, self.max_words, self.batch = encode, max_words, batch
        self.numbers = _Numbers()
        self.columns = [np.empty(1024, np.int32) for _ in range(width)]
        self.first, self.size, self.seen = (np.zeros(1024, np.int32) for _ in range(3))
        self.used = 0

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        if n <= len(array):
            return array
        wider = np.zeros(max(n, 2 * len(array)), array.dtype)
        wider[: len(array)] = array
        return wider

    def _learn(self) -> None:
        words, at = self.numbers.new, len(self.numbers) - len(self.numbers.new)
        self.numbers.new = []
        self.first, self.size, self.seen = (self._room(a, len(self.numbers)) for a in (self.first, self.size, self.seen))
        for s in range(0, len(words), self.batch):
            made, n = self.encode(words[s : s + self.batch])
            total = int(n.sum())
            self.size[at : at + len(n)] = n
            self.first[at : at + len(n)] = self.used + np.cumsum(n) - n
            self.columns = [self._room(c, self.used + total) for c in self.columns]
            for column, new in zip(self.columns, made):
                column[self.used : self.used + total] = new
            self.used, at = self.used + total, at + len(n)

    def _forget(self) -> None:
        n = len(self.numbers)
        keep = np.sort(np.argsort(-self.seen[:n], kind="stable")[: self.max_words // 2])
        words = list(self.numbers)
        size = self.size[keep]
        at = self._entries(keep)
        # Fresh arrays of the size in use, so that a group of many words leaves nothing behind.
        self.columns = [c[at] for c in self.columns]
        self.numbers = _Numbers([words[i] for i in keep.tolist()])
        self.size, self.first, self.seen = size, np.cumsum(size, dtype=np.int32) - size, self.seen[keep] // 2
        self.used = int(size.sum())

    def _entries(self, numbers: np.ndarray) -> np.ndarray:
        n = self.size[numbers]
        before = np.cumsum(n, dtype=np.int64) - n
        return np.repeat(self.first[numbers] - before, n) + np.arange(int(n.sum()))

    def __call__(self, texts: list[list]) -> list[list[np.ndarray]]:
        """For each text (a list of words) its columns."""
        if len(self.numbers) > self.max_words:
            self._forget()
        look = self.numbers.__getitem__
        numbers = [np.fromiter(map(look, words), np.int32, len(words)) for words in texts]
        if self.numbers.new:
            self._learn()
        if numbers:
            came = np.bincount(np.concatenate(numbers), minlength=1)
            self.seen[: len(came)] += came.astype(np.int32)
        out = []
        for number in numbers:
            at = self._entries(number)
            out.append([c[at] for c in self.columns])
        return out
