"""What a task remembers of words it has met, bounded in bytes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

ENTRY_BYTES = 170  # of a dictionary's entry: the string's head, the table's slots, the number


class Memo:
    """Numbers for words, in the order in which they were added. Once it is ``full``, its owner starts anew.

    Forgetting changes no result, only what is worked out again.
    """

    def __init__(self, most_bytes: int, value_bytes: int = 0) -> None:
        self.most, self.each = most_bytes, ENTRY_BYTES + value_bytes
        self.place: dict[str, int] = {}
        self.size = 0

    def numbers(self, words: Sequence[str]) -> np.ndarray:
        """The number of each word, -1 where there is none yet."""
        return np.fromiter((self.place.get(w, -1) for w in words), np.int64, len(words))

    def add(self, words: Sequence[str], more_bytes: int = 0) -> None:
        """Give ``words`` the next numbers, in order."""
        start = len(self.place)
        self.place.update(zip(words, range(start, start + len(words))))
        self.size += self.each * len(words) + sum(map(len, words)) + more_bytes

    @property
    def full(self) -> bool:
        return self.size > self.most

    def clear(self) -> None:
        self.place, self.size = {}, 0
