"""What has been worked out for single words, kept by each Python worker for the texts that follow."""

from __future__ import annotations

from collections.abc import Callable, Iterable

# x20 and x09 to x0D, at which bytes.split() splits.
SPACES = " \t\n\r\x0b\x0c"
# Words kept at most; a worker that has seen more starts anew.
MAX_WORDS = 400_000


class Known:
    """Values of words: bytes (packed arrays) that ``learn`` gives for a list of new ones."""

    def __init__(self, learn: Callable[[list], Iterable[bytes]], max_words: int = MAX_WORDS):
        self.learn, self.max_words = learn, max_words
        self.values: dict = {}

    def of(self, words: list) -> list[bytes]:
        found = list(map(self.values.get, words))
        if None in found:
            if len(self.values) > self.max_words:
                self.values = {}
            new = list(dict.fromkeys(w for w in words if w not in self.values))
            self.values.update(zip(new, self.learn(new), strict=True))
            found = list(map(self.values.__getitem__, words))
        return found
