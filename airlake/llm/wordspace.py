"""Word and window hashes of many texts at once, as numpy arrays.

Hashes only propose; every operator confirms on words or on full sets, or uses the 64 bits
as identity where it says so.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Odd multiplier of a window's words (fixed value).
STEP = 0xD6E8FEB86659FD93
# Places in a word whose bytes have a random number each in a table; later ones get theirs from a mix.
PLACES = 64


@lru_cache(maxsize=None)
def byte_table() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**64, PLACES << 8, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits (the finishing step of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordSpace:
    """Words of single-spaced texts.

    ``n``: words per text. ``first``: index of each text's first word. ``doc``: text of each
    word. ``hash``: 64 bits per word. ``starts``/``ends``: byte ranges in ``data``.
    """

    def __init__(self, texts: list[str]):
        self.n = np.array([t.count(" ") + 1 if t else 0 for t in texts], np.int64)
        self.first = np.cumsum(self.n) - self.n
        self.doc = np.repeat(np.arange(len(texts)), self.n)
        self.data = " ".join(t for t in texts if t).encode("utf-8")
        raw = np.frombuffer(self.data, np.uint8)
        spaces = np.flatnonzero(raw == 32)
        if len(raw):
            self.starts = np.concatenate(([0], spaces + 1))
            self.ends = np.concatenate((spaces, [len(raw)]))
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        # A word's hash is the sum of a random number per place and byte: no two words, however regular, collide
        # by construction, as they do under any polynomial modulo a power of two. Prefix sums add them up.
        sizes = self.ends - self.starts
        index = np.arange(len(raw), dtype=np.int32)
        index -= np.repeat(self.starts.astype(np.int32), sizes + 1)[: len(raw)]
        far = np.flatnonzero(index >= PLACES) if len(sizes) and sizes.max() >= PLACES else index[:0]
        late = mix((index[far].astype(np.uint64) << np.uint64(8)) | raw[far])
        index[far] = 0
        index <<= 8
        index |= raw
        values = byte_table()[index]
        values[far] = late
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        self.hash = mix(sums[self.ends] - sums[self.starts])

    def windows(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on (also across texts; see :meth:`inside`)."""
        count = max(0, len(self.hash) - size + 1)
        h = np.zeros(count, np.uint64)
        for k in range(size):
            h = h * np.uint64(STEP) + self.hash[k : k + count]
        return mix(h)

    def inside(self, size: int) -> np.ndarray:
        """Positions from which ``size`` words lie in one text."""
        count = max(0, len(self.hash) - size + 1)
        return np.flatnonzero(self.doc[:count] == self.doc[size - 1 : size - 1 + count])

    def text(self, first: int, last: int) -> str:
        """Words ``first`` to ``last`` (exclusive), joined by a space."""
        return self.data[self.starts[first] : self.ends[last - 1]].decode("utf-8")
