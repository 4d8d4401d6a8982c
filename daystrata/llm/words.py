"""Words of texts as hashes, in numpy."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

# Fixed tables: ASCII capitals to small letters, and ASCII characters that are no letter or digit to spaces.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PLAIN = bytes(32 if c < 128 and not chr(c).isalnum() else LOWER[c] for c in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes:
    """64-bit hashes of the words of a text; words already seen are looked up.

    Words are runs of anything but ASCII white space; ``table`` maps the bytes of the text before it is split.
    """

    def __init__(self, table: bytes | None = None, limit: int = 500_000):
        self.table, self.limit = table, limit
        self.known: dict[bytes, int] = {}

    def split(self, text: str | None) -> list[bytes]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        return (raw.translate(self.table) if self.table else raw).split()

    def __call__(self, text: str | None) -> np.ndarray:
        return self.hashes(self.split(text))

    def all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The hashes of several texts; each distinct word is looked for once."""
        split = [self.split(t) for t in texts]
        if not split:
            return []
        return np.split(self.hashes(list(chain.from_iterable(split))), np.cumsum([len(w) for w in split])[:-1])

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values = values * MIX
    return values ^ (values >> np.uint64(31))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive words."""
    return picked(hashes, tuple(range(length)))


def picked(hashes: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """Hash, for every place, of the words at ``offsets`` from it; the last offset is the largest."""
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    result = np.full(n, np.uint64(len(offsets)))
    for at in offsets:
        result = result * MULTIPLIER + hashes[at : at + n]
        result ^= result >> np.uint64(32)
    return mixed(result)
