"""Word shingles as 64-bit hashes, and their minhash collections."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Tensor:
    """Two collections of so many short minhash tuples; a table key is one tuple of each, so tables are the square of collection."""

    collection: int = 10
    width: int = 2
    words: int = 4
    seed: int = 1
    #: Of the first half of a set's digest: fewer than 64 only to test that sets of one short name are told apart.
    name_bits: int = 64


class Sketcher:
    """Turns texts to shingle sets and tuples. Made once per task; remembers hashes of a bounded number of words."""

    def __init__(self, how: Tensor):
        import numpy as np
        import xxhash

        self.how = how
        rng = np.random.default_rng(how.seed)
        count = 2 * how.collection * how.width
        self.mul = rng.integers(1 << 63, size=(count, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(1 << 63, size=(count, 1), dtype=np.uint64)
        digest = xxhash.xxh3_64_intdigest

        class Words(dict):
            def __missing__(own, word: bytes) -> int:  # noqa: N805
                if len(own) >= 100_000:
                    own.clear()
                value = digest(word)
                if len(word) <= 64:
                    own[word] = value
                return value

        self.known = Words()

    def shingles(self, text: bytes | None):
        """Distinct hashes, ascending: of windows of words, or of the whole where it has fewer words; none without a word."""
        import numpy as np

        words = (text or b"").lower().split()  # of bytes: A-Z only, and the six blanks of ASCII only
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(self.how.words, len(words))
        size = len(words) - width + 1
        out = np.full(size, width, np.uint64)  # a whole text of fewer words is never like a window
        for k in range(width):
            out = (out ^ h[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)

    def name(self, shingles) -> tuple[int, int]:
        """A digest of 128 bits, as two signed halves."""
        import xxhash

        whole = xxhash.xxh3_128_intdigest(shingles.tobytes())
        return ((whole & ((1 << self.how.name_bits) - 1)) - (1 << 63), (whole >> 64) - (1 << 63))

    def tuples(self, shingles):
        """int64 tuples, first collection then second. Equal with probability similarity ** width."""
        import numpy as np

        count, step = len(self.mul), 4096
        low = np.full(count, np.iinfo(np.uint64).max, np.uint64)
        for k in range(0, len(shingles), step):
            x = (shingles[k : k + step][None, :] ^ self.add) * self.mul
            x ^= x >> np.uint64(32)
            np.minimum(low, (x * self.mul).min(axis=1), out=low)
        pairs = low.reshape(2 * self.how.collection, self.how.width)
        out = np.arange(1, len(pairs) + 1, dtype=np.uint64)
        for k in range(self.how.width):
            out = (out ^ pairs[:, k]) * np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
        return out.view(np.int64)
