"""MinHash signatures of whole texts, as numpy over the bytes of many texts at once.

A text's shingles (runs of bytes or of words) become 64-bit hashes; a signature
has, for each of K functions, the smallest value over the text's shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SEED = np.uint64(0x9E3779B97F4A7C15)
#: Shingles hashed at a time, so that the work stays in the processor's cache.
_BLOCK = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each 64-bit value."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


class WordHashes(dict):
    """64-bit hashes of words; emptied when large."""

    def __missing__(self, word: bytes) -> int:
        h = 0xCBF29CE484222325
        for i in range(0, len(word), 8):
            h = (h ^ int.from_bytes(word[i : i + 8], "little")) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
            h ^= h >> 29
        h = (h ^ len(word)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        h ^= h >> 32
        if len(word) <= 64:
            if len(self) >= 400_000:
                self.clear()
            self[word] = h
        return h


def _whole_runs(sizes: np.ndarray, n: int) -> np.ndarray:
    """Of all places in texts of these sizes behind each other, those where a run of ``n`` lies in one text."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(sizes.sum())
    return np.flatnonzero(left >= n)


class CharRuns:
    """Hashes of runs of ``k`` code points: of one text, or of many at once for their signatures."""

    def __init__(self, k: int):
        self.k = k

    def flat(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The texts' shingles behind each other, and how many each text has; a shorter text is one run."""
        parts = [t.ljust(self.k, "\0") for t in texts]
        sizes = np.array([len(p) for p in parts])
        # A place's run lies in one text if it isn't among the last k - 1 of it.
        a = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        m = len(a) - self.k + 1
        x, n = a, 1  # of runs of n code points, whose number is doubled up to k
        with np.errstate(over="ignore"):
            for bit in f"{self.k:b}"[1:]:
                x = x[:-n] * _SEED**np.uint64(n) + x[n:]
                n *= 2
                if bit == "1":
                    x = x[:-1] * _SEED + a[n:]
                    n += 1
        inner = np.ones(len(a), bool)
        ends = np.cumsum(sizes)
        for i in range(1, self.k):
            inner[ends - i] = False
        return x[inner[:m]], (sizes - self.k + 1).tolist()


class WordRuns:
    """Shingles of ``n`` words: of one text, or of many at once for their signatures."""

    def __init__(self, split, n: int = 5):
        self.split, self.n, self.hashes = split, n, WordHashes()

    def flat(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The texts' shingles behind each other, and how many each text has (none without a word)."""
        parts = [self.split(t) for t in texts]
        # A shorter text is one run, filled up with empty words, which no text has.
        parts = [p + [b""] * (self.n - len(p)) if p and len(p) < self.n else p for p in parts]
        sizes = np.array([len(p) for p in parts])
        w = np.fromiter((self.hashes[x] for p in parts for x in p), np.uint64, sizes.sum())
        at = _whole_runs(sizes, self.n)
        x = np.zeros(len(at), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(self.n):
                x = mix(x + _SEED + w[at + i])
        return x, np.maximum(sizes - self.n + 1, 0).tolist()


_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and a 64-bit hash of each blank-separated word of some UTF-8."""
    inner = ~_BLANK[data]
    edges = np.diff(np.concatenate(([False], inner, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    word = np.cumsum(edges[:-1] == 1)[inner] - 1
    place = (np.flatnonzero(inner) - starts[word]).astype(np.uint64)
    with np.errstate(over="ignore"):
        letters = mix((place << np.uint64(8) | data[inner]) * _SEED + _SEED)
        return starts, ends, mix(np.add.reduceat(letters, np.flatnonzero(np.diff(word, prepend=-1))) + _SEED)


class MinHash:
    """K functions ``a * h mod 2^32`` (a odd) on 32 well-mixed bits of a shingle's hash.

    The smallest value is decided by a product's high bits, which depend on all of the hash.
    """

    def __init__(self, size: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 31, size, np.uint32) * np.uint32(2) + np.uint32(1)

    def signatures(self, shingles: list[np.ndarray]) -> np.ndarray:
        """A row of K values for each (non-empty) array of shingles."""
        return self.of_flat(np.concatenate(shingles), [len(s) for s in shingles])

    def of_flat(self, flat: np.ndarray, sizes: list[int]) -> np.ndarray:
        """The same for arrays that lie behind each other in ``flat``; repeated shingles change nothing."""
        out = np.empty((len(self.a), len(sizes)), np.uint32)
        at = 0
        for lo, hi in _blocks(sizes):
            ends = np.cumsum(sizes[lo:hi])
            h = (mix(flat[at : at + ends[-1]] + _SEED) >> np.uint64(32)).astype(np.uint32)
            at += ends[-1]
            starts = np.concatenate(([0], ends[:-1]))
            x = np.empty_like(h)
            for k, a in enumerate(self.a):
                np.multiply(h, a, out=x)
                np.minimum.reduceat(x, starts, out=out[k, lo:hi])
        return np.ascontiguousarray(out.T)


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    lo = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > _BLOCK:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each signature and band; the band's number is part of it."""
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(signatures), 1))
    with np.errstate(over="ignore"):
        for r in range(rows):
            keys = mix(keys * _SEED + signatures[:, r : bands * rows : rows].astype(np.uint64) + np.uint64(1))
    return keys.view(np.int64)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two sorted arrays of distinct ones have in common."""
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact Jaccard similarity of two sorted arrays of distinct shingles; two empty ones have 0."""
    both = shared(a, b)
    return both / (len(a) + len(b) - both) if both else 0.0


def shingle_sets(of: CharRuns | WordRuns, texts: list[str]) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    if not texts:
        return []
    flat, sizes = of.flat(texts)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    for lo, hi in zip(starts.tolist(), ends.tolist()):
        flat[lo:hi].sort()
    new = np.diff(flat, prepend=flat[:1]) != 0
    new[starts[starts < len(flat)]] = True
    flat, until = flat[new], np.append(0, np.cumsum(new))
    return [flat[lo:hi] for lo, hi in zip(until[starts].tolist(), until[ends].tolist())]
