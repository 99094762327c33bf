"""Words and word shingles of a block of texts as numpy arrays of 64-bit hashes.

A word is a run of letters, digits or ``_`` (every character beyond ASCII counts as a letter),
lower-cased. Hashes do not depend on the process, the block or the place in the text.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_SPAN = 1 << 18
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _SPAN + 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.concatenate((np.ones(1, np.uint64),
                                      np.cumprod(np.full(size - 1, p, np.uint64))))
                      for p in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span (spans ascend; prefix sums of a polynomial)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _SPAN, "left")))
        base = int(starts[i])
        seg = buf[base:int(ends[i:j].max())].astype(np.uint64) + np.uint64(1)
        power, inverse = _powers(len(seg) + 1)
        total = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(seg * power[:len(seg)], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


class Words:
    """Words of a block of texts: ``doc`` (text number, ascending), byte spans and ``hash``."""

    def __init__(self, texts: list[str]):
        raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        self.n_docs = len(raw)
        self.buf = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
        at = np.cumsum([0] + [len(r) + 1 for r in raw])
        inside = np.zeros(len(self.buf) + 2, np.int8)
        inside[1:-1] = _IS_WORD[self.buf]
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.doc = np.searchsorted(at, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.cumsum(self.count) - self.count
        self.hash = hash_spans(self.buf, self.start, self.end)

    def prefixes(self, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
        """(text number, hash) of the first ``n_bytes`` bytes of every longer word."""
        long = np.flatnonzero(self.end - self.start > n_bytes)
        return self.doc[long], hash_spans(self.buf, self.start[long], self.start[long] + n_bytes)

    def shingles(self, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(text number, hash) of every run of ``n`` words; of a shorter text, all its words."""
        factor = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
        docs, hashes = [], []
        if len(self.hash) >= n:
            last = len(self.hash) - n + 1
            whole = np.flatnonzero(self.doc[:last] == self.doc[n - 1:])
            total = np.zeros(len(whole), np.uint64)
            for j in range(n):
                total += self.hash[whole + j] * factor[j]
            docs.append(self.doc[whole])
            hashes.append(mix(total))
        for size in range(1, n):
            short = np.flatnonzero(self.count == size)
            total = np.full(len(short), size, np.uint64)
            for j in range(size):
                total += self.hash[self.first[short] + j] * factor[j]
            docs.append(short)
            hashes.append(mix(total))
        doc, value = np.concatenate(docs), np.concatenate(hashes)
        order = np.lexsort((value, doc))
        return doc[order], value[order]


def counted(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, value) with their counts; the input is sorted by both."""
    if not len(doc):
        return doc, value, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate(
        ([True], (doc[1:] != doc[:-1]) | (value[1:] != value[:-1]))))
    return doc[new], value[new], np.diff(np.append(new, len(doc)))
