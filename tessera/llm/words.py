"""Words of whole texts as arrays: positions and 64-bit hashes, computed with numpy over
a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ONE = np.uint64(1)
_ODD = 0x9E3779B97F4A7C15  # the base of the polynomial hash; odd, so it has an inverse


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype="uint64") * np.uint64(_ODD))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_powers = [np.ones(1, "uint64"), np.ones(1, "uint64")]


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            a = np.full(max(n, CHUNK_BYTES + 1), base, "uint64")
            a[0] = 1
            _powers[k] = np.cumprod(a)
    return _powers


@dataclass
class Words:
    """Words of some texts. doc: the text of each word, by its place in `texts`; at: byte
    spans in `data`, where a separator follows every text; first: per text, its first word."""

    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A hash of each word's bytes, with A-Z as a-z if lower."""
        up, down = _power(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, "uint64")
        np.cumsum((_LOWER if lower else _BYTE)[self.data] * up[: len(self.data)], out=total[1:])
        return mixed((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype("uint64"))


def split_words(texts: Sequence[str | None]) -> Words:
    """Maximal runs without space, \\t, \\n, \\v, \\f, \\r. A null text has no words."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), "uint8")
    ends = np.cumsum([len(x) + 1 for x in raw]) if raw else np.zeros(0, "int64")
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype("int8")))
    start, end = edge[::2], edge[1::2]
    doc = np.searchsorted(ends, start, side="right")
    return Words(data, doc, start, end, np.searchsorted(doc, np.arange(len(raw) + 1)))


def in_chunks(texts: Sequence[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` characters together; a longer text stands alone."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if len(texts) > lo:
        yield lo, len(texts)


def ngrams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one text, and the place of their first word."""
    if len(hashes) < n:
        return np.zeros(0, "uint64"), np.zeros(0, "int64")
    at = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
    x = np.zeros(len(at), "uint64")
    for k in range(n):
        x = mixed(x + hashes[at + k] + np.uint64(k + 1))
    return x, at


def shingle_sets(texts: Sequence[str | None], n: int, lower: bool = True) -> list[np.ndarray]:
    """Each text's set of n-word shingles, as sorted distinct hashes. A text of fewer words
    has its whole sequence as one; a text without words, or null, has the empty set."""
    out: list[np.ndarray] = []
    for lo, hi in in_chunks(texts):
        w = split_words(texts[lo:hi])
        h = w.hashes(lower)
        x, at = ngrams(h, w.doc, n)
        cut = np.searchsorted(w.doc[at], np.arange(hi - lo + 1))
        for i in range(hi - lo):
            few = h[w.first[i] : w.first[i + 1]]
            if 0 < len(few) < n:
                s = np.zeros(1, "uint64") + np.uint64(len(few))
                for k in range(len(few)):
                    s = mixed(s * np.uint64(31) + few[k : k + 1])
                out.append(s)
            else:
                out.append(np.unique(x[cut[i] : cut[i + 1]]))
    return out
