"""Words of whole texts as 64-bit hashes, cut and hashed in numpy a buffer at a time.

A word is a run of bytes outside space, tab, line feed, vertical tab, form feed and carriage return,
with A-Z lower-cased; on UTF-8 that is the pattern ``[^\\x20\\x09-\\x0D]+``. Hashes stand for words and
shingles; two different ones share a hash with probability 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Texts are hashed together up to about this many bytes; a longer text alone.
BUFFER = 1 << 20
_powers: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        tables = []
        for base in (_BASE, _INVERSE):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            tables.append(np.multiply.accumulate(factors))
        _powers[:] = tables
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    inside = np.empty(len(data) + 1, bool)
    inside[0] = False
    np.logical_not((data == 32) | ((data >= 9) & (data <= 13)), out=inside[1:])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    up, down = _tables(max(BUFFER * 2, len(data)))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(data * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    first = np.cumsum(lengths + 1) - lengths - 1
    bounds = np.searchsorted(starts, np.append(first, len(data)))
    return mix(hashes), np.diff(bounds)


def buffers(texts: Iterable[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Cut the texts of a batch into runs of about :data:`BUFFER` bytes: position of the first, UTF-8 texts (null: empty)."""
    run: list[bytes] = []
    first = size = 0
    for i, text in enumerate(texts):
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if run and size + len(raw) > BUFFER:
            yield first, run
            run, first, size = [], i, 0
        run.append(raw)
        size += len(raw)
    if run:
        yield first, run


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside a text, and their number by text; a text of fewer words gives its whole sequence as one."""
    n = len(hashes)
    if not n:
        return hashes, np.zeros(len(counts), np.int64)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    left = ends[doc] - np.arange(n)
    whole = counts[doc] < size
    out = np.zeros(n, np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for k in range(size):
        # A short text's first position takes the words it has.
        term = np.where(left > k, padded[k : k + n], np.uint64(0))
        out = mix(out + term + np.uint64((k + 1) * _BASE & 0xFFFFFFFFFFFFFFFF))
    keep = np.where(whole, left == counts[doc], left >= size)
    return out[keep], np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
