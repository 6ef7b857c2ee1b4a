"""Word shingles of whole texts as 64-bit hashes, vectorised over runs of texts."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Sums modulo 2**64 differ for different short words, up to chance, but not for long
#: words of a certain structure; words beyond so many bytes are hashed otherwise.
LONG_WORD = 64
#: A run needs about a hundred times as much memory for a moment.
RUN_BYTES = 250_000


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_VALUES = _mix(np.arange(1, 257, dtype=np.uint64))


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > RUN_BYTES:
            yield at, i
            at, held = i, 0
        held += len(text) + 1
    if at < len(texts):
        yield at, len(texts)


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``k`` words, A-Z in
    lower case; with fewer words the whole sequence is one, without words none."""
    for a, b in _runs(texts):
        data = np.frombuffer(b" ".join(texts[a:b]).lower() + b" ", np.uint8)
        blank = _BLANK[data]
        edge = np.flatnonzero(np.diff(blank, prepend=True))
        starts, ends = edge[0::2], edge[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers(_BASE, len(data)), out=sums[1:])
        back = _powers(_INVERSE, len(data))
        words = _mix((sums[ends] - sums[starts]) * back[starts]) if len(starts) else np.zeros(0, np.uint64)
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            digest = blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
            words[i] = np.frombuffer(digest, np.uint64)[0]
        text_ends = np.cumsum(np.fromiter(map(len, texts[a:b]), np.int64, b - a) + 1)
        first = np.searchsorted(starts, text_ends - 1)
        grams = np.zeros(max(len(words) - k + 1, 0), np.uint64)
        for i in range(k):
            grams = grams * _BASE + words[i:i + len(grams)]
        grams = _mix(grams + np.uint64(k))
        at = 0
        for end in first.tolist():
            if end - at >= k:
                yield np.unique(grams[at:end - k + 1])
            elif end > at:
                yield np.frombuffer(blake2b(words[at:end].tobytes(), digest_size=8).digest(), np.uint64)
            else:
                yield np.zeros(0, np.uint64)
            at = end


def set_digest(grams: np.ndarray) -> int:
    return int.from_bytes(blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)
