"""Texts as one flat array of code points, for vectorised work on characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def flatten(texts: list[str], before: int, after: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All code points in one array, each text between ``before`` and ``after``
    zeros; where texts start in it, and their lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    pad = before + after
    starts = np.cumsum(lengths + pad) - lengths - after
    out = np.zeros(len(flat) + pad * len(texts), np.uint32)
    if len(flat):
        shift = np.repeat(np.arange(len(texts)) * pad + before, lengths)
        out[np.arange(len(flat)) + shift] = flat
    return out, starts, lengths


def chunks(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters; a longer text is its own run."""
    at, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield at, i
            at, held = i, 0
        held += len(text) + 4
    if at < len(texts):
        yield at, len(texts)
