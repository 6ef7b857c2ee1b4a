"""Anchors of a large batch: the same as of single texts, a slice in memory at a time."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from orderlake.llm import common, suffixes


def test_a_batch_of_many_texts_is_worked_on_in_slices():
    rng = random.Random(1)
    texts = [rng.randbytes(rng.randrange(4000)).hex().encode() for _ in range(6000)] + [b"", b"short"]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts, pa.binary())], names=["doc_id", "tie", "text"])
    tracemalloc.start()
    rows, largest = 0, 0
    for found in suffixes._anchor_batches(iter([batch, batch.slice(0, 0)]), 100):
        rows, largest = rows + found.num_rows, max(largest, found.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == sum(len(own[0]) for own in suffixes.anchors(texts))
    assert batch.nbytes > 2e7 and peak < 1.5e8 and largest < 4e6

    few = batch.slice(100, 400)
    found = pa.Table.from_batches(suffixes._anchor_batches(iter([few]), 100))
    at = 0
    for i, (hashes, starts, sizes, digests) in enumerate(suffixes.anchors(texts[100:500])):
        own = found.slice(at, len(hashes))
        at += len(hashes)
        assert set(own["doc_id"].to_pylist()) <= {100 + i}
        for name, want in zip(("anchor", "start", "size", "digest"), (hashes, starts, sizes, digests)):
            assert np.array_equal(own[name].to_numpy().astype(np.uint64), want.astype(np.uint64))
    assert at == found.num_rows


def test_slices_hold_each_row_once():
    texts = [b"abc", None, b"", b"x" * 50, b"de", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    for most in (1, 5, 1000):
        parts = [part.column(0).to_pylist() for part in common.text_runs(batch, 0, most)]
        assert sum(parts, []) == texts and all(parts)
    assert list(common.text_runs(batch.slice(0, 0), 0, 5)) == []
