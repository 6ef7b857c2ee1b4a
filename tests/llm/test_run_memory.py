"""What a task holds of its texts at a time, however many rows come to it."""

import random
import tracemalloc

import pyarrow as pa
import pytest

from orderlake.llm import ngrams
from orderlake.sources.staging import stage

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


class Caught:
    """Gives the function that a step would send to the tasks."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):  # noqa: N802
        return function


def texts_of(n):
    rng = random.Random(3)
    return [rng.randbytes(rng.randrange(5000)).hex() for _ in range(n)]


def test_n_grams_of_a_large_batch_are_asked_for_in_slices():
    texts = texts_of(8000)
    of = pa.array([i % 2 for i in range(len(texts))], pa.int64())
    batch = pa.RecordBatch.from_arrays([of, pa.array(texts)], names=["run", "text"])
    assert batch.nbytes > 3.5e7
    tracemalloc.start()
    found = list(ngrams.asked(Caught())(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6.5e7
    for part in found:
        run, own = part["run"][0].as_py(), part["gram"].to_pylist()
        want = set(ngrams.grams_of(texts[run:400:2], ngrams.ORDER)[0])
        assert set(part["run"].to_pylist()) == {run} and want <= set(own) and len(own) == len(set(own))
    assert sorted(part["run"][0].as_py() for part in found) == [0, 1]


def test_packed_runs_hold_each_row_once():
    texts = ["x" * 3_000_000, "é" * 1_500_000, *texts_of(2000), "short"]
    rows = {name: pa.array(range(len(texts)), pa.int64()) for name in ("doc_id", "tie")}
    of = pa.array([i % 3 for i in range(len(texts))], pa.int64())
    batch = pa.RecordBatch.from_pydict({"run": of, **rows, "text": texts})
    back = []
    for part in ngrams.packed(Caught())(iter([batch, batch.slice(0, 0)])):
        for run, data in zip(part["run"].to_pylist(), part["data"].to_pylist()):
            held = pa.ipc.open_stream(data).read_all().to_pylist()
            assert sum(len(r["text"].encode()) for r in held) <= 2_000_000 or len(held) == 1
            back += [(r["doc_id"], run, r["tie"], r["text"]) for r in held]
    assert sorted(back) == [(i, i % 3, i, t) for i, t in enumerate(texts)]


def test_a_staged_write_bounds_the_batches_that_go_to_python(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    texts = spark.range(3000).selectExpr("id", "repeat(cast(id AS string), 1000) AS text").coalesce(1)
    before = spark.conf.get(BATCH)
    found = stage(texts.mapInArrow(sizes, "n bigint, size bigint"), "sizes", 500_000).collect()
    assert sum(r.n for r in found) == 3000 and max(r.size for r in found) < 600_000
    with pytest.raises(Exception, match="no_such_column"):
        stage(texts.selectExpr("raise_error('no_such_column') AS x"), "broken", 500_000)
    assert spark.conf.get(BATCH) == before
