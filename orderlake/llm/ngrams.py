"""Kneser-Ney probabilities of character n-grams, by sharded joins.

N-grams are strings of code points as they are. Counts, contexts and back-off
weights stay tables dealt by n-gram; the n-grams of the documents are joined
with them order by order. Documents come in runs, and a run asks for each of its
n-grams once: their probabilities come back to the run, whose texts are then summed
document by document. No table is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderlake.llm.characters import chunks, flatten
from orderlake.llm.common import text_runs
from orderlake.sources.staging import stage

ORDER = 4
#: Without any discount, what a context has not met yet would be impossible.
LEAST_DISCOUNT = 0.1
#: Characters looked at together, and characters of a run; a longer text is one.
CHUNK = 500_000
RUN_CHARS = 30_000_000
#: Bytes of texts that a task takes from a batch at a time, and of a batch.
SLICE_BYTES = 2_000_000
BATCH_BYTES = 4_000_000


def grams_of(texts: list[str], order: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct n-grams; for every place of the texts, and the end of each, the
    number of the n-gram that ends there; and how many places each text has."""
    flat, starts, lengths = flatten(texts, order - 1, 1)
    used = np.zeros(int(flat.max(initial=0)) + 1, bool)
    used[flat] = True
    points = np.flatnonzero(used)
    rank = np.zeros(len(used), np.int64)
    rank[points] = np.arange(len(points))
    symbols, sizes = rank[flat], lengths + 1
    ends = np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    codes = symbols[ends]
    for back in range(1, order):
        # Codes beyond 63 bits are numbered anew; either way they stay exact.
        if int(codes.max()) + 1 > 2**62 // len(points):
            codes = np.unique(codes, return_inverse=True)[1]
        codes = codes + (int(codes.max()) + 1) * symbols[ends - back]
    _, at, number = np.unique(codes, return_index=True, return_inverse=True)
    windows = flat[ends[at][:, None] + np.arange(1 - order, 1)]
    joined = windows.astype("<u4").tobytes().decode("utf-32-le")
    return [joined[i:i + order] for i in range(0, len(joined), order)], number, sizes


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    return (part for batch in batches for part in text_runs(batch, column, SLICE_BYTES))


def count(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n`` over a column ``text``; missing and empty texts have none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, 0):
            rows = part.column(0).to_pylist()
            for a, b in chunks(rows, CHUNK):
                grams, number, _ = grams_of(rows[a:b], order)
                n = np.bincount(number, minlength=len(grams))
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n)], names=["gram", "n"])

    parts = texts.where(F.length("text") > 0).select("text").mapInArrow(read, "gram string, n bigint")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def in_runs(documents: DataFrame, run_chars: int) -> DataFrame:
    """Texts with the ``run`` they belong to: a partition of the input, or, of one with
    more than ``run_chars`` characters, the rows of a hash. The same rows come in the
    same runs whenever the input is read; a run that differs is found when summed."""
    part = F.spark_partition_id()
    texts = documents.where(F.length("text") > 0).select("doc_id", "tie", "text")
    sizes = texts.groupBy(part.alias("part")).agg(F.sum(F.length("text")).alias("chars"))
    most = sizes.agg(F.max("chars")).first()[0] or 0
    pieces = max(1, -(-most // run_chars))
    piece = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(pieces))
    return texts.withColumn("run", part.cast("bigint") * pieces + piece)


def asked(runs: DataFrame, order: int = ORDER) -> DataFrame:
    """``run, gram``, the distinct n-grams of each run."""
    return runs.select("run", "text").mapInArrow(
        lambda batches: _asked_batches(batches, order), "run bigint, gram string"
    )


def _asked_batches(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    found: dict[int, set[str]] = {}
    for part in _slices(batches, 1):
        texts, of = part.column(1).to_pylist(), part.column(0).to_numpy()
        for run in np.unique(of).tolist():
            own = [texts[i] for i in np.flatnonzero(of == run)]
            for a, b in chunks(own, CHUNK):
                found.setdefault(run, set()).update(grams_of(own[a:b], order)[0])
    for run in list(found):
        grams = found.pop(run)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(grams), run)), pa.array(list(grams))], names=["run", "gram"]
        )


def packed(runs: DataFrame) -> DataFrame:
    """``run, data``: compressed batches of a run's ``doc_id, tie, text``, as texts
    are moved to their probabilities once."""
    return runs.select("run", "doc_id", "tie", "text").mapInArrow(_packed_batches, "run bigint, data binary")


def _packed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for part in _slices(batches, 3):
        of = part.column(0).to_numpy()
        for run in np.unique(of).tolist():
            own = part.filter(pa.array(of == run)).select(["doc_id", "tie", "text"])
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, own.schema, options=options) as writer:
                writer.write_batch(own)
            yield pa.RecordBatch.from_pydict({"run": [run], "data": [out.getvalue().to_pybytes()]})


def summed(runs: DataFrame, logs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id, tie, nats, chars`` from the texts of each run and ``run, gram, log``."""

    def add(texts: pa.Table, known: pa.Table) -> pa.Table:
        log = dict(zip(known.column("gram").to_pylist(), known.column("log").to_pylist()))
        found = [_nothing]
        for data in texts.column("data"):
            held = pa.ipc.open_stream(data.as_buffer()).read_all()
            rows = held.column("text").to_pylist()
            nats, chars = [], []
            for a, b in chunks(rows, CHUNK):
                grams, number, sizes = grams_of(rows[a:b], order)
                try:
                    each = np.array([log[g] for g in grams])[number]
                except KeyError as error:
                    raise ValueError("a run of documents was read differently the second time") from error
                nats.append(-np.add.reduceat(each, np.cumsum(sizes) - sizes))
                chars.append(sizes)
            found.append(pa.table([
                held.column("doc_id"), held.column("tie"), np.concatenate(nats), np.concatenate(chars),
            ], schema=_nothing.schema))
        return pa.concat_tables(found)

    _nothing = pa.schema([
        ("doc_id", pa.int64()), ("tie", pa.int64()), ("nats", pa.float64()), ("chars", pa.int64())
    ]).empty_table()
    return packed(runs).groupBy("run").cogroup(logs.groupBy("run")).applyInArrow(
        add, "doc_id bigint, tie bigint, nats double, chars bigint"
    )


def _suffix(order: int) -> Column:
    return F.substring("gram", 2, order - 1)


class Model:
    """Staged counts of every order: n-grams of the text, then of how many
    characters precede each shorter one."""

    def __init__(self, texts: DataFrame, order: int = ORDER):
        self.order, self.counts = order, {order: stage(count(texts, order), f"grams-{order}", BATCH_BYTES)}
        for n in range(order, 1, -1):
            fewer = self.counts[n].groupBy(_suffix(n).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
            self.counts[n - 1] = stage(fewer, f"grams-{n - 1}")
        self.symbols = self.counts[1].count()

    def _discount(self, n: int) -> Column:
        exact = [F.count_if(F.col("n") == i) for i in range(1, 5)]
        t1, t2, t3, t4 = (float(v or 0) for v in self.counts[n].agg(*exact).first())
        y = t1 / (t1 + 2 * t2) if t1 else 0.0
        off = [
            min(max(i - (i + 1) * y * more / have, LEAST_DISCOUNT), i) if have and y else 0.5
            for i, have, more in ((1, t1, t2), (2, t2, t3), (3, t3, t4))
        ]
        return F.when(F.col("n") == 1, off[0]).when(F.col("n") == 2, off[1]).otherwise(off[2])

    def probabilities(self, grams: DataFrame, n: int | None = None) -> DataFrame:
        """``gram, p`` of distinct n-grams ``gram``: how likely the last character
        is after the others. All characters without counts are one."""
        n = n or self.order
        context = F.substring("gram", 1, n - 1)
        rows = self.counts[n].select("gram", "n", self._discount(n).alias("d"), context.alias("context"))
        contexts = rows.groupBy("context").agg(
            F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("rest")
        )
        own = rows.select(F.col("gram").alias("known"), (F.col("n") - F.col("d")).alias("left"))
        asked = grams.select("gram", context.alias("c")).join(own, F.col("gram") == F.col("known"), "left")
        asked = asked.join(contexts, F.col("c") == F.col("context"), "left")
        seen = F.coalesce(F.col("left") / F.col("total"), F.lit(0.0))
        rest = F.coalesce("rest", F.lit(1.0))
        if n == 1:
            return asked.select("gram", (seen + rest / F.lit(self.symbols + 1.0)).alias("p"))
        lower = self.probabilities(stage(grams.select(_suffix(n).alias("gram")).distinct(), f"asked-{n - 1}"), n - 1)
        lower = lower.select(F.col("gram").alias("shorter"), F.col("p").alias("p_lower"))
        mixed = asked.join(lower, _suffix(n) == F.col("shorter"))
        return stage(mixed.select("gram", (seen + rest * F.col("p_lower")).alias("p")), f"probabilities-{n}")


def score(documents: DataFrame, model: Model, run_chars: int = RUN_CHARS) -> DataFrame:
    """``doc_id, tie, nats, chars`` of ``doc_id, tie, text``, once for equal pairs;
    texts that are missing or empty are left out."""
    runs = in_runs(documents, run_chars)
    grams = stage(asked(runs, model.order), "run-grams", BATCH_BYTES)
    logs = model.probabilities(stage(grams.select("gram").distinct(), f"asked-{model.order}"))
    logs = logs.select(F.col("gram").alias("known"), F.ln("p").alias("log"))
    told = grams.join(logs, F.col("gram") == F.col("known")).select("run", "gram", "log")
    scored = summed(runs, told, model.order)
    return scored.groupBy("doc_id", "tie").agg(F.min("nats").alias("nats"), F.min("chars").alias("chars"))
