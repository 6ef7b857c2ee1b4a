"""Packing documents into fixed windows by non-negative least squares."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from string import punctuation
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from orderlake.llm.common import blocks_for, local_table, unit_interval
from orderlake.sources.staging import stage

WINDOW = 2048
#: Lengths count in steps of this many tokens, rounded up: the padding a piece may cost.
STEP = 8
#: Parts of a combination the solver may use.
DEPTH = 3
END_ID = 1
MAX_CACHED = 700_000
TOKENIZER = "word_bpe_49k.json"
_MARKS = punctuation.encode()
#: Bytes of texts whose words are looked up together, and of a batch of texts.
RUN_BYTES = 8_000_000
_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Ids(dict):
    """Ids of a word between blanks as little-endian bytes; the tokenizer never
    joins across ASCII blanks, so a word's ids do not depend on its neighbours.

    A word of letters with ASCII marks behind it is its lower-case form, then the marks.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(c.ids, dtype="<u4") for c in coded]

    def _learn_letters(self, words: list[bytes]) -> None:
        """Lower-case words of letters are one pre-token each, so many are coded
        as one text and told apart by the ids that end a word."""
        runs = [words[i:i + 1000] for i in range(0, len(words), 1000)]
        for run, ids in zip(runs, self._encode([b" ".join(run).decode() for run in runs])):
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(run) or cuts[-1] != len(ids):
                self._learn_each(run)
                continue
            raw, at = ids.tobytes(), 0
            for word, cut in zip(run, (cuts * 4).tolist()):
                self[word] = raw[at:cut]
                at = cut

    def _learn_ascii(self, words: list[bytes]) -> None:
        """Lower-case ASCII words of letters are as the model takes them."""
        split = self.tokenizer.model.tokenize
        for word in words:
            ids = [token.id for token in split(word.decode())]
            self[word] = pack_ids(f"<{len(ids)}I", *ids)

    def _learn_each(self, words: list[bytes]) -> None:
        for word, ids in zip(words, self._encode([word.decode() for word in words])):
            self[word] = ids.tobytes()

    def learn(self, words: Iterable[bytes]) -> None:
        """Make sure that all these words are held."""
        if len(self) > MAX_CACHED:
            self.clear()
        made, plain, letters, others = [], set(), set(), set()
        for raw in words:
            if raw in self:
                continue
            base = raw.rstrip(_MARKS)
            word = base.decode()
            if not word.isalpha() or "Σ" in word:
                others.add(raw)
                continue
            lower = word.lower()
            if not lower.isalpha():
                # Marks of a letter's lower case run on into those behind it.
                others.add(raw)
                continue
            low, mark = lower.encode(), raw[len(base):]
            if low not in self:
                (plain if low.isascii() else letters).add(low)
            if mark and mark not in self:
                others.add(mark)
            if low != raw:
                made.append((raw, low, mark))
        self._learn_ascii(list(plain))
        self._learn_letters(list(letters))
        self._learn_each(list(others))
        for raw, low, mark in made:
            self[raw] = self[low] + self[mark] if mark else self[low]


def _coded(known: _Ids, texts: pa.Array) -> Iterator[bytes]:
    """Ids of each text as little-endian bytes. Of a run of texts, each different
    word is looked up once and its ids are taken for all its places together."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + RUN_BYTES, side="right")))
        words = pc.ascii_split_whitespace(texts.slice(at, stop - at).cast(pa.string(), safe=False))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        known.learn(distinct)
        ids = pa.array([known[word] for word in distinct], pa.large_binary())
        lengths = pc.binary_length(ids).to_numpy(zero_copy_only=False)
        places = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(lengths[places]))
        joined = b"".join(ids.take(coded.indices).buffers()[2:]) if ends[-1] else b""
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        cuts = ends[np.append(0, np.cumsum(counts))].tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield joined[a:b]
        at = stop


def pieces(documents: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Whole windows from a document's start, then what is left of it."""
    path = path or tokenizer_path()
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = _Ids(path), END_ID.to_bytes(4, "little")
        wide = 4 * window
        for batch in batches:
            ids, starts, lengths, sums, totals = [], [], [], [], []
            for doc_id, tokens in zip(batch.column(0).to_pylist(), _coded(known, batch.column(1))):
                tokens += end
                for at in range(0, len(tokens), wide):
                    piece = tokens[at:at + wide]
                    ids.append(doc_id)
                    starts.append(at // 4)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(len(tokens) // 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (ids, starts, lengths, sums, totals)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return rows.mapInArrow(cut, _PIECES)


def combinations(units: int, parts: int, present: list[int]) -> list[tuple[int, ...]]:
    """All ways to fill ``units`` exactly with up to ``parts`` of the present lengths."""
    found, have = [], set(present)

    def add(chosen: tuple, left: int, least: int) -> None:
        if left >= least and left in have:
            found.append((*chosen, left))
        if len(chosen) + 2 <= parts:
            for n in present:
                if n >= least and left - n >= n:
                    add((*chosen, n), left - n, n)

    add((), units, 1)
    return found


def _solve(square: np.ndarray, right: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(square, right)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(square, right, rcond=None)[0]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """Least squares with x >= 0 by active sets (Lawson and Hanson).

    Only the products of active columns are formed: those of all would take the
    square of the number of columns."""
    target = a.T @ b
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    small = 1e-9 * max(1.0, np.abs(target).max(initial=0))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(slope.argmax()) if n else 0
        if not n or slope[best] <= small:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            columns = a[:, at]
            trial = _solve(columns.T @ columns, target[at])
            if (trial > 0).all():
                x[:] = 0
                x[at] = trial
                break
            old = x[at]
            bad = trial <= 0
            step = np.min(old[bad] / np.maximum(old[bad] - trial[bad], 1e-300))
            x[at] = old + step * (trial - old)
            active[at[(x[at] <= 1e-12) | (bad & (old == 0))]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


def plan_windows(counts: dict[int, int], units: int, depth: int = DEPTH) -> list[tuple[dict, int]]:
    """``(units -> how many, repeats)`` so that every counted piece has a place.

    The solver sets how often each exact filling is repeated; rounded down,
    what is left is packed greedily, largest first, whole repeats at a time.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    plan = []

    def use(pattern: tuple, times: int) -> None:
        need = {n: pattern.count(n) for n in set(pattern)}
        times = min([times, *(left.get(n, 0) // k for n, k in need.items())])
        if times > 0:
            plan.append((need, times))
            for n, k in need.items():
                left[n] -= k * times
                if not left[n]:
                    del left[n]

    present = sorted(left)
    patterns = combinations(units, depth, present)
    if patterns:
        row = {n: i for i, n in enumerate(present)}
        a = np.zeros((len(present), len(patterns)))
        for j, pattern in enumerate(patterns):
            for n in pattern:
                a[row[n], j] += 1
        x = nnls(a, np.array([left[n] for n in present], float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 1:
                break
            use(patterns[j], int(x[j] + 1e-6))
    while left:
        sizes = sorted(left, reverse=True)
        pattern, room = [], units
        for n in sizes:
            fit = min(room // n, left[n])
            pattern += [n] * fit
            room -= n * fit
        use(tuple(pattern), min(left[n] // pattern.count(n) for n in set(pattern)))
    return plan


def pack(cut: DataFrame, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """Places for pieces: adds ``sequence_id, offset`` to :func:`pieces`.

    Needs of the driver a histogram of ``window / step`` rows only. A piece's
    rank among those of its length class, by prefix sums over blocks of random
    keys, is its slot in the plan; offsets add up within one sequence.
    """
    spark = cut.sparkSession
    unit = F.ceil(F.col("length") / F.lit(step)).cast("int")
    rows = stage(cut.select("*", unit.alias("unit"), F.monotonically_increasing_id().alias("piece")), "pieces", RUN_BYTES)
    counts = {r.unit: r.n for r in rows.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_windows(counts, -(-window // step))
    width = blocks_for(sum(counts.values()))
    slots, used, first = [], dict.fromkeys(counts, 0), 0
    for need, times in plan:
        for n, k in need.items():
            slots.append((n, used[n], used[n] + k * times, first, k))
            used[n] += k * times
        first += times
    places = local_table(
        spark, slots, "unit int, low bigint, high bigint, first bigint, many bigint"
    )
    blocks = local_table(
        spark, [(n, -(-c // width)) for n, c in counts.items()], "unit int, n_blocks bigint"
    )
    dealt = rows.join(blocks, "unit").withColumn(
        "block", F.floor(unit_interval(F.xxhash64("piece")) * F.col("n_blocks"))
    ).drop("n_blocks")
    before = Window.partitionBy("unit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("unit", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "unit", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranked")
    )
    inner = F.row_number().over(Window.partitionBy("unit", "block").orderBy("piece")) - 1
    ranked = dealt.withColumn("inner", inner).join(starts, ["unit", "block"]).withColumn(
        "rank", F.col("ranked") + F.col("inner")
    )
    placed = ranked.join(
        places.withColumnRenamed("unit", "place"),
        (F.col("unit") == F.col("place")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    ).withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("many")))
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("unit"), "rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("bigint").alias("offset"),
    )


def pack_documents(documents: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    A missing or empty text is the end id alone. A document longer than the
    window is cut at whole windows. Rows that repeat, or share or lack a
    doc_id, are documents of their own; other columns are ignored; an empty
    table gives no rows. The cache of word ids is bounded.
    """
    return pack(pieces(documents, window, path), window)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
