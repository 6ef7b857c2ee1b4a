"""Aligning the tokens of two tokenizers over the same bytes.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model that
puts a space before each text; both are held against a space and the text. Ends
come from character offsets (A) and from the spans of the encoded pieces (B).
Tokens that end inside a character have no end of their own there: parts of a
multibyte character (A) and byte-fallback pieces (B) are placed by the bytes
they decode to.

Neither tokenizer joins tokens across a space or line end behind a printable ASCII
character, letter or digit, nor across a comma or full stop behind a Latin letter.
A text is coded by such units, and each unit only once while it is held. Units are
checked byte by byte, so a text has tokens only if all of its bytes come back from
both tokenizers.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlake.sources.staging import stage

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters coded at a time; units held by a worker, and links in them.
SLICE_CHARS = 500_000
MAX_HELD = 400_000
MAX_HELD_PAIRS = 2_000_000
#: Pairs of ids (32 bytes each) that may go to every executor.
MAX_SENT_PAIRS = 1_000_000
#: A pair of ids is one number: A's id times this, and B's.
SHIFT = 20
_SAFE, _LATIN = r"[!-~\w]", "A-Za-zÀ-ÖØ-öø-ÿ"
_UNITS = re.compile(rf"(?<={_SAFE})(?=[ \n])|(?<=[{_LATIN}])(?=[,.])")
#: Units that keep their tokens between line ends, so that many are coded at once.
_PLAIN = re.compile(rf"[ \n]?{_SAFE}(?:.*{_SAFE})?", re.S)
UNITS_AT_ONCE = 2000
_CODED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
    "pairs array<bigint>, times array<bigint>"
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones
    for themselves, the others from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def filled(coarse: np.ndarray, sure: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of all tokens: the coarse ones where they are sure, behind those by the
    decoded bytes."""
    decoded = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(sure, np.arange(len(sure)), -1))
    return np.where(last < 0, decoded, coarse[last] + decoded - decoded[last])


class Aligner:
    """Both tokenizers and the units coded so far, numbered as they come."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_alphabet()
        self.a_bytes = {
            i: bytes(map(letters.get, token)) if all(c in letters for c in token) else token.encode()
            for token, i in self.a.get_vocab(with_added_tokens=True).items()
        }
        # U+2581 stands for a space; <0xHH> for a byte.
        self.b_bytes, self.raw = [], []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.raw.append(self.b.is_byte(i))
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.raw[i] else piece.replace("▁", " ").encode())
        self.raw = np.array(self.raw)
        self.b_sizes = np.array(list(map(len, self.b_bytes)))
        self.a_sizes = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.forget()

    def forget(self) -> None:
        self.held: dict[str, int] = {}
        self.texts: list[str] = []
        self.n_a, self.n_b, self.n_links, self.bad = (array("q") for _ in range(4))
        self.starts, self.pairs = array("q"), array("q")

    def _tokens_a(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ends, in bytes, of A's tokens."""
        coded = self.a.encode(text, add_special_tokens=False)
        ids = np.array(coded.ids, np.int64)
        spans = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        letters = np.frombuffer(text.encode("utf-32-le"), "<u4")
        place = np.concatenate(([0], np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF))))
        # A character that the next token shares has not ended yet.
        sure = np.ones(len(ids), bool)
        sure[:-1] = spans[1:, 0] >= spans[:-1, 1]
        return ids, filled(place[spans[:, 1]], sure, self.a_sizes[ids])

    def _tokens_b(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The same of B, which puts a space before a text: before a line end, which
        no longer piece holds, that is a token of its own. Of the byte pieces of a
        character only the last has a span."""
        [coded] = self.b.encode(["\n" + text], return_type="proto")
        flat = np.fromiter(
            chain.from_iterable((p.id, p.begin, p.end) for p in coded.pieces[2:]), np.int64
        ).reshape(-1, 3)
        ids, begin, end = flat.T
        return ids, filled(end - 1, ~(self.raw[ids] & (begin == end)), self.b_sizes[ids])

    def _faithful(self, raw: list[bytes], begin: np.ndarray, tokens: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Which units come back byte by byte from both."""
        good, whole = np.ones(len(raw), bool), b"\n".join(raw)
        for (ids, ends), known in zip(tokens, (self.a_bytes, self.b_bytes)):
            back = list(map(known.__getitem__, ids.tolist()))
            if b"".join(back) != whole:
                first = np.searchsorted(ends, begin, "right").tolist()
                last = np.searchsorted(ends, begin + list(map(len, raw)), "right").tolist()
                good &= [b"".join(back[low:high]) == r for low, high, r in zip(first, last, raw)]
        return good

    def learn(self, units: set[str]) -> None:
        """Make sure that all these units are held."""
        if len(self.held) > MAX_HELD or len(self.pairs) > MAX_HELD_PAIRS:
            self.forget()
        new = [u for u in units if u not in self.held]
        plain = [u for u in new if _PLAIN.fullmatch(u)]
        for low in range(0, len(plain), UNITS_AT_ONCE):
            self._learn(plain[low:low + UNITS_AT_ONCE])
        for unit in set(new).difference(plain):
            self._learn([unit])

    def _learn(self, units: list[str]) -> None:
        """Code units, parted by line ends, as one text."""
        raw, text, n = [u.encode() for u in units], "\n".join(units), len(units)
        size = np.array(list(map(len, raw)))
        begin = np.cumsum(size + 1) - size - 1
        (a, a_end), (b, b_end) = self._tokens_a(text), self._tokens_b(text)
        good = self._faithful(raw, begin, [(a, a_end), (b, b_end)])
        # Line ends between units, and units that do not come back, have no tokens.
        a_unit, b_unit = (np.maximum(np.searchsorted(begin, ends, "left") - 1, 0) for ends in (a_end, b_end))
        of_a, of_b = (good[unit] & (ends <= (begin + size)[unit]) for unit, ends in ((a_unit, a_end), (b_unit, b_end)))
        a, a_unit, a_end, b, b_unit, b_end = a[of_a], a_unit[of_a], a_end[of_a], b[of_b], b_unit[of_b], b_end[of_b]
        cut_a, cut_b = np.flatnonzero(np.isin(a_end, b_end)), np.flatnonzero(np.isin(b_end, a_end))
        groups = np.bincount(a_unit[cut_a], minlength=n)
        texts, a_text, b_text = [], list(map(str, a.tolist())), list(map(str, b.tolist()))
        i = j = 0
        for to_i, to_j in zip((cut_a + 1).tolist(), (cut_b + 1).tolist()):
            if to_i == i + 1 and to_j == j + 1:
                texts.append(f"{a_text[i]}|{b_text[j]}")
            else:
                texts.append(f"{','.join(a_text[i:to_i])}|{','.join(b_text[j:to_j])}")
            i, j = to_i, to_j
        ends = np.cumsum(groups)
        self.held.update(zip(units, range(len(self.texts), len(self.texts) + n)))
        self.texts += [";".join(texts[low:high]) for low, high in zip((ends - groups).tolist(), ends.tolist())]
        self.starts.extend((len(self.pairs) + ends - groups).tolist())
        self.pairs.extend(((a[cut_a] << SHIFT) + b[cut_b]).tolist())
        self.n_links.extend(groups.tolist())
        self.n_a.extend(np.bincount(a_unit, minlength=n).tolist())
        self.n_b.extend(np.bincount(b_unit, minlength=n).tolist())
        self.bad.extend((~good).tolist())

    def code(self, texts: list[str | None], keep_groups: bool) -> list[list]:
        """Columns for a slice of texts, as in ``_CODED``."""
        cut = [_UNITS.split(" " + text) if text else [] for text in texts]
        self.learn({unit for units in cut for unit in units})
        units = np.fromiter(map(self.held.__getitem__, chain.from_iterable(cut)), np.int64)
        bounds = np.cumsum([0, *map(len, cut)])

        def total(values: array) -> np.ndarray:
            sums = np.concatenate(([0], np.cumsum(np.frombuffer(values, np.int64)[units] if len(units) else units)))
            return sums[bounds[1:]] - sums[bounds[:-1]]

        good = total(self.bad) == 0
        counts = [np.where(good, total(v), 0) for v in (self.n_a, self.n_b, self.n_links)]
        whole = [
            ";".join(map(self.texts.__getitem__, units[low:high].tolist())) if ok else ""
            for low, high, ok in zip(bounds.tolist(), bounds[1:].tolist(), good.tolist())
        ]
        pairs, times = self._pairs(units[np.repeat(good, np.diff(bounds))], np.repeat(np.flatnonzero(good), np.diff(bounds)[good]), len(texts))
        digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in whole]
        return [
            counts[0], counts[1], counts[2], counts[2], digests, whole if keep_groups else [None] * len(whole), pairs, times,
        ]

    def _pairs(self, units: np.ndarray, owner: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
        """Linked ids of each row and how often, as lists."""
        if not len(units):
            none = pa.ListArray.from_arrays(pa.array([0] * (rows + 1), pa.int32()), pa.array([], pa.int64()))
            return none, none
        sizes = np.frombuffer(self.n_links, np.int64)[units]
        before = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(np.frombuffer(self.starts, np.int64)[units] - before, sizes)
        owned = (np.repeat(owner, sizes) << (2 * SHIFT)) | np.frombuffer(self.pairs, np.int64)[at]
        found, times = np.unique(owned, return_counts=True)
        bounds = np.searchsorted(found >> (2 * SHIFT), np.arange(rows + 1)).astype(np.int32)
        return (
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(found & ((1 << (2 * SHIFT)) - 1))),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(times.astype(np.int64))),
        )


def aligned(
    documents: DataFrame, path_a: str | None = None, path_b: str | None = None, keep_groups: bool = False
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256``,
    ``groups`` as ``a1,a2|b1;a3|b2,b3`` (NULL unless asked for), and the distinct
    linked ``pairs`` (A's id times 2**20, plus B's) with their ``times``.

    A missing or empty text, or one whose bytes do not come back, has zeros, an
    empty digest and no pairs. Repeated rows stay rows, a NULL ``doc_id`` is kept,
    other columns are ignored, an empty table gives no rows; a long text is coded
    whole, in one task.
    """
    path_a, path_b = path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)
    rows = documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            texts, size, low = batch.column(1), 0, 0
            for i in range(batch.num_rows):
                size += texts[i].as_buffer().size if texts[i].is_valid else 0
                if size >= SLICE_CHARS or i + 1 == batch.num_rows:
                    part = texts.slice(low, i + 1 - low).to_pylist()
                    columns = aligner.code(part, keep_groups)
                    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
                    arrays[5] = arrays[5].cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(low, len(part)), *arrays],
                        names=["doc_id", *(c.split()[0] for c in _CODED.split(", "))],
                    )
                    size, low = 0, i + 1

    return rows.mapInArrow(run, f"doc_id {kind}, {_CODED}")


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, count`` over all rows, and whether the count is the highest of the
    pair's B id (``best``, ties included)."""
    counts = stage(linked.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    b = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.join(most, b == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def agreement(coded: DataFrame, most_sent: int = MAX_SENT_PAIRS) -> DataFrame:
    """``aligned`` rows with ``n_best``, the links whose pair is the commonest of its
    B id over all rows, and ``count_sum``, the counts of all links.

    The counts are sent to the rows while they are at most ``most_sent``; beyond
    that, links and counts are shuffled by pair.
    """
    rows = stage(coded.withColumn("row", F.monotonically_increasing_id()), "coded-documents")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("n")
    )
    counts = stage(pair_counts(links), "best-pairs")
    way = "broadcast" if counts.count() <= most_sent else "merge"
    scored = links.join(counts.hint(way), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    return rows.join(scored, "row", "left").select(
        *[c for c in coded.columns if c not in ("pairs", "times")],
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
    )


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    return agreement(aligned(spark.read.parquet(f"{sf_dir}/documents.parquet"))).drop("groups")
