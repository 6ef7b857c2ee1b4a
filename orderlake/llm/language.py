"""Language ID: script ranges narrow the candidates of a word, and Viterbi over
per-word scores with a switching penalty labels spans of mixed text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlake.llm.characters import chunks, flatten

#: Letters outside these ranges share one script. Fixed values (Unicode blocks).
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("han", 0x20000, 0x3134F),
]
FEATURES = 1 << 16
N_SCRIPTS = 32
#: Share of a language's letters a script needs to make it a candidate there.
SCRIPT_SHARE = 0.005
#: What a change of language costs, in nats.
SWITCH = 12.0
SMOOTH = 0.05
CELLS = 12_000_000
UNKNOWN = "und"


def script_table() -> np.ndarray:
    """Script number per code point; 0 where it is no letter."""
    letters = np.fromiter(
        (unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000
    )
    scripts = np.ones(0x110000, np.uint8)
    names = list(dict.fromkeys(name for name, _, _ in SCRIPTS))
    for name, first, last in SCRIPTS:
        scripts[first:last + 1] = names.index(name) + 2
    return np.where(letters, scripts, 0).astype(np.uint8)


def _lower(text: str) -> str:
    """Lower case of the same length, so that places in it are places in the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[:1] for c in text)


class _Words:
    """Words of a run of texts: letter runs, with hashed trigrams as features."""

    def __init__(self, texts: list[str], table: np.ndarray):
        flat, starts, lengths = flatten([_lower(t) for t in texts], 1, 2)
        scripts = table[flat]
        letter = scripts > 0
        codes = np.where(letter, flat, 0).astype(np.uint32)
        before = np.zeros(len(codes), np.uint32)
        before[1:] = codes[:-1]
        two = np.zeros(len(codes), np.uint32)
        two[2:] = np.where(before[2:] > 0, codes[:-2], 0)
        used = np.flatnonzero(letter | (before > 0))
        mixed = (two * np.uint32(0x9E3779B1)) ^ (before * np.uint32(0x85EBCA77) + codes * np.uint32(0xC2B2AE3D))
        mixed ^= mixed >> np.uint32(15)
        self.features = ((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(16))[used]
        first = letter & (before == 0)
        at = np.flatnonzero(first)
        #: Where words start among the features, in the flat text and in their text.
        self.starts = np.searchsorted(used, at)
        after = np.append(self.starts[1:], len(used))
        self.letters = after - self.starts - 1
        self.script = scripts[at]
        self.text = np.searchsorted(starts, at, side="right") - 1
        self.begin = at - starts[self.text] if len(at) else at
        self.counts = np.bincount(self.text, minlength=len(texts))


def count_features(rows: DataFrame) -> DataFrame:
    """``lang, feature, n`` from ``lang, text``; scripts count as features
    beyond the hashed ones, by letters."""
    table = rows.sparkSession.sparkContext.broadcast(script_table())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = (batch.column(i).to_pylist() for i in (0, 1))
            for lang in sorted(set(langs)):
                own = [t for t, name in zip(texts, langs) if name == lang]
                sums = np.zeros(FEATURES + N_SCRIPTS, np.int64)
                for a, b in chunks(own, CELLS // 4):
                    words = _Words(own[a:b], table.value)
                    sums[:FEATURES] += np.bincount(words.features, minlength=FEATURES)
                    sums[FEATURES:] += np.bincount(
                        words.script, weights=words.letters, minlength=N_SCRIPTS
                    ).astype(np.int64)
                seen = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(sums[seen])],
                    names=["lang", "feature", "n"],
                )

    parts = rows.mapInArrow(count, "lang string, feature int, n bigint")
    return parts.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities of features per language, and each script's candidates."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        grams, scripts = counts[:, :FEATURES], counts[:, FEATURES:]
        total = grams.sum(axis=1, keepdims=True)
        self.logs = np.log((grams + SMOOTH) / (total + SMOOTH * FEATURES)).T.astype(np.float32).copy()
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.candidates = (share >= SCRIPT_SHARE).T.copy()
        self.candidates[~self.candidates.any(axis=1)] = True


def fit(rows: DataFrame) -> Model | None:
    """A model of all texts by language; None without any. Languages are a
    closed set: the driver holds one row of counts (512 KB) for each."""
    held = count_features(rows.where("lang IS NOT NULL AND text IS NOT NULL")).toArrow()
    langs = sorted(set(held.column(0).to_pylist()))
    if not langs:
        return None
    counts = np.zeros((len(langs), FEATURES + N_SCRIPTS))
    row = {lang: i for i, lang in enumerate(langs)}
    at = np.fromiter((row[x] for x in held.column(0).to_pylist()), np.int64, held.num_rows)
    counts[at, held.column(1).to_numpy()] = held.column(2).to_numpy()
    return Model(langs, counts)


def word_scores(words: _Words, model: Model) -> np.ndarray:
    sums = np.add.reduceat(model.logs[words.features], words.starts, axis=0)
    sums[~model.candidates[words.script]] = -1e4
    return sums


def _single(scores: np.ndarray, counts: np.ndarray, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """The best single language per text, and where no change can pay: no run of
    words gains more than a switch over it, none at an end more than half."""
    starts = np.cumsum(counts) - counts
    total = np.add.reduceat(scores, starts, axis=0)
    best = total.argmax(axis=1)
    text = np.repeat(np.arange(len(counts)), counts)
    gain = scores.astype(np.float64) - scores[np.arange(len(text)), best[text]][:, None]
    upto = np.cumsum(gain, axis=0)
    base = upto[starts] - gain[starts]
    upto -= base[text]
    before = upto - gain
    apart = text[:, None] * (2.0 * np.abs(before).max(initial=0) + 1.0)
    least = np.minimum.accumulate(before - apart, axis=0) + apart
    run = np.maximum.reduceat(upto - least, starts, axis=0)
    head = np.maximum.reduceat(upto, starts, axis=0)
    tail = upto[starts + counts - 1] - np.minimum.reduceat(before, starts, axis=0)
    fine = (run <= switch) & (head <= switch / 2) & (tail <= switch / 2)
    return best, fine.all(axis=1)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language per word; texts of one or more words lie one after the
    other. All texts advance together, a word at a time."""
    order = np.argsort(-counts, kind="stable")
    lengths, at = counts[order], (np.cumsum(counts) - counts)[order]
    live = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    stayed = np.ones(scores.shape, bool)
    best_before = np.zeros(len(scores), np.int32)
    state = np.empty(len(scores), np.int32)
    value = scores[at].astype(np.float64)
    last = np.empty(len(counts), np.int32)
    for t in range(1, lengths[0]):
        n = live[t]
        if n < len(value):
            last[n:len(value)] = value[n:].argmax(axis=1)
            value = value[:n]
        best = value.argmax(axis=1)
        top = value[np.arange(n), best] - switch
        stay = value >= top[:, None]
        here = at[:n] + t
        value = np.where(stay, value, top[:, None]) + scores[here]
        stayed[here], best_before[here] = stay, best
    last[:len(value)] = value.argmax(axis=1)
    now = last
    state[at + lengths - 1] = last
    for t in range(lengths[0] - 1, 0, -1):
        n = live[t]
        here = at[:n] + t
        now[:n] = np.where(stayed[here, now[:n]], now[:n], best_before[here])
        state[here - 1] = now[:n]
    return state


def label_words(words: _Words, model: Model, switch: float = SWITCH) -> np.ndarray:
    scores = word_scores(words, model)
    filled = words.counts[words.counts > 0]
    best, fine = _single(scores, filled, switch)
    labels = np.repeat(best, filled).astype(np.int32)
    if not fine.all():
        mixed = np.repeat(~fine, filled)
        labels[mixed] = viterbi(scores[mixed], filled[~fine], switch)
    return labels


_OUT = "lang_pred string, score double, spans array<struct<start:int,stop:int,lang:string>>"


def identify(documents: DataFrame, model: Model | None, key: str = "doc_id", switch: float = SWITCH) -> DataFrame:
    """``key, lang_pred, score, spans`` for each row.

    ``spans`` are runs of words of one language, in characters of the text
    (``start`` counts, ``stop`` does not). ``lang_pred`` has the most letters,
    the first by name of equals; ``score`` is its share of the letters. A text
    that is missing or has no letters is ``und`` with score 0, as is every text
    without a model. Repeated rows are labelled alike, other columns ignored,
    an empty table gives no rows.
    """
    rows = documents.select(F.col(key).alias("key"), "text")
    context = documents.sparkSession.sparkContext
    held, table = context.broadcast(model), context.broadcast(script_table())
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())])

    def label(texts: list[str]):
        known = held.value
        words = _Words(texts, table.value)
        names, shares, spans = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
        if known is None or not len(words.starts):
            return names, shares, spans
        labels = label_words(words, known, switch)
        n = len(known.langs)
        letters = np.bincount(
            words.text * n + labels, weights=words.letters, minlength=len(texts) * n
        ).reshape(-1, n)
        best = letters.argmax(axis=1)
        there = np.flatnonzero(words.counts)
        shares[there] = letters[there, best[there]] / letters[there].sum(axis=1)
        for i in there:
            names[i] = known.langs[best[i]]
        new = np.ones(len(labels), bool)
        new[1:] = (labels[1:] != labels[:-1]) | (words.text[1:] != words.text[:-1])
        first = np.flatnonzero(new)
        final = np.append(first[1:], len(labels)) - 1
        stops = words.begin[final] + words.letters[final]
        for i, start, stop, lang in zip(words.text[first], words.begin[first], stops, labels[first]):
            spans[i].append({"start": start, "stop": stop, "lang": known.langs[lang]})
        return names, shares, spans

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = CELLS // max(4, len(held.value.langs) if held.value else 4)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts, most):
                names, shares, spans = label(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array(names, pa.string()),
                        pa.array(shares, pa.float64()), pa.array(spans, pa.list_(span)),
                    ],
                    names=["key", "lang_pred", "score", "spans"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(read, f"key {kind}, {_OUT}").withColumnRenamed("key", key)


def held_out(doc_id):
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))
    return F.coalesce(remainder == 2, F.lit(False))


def op4_language(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = documents.where(~held_out(F.col("doc_id"))).select("lang", "text")
    return identify(documents, fit(learned)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
