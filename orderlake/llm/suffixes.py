"""Exact removal of repeated byte strings by merged Burrows-Wheeler transforms.

Every string of ``LENGTH`` bytes has an anchor: the gram whose hash is the least
of all grams in the string. Equal strings have equal anchors at equal places, so
only the strings around anchors that occur twice can repeat, and those
of one anchor can be looked at together. There, equal surroundings are one; the
different ones are dealt into shards, each shard gets its suffix array and its
transform, and the transforms are merged by refining their interleave, a
letter of ten characters a round. After ``LENGTH`` characters the blocks of the
interleave are the intervals of suffixes with that long a common prefix: the
repeated strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlake.llm.common import text_runs
from orderlake.llm.jaccard import _shared
from orderlake.llm.shingles import _BASE, _INVERSE, _VALUES, _mix, _powers, _runs
from orderlake.sources.staging import stage

LENGTH = 100
GRAM = 32
#: Bytes of surroundings a bucket holds, on average, and shards of a bucket.
BUCKET_BYTES = 500_000
SHARDS = 4
#: Bytes of texts a task works on at a time.
TASK_BYTES = 1_000_000
#: Bits of a bitmap (Spark's bitmap functions fix it), bits a document should have
#: in all of them, and how many bitmaps are sent to the texts at most: 32 MB.
BITS, KEY_BITS, MAX_BITMAPS = 32_768, 16, 8_192


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of each run of ``width`` values, by doubling; shorter at the end."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[:-step] = best(out[:-step], out[step:]) if step < len(out) else out[:-step]
        have += step
    return out


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Hashes of each text's anchors, and start, size and digest of their
    surroundings: the bytes of the strings of ``length`` that have this anchor.

    A string's anchor is its gram with the least upper half of the hash, the
    first of several, so every string has one and equal strings the same.
    """
    for a, b in _runs(texts):
        data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        sizes = np.fromiter(map(len, texts[a:b]), np.int64, b - a)
        ends = np.cumsum(sizes)
        n = len(data)
        begins = stops = np.zeros(0, np.int64)
        hashes = digests = np.zeros(0, np.uint64)
        # A string must lie in its text.
        strings = np.flatnonzero(np.repeat(ends, sizes) - np.arange(n) >= length)
        if len(strings):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_VALUES[data] * _powers(_BASE, n), out=sums[1:])
            back = _powers(_INVERSE, n)
            h = _mix((sums[gram:] - sums[:-gram]) * back[:n - gram + 1])
            place = np.uint64(0xFFFFFFFF)
            least = _slide((h & ~place) | np.arange(len(h), dtype=np.uint64), length - gram + 1, np.minimum)[strings]
            new = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
            begins = strings[new]
            stops = strings[np.append(new[1:] - 1, len(strings) - 1)] + length
            hashes = h[(least[new] & place).astype(np.int64)]
            digests = _mix((sums[stops] - sums[begins]) * back[begins])
        spans = stops - begins
        cuts = np.searchsorted(begins, np.concatenate([[0], ends]))
        for i in range(b - a):
            own = slice(cuts[i], cuts[i + 1])
            yield hashes[own], begins[own] - (ends[i] - sizes[i]), spans[own], digests[own]


def _stable(values: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers from 0 on, by rounds of 16 bits."""
    order = np.argsort(values.astype(np.uint16), kind="stable")
    for shift in range(16, int(values.max(initial=0)).bit_length(), 16):
        order = order[np.argsort((values >> shift).astype(np.uint16)[order], kind="stable")]
    return order


def _ranks(values: np.ndarray) -> np.ndarray:
    """The rank, from 0, of each number among the different ones."""
    order = _stable(values)
    ranked = values[order]
    rank = np.empty(len(values), np.int64)
    rank[order] = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))[:len(values)]
    return rank


def step_for(length: int) -> int:
    """Characters taken together: the largest divisor of the length up to 10."""
    return max(d for d in range(1, 11) if length % d == 0)


def letters(strings: list[bytes], step: int) -> tuple[np.ndarray, np.ndarray]:
    """The joined strings, each with an end mark, as one letter a place: the rank,
    from 1, of the ``step`` bytes from there, or 0 where the string ends before;
    and the place within the string."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    data = np.frombuffer(b"\0".join(strings) + b"\0" * step, np.uint8).astype(np.int64)
    n = int(sizes.sum())
    # Up to five bytes are a number; two that may overlap have up to ten.
    have = min(5, step)
    number = np.zeros(n + step - have, np.int64)
    for i in range(have):
        number = number * 256 + data[i:i + len(number)]
    rank = _ranks(number)
    if have < step:
        rank = _ranks(rank[:n] * len(rank) + rank[step - have:])
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = place + step < np.repeat(sizes, sizes)
    return np.where(whole, rank[:n] + 1, 0), place


def suffix_array(letter: np.ndarray, step: int) -> np.ndarray:
    """Order of all suffixes, read ``step`` places a letter, by doubling; those
    too short for a letter come first and all differ."""
    n, short = len(letter), letter == 0
    key = np.where(short, np.cumsum(short), letter + n)
    order = _stable(key)
    key = key[order]
    first = np.append(True, key[1:] != key[:-1])
    # A rank is the slot in which those of equal beginnings start.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    k = step
    while k < n:
        slots = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(slots):
            break
        own = order[slots]
        after = np.where(own + k < n, rank[np.minimum(own + k, n - 1)] + 1, 0)
        key = rank[own] * (n + 1) + after
        new = _stable(key)
        own, key = own[new], key[new]
        fresh = np.append(True, key[1:] != key[:-1])
        order[slots], first[slots] = own, fresh
        rank[own] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))]
        k *= 2
    return order


def shard_transform(letter: np.ndarray, place: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order, and the letter that leads to each: the one
    ``step`` places before, 0 where the string begins after that."""
    order = suffix_array(letter, step)
    before = np.zeros(len(letter), np.int64)
    before[step:] = letter[:-step]
    before[place < step] = 0
    return order, before[order]


def merge_transforms(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of transforms after ``rounds`` letters, and its blocks:
    suffixes of one block agree in so many letters.

    A round sends every position to the suffix one letter longer; stable
    counting by that letter keeps the order found so far. Suffixes shorter than a
    letter sort by shard and place and are blocks of their own.
    """
    chars = np.concatenate(transforms).astype(np.int32)
    n, counts = len(chars), [int((t == 0).sum()) for t in transforms]
    ends = sum(counts)
    interleave = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t) for t in transforms])
    marks = np.repeat(np.arange(len(counts), dtype=np.uint8), counts)
    block = np.zeros(n, np.int32)
    current = np.empty(n, np.int32)
    for _ in range(rounds):
        current[np.argsort(interleave, kind="stable")] = chars
        go = _stable(current)[ends:]
        char, source = current[go], block[go]
        fresh = (char[1:] != char[:-1]) | (source[1:] != source[:-1])
        interleave = np.concatenate([marks, interleave[go]])
        inner = ends + np.cumsum(np.append(0, fresh), dtype=np.int32)[:len(go)]
        block = np.concatenate([np.arange(ends, dtype=np.int32), inner])
        if block[-1] == n - 1:
            break
    return interleave, block


def repeated(strings: list[bytes], length: int = LENGTH, shards: int = SHARDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings and places of every substring of ``length`` that occurs more than
    once, an array pair for all of them; equal ones share ``group``."""
    shards = max(1, min(shards, len(strings)))
    parts = [strings[i::shards] for i in range(shards)]
    step = step_for(length)
    letter, inside = letters([s for part in parts for s in part], step)
    ends = np.cumsum([sum(len(s) + 1 for s in part) for part in parts])[:-1]
    made = [
        shard_transform(own, at, step) for own, at in zip(np.split(letter, ends), np.split(inside, ends))
    ]
    interleave, block = merge_transforms([m[1] for m in made], length // step)
    order = np.argsort(interleave, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.concatenate([m[0] for m in made])
    sizes = np.bincount(block)
    keep = sizes[block] > 1
    group, shard, place = block[keep], interleave[keep], place[keep]
    string, at = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    for s, part in enumerate(parts):
        own = shard == s
        starts = np.cumsum([0] + [len(x) + 1 for x in part])
        index = np.searchsorted(starts, place[own], side="right") - 1
        string[own] = index * shards + s
        at[own] = place[own] - starts[index]
    return string, at, group


def _marked(texts: DataFrame, keys: DataFrame, documents: int) -> DataFrame:
    """The texts with ``held``: whether their document may be among the ``keys``
    (``doc_id, tie``), which is true for all of those and for few others.

    Only bitmaps are sent to the texts: some bits for each of the ``documents``,
    never more than ``MAX_BITMAPS``. Beyond that more texts than needed are held.
    """
    maps = min(MAX_BITMAPS, documents * KEY_BITS // BITS + 1)
    place = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(maps * BITS))
    bitmap, bit = F.floor(place / BITS).alias("map"), place % BITS
    sent = keys.groupBy(bitmap).agg(F.bitmap_construct_agg(bit).alias("bits"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    held = F.coalesce(F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1, F.lit(False))
    joined = texts.withColumn("map", bitmap).join(sent.hint("broadcast"), "map", "left")
    return joined.select(*texts.columns, held.alias("held"))


def _texts(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tie"), text.cast("binary").alias("text")
    )


def _anchor_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for part in (part for batch in batches for part in text_runs(batch, 2, TASK_BYTES)):
        found = list(anchors(part.column(2).to_pylist(), length))
        row = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
        anchor, start, size, digest = (np.concatenate(x) for x in zip(*found))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchor.view(np.int64)), part.column(0).take(row), part.column(1).take(row),
                pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(digest.view(np.int64)),
            ], names=["anchor", "doc_id", "tie", "start", "size", "digest"],
        )


def _anchored(texts: DataFrame, length: int) -> DataFrame:
    """``anchor, doc_id, tie, start, size, digest`` of each anchor's surroundings."""

    return texts.where(F.octet_length("text") >= length).mapInArrow(
        lambda batches: _anchor_batches(batches, length),
        "anchor bigint, doc_id bigint, tie bigint, start int, size int, digest bigint"
    )


def _with_bytes(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``anchor, doc_id, tie, start, around``: the bytes of some surroundings."""
    here = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t"))
    around = F.substring("text", F.col("start") + 1, F.col("size"))
    return texts.join(places.withColumnsRenamed({"doc_id": "d", "tie": "t"}), here).select(
        "anchor", "doc_id", "tie", "start", around.alias("around")
    )


def _runs_of(batch: pd.DataFrame, length: int) -> pd.DataFrame:
    """Ranges of bytes to remove from one bucket of different surroundings."""
    batch = batch.sort_values(["doc_id", "tie", "start"], na_position="first", kind="stable").reset_index(drop=True)
    string, at, group = repeated(batch.around.tolist(), length)
    place = batch.start.to_numpy()[string] + at
    document = pd.factorize(pd.MultiIndex.from_frame(batch[["doc_id", "tie"]].fillna({"doc_id": -2**63})))[0][string]
    order = np.lexsort((place, document, group))
    group, document, place, string = group[order], document[order], place[order], string[order]
    first = np.append(True, group[1:] != group[:-1])
    # The same place of a document, seen from two anchors, is one occurrence.
    lead = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    later = (document != document[lead]) | (place != place[lead])
    found = pd.DataFrame({"row": string[later], "document": document[later], "start": place[later]})
    found = found.drop_duplicates(["document", "start"]).sort_values(["document", "start"])
    new = (found.document != found.document.shift()) | (found.start != found.start.shift() + 1)
    runs = found.groupby(new.cumsum()).agg(row=("row", "first"), start=("start", "min"), stop=("start", "max"))
    out = batch.loc[runs.row, ["doc_id", "tie"]].reset_index(drop=True)
    out["start"], out["stop"] = runs.start.to_numpy(), runs.stop.to_numpy() + length
    return out


def repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, tie, start, stop``: ranges that earlier strings cover."""
    texts = _texts(documents)
    size = F.octet_length("text")
    keys = texts.where(size >= length).select("doc_id", "tie", F.sha2("text", 256).alias("digest"), size.alias("size"))
    keys = stage(keys.distinct(), "text-digests")
    firsts = keys.groupBy("digest").agg(
        F.min(F.struct("doc_id", "tie")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").select("digest", "first")
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tie") == F.col("first.tie"))
    keys = stage(
        keys.join(firsts, "digest", "left")
        .select("doc_id", "tie", "size", (F.col("first").isNotNull() & ~own).alias("copy")), "copies",
    )
    copies = keys.where("copy").select("doc_id", "tie", F.lit(0).alias("start"), F.col("size").alias("stop"))
    n_documents = keys.count()
    # A copy that is held all the same is covered again, anchor by anchor.
    once = _marked(texts, keys.where("NOT copy"), n_documents).where("held")
    listed = _anchored(once, length).repartition("anchor").sortWithinPartitions("anchor")
    around = stage(_shared(listed), "shared-anchors")

    same = around.groupBy("anchor", "digest").agg(
        F.min(F.struct("doc_id", "tie", "start", "size")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    same = stage(same, "different-surroundings")
    again = same.where("n > 1").select(F.col("anchor").alias("a"), F.col("digest").alias("g"), "first")
    here = F.struct("doc_id", "tie", "start", "size")
    covered = around.join(
        again, (F.col("anchor") == F.col("a")) & (F.col("digest") == F.col("g"))
    ).where(~here.eqNullSafe(F.col("first"))).select(
        "doc_id", "tie", "start", (F.col("start") + F.col("size")).alias("stop")
    )
    several = same.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    chosen = stage(same.join(several, "anchor", "left_semi").select("anchor", "first.*"), "chosen-surroundings")
    # Rows may repeat; their texts then bring the same bytes again.
    texts = _marked(texts, chosen, n_documents).where("held")
    different = stage(_with_bytes(texts, chosen).dropDuplicates(["anchor", "doc_id", "tie", "start"]), "compared-surroundings")
    total = different.agg(F.sum(F.octet_length("around"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")
    found = different.select(bucket, "doc_id", "tie", "start", "around").groupBy("bucket").applyInPandas(
        lambda key, batch: _runs_of(batch, length), "doc_id bigint, tie bigint, start int, stop int"
    )
    return copies.unionByName(covered).unionByName(found)


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for each row, ``kept`` the
    bytes that stay.

    A byte goes when a string of ``length`` bytes over it also starts earlier:
    in a smaller doc_id, or earlier in the same document. A missing text is
    empty, a missing doc_id the smallest; of different texts with one doc_id,
    the one with the smaller hash is earlier; rows with the same doc_id and text
    are one document and get one result each. Other columns are ignored; an
    empty table gives no rows.
    """
    spans = stage(repeats(documents, length), "repeats").groupBy(
        F.col("doc_id").alias("d"), F.col("tie").alias("t")
    ).agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    spans = stage(spans, "repeated-spans")
    texts = _marked(_texts(documents), spans.select(F.col("d").alias("doc_id"), F.col("t").alias("tie")), spans.count())
    here = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t"))
    found = texts.where("held").join(spans, here, "left").select("doc_id", "text", "spans")
    whole = texts.where("NOT held").select("doc_id", "text", F.lit(None).cast(found.schema["spans"].dataType).alias("spans"))
    rows = whole.unionByName(found)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in text_runs(whole, 1, TASK_BYTES)):
            sizes, removed, runs, kept = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts, at, n = [], 0, 0
                for span in spans or ():
                    start, stop = span["start"], span["stop"]
                    if start > at or not n:
                        parts.append(text[at:start])
                        n += 1
                    at = max(at, stop)
                parts.append(text[at:])
                left = b"".join(parts)
                sizes.append(len(text))
                removed.append(len(text) - len(left))
                runs.append(n)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return rows.mapInArrow(
        strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def op5_repeats(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
