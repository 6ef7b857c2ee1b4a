"""N-gram Jaccard join and its components, by relations between sets.

Sets that are equal are one. Rare tokens first, each set is listed under the
tokens of its prefix; linked sets share one. Two rounds compare each set with one
leader of its lists only, the likeliest one not joined to it yet, and join what
links. A list is led by the set with the fewest rarer tokens: of a family of near
copies, that with the fewest edits of its own, to which most others link. The last
round goes through the lists again, in blocks that are skipped by size and
position, for pairs not joined yet that share enough of their prefixes; what is
known of their leaders joins or rules out most of them, and only the others are
compared themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderlake.llm.common import MAX_SENT_IDS, text_runs, unused, with_ids
from orderlake.llm.components import components
from orderlake.llm.shingles import set_digest, shingle_sets
from orderlake.sources.staging import batches_of, stage

#: Tokens are counted in so many cells by hash, and sort by their cell's count and
#: then by hash. Any order of all tokens gives whole results; this one is as fine at
#: every size, and its table (4 bytes a cell) does not grow with the input.
CELLS = 1 << 21
CELL_BLOCK = 1024
BLOCK = 64
#: Bytes of texts a task works on at a time.
TASK_BYTES = 2_000_000
#: Bytes of a batch of texts.
BATCH_BYTES = 4_000_000
#: Pairs a task sums before it sends them on.
HELD_PAIRS = 200_000
#: 64-bit words of a set's parity bits: whether a bucket of hashes holds an odd
#: number of its tokens.
PARITY_WORDS = 8
_PARITY = [f"p{i}" for i in range(PARITY_WORDS)]
#: Tokens before its own that an entry of the last round knows.
EARLIER = 4
_EARLIER = [f"before{i}" for i in range(1, EARLIER + 1)]


def _parity(grams: np.ndarray) -> np.ndarray:
    buckets = 64 * PARITY_WORDS
    held = np.bincount((grams % np.uint64(buckets)).astype(np.int64), minlength=buckets)
    return np.packbits((held & 1).astype(np.uint8)).view(np.int64)


def _sets(documents: DataFrame, k: int) -> DataFrame:
    """Kind 0: ``doc_id, mark, sig, n`` and parity bits of each row. Kind 1: a
    block of cells (its number as ``n``) and how many tokens of a task fall in each."""
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )

    names = ["kind", "doc_id", "mark", "sig", "n", *_PARITY, "cells"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for batch in _text_runs(batches, 2):
            sets = list(shingle_sets(batch.column(2).to_pylist(), k))
            size = len(sets)
            if not size:
                continue
            bits = np.stack([_parity(s) for s in sets], axis=1)
            counts += np.bincount(_cells(np.concatenate(sets)), minlength=CELLS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(size, np.int8)), batch.column(0), batch.column(1),
                    pa.array([set_digest(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, bits),
                    pa.nulls(size, pa.binary()),
                ], names=names,
            )
        blocks = counts.reshape(-1, CELL_BLOCK)
        held = np.flatnonzero(blocks.any(axis=1))
        empty = pa.nulls(len(held), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(held), np.int8)), empty, empty, empty, pa.array(held)]
            + [empty] * PARITY_WORDS + [pa.array([blocks[b].tobytes() for b in held], pa.binary())],
            names=names,
        )

    kinds = ["kind byte", *(f"{c} bigint" for c in names[1:-1]), "cells binary"]
    with batches_of(documents.sparkSession, BATCH_BYTES):
        return stage(rows.mapInArrow(build, ", ".join(kinds)), "sets")


def _text_runs(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    return (part for batch in batches for part in text_runs(batch, column, TASK_BYTES))


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _cell_counts(base: DataFrame) -> np.ndarray:
    """How many tokens of all rows fall in each cell: summed per block of cells by
    tasks that hold one table each, and gathered as one table of fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                more = np.frombuffer(cells.as_buffer(), np.int64)
                sums[block] = sums[block] + more if block in sums else more
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([c.tobytes() for c in sums.values()], pa.binary())],
            names=["n", "cells"],
        )

    parts = base.where("kind = 1").select("n", "cells").repartition("n")
    counts = np.zeros((CELLS // CELL_BLOCK, CELL_BLOCK), np.int64)
    found = parts.mapInArrow(add, "n bigint, cells binary").toArrow()
    for block, cells in zip(found.column("n").to_pylist(), found.column("cells")):
        counts[block] = np.frombuffer(cells.as_buffer(), np.int64)
    return np.minimum(counts.ravel(), 2**31 - 1).astype(np.int32)


def _entries(documents: DataFrame, k: int, counts, percent: int) -> DataFrame:
    """``token, sig, n, pos`` for the prefix of each row's set."""
    rows = documents.select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _text_runs(batches, 0):
            tokens, sigs, sizes, places = [], [], [], []
            for grams in shingle_sets(batch.column(0).to_pylist(), k):
                n = len(grams)
                prefix = n - -(-percent * n // 100) + 1 if n else 0
                rarest = np.argsort(counts.value[_cells(grams)], kind="stable")[:prefix]
                tokens.append(grams[rarest])
                sigs.append(set_digest(grams))
                sizes.append(n)
                places.append(prefix)
            pos = np.concatenate([np.arange(p, dtype=np.int32) for p in places])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(sigs, np.int64), places)),
                    pa.array(np.repeat(np.array(sizes, np.int32), places)), pa.array(pos),
                ], names=["token", "sig", "n", "pos"],
            )

    return rows.mapInArrow(build, "token bigint, sig bigint, n int, pos int")


def _lists(entries: DataFrame, *order: str) -> DataFrame:
    """Entries with a token's list in one partition, sorted."""
    return entries.repartition("token").sortWithinPartitions("token", *order)


def _shared(listed: DataFrame) -> DataFrame:
    """The entries of tokens that more than one entry holds."""
    return listed.mapInArrow(_shared_batches, listed.schema)


def _distinct_shared(listed: DataFrame) -> DataFrame:
    """:func:`_shared` of entries sorted by ``token, n, sig``, equal ones counted once."""
    return listed.mapInArrow(lambda batches: _shared_batches(_distinct_batches(batches)), listed.schema)


def _shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, waiting = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        token = batch.column(0).to_numpy()
        same = token[1:] == token[:-1]
        keep = np.append(same, False) | np.insert(same, 0, token[0] == last)
        if waiting is not None and token[0] == last:
            yield waiting
        last = token[-1]
        waiting = None if keep[-1] else batch.slice(batch.num_rows - 1)
        yield batch.filter(pa.array(keep))


def _distinct_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        token, sig = (batch.column(i).to_numpy() for i in range(2))
        same = (token[1:] == token[:-1]) & (sig[1:] == sig[:-1])
        yield batch.filter(pa.array(np.insert(~same, 0, (token[0], sig[0]) != last)))
        last = token[-1], sig[-1]


def _with_leaders(listed: DataFrame, percent: int, depth: int) -> DataFrame:
    """Pairs of a list's leader and a set not joined to it. Lists are sorted by
    ``pos``: the first entry leads, as nothing of its set is rarer than what the
    others share with it, then the first one of a size that cannot link with any
    leader yet. A leader is followed by up to ``depth - 1`` ones of its size that
    are in other components, and the last of them leads what comes after."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, leaders = None, []
        for batch in batches:
            pairs = Counter()
            columns = (batch.column(i).to_pylist() for i in range(4))
            for t, sig, n, comp in zip(*columns):
                if t != token:
                    token, leaders = t, []
                for size, chain in leaders:
                    if percent * n <= 100 * size and percent * size <= 100 * n:
                        leader, m, whole = chain[-1]
                        if comp != whole:
                            pairs[leader, sig, m, n] += 1
                            if len(chain) < depth and all(comp != c for _, _, c in chain):
                                chain.append((sig, n, comp))
                        break
                else:
                    leaders.append((n, [(sig, n, comp)]))
            yield _pair_batch(pairs)

    return _summed(listed.select("token", "sig", "n", "comp").mapInArrow(lead, _PAIRS), percent)


def _likeliest(pairs: DataFrame) -> DataFrame:
    """One leader ``a`` for each set ``b``: that with most in common, then the
    nearest in size, then the smallest."""
    near = F.struct("shared", -F.abs(F.col("n_a") - F.col("n_b")), -F.col("a"))
    return pairs.groupBy("b").agg(F.max_by("a", near).alias("a")).select("a", "b")


_PAIRS = "a bigint, b bigint, n_a int, n_b int, shared int"


def _pair_batch(pairs: Counter) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = [pa.array([p[i] for p in pairs], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(pairs.values(), pa.int32())], names=["a", "b", "n_a", "n_b", "shared"]
    )


def _summed(pairs: DataFrame, percent: int) -> DataFrame:
    return _enough(pairs.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared")), percent)


def _enough(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose shared prefix tokens suffice: a common token outside both
    prefixes lies behind the prefix of one of the two."""
    union = F.col("n_a") + F.col("n_b")
    behind = F.ceil(F.lit(percent) * F.greatest("n_a", "n_b") / 100) - 1
    needed = F.ceil(F.lit(percent) * union / (100 + percent))
    return pairs.where(F.col("shared") + behind >= needed)


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parity bits allow a link. Each bit that differs stands for
    a token that only one of the two sets holds."""

    def side(name: str) -> DataFrame:
        bits = [F.col(c).alias(f"{c}_{name}") for c in _PARITY]
        return sets.select(F.col("sig").alias(name), F.col("n").alias(f"n_{name}"), *bits)

    apart = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in _PARITY), F.lit(0))
    union = F.col("n_a") + F.col("n_b")
    allowed = union - 2 * F.ceil(F.lit(percent) * union / (100 + percent))
    pairs = pairs.select("a", "b", "shared")
    return pairs.join(side("a"), "a").join(side("b"), "b").where(apart <= allowed).select("a", "b", "n_a", "n_b", "shared")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()


def _needed(n, m, percent: int):
    """The least intersection with which sets of these sizes link."""
    return -(-percent * (n + m) // (100 + percent))


def _open_pairs(listed: DataFrame, percent: int) -> DataFrame:
    """Pairs of a list that are not in one component yet and may link by size, by
    the places of the token (no more than the tokens before the nearer place and
    those from the farther one on can be common) and by their parity bits. Blocks
    of a list are skipped as a whole by their largest places and rests. A pair met
    in an earlier list, as the tokens before show, is not given again."""

    def join(run: list[np.ndarray]):
        sig, n, pos, comp, *more = run
        bits, before = np.stack(more[:PARITY_WORDS], axis=1), np.stack(more[PARITY_WORDS:], axis=1)
        rest = n - pos
        if (comp == comp[0]).all():
            return
        tops = [(pos[b:b + BLOCK].max(), rest[b:b + BLOCK].max()) for b in range(0, len(n), BLOCK)]
        for i in range(len(n) - 1):
            stop = np.searchsorted(n, 100 * n[i] // percent, side="right")
            for b in range((i + 1) // BLOCK, -(-stop // BLOCK)):
                from_ = max(i + 1, b * BLOCK)
                far, left = tops[b]
                if min(pos[i], far) + min(rest[i], left) < _needed(n[i], n[from_], percent):
                    continue
                at = np.arange(from_, min(stop, (b + 1) * BLOCK))
                most = np.minimum(pos[i], pos[at]) + np.minimum(rest[i], rest[at])
                needed = _needed(n[i], n[at], percent)
                may = (comp[at] != comp[i]) & (most >= needed)
                at, needed = at[may], needed[may]
                # Of signed numbers, the bits of the absolute value would be counted.
                apart = np.bitwise_count((bits[at] ^ bits[i]).view(np.uint64)).sum(axis=1, dtype=np.int64)
                at = at[apart <= n[i] + n[at] - 2 * needed]
                at = at[~(before[at][:, :, None] == before[i]).any(axis=(1, 2))]
                for other, size in zip(sig[at].tolist(), n[at].tolist()):
                    one, two = (sig[i], n[i]), (other, size)
                    (x, n_x), (y, n_y) = min(one, two), max(one, two)
                    yield int(x), int(y), int(n_x), int(n_y)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _ended(batches):
            pairs = Counter()
            if batch is not None and held is not None:
                batch = pa.concat_batches([held, batch])
            whole = batch if batch is not None else held
            held = None
            if whole is None or not whole.num_rows:
                continue
            token, *columns = (whole.column(i).to_numpy() for i in range(whole.num_columns))
            cuts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            if batch is not None:
                held = whole.slice(int(cuts[-1]))
            else:
                cuts = np.append(cuts, len(token))
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1:
                    for pair in join([c[a:b].astype(np.int64) for c in columns]):
                        pairs[pair] += 1
                        if len(pairs) >= HELD_PAIRS:
                            yield _pair_batch(pairs)
                            pairs.clear()
            yield _pair_batch(pairs)

    columns = ["token", "sig", "n", "pos", "comp", *_PARITY, *_EARLIER]
    return listed.select(columns).mapInArrow(read, _PAIRS).select("a", "b").distinct()


def _sharing(pairs: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The pairs that share enough tokens of their prefixes to link. Shared ones are
    listed, so a set's listed tokens are looked at only, some hundredths of it."""
    prefixes = lists.join(_ends(pairs), "sig", "left_semi").groupBy("sig").agg(F.max("n").alias("n"), F.collect_list("token").alias("tokens"))

    def side(name: str) -> DataFrame:
        return prefixes.select(F.col("sig").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"in_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return _enough(both.withColumn("shared", F.size(F.array_intersect("in_a", "in_b"))), percent).select("a", "b")


def _with_earlier(listed: DataFrame) -> DataFrame:
    """Entries with the tokens before theirs in the same set, of those listed. An entry
    without one has its set's digest there, which no other set shares."""
    own = Window.partitionBy("sig").orderBy("pos")
    return listed.withColumns(
        {c: F.coalesce(F.lag("token", i).over(own), "sig") for i, c in enumerate(_EARLIER, 1)}
    )


def _ended(batches):
    yield from batches
    yield None


def _arrays(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``sig, grams`` of the wanted sets, from the text of one document each."""
    wanted = stage(wanted.select("sig", "first_doc"), "wanted-sets")
    ids = wanted.select(F.col("first_doc").alias("wanted_id")).distinct()
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    texts = with_ids(rows, "doc_id", ids, "wanted_id").select("text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _text_runs(batches, 0):
            sets = list(shingle_sets(batch.column(0).to_pylist(), k))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_digest(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ], names=["sig", "grams"],
            )

    sets = texts.mapInArrow(build, "sig bigint, grams binary").join(wanted.select("sig"), "sig", "left_semi")
    with batches_of(documents.sparkSession, BATCH_BYTES):
        return stage(sets.dropDuplicates(["sig"]), "set-tokens")


def _compared(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b, common`` of each pair."""
    left = arrays.select(F.col("sig").alias("a"), F.col("grams").alias("grams_a"))
    right = arrays.select(F.col("sig").alias("b"), F.col("grams").alias("grams_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for a, b in zip(batch.column(2), batch.column(3)):
                one, two = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                both = np.sort(np.concatenate([one, two]), kind="stable")
                sizes.append((len(one), len(two), int((both[1:] == both[:-1]).sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array([s[i] for s in sizes], pa.int64()) for i in range(3)],
                names=["a", "b", "n_a", "n_b", "common"],
            )

    # Each side is picked by the pairs before it is moved, not all arrays once a call.
    pairs = pairs.select("a", "b")
    joined = pairs.join(left, "a").join(pairs.join(right, "b"), ["a", "b"]).select("a", "b", "grams_a", "grams_b")
    return stage(joined.mapInArrow(compare, "a bigint, b bigint, n_a bigint, n_b bigint, common bigint"), "compared")


def _links(compared: DataFrame, percent: int) -> DataFrame:
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    return compared.where(100 * F.col("common") >= percent * union).select("a", "b")


def _with_arrays(documents: DataFrame, sets: DataFrame, pairs: DataFrame, arrays: DataFrame | None, k: int) -> DataFrame:
    """``arrays`` with the sets of ``pairs`` that are not among them yet."""
    wanted = _ends(pairs)
    if arrays is None:
        return _arrays(documents, sets.join(wanted, "sig", "left_semi"), k)
    missing = wanted.join(arrays.select("sig"), "sig", "left_anti")
    return arrays.unionByName(_arrays(documents, sets.join(missing, "sig", "left_semi"), k))


def _not_joined(lists: DataFrame, joined: DataFrame) -> DataFrame:
    """Entries with their component, of the lists that hold more than one."""
    comp = F.coalesce("component", "sig").alias("comp")
    marked = stage(
        lists.join(joined, F.col("sig") == F.col("node"), "left").select("token", "sig", "n", "pos", comp), "marked"
    )
    mixed = marked.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return marked.join(mixed.select("token"), "token", "left_semi")


def _labelled(rows: DataFrame, reached: DataFrame) -> DataFrame:
    smallest = reached.groupBy("comp").agg(F.min("first_doc").alias("component_id"))
    ids = reached.join(smallest, "comp").select(F.col("sig").alias("own"), "component_id")
    return rows.join(ids, F.col("sig") == F.col("own"), "left").select(
        "doc_id", "mark", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def classes(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, mark, n_shingles, component_id`` for each row.

    Two documents link when their sets of ``k``-word shingles have a Jaccard
    similarity of ``percent`` or more; ``component_id`` is the smallest doc_id
    reachable over links. Words are parted by ASCII blanks, A-Z count as a-z; a
    text with fewer than ``k`` words is one shingle; one without words, or a
    missing one, has none and links with nothing. ``mark`` is a hash of the
    text, for joins back to the rows. Repeated rows link with each other, a
    missing doc_id is never the smallest one, other columns are ignored, an
    empty table gives no rows. Shingles are compared as 64-bit hashes.
    """
    spark = documents.sparkSession
    base = _sets(documents, k)
    rows = base.where("kind = 0").select("doc_id", "mark", "sig", "n", *_PARITY)
    counts = spark.sparkContext.broadcast(_cell_counts(base))
    sets = stage(
        rows.where("n > 0").groupBy("sig").agg(
            F.min("doc_id").alias("first_doc"), *[F.max(c).alias(c) for c in ("n", *_PARITY)]
        ), "distinct-sets",
    )
    with batches_of(spark, BATCH_BYTES):
        lists = stage(_distinct_shared(_lists(_entries(documents, k, counts, percent), "n", "sig")), "lists")
    if lists.isEmpty():
        return _labelled(rows, sets.select("sig", "first_doc", F.col("sig").alias("comp")))

    first, links, arrays = None, None, None
    open_lists = lists.withColumn("comp", F.col("sig"))
    for depth in (1, 2):
        leads = _plausible(_with_leaders(_lists(open_lists, "pos", "n", "sig"), percent, depth), sets, percent)
        if first is not None:
            leads = leads.join(first.select("a", "b"), ["a", "b"], "left_anti")
        leads = stage(_likeliest(leads), "leader-pairs")
        arrays = _with_arrays(documents, sets, leads, arrays, k)
        compared = _compared(leads, arrays)
        first = compared if first is None else first.unionByName(compared)
        links = _links(first, percent)
        joined = components(links)
        open_lists = stage(_not_joined(lists, joined), "open-lists")
    bits = sets.select(F.col("sig").alias("own"), *_PARITY)
    signed = _with_earlier(open_lists).join(bits, F.col("sig") == F.col("own")).drop("own")
    pairs = stage(_open_pairs(_lists(signed, "n", "sig"), percent), "open-pairs")
    pairs = stage(_sharing(pairs, open_lists, percent), "sharing-pairs")
    arrays = _with_arrays(documents, sets, pairs, arrays, k)

    # What a set's leader has in common with it bounds, or decides, its own answers.
    led = F.max_by(F.col("a"), F.col("common"))
    leaders = stage(
        first.join(links, ["a", "b"], "left_semi").groupBy(F.col("b").alias("sig")).agg(
            led.alias("leader"), F.max("common").alias("kept"), F.max("n_b").alias("size")
        ), "leaders",
    )
    sizes = sets.select("sig", "n")

    def side(name: str) -> DataFrame:
        return leaders.select(
            F.col("sig").alias(name), F.col("leader").alias(f"leader_{name}"),
            (F.col("size") - F.col("kept")).alias(f"apart_{name}"),
        )

    led_pairs = stage(
        pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").select(
            "a", "b",
            F.coalesce("leader_a", "a").alias("x"), F.coalesce("leader_b", "b").alias("w"),
            F.coalesce("apart_a", F.lit(0)).alias("apart_a"), F.coalesce("apart_b", F.lit(0)).alias("apart_b"),
        ), "led-pairs",
    )
    tops = led_pairs.select(F.least("x", "w").alias("a"), F.greatest("x", "w").alias("b")).where("a <> b").distinct()
    above = _compared(tops, arrays)
    more = _links(above, percent)
    known = above.select(F.col("a").alias("low"), F.col("b").alias("high"), F.col("common").alias("top"))
    bounded = led_pairs.where("x <> a OR w <> b").join(
        known, (F.least("x", "w") == F.col("low")) & (F.greatest("x", "w") == F.col("high")), "left"
    )
    both = bounded.join(sizes.select(F.col("sig").alias("a"), F.col("n").alias("n_a")), "a").join(
        sizes.select(F.col("sig").alias("b"), F.col("n").alias("n_b")), "b"
    )
    union = F.col("n_a") + F.col("n_b")
    most = F.coalesce(F.col("top"), union) + F.col("apart_a") + F.col("apart_b")
    undecided = both.where((100 + percent) * most >= percent * union).select("a", "b")
    last = _links(_compared(undecided.distinct(), arrays), percent)

    final = components(links.unionByName(more).unionByName(last))
    reached = sets.join(final, F.col("sig") == F.col("node"), "left").select(
        "sig", "first_doc", F.coalesce("component", "sig").alias("comp")
    )
    return _labelled(rows, reached)


def one_of_each(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows that stay, one of each component, with their columns: the one
    with the component's smallest doc_id. Rows without words all stay, equal
    ones once. See :func:`classes`."""
    found = stage(classes(documents, k, percent), "near-classes")
    first = found.where((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    doc, mark, text_mark = (unused(documents, c) for c in ("kept_doc", "kept_mark", "mark"))
    stays = first.groupBy("doc_id").agg(F.min("mark").alias("mark")).unionByName(
        found.where("n_shingles = 0").select("doc_id", "mark").distinct()
    ).select(F.col("doc_id").alias(doc), F.col("mark").alias(mark))
    keys = found.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col("mark") == F.col(mark))

    def sent(rows: DataFrame, name: str) -> DataFrame:
        held = stage(rows.select(F.col("doc_id").alias(doc), F.col("mark").alias(mark)), name)
        return held.hint("broadcast" if held.count() <= MAX_SENT_IDS else "merge")

    # Texts are not moved: the keys that go, and those of repeated rows, are sent to
    # them while they are few.
    goes = sent(keys.join(stays, same, "left_anti"), "near-copies")
    repeated = sent(keys.where("n > 1").join(stays, same, "left_semi"), "repeated-rows")
    rows = documents.withColumn(text_mark, F.xxhash64("text"))
    here = F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc)) & (F.col(text_mark) == F.col(mark))
    kept = rows.join(goes, here, "left_anti")
    if not repeated.isEmpty():
        once = rows.join(repeated, here, "left_semi").dropDuplicates(["doc_id", text_mark])
        kept = kept.join(repeated, here, "left_anti").unionByName(once)
    return kept.select(documents.columns)


def op8_jaccard(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classes(documents, k=4, percent=85).select("doc_id", "n_shingles", "component_id")
