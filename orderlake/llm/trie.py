"""A trie of conversations: which beginnings are shared, and what sharing saves.

Conversations, written as sequences of turn digests, are dealt by ranges of that
sequence. Each run of them is one shard: a trie in balanced parentheses over an
excess array whose blocks keep their minima. The matching parenthesis delimits a
node's subtree, pairs ``()`` counted by rank are its leaves, and cumulative sums
over the opening ones give members and savings.

Only a shard's first and last path can go on in a neighbour. These spines come
back as sequences with the sums that hang off each of their nodes, and are
encoded in the same way, by as many rounds as it takes to get them into one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderlake.sources.staging import stage

#: Turns a shard holds, and conversations: what a task has in memory at a time.
RUN_TURNS = 100_000
BLOCK = 64
#: Base64 characters of a turn's digest (120 bits).
DIGEST = 20
_NONE = np.iinfo(np.int64).max

_OUT = (
    "kind int, id string, parent_id string, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, "
    "path string, sizes array<bigint>, members array<bigint>, kids array<bigint>, "
    "leaves array<bigint>, saved array<bigint>, least array<bigint>"
)
_NODE, _ENDS, _SPINE = 0, 1, 2


class Parentheses:
    """Balanced parentheses with block minima of the excess in a complete tree."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = -(-len(bits) // BLOCK)
        self.width = 1 << max(0, (blocks - 1).bit_length())
        padded = np.full(self.width * BLOCK, _NONE)
        padded[:len(bits)] = self.excess
        self.blocks = padded.reshape(self.width, BLOCK)
        self.least = np.full(2 * self.width, _NONE)
        self.least[self.width:] = self.blocks.min(axis=1)
        for level in range(self.width.bit_length() - 2, -1, -1):
            low = 1 << level
            pairs = self.least[2 * low:4 * low].reshape(low, 2)
            self.least[low:2 * low] = pairs.min(axis=1)
        pair = (bits[:-1] == 1) & (bits[1:] == 0)
        self.pairs = np.concatenate(([0], np.cumsum(pair), [pair.sum()]))

    def _in_block(self, block: np.ndarray, after: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """Place of the first excess ``goal`` behind ``after`` in each block, or -1."""
        found = np.full(len(block), -1)
        for part in range(0, len(block), 8192):
            at = slice(part, part + 8192)
            hit = (self.blocks[block[at]] == goal[at, None]) & (np.arange(BLOCK) > after[at, None])
            found[at] = np.where(hit.any(axis=1), block[at] * BLOCK + hit.argmax(axis=1), -1)
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The matching closing parenthesis of each opening one."""
        goal, block = self.excess[opens] - 1, opens // BLOCK
        close = self._in_block(block, opens % BLOCK, goal)
        open_yet = np.flatnonzero(close < 0)
        node, goal = block[open_yet] + self.width, goal[open_yet]
        climbing = np.ones(len(node), bool)
        while climbing.any():
            right = (node % 2 == 0) & climbing
            fits = right.copy()
            fits[right] = self.least[node[right] + 1] <= goal[right]
            node = np.where(fits, node + 1, np.where(climbing, node // 2, node))
            climbing &= ~fits
        while (inner := node < self.width).any():
            left = 2 * node[inner]
            node[inner] = np.where(self.least[left] <= goal[inner], left, left + 1)
        close[open_yet] = self._in_block(node - self.width, np.full(len(node), -1), goal)
        return close

    def leaves(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        """Pairs ``()`` from each opening parenthesis to its closing one."""
        return self.pairs[closes] - self.pairs[opens]


def _common(a: str, b: str) -> int:
    """Turns two paths share from their start."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // DIGEST
    at = 0
    while a[at:at + DIGEST] == b[at:at + DIGEST]:
        at += DIGEST
    return at // DIGEST


def _child_id(parent: str, digest: str) -> str:
    return hashlib.sha256((parent + digest).encode()).hexdigest()[:32]


ROOT_ID = _child_id("", "")


class Shard:
    """One run of sorted paths. ``marks`` holds, per path, sums that hang off its
    nodes from the root on: ``members, kids, leaves, saved, least``; without marks,
    a path is a conversation that ends at its last node."""

    def __init__(self, paths: list[str], sizes: list, convs: list[int] | None, marks: list | None):
        self.paths, self.sizes, self.convs = paths, sizes, convs
        parent, depth, opened, own, ends, lines = [-1], [0], [0], [0], [], []
        bits, stack, before = bytearray(b"\1"), [0], ""
        for s, path in enumerate(paths):
            keep, turns = _common(before, path), len(path) // DIGEST
            bits += b"\0" * (len(stack) - 1 - keep)
            del stack[keep + 1:]
            for d in range(keep + 1, turns + 1):
                parent.append(stack[-1])
                stack.append(len(depth))
                depth.append(d)
                opened.append(s)
                own.append(sizes[s][d - 1])
            bits += b"\1" * (turns - keep)
            ends.append(stack[-1])
            if marks is not None:
                lines.append(np.array(stack))
            before = path
        bits += b"\0" * len(stack)
        self.parent, self.depth = np.array(parent), np.array(depth)
        self.opened, self.own, self.ends = np.array(opened), np.array(own, np.int64), np.array(ends)
        n = len(self.depth)
        self.members, self.kids, self.hung, self.kept = (np.zeros(n, np.int64) for _ in range(4))
        self.least = np.full(n, _NONE)
        if marks is None:
            np.add.at(self.members, self.ends, 1)
            np.minimum.at(self.least, self.ends, np.array(convs, np.int64))
        else:
            for line, (members, kids, leaves, saved, least) in zip(lines, marks):
                # A path's nodes differ, so plain indexing adds each once.
                self.members[line] += members
                self.kids[line] += kids
                self.hung[line] += leaves
                self.kept[line] += saved
                self.least[line] = np.minimum(self.least[line], least)
        self._sum(np.frombuffer(bytes(bits), np.uint8), n)

    def _sum(self, bits: np.ndarray, n: int) -> None:
        tree = Parentheses(bits)
        opens = np.flatnonzero(bits)
        closes = tree.findclose(opens)
        self.last = np.arange(n) + (closes - opens + 1) // 2
        below = self.below
        self.spine = np.zeros(n, bool)
        for end in (self.ends[0], self.ends[-1]):
            while end >= 0 and not self.spine[end]:
                self.spine[end] = True
                end = self.parent[end]
        inner = np.bincount(self.parent[1:], minlength=n)
        self.children = inner + self.kids
        self.n_convs = below(self.members)
        # Whether a spine ends, and what its own turn saves, is known when spines merge.
        not_leaf = (inner == 0) & (self.spine | (self.kids > 0))
        self.spared = np.where(self.spine, 0, (self.n_convs - 1) * self.own)
        self.n_leaves = tree.leaves(opens, closes) - below(not_leaf) + below(self.hung)
        self.saved = below(self.spared + self.kept)
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(1, self.depth.max() + 2))
        for low, high in reversed(list(zip(cuts, cuts[1:]))):
            at = order[low:high]
            np.minimum.at(self.least, self.parent[at], self.least[at])

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sums over each node's subtree, its top included."""
        total = np.concatenate(([0], np.cumsum(values)))
        return total[self.last] - total[:-1]

    def finish(self) -> None:
        """All paths are here, so spines are like other nodes."""
        self.n_leaves += self.below(self.spine & (self.children == 0))
        self.saved += self.below(np.where(self.spine, (self.n_convs - 1) * self.own, 0))
        self.spine[:] = False

    def _line(self, node: int) -> np.ndarray:
        found = []
        while node >= 0:
            found.append(node)
            node = self.parent[node]
        return np.array(found[::-1])

    def ids(self) -> list[str]:
        """Ids of all nodes, each made from its parent's."""
        found = [ROOT_ID]
        for node in range(1, len(self.depth)):
            d = int(self.depth[node])
            digest = self.paths[self.opened[node]][(d - 1) * DIGEST:d * DIGEST]
            found.append(_child_id(found[self.parent[node]], digest))
        return found

    def spines(self) -> tuple[list[dict], dict[int, str]]:
        """The first and the last path with what hangs off their nodes, and the ids
        of these nodes. Nodes of both paths carry their sums on the first."""
        rows, ids, given = [], {-1: "", 0: ROOT_ID}, np.zeros(len(self.depth), bool)
        inside = self.spine.copy()
        inside[0] = False
        at = np.flatnonzero(inside)
        hang = {}
        for name, total in (("members", self.n_convs), ("leaves", self.n_leaves), ("saved", self.saved)):
            hang[name] = total.copy()
            np.subtract.at(hang[name], self.parent[at], total[at])
        hang["kids"] = self.children.copy()
        np.subtract.at(hang["kids"], self.parent[at], 1)
        for s in dict.fromkeys((0, len(self.paths) - 1)):
            line = self._line(int(self.ends[s]))
            for d, node in enumerate(line.tolist()[1:]):
                if node not in ids:
                    ids[node] = _child_id(ids[int(self.parent[node])], self.paths[s][d * DIGEST:(d + 1) * DIGEST])
            fresh = ~given[line]
            given[line] = True
            row = {name: np.where(fresh, values[line], 0).tolist() for name, values in hang.items()}
            row["least"] = np.where(fresh, self.least[line], _NONE).tolist()
            rows.append({"kind": _SPINE, "path": self.paths[s], "sizes": list(self.sizes[s])} | row)
        return rows, ids

    def closings(self) -> Iterator[tuple[int, str]]:
        """Nodes at which conversations end, with their ids in ascending order."""
        cuts = np.flatnonzero(np.diff(self.ends, prepend=-1, append=-1))
        for low, high in zip(cuts.tolist(), cuts.tolist()[1:]):
            yield int(self.ends[low]), ",".join(map(str, self.convs[low:high]))


_EMPTY = hashlib.sha256(b"").hexdigest()
_COLUMNS = [part.split() for part in _OUT.split(", ")]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in _COLUMNS],
        names=[name for name, _ in _COLUMNS],
    )


def _encoded(shard: Shard, whole: bool) -> list[dict]:
    """Rows of a shard: finished nodes, ends of spine nodes, spines."""
    rows, first = [], shard.convs is not None
    named = {} if first else dict(enumerate(shard.ids()))
    if whole:
        shard.finish()
    else:
        rows, ids = shard.spines()
        named |= ids
    ends = {}
    for node, text in shard.closings() if first else ():
        if shard.spine[node]:
            rows.append({"kind": _ENDS, "id": named[node], "ends": text, "conv_id": int(text.partition(",")[0])})
        else:
            ends[node] = hashlib.sha256(text.encode()).hexdigest()
    at = np.flatnonzero(~shard.spine)
    columns = (shard.parent, shard.depth, shard.least, shard.n_convs, shard.children, shard.n_leaves, shard.saved)
    for node, up, depth, least, convs, kids, leaves, saved in zip(at.tolist(), *(c[at].tolist() for c in columns)):
        row = {
            "kind": _NODE, "conv_id": least, "depth": depth, "n_convs": convs, "n_children": kids,
            "n_leaves": leaves, "saved_tokens": saved,
        }
        if first:
            row["ends"] = ends.get(node, _EMPTY)
        else:
            row["id"] = named[node]
        if up >= 0 and shard.spine[up]:
            row["parent_id"] = named[up]
        elif up >= 0:
            row["parent_conv_id"] = int(shard.least[up])
        rows.append(row)
    return rows


def _shards(batches: Iterator[pa.RecordBatch], whole: bool, marked: bool, run_turns: int) -> Iterator[pa.RecordBatch]:
    paths, sizes, convs, marks, turns = [], [], [], [], 0

    def close() -> Iterator[pa.RecordBatch]:
        rows = _encoded(Shard(paths, sizes, None if marked else convs, marks if marked else None), whole)
        for low in range(0, len(rows), 20_000):
            yield _batch(rows[low:low + 20_000])

    for batch in batches:
        held = [batch.column(name).to_pylist() for name in batch.schema.names]
        for path, size, *rest in zip(*held):
            paths.append(path)
            sizes.append(size)
            if marked:
                marks.append([np.array(values, np.int64) for values in rest])
            else:
                convs.append(rest[0])
            turns += 1 + len(size)
            if turns >= run_turns and not whole:
                yield from close()
                paths, sizes, convs, marks, turns = [], [], [], [], 0
    if paths:
        yield from close()


_MARKS = ["members", "kids", "leaves", "saved", "least"]


def _round(rows: DataFrame, whole: bool, marked: bool, parts: int, run_turns: int) -> DataFrame:
    """Deal paths by ranges and encode each run; equal ones may be parted."""
    names = ["path", "sizes", *(_MARKS if marked else ["conv_id"])]
    order = ["path", "least"] if marked else ["path", "conv_id"]
    dealt = rows.select(names).repartition(1) if whole else rows.select(names).repartitionByRange(parts, *order)
    found = dealt.sortWithinPartitions(*order).mapInArrow(
        lambda batches: _shards(batches, whole, marked, run_turns), _OUT
    )
    return stage(found, "trie-round")


def _joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests over the ends of each node, row by row."""
    now, digest = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"ends_id": [now], "ends_sha": [digest.hexdigest()]})

    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != now:
                if now is not None:
                    yield told()
                now, digest = name, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
    if now is not None:
        yield told()


def nodes(paths: DataFrame, run_turns: int = RUN_TURNS) -> DataFrame:
    """All nodes of the trie over ``conv_id, path, sizes``: digests of the turns,
    joined, and the bytes of each turn's text. Columns as in ``prefix_trie``."""
    levels, marked = [], False
    while True:
        turns = paths.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("sizes")), F.lit(0))).first()[0]
        parts = -(-turns // run_turns)
        # A round of spines that does not shrink (paths longer than a shard) ends in one.
        whole = marked and (parts <= 1 or len(levels) > 1 and turns >= before)
        before = turns
        level = _round(paths, whole, marked, max(1, parts), run_turns)
        levels.append(level)
        if whole or not turns:
            break
        paths, marked = level.where(F.col("kind") == _SPINE), True
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    rows = found.where(F.col("kind") == _NODE)
    spines = rows.where(F.col("id").isNotNull()).select(
        F.col("id").alias("spine_id"), F.col("conv_id").alias("spine_conv")
    )
    ends = (
        levels[0].where(F.col("kind") == _ENDS).select("id", "conv_id", "ends")
        .repartition("id").sortWithinPartitions("id", "conv_id")
        .mapInArrow(_joined_ends, "ends_id string, ends_sha string")
    )
    return (
        rows.join(spines, F.col("parent_id") == F.col("spine_id"), "left")
        .join(ends, F.col("id") == F.col("ends_id"), "left")
        .select(
            "conv_id", "depth", F.coalesce("parent_conv_id", "spine_conv").alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce(F.when(F.col("id").isNull(), F.col("ends")), "ends_sha", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


def turn_digest(role: Column, text: Column) -> Column:
    """120 bits of SHA-256 over role and text; the role's length parts the two."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.base64(F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 15))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order, as ``turn, digest, size`` structs."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn"), turn_digest(role, text).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn")
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def prefix_trie(turns: DataFrame, run_turns: int = RUN_TURNS) -> DataFrame:
    """One row per distinct beginning of the ``turns`` of ``conv_id``, the empty one
    included: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` come from ``turn_lists``: rows by turn, a missing number first, ties by
    digest, repeated rows as turns of their own; a missing role or text is empty and
    rows without a ``conv_id`` are left out; other columns are ignored. No
    conversation gives no node. A conversation's digests are one row (28 bytes a
    turn), its texts are not gathered.
    """
    listed = turns.select(
        "conv_id", F.array_join(F.col("turns.digest"), "").alias("path"), F.col("turns.size").alias("sizes")
    )
    return nodes(stage(listed, "conversation-paths"), run_turns)


def replanted(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Every conversation begins with the first ``crc32(conv_id) % most`` turns of the
    first one of its family, and goes on with its own turns behind that many."""
    head, base = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most, F.col("conv_id") - F.col("conv_id") % family
    first = turns.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("turns", 1, most - 1).alias("first_turns")
    )
    own = turns.select("conv_id", "turns", base.alias("base"), head.cast("int").alias("head"))
    none = F.slice("turns", 1, 0)
    begun = F.slice(F.coalesce("first_turns", none), F.lit(1), F.col("head"))
    rest = F.slice("turns", F.col("head") + 1, F.size("turns"))
    return own.join(first, F.col("base") == F.col("first_id"), "left").select(
        "conv_id", F.concat(begun, rest).alias("turns")
    )


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie(replanted(turn_lists(conversations)))


OP13_SQL = r"""
WITH heads AS (
  SELECT c AS conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT heads.conv_id, 0 AS part, turns.r, role, text
  FROM heads JOIN turns ON turns.conv_id = heads.conv_id - heads.conv_id % 5 AND turns.r <= h
  UNION ALL
  SELECT heads.conv_id, 1, turns.r, role, text FROM heads JOIN turns USING (conv_id) WHERE turns.r > h
), placed AS (
  SELECT conv_id, role, text, row_number() OVER w AS depth,
    sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS node
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, r)
), members AS (
  SELECT conv_id, depth, node, strlen(text) AS bytes, lag(node, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
    max(depth) OVER (PARTITION BY conv_id) AS total
  FROM placed
  UNION ALL
  SELECT conv_id, 0, '', 0, NULL, (SELECT count(*) FROM rebuilt WHERE rebuilt.conv_id = heads.conv_id) FROM heads
), own AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
    (count(*) - 1) * any_value(bytes) AS spared,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = total), '')) AS ends_sha256
  FROM members GROUP BY node
), kids AS (
  SELECT parent AS node, count(*) AS n FROM own WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT members.node, sum(spared) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM own JOIN members ON members.conv_id = own.conv_id AND members.depth <= own.depth
    LEFT JOIN kids ON kids.node = own.node
  GROUP BY members.node
)
SELECT own.conv_id, CAST(own.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, own.n_convs,
  coalesce(kids.n, 0) AS n_children, below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, own.ends_sha256
FROM own JOIN below USING (node) LEFT JOIN kids USING (node) LEFT JOIN own AS up ON up.node = own.parent
"""
