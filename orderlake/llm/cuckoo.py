"""Exact dedup over a cuckoo-filter index of live digests."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from orderlake.llm.common import unused
from orderlake.sources.staging import stage

SLOTS = 4
MAX_KICKS = 200
#: Digests one bucket of the index holds, on average.
BUCKET_KEYS = 20_000
SALTS = 8


class CuckooFilter:
    """16-bit fingerprints in buckets of four, each in one of two buckets.

    ``keys`` is the stored content a hit is verified against; a filter that
    overflows is rebuilt at twice the size from it.
    """

    def __init__(self, keys: dict, capacity: int = 64):
        self.keys = keys
        self._build(capacity)

    def _build(self, capacity: int) -> None:
        while True:
            n = 1
            while n * SLOTS * 0.85 < max(capacity, len(self.keys)):
                n *= 2
            self.mask = n - 1
            self.table = [[] for _ in range(n)]
            if all(self._place(k) for k in self.keys):
                return
            capacity = n * SLOTS * 2

    @staticmethod
    def _mark(key: bytes) -> int:
        return int.from_bytes(key[:2], "little") or 1

    def _homes(self, key: bytes) -> tuple[int, int, int]:
        mark = self._mark(key)
        one = int.from_bytes(key[8:16], "little") & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, home: int, mark: int) -> int:
        return (home ^ (mark * 0x5BD1E995)) & self.mask

    def _place(self, key: bytes) -> bool:
        mark, one, two = self._homes(key)
        for home in (one, two):
            if len(self.table[home]) < SLOTS:
                self.table[home].append(mark)
                return True
        home = one
        for kick in range(MAX_KICKS):
            row = self.table[home]
            mark, row[kick % SLOTS] = row[kick % SLOTS], mark
            home = self._other(home, mark)
            if len(self.table[home]) < SLOTS:
                self.table[home].append(mark)
                return True
        return False

    def maybe(self, key: bytes) -> bool:
        mark, one, two = self._homes(key)
        return mark in self.table[one] or mark in self.table[two]

    def find(self, key: bytes):
        """The stored value, or None: a hit is verified against the content."""
        return self.keys.get(key) if self.maybe(key) else None

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not stored, or replace its value."""
        known = self.find(key) is not None
        self.keys[key] = value
        if not known and not self._place(key):
            self._build(2 * SLOTS * (self.mask + 1))

    def delete(self, key: bytes) -> bool:
        """Remove a stored key; others stay findable."""
        if self.find(key) is None:
            return False
        del self.keys[key]
        mark, one, two = self._homes(key)
        self.table[one if mark in self.table[one] else two].remove(mark)
        return True


_INDEX = "bucket int, text_sha256 string, keep_id bigint, group_size bigint"


def _key(digest: str) -> bytes:
    return bytes.fromhex(digest)


def _apply(bucket: int, stored: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """One bucket's index after its changes; ``delta`` rows join or leave a group."""
    content = {
        _key(d): (k, n)
        for d, k, n in zip(stored.text_sha256, stored.keep_id, stored.group_size)
    }
    index = CuckooFilter(content, len(content) + len(changes) // 2)
    for digest, doc_id, delta in zip(changes.text_sha256, changes.keep_id, changes.delta):
        key = _key(digest)
        live = index.find(key)
        if live is None:
            if delta > 0:
                index.insert(key, (doc_id, delta))
            continue
        keep, n = live
        if delta < 0 and n + delta <= 0:
            index.delete(key)
        else:
            if doc_id is not None and delta > 0 and (keep is None or doc_id > keep):
                keep = doc_id
            index.insert(key, (keep, n + delta))
    out = pd.DataFrame({
        "text_sha256": pd.array([k.hex() for k in index.keys], dtype="object"),
        "keep_id": pd.array([v[0] for v in index.keys.values()], dtype="object"),
        "group_size": np.array([v[1] for v in index.keys.values()], dtype="int64"),
    })
    out.insert(0, "bucket", np.int32(bucket))
    return out


def _none(column: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else int(v) for v in column], dtype="object", index=column.index)


def digests(documents: DataFrame, normalise=None) -> DataFrame:
    """``doc_id, text_sha256, copies``: each id and text once; no text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    text = normalise(text) if normalise else text
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )
    return rows.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("copies"))


def _changes(keyed: DataFrame, buckets: int, sign: int) -> DataFrame:
    """Copies counted per digest and salt, so a digest that a third of all rows
    share reaches its bucket as a few rows."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    sums = keyed.groupBy("text_sha256", salt.alias("salt")).agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("n")
    )
    return sums.select(
        _bucket(buckets), "text_sha256", "keep_id", (F.col("n") * sign).alias("delta")
    )


def _bucket(buckets: int):
    head = F.conv(F.substring("text_sha256", 33, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int").alias("bucket")


def empty_index(spark) -> DataFrame:
    return spark.createDataFrame([], _INDEX)


def update_index(
    index: DataFrame, buckets: int, inserts: DataFrame | None = None,
    deletes: DataFrame | None = None,
) -> DataFrame:
    """The index after batches of :func:`digests` come and go.

    Each bucket builds its cuckoo filter from the stored keys, verifies hits
    against them and grows when it overflows. Deleting copies shrinks a group;
    the last one frees its digest. The keeper stays as long as the group: a
    caller that deletes the keeper itself inserts the remaining rows anew.
    ``buckets`` must be that of the index.
    """
    parts = [_changes(rows, buckets, sign) for rows, sign in ((inserts, 1), (deletes, -1)) if rows is not None]
    changes = parts[0]
    for more in parts[1:]:
        changes = changes.unionByName(more)

    def merged(key, stored: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        stored = stored.assign(keep_id=_none(stored.keep_id))
        new = new.assign(keep_id=_none(new.keep_id)).sort_values(
            ["delta", "text_sha256"], ascending=False, kind="stable"
        )
        return _apply(int(key[0]), stored, new)

    return index.groupBy("bucket").cogroup(changes.groupBy("bucket")).applyInPandas(merged, _INDEX)


def dedup(documents: DataFrame, normalise=None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Texts are equal when identical (after ``normalise``, a function on columns,
    if given); a missing text counts as empty. Of equal texts the row with the
    largest doc_id stays, a missing doc_id counts as smallest; of several rows
    with that id one stays. Other columns are ignored; an empty table gives no
    rows. Two texts with one SHA-256 are taken as equal.
    """
    spark = documents.sparkSession
    keyed = stage(digests(documents, normalise), "digests")
    buckets = max(1, -(-keyed.count() // BUCKET_KEYS))
    index = update_index(empty_index(spark), buckets, inserts=keyed).drop("bucket")
    rows = keyed.join(index, "text_sha256")
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    return rows.select("*", copy).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def deduped(documents: DataFrame, normalise=None) -> DataFrame:
    """The rows that stay, with their columns; see :func:`dedup`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = unused(documents, "digest")
    rows = documents.withColumn(
        digest, F.sha2((normalise(text) if normalise else text).cast("binary"), 256)
    )
    stays = dedup(documents, normalise).where("kept").select(
        F.col("doc_id").alias("id_"), F.col("text_sha256").alias("digest_")
    )
    kept = rows.join(
        stays,
        (rows[digest] == stays["digest_"]) & rows["doc_id"].cast("bigint").eqNullSafe(stays["id_"]),
        "left_semi",
    )
    return kept.dropDuplicates(["doc_id", digest]).select(documents.columns)


def op2_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = """
WITH digests AS (
  SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents
), groups AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM digests JOIN groups USING (text_sha256)
"""
