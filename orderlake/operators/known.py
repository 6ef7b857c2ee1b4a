"""Keys of past runs, dealt by hash, with a Bloom filter in front.

A run's keys lie in folders by part. The filter is a table of bitmaps over all
runs' keys: a key falls into one bitmap and sets a few bits there. Today's keys
are held against the bitmaps, and only the parts of keys that may be known are
read, in which most false hits end as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderlake.sources.staging import stage

PARTS = 256
#: Bits of a bitmap (Spark's bitmap functions fix it), keys it should hold at most,
#: and bits a key sets: 0.9 % of unknown keys pass a full bitmap.
BITS, LOAD, HASHES = 32_768, 3_000, 4
KEY, PART = "order_id", "part"


def _hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def with_part(keys: DataFrame, key: str = KEY, parts: int = PARTS) -> DataFrame:
    return keys.withColumn(PART, F.pmod(_hash(key, 0), F.lit(parts)).cast("int"))


def _bucket(key: str, buckets: Column) -> Column:
    return F.pmod(_hash(key, 1), buckets)


def _places(key: str) -> Column:
    return F.array(*[F.pmod(_hash(key, 2 + i), F.lit(BITS)) for i in range(HASHES)])


def buckets_for(n_keys: int) -> int:
    """A power of two, so that growing filters are rebuilt seldom."""
    return 1 << max(0, -(-max(n_keys, 1) // LOAD) - 1).bit_length()


def filter_of(keys: DataFrame, buckets: int, key: str = KEY) -> DataFrame:
    """``buckets, bucket, bitmap, n`` over different keys; bits are set by partial
    aggregates of 4 KB a bitmap."""
    counted = keys.groupBy(_bucket(key, F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    bits = keys.select(_bucket(key, F.lit(buckets)).alias("bucket"), F.explode(_places(key)).alias("place"))
    maps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bitmap"))
    return maps.join(counted, "bucket").select(F.lit(buckets).alias("buckets"), "bucket", "bitmap", "n")


def merged_filter(filters: list[DataFrame]) -> DataFrame:
    """Filters with as many buckets, over different keys, as one."""
    rows = reduce(DataFrame.unionByName, filters)
    return rows.groupBy("buckets", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("n").alias("n"))


def may_hold(keys: DataFrame, filters: DataFrame, buckets: int, key: str = KEY) -> DataFrame:
    """The keys whose bits are all set: all known ones, and few others."""
    found = keys.withColumn("_bucket", _bucket(key, F.lit(buckets))).join(
        filters.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap")), "_bucket"
    )

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
        return F.getbit(byte.cast("int"), (place % 8).cast("int")) == 1

    return found.where(F.forall(_places(key), is_set)).select(keys.columns)


def known_among(keys: DataFrame, store: DataFrame, filters: DataFrame, key: str = KEY) -> DataFrame:
    """The ``keys`` (each once, with ``part``) that the ``store`` (``key, part``) holds.

    The hits are staged and their parts named to the store's scan, so it reads the
    folders of those parts alone. A missing key is a key like others.
    """
    buckets = (filters.agg(F.max("buckets")).first()[0]) or 1
    hits = stage(may_hold(keys, filters, buckets, key), "may-be-known")
    parts = [r[0] for r in hits.select(PART).distinct().collect()]
    touched = store.where(F.col(PART).isin(parts))
    same = F.col(key).eqNullSafe(F.col("_hit"))
    return touched.join(hits.select(F.col(key).alias("_hit")), same, "left_semi").select(key)


def grown_filter(store: DataFrame, new: DataFrame, filters: DataFrame, key: str = KEY) -> DataFrame:
    """The filter with a run's new keys. Where bitmaps would be overfull, it is made
    again from all keys with at least twice as many, which reads the store once for
    each doubling of its size."""
    told = filters.agg(F.max("buckets"), F.coalesce(F.sum("n"), F.lit(0))).first()
    wanted = buckets_for(told[1] + new.count())
    if told[0] and wanted <= told[0]:
        return merged_filter([filters, filter_of(new, told[0], key)])
    return filter_of(store.select(key).unionByName(new.select(key)), wanted, key)
