"""Small helpers the operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: White space that separates words, as a character class body.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"


def unused(df: DataFrame, base: str) -> str:
    """A column name the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def blocks_for(rows: int, least: int = 256) -> int:
    """How many rows a block holds so that blocks and rows per block grow alike."""
    return max(least, math.isqrt(max(rows, 0)))


def unit_interval(h: Column) -> Column:
    """A 64-bit hash as a number from 0 (with) to 1 (without)."""
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def local_table(spark: SparkSession, rows: list, schema: str | StructType) -> DataFrame:
    """Rows the driver holds, as a relation whose size Spark knows: it broadcasts
    it below its threshold and joins it by shuffle beyond."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) or [[] for _ in kind]
    fields = to_arrow_schema(kind)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), kind)


def text_runs(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts hold up to ``most`` bytes, one text at least:
    what a step makes of them grows with the slice, however many rows a batch has."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes.astype(np.int64)), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


#: Ids (8 bytes each) that may go to every executor.
MAX_SENT_IDS = 500_000


def with_ids(rows: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """The rows whose ``key`` is among ``ids`` (column ``name``, NULL is an id).
    Counted, and sent to the rows while they are few; beyond that, both are
    shuffled and sorted."""
    way = "broadcast" if ids.count() <= MAX_SENT_IDS else "merge"
    return rows.join(ids.hint(way), F.col(key).eqNullSafe(F.col(name)), "left_semi")
