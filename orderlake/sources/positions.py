"""Positions of one long: the ordinal of a row's split, then its place there.

Sources give a position as a struct that ends in ``row``, with the file and split
before it. Comparing such structs rules out hash aggregates and moves a path with
every row. Once rows are staged, the splits are few and known: they are numbered
in order, and the number and the row make one long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructType

from orderlake.contracts import POSITION
from orderlake.sources.staging import stage

#: Bits of a row's place within its split (and of Spark's row number in a task).
ROW_BITS = 33
#: Splits, some 200 bytes each, that may go to every executor: 128 TB in splits of 128 MB.
MAX_SENT_SPLITS = 1_000_000


def _leaves(kind: StructType, at: Column, path: str = "_split") -> list[Column]:
    found = []
    for field in kind:
        name = f"{path}_{field.name}"
        if isinstance(field.dataType, StructType):
            found += _leaves(field.dataType, at[field.name], name)
        else:
            found.append(at[field.name].alias(name))
    return found


def fixed_width(staged: DataFrame, position: str = POSITION) -> DataFrame:
    """The staged rows with their position as one long, in the same order.

    The splits are read from the position column alone and numbered in a staged
    dictionary. It is sent to the rows while it is small, and joined by shuffle
    beyond that. A position that is a number already stays.
    """
    kind = staged.schema[position].dataType
    if not isinstance(kind, StructType):
        return staged
    row = kind.fields[-1].name
    split = StructType([f for f in kind.fields if f.name != row])
    marked = staged.select(
        "*", *_leaves(split, F.col(position)),
        F.col(position)[row].cast(LongType()).bitwiseAND((1 << ROW_BITS) - 1).alias("_row"),
    )
    keys = [c for c in marked.columns if c.startswith("_split_")]
    splits = stage(marked.select(keys).distinct(), "splits")
    # One window over all splits: a row for each 128 MB of input, not for each row.
    ordinal = (F.row_number().over(Window.orderBy(*keys)) - 1).cast("bigint")
    numbered = stage(splits.withColumn("_ordinal", ordinal), "numbered-splits")
    way = "broadcast" if splits.count() <= MAX_SENT_SPLITS else "merge"
    packed = F.shiftleft(F.col("_ordinal"), ROW_BITS).bitwiseOR(F.col("_row"))
    joined = marked.join(numbered.hint(way), keys)
    return joined.withColumn(position, packed).select(staged.columns)
