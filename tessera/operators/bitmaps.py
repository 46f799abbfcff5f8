"""Referential integrity by bitmaps, for integer keys of dimensions too large to broadcast.

Both sides' distinct keys become bitmaps of 32,768 keys each
(``bitmap_construct_agg``, combined map-side, so a hot key costs one bit a
task). Only bitmaps are shuffled: 4 KiB for up to 32,768 values, however many
rows hold them. Bitmap by bitmap, the fact's keys that the dimension lacks
remain. The rows that hold them are counted in a second scan of the fact,
against the blocks of lacking keys, which are broadcast when their size is
within bounds.

It pays where keys are dense, as surrogate keys and serial numbers are. Keys
scattered over 64 bits give one bitmap a key; for these, ``quality.fk_report``
shuffles the values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tessera.operators.joins import checked_broadcast, written
from tessera.operators.quality import ForeignKey


def _place(key: Column) -> tuple[Column, Column]:
    return F.bitmap_bucket_number(key).alias("block"), F.bitmap_bit_position(key).alias("bit")


def key_bitmaps(df: DataFrame, column: str) -> DataFrame:
    """``block`` and ``bitmap`` of the distinct non-null values of an integer column."""
    if not isinstance(df.schema[column].dataType, IntegralType):
        raise TypeError(f"{column} must be an integer column")
    key = F.col(column).cast("long")
    return df.where(F.col(column).isNotNull()).select(*_place(key)).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def missing_bitmaps(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """``block``, ``lost`` (bitmap) and ``n_lost`` of the fact's key values that the dimension lacks."""
    ours = key_bitmaps(fact, fk).select(F.col("block").alias("b"), F.col("bitmap").alias("held"))
    theirs = key_bitmaps(dim, dim_key)
    both = ours.join(theirs, F.col("b") == F.col("block"), "left").select(F.col("b").alias("block"), "held", "bitmap")

    def run(batches):
        for batch in batches:
            blocks, lost, n = [], [], []
            for block, held, there in zip(*(c.to_pylist() for c in batch.columns)):
                left = np.frombuffer(held, np.uint8)
                if there is not None:
                    left = left & ~np.frombuffer(there, np.uint8)
                if left.any():
                    blocks.append(block)
                    lost.append(left.tobytes())
                    n.append(int(np.bitwise_count(left).sum()))
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(lost, pa.binary()), pa.array(n, pa.int64())],
                                                 names=["block", "lost", "n_lost"])

    return both.mapInArrow(run, "block long, lost binary, n_lost long")


def _bit(bitmap: Column, position: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), position % 8)).cast("int") % 2 == 1


def fk_report_bitmap(fact: DataFrame, fks: Sequence[ForeignKey], max_broadcast_rows: int | None = None) -> DataFrame:
    """``fk_column, n_rows, n_null, n_orphan, n_orphan_keys`` per foreign key, as ``quality.fk_report`` counts them.

    ``n_orphan_keys`` is the number of different values among the orphans.
    Key columns must be integers, of any width. A key whose values are all
    there is not looked up again: its rows are only counted.
    """
    out = []
    zero = F.lit(0).cast("long")
    for fk in fks:
        lost = written(missing_bitmaps(fact, fk.column, fk.dim, fk.dim_key))
        total = lost.agg(F.coalesce(F.sum("n_lost"), zero)).first()[0]
        key = F.col(fk.column).cast("long")
        rows = fact.select(F.col(fk.column).isNull().alias("null"), F.bitmap_bucket_number(key).alias("b"), F.bitmap_bit_position(key).alias("bit"))
        orphan = F.lit(False)
        if total:
            side, _ = checked_broadcast(lost.select("block", "lost"), max_broadcast_rows, materialize=False)
            rows = rows.join(side, F.col("b") == F.col("block"), "left")
            orphan = F.coalesce(F.when(F.col("lost").isNotNull(), _bit(F.col("lost"), F.col("bit"))), F.lit(False))
        out.append(rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("null").alias("n_null"), F.count_if(orphan).alias("n_orphan"))
                   .select(F.lit(fk.column).alias("fk_column"), "*", F.lit(total).cast("long").alias("n_orphan_keys")))
    return reduce(DataFrame.unionByName, out)
