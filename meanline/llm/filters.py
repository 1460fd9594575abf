"""A filter of fixed size for keys that are wanted in a later join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BITS = 1 << 23


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """The ``rows`` whose ``key`` may be in ``wanted``: all that are, and few others.  With ``keep`` off, the rest.

    The filter is a bitmap of hashes, 1 MiB however many keys are wanted, so it may be broadcast; when
    it fills up it only filters less.  Null keys are never wanted.
    """
    number = F.pmod(F.xxhash64(key), F.lit(_BITS))
    bitmaps = wanted.where(F.col(key).isNotNull()).select(number.alias("n")).groupBy(
        F.bitmap_bucket_number("n").alias("_part")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("_bits"))
    bit = "(cast(conv(hex(substring(_bits, cast(_place div 8 as int) + 1, 1)), 16, 10) as int) >> cast(_place % 8 as int)) & 1"
    found = rows.withColumn("_part", F.bitmap_bucket_number(number)).withColumn(
        "_place", F.bitmap_bit_position(number)
    ).join(F.broadcast(bitmaps), "_part", "left")
    held = F.coalesce(F.expr(f"({bit}) = 1"), F.lit(False)) & F.col(key).isNotNull()
    return found.where(held if keep else ~held).select(*rows.columns)
