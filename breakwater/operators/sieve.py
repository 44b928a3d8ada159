"""A filter of bits that tells a scan which keys are wanted, so that the other rows need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter: at most 4,096 bitmaps of 4 KB, whatever the number of keys.
BITS = 1 << 27


def _place(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITS)) + 1


def sifted(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` without most of those whose key is not ``wanted``. No row with a wanted key is left out, and
    some others stay, so a join has to follow."""
    keys = list(keys)
    if any(rows.schema[k].dataType != wanted.schema[k].dataType for k in keys):
        return rows  # equal values of other types have other hashes
    place = wanted.select(_place(keys).alias("_place"))
    bitmaps = place.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap")
    )
    bit = F.bitmap_bit_position(_place(keys))
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    # Bounded by construction, see BITS.
    found = rows.join(F.broadcast(bitmaps), F.bitmap_bucket_number(_place(keys)) == F.col("_bucket"))
    return found.filter(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*rows.columns)
