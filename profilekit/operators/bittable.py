"""Bit tables: a summary of an id list that fits in memory however long the list is.

An id list past the broadcast bound would make the whole log travel to a
shuffle join, though few of its rows are listed. A bit table is a Bloom filter
in blocks of Spark's own bitmaps: an id's hash names one block and up to four
bits of it. Tasks build the blocks, at most ``MAX_BITS`` in all, so the table
can be broadcast whatever the list's length; log rows meet their block at the
scan and rows of a bit that is not set go before any shuffle. The table has no
false negatives: an exact join behind it decides, the table only spares rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilekit.session import shared_path

# Bits in one of Spark's bitmaps (4 KB).
BLOCK_BITS = 32768
# Bits given to each id, as long as the table stays within MAX_BITS (64 MB).
BITS_PER_ID = 16
MAX_BITS = 1 << 29
# Bits set per id: pieces of 15 bits of a 64-bit hash.
MAX_PLACES = 4


@dataclass(frozen=True)
class BitTable:
    """Rows ``(block, bits)``, the number of blocks and the bits set per id."""

    rows: DataFrame
    blocks: int
    places: int


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _place(code: Column, i: int) -> Column:
    return F.shiftright(code, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1))


def _code(key: Column) -> Column:
    return F.xxhash64(key, F.lit(1))


def bit_table(ids: DataFrame, key: str, n_ids: int | None = None, max_bits: int | None = None) -> BitTable:
    """The table of the list's ids, written to the shared folder; nulls are left out, repeats change nothing.

    Repeated ids are combined inside the tasks, so a hot id does not reach one
    task; then ids travel to their block as two numbers each. ``n_ids`` (rows
    of the list, counted if not given) only sets the table's size.
    """
    n = max(1, ids.count() if n_ids is None else n_ids)
    most = max(1, (MAX_BITS if max_bits is None else max_bits) // BLOCK_BITS)
    blocks = min(most, -(-n * BITS_PER_ID // BLOCK_BITS))
    places = max(1, min(MAX_PLACES, round(0.69 * blocks * BLOCK_BITS / n)))
    spark, path = ids.sparkSession, shared_path(ids.sparkSession, "bit-table")
    codes = (ids.filter(F.col(key).isNotNull())
             .select(_block(F.col(key), blocks).alias("block"), _code(F.col(key)).alias("code")).distinct())
    (codes.repartition("block")
     .select("block", F.explode(F.array(*[_place(F.col("code"), i) for i in range(places)])).alias("place"))
     .groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))
     .write.parquet(path))
    return BitTable(spark.read.schema("block long, bits binary").parquet(path), blocks, places)


def maybe_listed(rows: DataFrame, key: str, table: BitTable) -> DataFrame:
    """The rows whose key may be in the list: all that are, and few others. Rows of a null key go."""
    mark = uuid.uuid4().hex[:12]
    block, bits = f"_block_{mark}", f"_bits_{mark}"
    side = F.broadcast(table.rows.toDF(block, bits))  # at most MAX_BITS
    met = rows.join(side, _block(F.col(key), table.blocks) == F.col(block))
    keep = F.col(key).isNotNull()
    for i in range(table.places):
        place = _place(_code(F.col(key)), i)
        byte = F.conv(F.hex(F.substring(F.col(bits), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10)
        keep = keep & (F.getbit(byte.cast("int"), place.bitwiseAND(F.lit(7)).cast("int")) == 1)
    return met.filter(keep).drop(block, bits)


def few_unlisted(rows: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """``rows`` without most of the unlisted ones, for an exact join with ``ids`` that follows.

    Keys of unlike types are compared after a cast, which a hash does not see: such rows are left as they are.
    """
    if rows.schema[key].dataType != ids.schema[id_col].dataType:
        return rows
    return maybe_listed(rows, key, bit_table(ids, id_col))
