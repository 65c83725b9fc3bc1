"""Key sketch: a bitmap of hashed keys, bounded in size whatever their number.

``key_sketch`` sets one bit per key in ``2**bits`` bits, stored as rows of
4 KB (``bitmap_construct_agg``); ``in_sketch`` looks a frame's keys up in it by
a broadcast join on the bitmap's number. A key that was put in is always found;
another one is found with the share of set bits. So a sketch may reduce a large
side before an exact join or count, and never replaces it. The broadcast holds
``2**bits / 8`` bytes at most: ``BITS`` is 64 MB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 29
_ROW_BITS = 15  # bits of a place within one bitmap: fixed by bitmap_construct_agg


def _number(key: Column, bits: int) -> Column:
    return F.shiftright(key, 64 - bits + _ROW_BITS) if bits > _ROW_BITS else F.lit(0).cast("bigint")


def _place(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).bitwiseAND(F.lit((1 << min(bits, _ROW_BITS)) - 1)).cast("bigint")


def hashed(*keys: Column | str) -> Column:
    """The 64-bit hash whose upper bits name a place in a sketch."""
    return F.xxhash64(*keys)


def key_sketch(keys: DataFrame, key: Column, bits: int = BITS) -> DataFrame:
    """(number, bitmap) of the 64-bit hashes ``key`` of ``keys``. The places are
    moved as they are (a bitmap per task and number would be larger), so a
    bitmap is built by one task from the places of its number alone."""
    places = keys.select(_number(key, bits).alias("number"), _place(key, bits).alias("place"))
    return places.repartition("number").groupBy("number").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def in_sketch(df: DataFrame, key: Column, sketch: DataFrame, flag: str, bits: int = BITS) -> DataFrame:
    """``df`` with the boolean column ``flag``: the hash ``key`` may be in the sketch."""
    number, bitmap = f"{flag}_number", f"{flag}_bitmap"
    side = F.broadcast(sketch.select(F.col("number").alias(number), F.col("bitmap").alias(bitmap)))
    place = _place(key, bits).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), place.bitwiseAND(F.lit(7)) + 1)
    found = F.col(bitmap).isNotNull() & (byte.bitwiseAND(mask) != 0)
    return (df.join(side, _number(key, bits) == F.col(number), "left")
            .withColumn(flag, F.coalesce(found, F.lit(False))).drop(number, bitmap))


def distinct_counts(df: DataFrame, value: str, fingerprint: Column | None = None, bits: int = 27) -> DataFrame:
    """One row (n_rows, n_distinct): rows, and distinct non-NULL values of
    ``value``; exact, in two stages.

    The first stage counts 8-byte fingerprints, which is all it moves. A value
    whose fingerprint is alone in the table is distinct without being looked
    at; the fingerprints found several times are put into a sketch, and only
    rows that are in it (repeated values, a collision of fingerprints, or a
    place of the sketch that is shared) go on with the whole value, so nothing
    depends on the fingerprints being free of collisions. ``df`` is read twice."""
    print_ = hashed(value) if fingerprint is None else fingerprint
    rows = df.select(F.col(value).alias("value"), print_.cast("bigint").alias("print"))
    repeated = (rows.where("value is not null").groupBy("print").agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("print"))
    told = in_sketch(rows, hashed("print"), key_sketch(repeated, hashed("print"), bits), "several", bits)
    alone = ~F.col("several") & F.col("value").isNotNull()
    return told.agg(F.count(F.lit(1)).alias("n_rows"),
                    (F.count_if(alone) + F.count_distinct(F.when(F.col("several"), F.col("value")))).alias("n_distinct"))
