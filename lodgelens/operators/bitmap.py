"""Key bitmaps: which rows can't have a partner, known before they are shuffled.

``key_bitmap`` hashes a key column into a table of bitmaps (one of 2^15 bits a
row, made by ``bitmap_construct_agg``, reduced map-side).  It has 16 bits a
key, at most 2^26 bits: 16 MB in all as arrays, whatever the number of keys,
which is what lets it be broadcast.  ``may_hold`` keeps the rows whose key's bit
is set: all rows with a partner and, up to the bound, about one in 16 of the
others.  An exact join comes after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_A_KEY, MOST_BITS = 16, 1 << 26
PAGE = 1 << 15


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(bits))


def bitmap_bits(keys: int) -> int:
    """The bitmap's size for so many keys: a power of two from 2^15 to 2^26."""
    return min(max(1 << max(keys * BITS_A_KEY - 1, 1).bit_length(), PAGE), MOST_BITS)


def key_bitmap(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(page, words) of the bitmap of ``keys``' column ``key`` (NULL left out), and its size in bits."""
    known = keys.where(F.col(key).isNotNull())
    bits = bitmap_bits(known.count())
    at = known.select(_bit(F.col(key), bits).alias("at"))
    pages = at.groupBy(F.bitmap_bucket_number("at").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
    # 32 bits a word, so that a test is an element and a shift
    words = F.transform(F.sequence(F.lit(0), F.lit(PAGE // 32 - 1)),
                        lambda i: F.conv(F.hex(F.substring("bitmap", i * 4 + 1, F.lit(4))), 16, 10).cast("long"))
    return pages.select("page", words.alias("words")), bits


def may_hold(df: DataFrame, key: str, bitmap: tuple[DataFrame, int]) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be one of the bitmap's keys; NULL keys go."""
    pages, bits = bitmap
    at = _bit(F.col(key), bits)
    place = F.bitmap_bit_position(at)
    # byte b of a page holds its places 8b to 8b + 7, least bit first; words are big-endian
    shift = ((F.lit(3) - F.floor(place / 8) % 4) * 8 + place % 8).cast("int")
    word = F.element_at("_words", (F.floor(place / 32) + 1).cast("int"))
    with_page = df.where(F.col(key).isNotNull()).withColumn("_page", F.bitmap_bucket_number(at))
    side = F.broadcast(pages.select(F.col("page").alias("_of"), F.col("words").alias("_words")))
    met = with_page.join(side, F.col("_page") == F.col("_of")).where(F.getbit(word, shift) == 1)
    return met.select(*df.columns)


def semi_join(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``df.join(keys, key, "left_semi")``; rows without a partner mostly go before the shuffle."""
    return may_hold(df, key, key_bitmap(keys, key)).join(keys.select(key), key, "left_semi")
