"""Distinct ids per day that merge: the days of a window are united, their rows are not read again.

For dense whole-number ids a day is a few bitmaps of 32,768 ids each, and counts are exact.  For any ids a day is one
sketch of some kilobytes (HyperLogLog), and counts are estimates.  Both are small next to the rows, are combined on the map
side, and can be stored and extended day by day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS = 12  # a sketch of 2^12 buckets has a standard error of about 1.6 %


def daily_bitmaps(df: DataFrame, keys: Sequence[str], id_column: str, ts: str) -> DataFrame:
    """``keys, day, bucket, ids``: which ids were seen on a day; rows without id or time do not count.

    Ids are whole numbers from 0.  They should be dense: an id that is alone among its 32,768 neighbours costs a whole bitmap.
    """
    known = df.filter(F.col(id_column).isNotNull() & F.col(ts).isNotNull())
    bit = F.bitmap_bit_position(F.col(id_column).cast("bigint") + 1)  # bitmaps number from 1
    bucket = F.bitmap_bucket_number(F.col(id_column).cast("bigint") + 1)
    return known.groupBy(*keys, F.to_date(ts).alias("day"), bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("ids"))


def daily_sketches(df: DataFrame, keys: Sequence[str], id_column: str, ts: str, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """``keys, day, ids``: a sketch of the ids seen on a day; rows without id or time do not count."""
    known = df.filter(F.col(id_column).isNotNull() & F.col(ts).isNotNull())
    return known.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.hll_sketch_agg(F.col(id_column), log_buckets).alias("ids"))


def _spread(days: DataFrame, window: int, first: Column, last: Column) -> DataFrame:
    """Every day's row once for each day whose trailing window holds it, from ``first`` to ``last``."""
    start, end = F.greatest(F.col("day"), first), F.least(F.date_add("day", window - 1), last)
    reached = days.filter(start <= end)
    return reached.withColumn("day", F.explode(F.sequence(start, end)))


def trailing_exact(bitmaps: DataFrame, keys: Sequence[str], window: int, first: Column, last: Column) -> DataFrame:
    """``keys, day, users``: distinct ids of the ``window`` days that end with ``day``; windows without ids have no row."""
    merged = _spread(bitmaps, window, first, last).groupBy(*keys, "day", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("ids")).alias("n"))
    return merged.groupBy(*keys, "day").agg(F.sum("n").alias("users"))


def trailing_estimate(sketches: DataFrame, keys: Sequence[str], window: int, first: Column, last: Column) -> DataFrame:
    """Like `trailing_exact`, from sketches."""
    merged = _spread(sketches, window, first, last).groupBy(*keys, "day").agg(F.hll_union_agg("ids").alias("ids"))
    return merged.select(*keys, "day", F.hll_sketch_estimate("ids").alias("users"))
