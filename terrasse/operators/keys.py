"""Row choice per key: latest, first n, de-duplication, semi and anti membership.

``row_number() <= n`` filters are planned with a group limit before the shuffle, so each map
task sends at most ``n`` rows per key however hot the key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN, _BUCKET = "__rn", "__bucket"
BUCKETS = 32  # groups of map tasks in a pick of many rows per key


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, buckets: int = 1) -> DataFrame:
    """First ``n`` rows per key.

    With ``buckets`` the map tasks of a key are picked from in that many groups first, so that the last
    pick of a hot key meets ``buckets * n`` rows however many map tasks there are.
    """
    if buckets > 1:
        group = F.pmod(F.spark_partition_id(), F.lit(buckets))
        return _first_n(_first_n(df.withColumn(_BUCKET, group), [*keys, _BUCKET], order, n).drop(_BUCKET), keys, order, n)
    return _first_n(df, keys, order, n)


def _first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) <= n).drop(_RN)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_n_per_key(df, keys, order, 1)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row per key.

    Without ``order_by`` the ingest time decides, else the event time.  Ties are broken by the
    remaining columns, so the result does not depend on row order.
    """
    if order_by is None:
        order_by = next(([c] for c in ("_ingested_at", "event_timestamp") if c in df.columns), [])
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in {*keys, *order_by}]
    order = [F.col(c).desc() for c in [*order_by, *tie_breakers]] or [F.lit(0)]
    return first_per_key(df, keys, order)


def drop_duplicate_events(df: DataFrame, id_column: str = "event_id", order_by: Sequence[str] = ()) -> DataFrame:
    """Keep the earliest row per event id."""
    rest = [c for c in df.columns if c not in {id_column, *order_by}]
    return first_per_key(df, [id_column], [F.col(c).asc() for c in [*order_by, *rest]])


def keep_last_n(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int = 168) -> DataFrame:
    """The newest ``n`` history entries per key."""
    return top_n_per_key(df, keys, [F.col(c).desc() for c in order_by], n, BUCKETS)


def insert_if_absent(new: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``."""
    return new.join(existing.select(*on).distinct(), list(on), "left_anti")


def seen_before(df: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(known.select(*on).distinct(), list(on), "left_semi")


def with_existence_flag(df: DataFrame, members: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Left join on the distinct members, as a true/false column."""
    marked = members.select(*on).distinct().withColumn(flag, F.lit(True))
    return df.join(marked, list(on), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
