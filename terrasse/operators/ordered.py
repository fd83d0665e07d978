"""Ordered per-key columns (next, previous, last known, running total) that survive hot keys.

A window over ``partitionBy(key)`` puts every row of a key into one task.  That is the right
plan while keys are small.  A key that holds a large part of the table is handled apart: its
rows are range-partitioned on the full order into consecutive runs, each run is windowed on
its own, and one summary row per run hands the missing values over the run borders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasse.settings import BROADCAST_ROWS, RUN_ROWS, durable, durable_counted, limit_of

RUN = "__run"
_ROWS = "__rows"


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on all keys where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame | None, DataFrame | None]:
    """Return ``(calm, hot)``; ``hot`` carries a run number that grows along ``order``.

    The count below reads the key columns only and combines on the map side, so a hot key
    costs one row per map task.
    """
    spark = df.sparkSession
    rows_per_run = limit_of(spark, RUN_ROWS)

    if not keys:
        total = df.count()
        if total <= rows_per_run:
            return df, None
        return None, _runs(df, order, total, rows_per_run)

    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS)).filter(F.col(_ROWS) > rows_per_run)
    n_keys, n_rows = sizes.agg(F.count(F.lit(1)), F.sum(_ROWS)).first()
    if not n_keys:
        return df, None

    names = durable(sizes.select(*[F.col(k).alias(f"__h_{k}") for k in keys]), "hot-keys")
    if n_keys <= limit_of(spark, BROADCAST_ROWS):
        names = F.broadcast(names)
    match = reduce(lambda a, b: a & b, [df[k].eqNullSafe(names[f"__h_{k}"]) for k in keys])
    calm = df.join(names, match, "left_anti")
    hot = df.join(names, match, "left_semi")
    return calm, _runs(hot, [*keys, *order], n_rows, rows_per_run)


def _runs(df: DataFrame, sort_columns: Sequence[str], rows: int, rows_per_run: int) -> DataFrame:
    # Written out because a second evaluation would sample other range borders.
    parts = -(-rows // rows_per_run) + 1
    ranged = df.repartitionByRange(parts, *sort_columns).withColumn(RUN, F.spark_partition_id())
    return durable(ranged, "runs")


def over_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    last: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    total: Mapping[str, str] | None = None,
    index: str | None = None,
) -> DataFrame:
    """Add ordered columns; every mapping is ``{new column: source column}``.

    ``last``  last non-NULL value so far in the key, this row included
    ``lead``  value of the next row            ``lag``  value of the previous row
    ``total`` running sum, this row included   ``index`` name for the row number from 1

    ``order`` must be a total order within the key, ascending.
    """
    wanted = dict(last=last or {}, lead=lead or {}, lag=lag or {}, total=dict(total or {}))
    if index:
        df = df.withColumn("__one", F.lit(1).cast("bigint"))
        wanted["total"][index] = "__one"
    calm, hot = split_hot(df, keys, order)
    parts = []
    if calm is not None:
        parts.append(_plain(calm, keys, order, **wanted))
    if hot is not None:
        parts.append(_across_runs(hot, keys, order, **wanted))
    out = reduce(DataFrame.unionByName, parts)
    return out.drop("__one") if index else out


def _plain(df, keys, order, last, lead, lag, total):
    w = Window.partitionBy(*keys).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "*",
        *[F.last(c, ignorenulls=True).over(so_far).alias(n) for n, c in last.items()],
        *[F.lead(c).over(w).alias(n) for n, c in lead.items()],
        *[F.lag(c).over(w).alias(n) for n, c in lag.items()],
        *[F.sum(c).over(so_far).alias(n) for n, c in total.items()],
    )


def _across_runs(df, keys, order, last, lead, lag, total):
    group = [*keys, RUN]
    at = F.struct(*order)
    needed = sorted({*lead.values(), *lag.values()})
    row = F.struct(*(needed or order))

    summary = df.groupBy(*group).agg(
        F.min_by(row, at).alias("__head"),
        F.max_by(row, at).alias("__tail"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"__last_{n}") for n, c in last.items()],
        *[F.sum(c).alias(f"__total_{n}") for n, c in total.items()],
    )
    along = Window.partitionBy(*keys).orderBy(RUN)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carry, borders = durable_counted(
        summary.select(
            *group,
            F.lead("__head").over(along).alias("__after"),
            F.lag("__tail").over(along).alias("__before"),
            *[F.last(f"__last_{n}", ignorenulls=True).over(before).alias(f"__carry_{n}") for n in last],
            *[F.sum(f"__total_{n}").over(before).alias(f"__carry_{n}") for n in total],
        ),
        "run-borders",
    )
    if borders <= limit_of(df.sparkSession, BROADCAST_ROWS):
        carry = F.broadcast(carry)

    w = Window.partitionBy(*group).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.select(
        "*",
        *[F.last(c, ignorenulls=True).over(so_far).alias(n) for n, c in last.items()],
        # wrapped in a struct, so that NULL means "no such row" and not "NULL value"
        *[F.lead(F.struct(c)).over(w).alias(n) for n, c in lead.items()],
        *[F.lag(F.struct(c)).over(w).alias(n) for n, c in lag.items()],
        *[F.sum(c).over(so_far).alias(n) for n, c in total.items()],
    )
    joined = local.join(carry, same_key(local, carry, group), "left")
    computed = {*last, *lead, *lag, *total}
    return joined.select(
        *[local[c] for c in df.columns if c != RUN and c not in computed],
        *[F.coalesce(local[n], carry[f"__carry_{n}"]).alias(n) for n in last],
        *[
            F.when(local[n].isNotNull(), local[n].getField(c)).otherwise(carry["__after"].getField(c)).alias(n)
            for n, c in lead.items()
        ],
        *[
            F.when(local[n].isNotNull(), local[n].getField(c)).otherwise(carry["__before"].getField(c)).alias(n)
            for n, c in lag.items()
        ],
        *[
            F.when(local[n].isNull(), carry[f"__carry_{n}"])
            .otherwise(local[n] + F.coalesce(carry[f"__carry_{n}"], F.lit(0)))
            .alias(n)
            for n in total
        ],
    )


def trailing_stats(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, rows: int,
    mean: str = "trailing_mean", spread: str = "trailing_stddev", seen: str = "trailing_n",
) -> DataFrame:
    """Mean, sample standard deviation and count of ``value`` over the ``rows`` rows before each row."""

    def stats(frame, partition, by):
        w = Window.partitionBy(*partition).orderBy(*by).rowsBetween(-rows, -1)
        return frame.select(
            "*",
            F.avg(value).over(w).alias(mean),
            F.stddev_samp(value).over(w).alias(spread),
            F.count(value).over(w).alias(seen),
        )

    calm, hot = split_hot(df, keys, order)
    parts = []
    if calm is not None:
        parts.append(stats(calm, keys, order))
    if hot is not None:
        # Number the rows, cut the numbers into equal blocks and lend each block the last
        # ``rows`` rows of the block before it.
        size = max(rows, limit_of(df.sparkSession, RUN_ROWS))
        numbered = _across_runs(
            hot.withColumn("__one", F.lit(1).cast("bigint")), keys, order, {}, {}, {}, {"__n": "__one"}
        ).drop("__one")
        position = F.col("__n") - 1
        own = F.floor(position / size)
        lent = F.when(position % size >= size - rows, F.array(own, own + 1)).otherwise(F.array(own))
        blocks = numbered.withColumn("__own", own).withColumn("__block", F.explode(lent))
        out = stats(blocks, [*keys, "__block"], ["__n"]).filter(F.col("__block") == F.col("__own"))
        parts.append(out.drop("__n", "__own", "__block"))
    return reduce(DataFrame.unionByName, parts)
