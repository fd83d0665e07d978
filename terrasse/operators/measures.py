"""Aggregates: group metrics, shares, pivots, ranks, top lists, distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasse.functions.ordering import double_of_key, with_double_key
from terrasse.operators.ordered import over_order
from terrasse.settings import durable

# Fixed value: number of equal-width bins.
BINS = 30


def group_metrics(df: DataFrame, keys: Sequence[str], value: str, digits: int = 2, names: Mapping[str, str] | None = None) -> DataFrame:
    """Rows, mean, minimum, maximum and sum per group."""
    n = {"rows": "row_count", "mean": "avg_value", "min": "min_value", "max": "max_value", "sum": "sum_value", **(names or {})}
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(n["rows"]),
        F.round(F.avg(value), digits).alias(n["mean"]),
        F.min(value).alias(n["min"]),
        F.max(value).alias(n["max"]),
        F.sum(value).alias(n["sum"]),
    )


def counts_by(df: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def rate(part: str | Column, whole: str | Column, digits: int = 1, factor: int = 100) -> Column:
    """Rounded ratio; NULL when the denominator is zero."""
    p = F.col(part) if isinstance(part, str) else part
    w = F.col(whole) if isinstance(whole, str) else whole
    return F.round(F.try_divide(p, w) * factor, digits)


def distinct_count(df: DataFrame, keys: Sequence[str], value: str, name: str = "n_distinct", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(value) if approximate else F.count_distinct(value)
    return (df.groupBy(*keys) if keys else df).agg(count.alias(name))


def monthly_counts(df: DataFrame, ts: str | Column, keys: Sequence[str] = (), name: str = "n", period: str = "period") -> DataFrame:
    """Rows per calendar month, labelled with its first day; rows without a date drop out."""
    when = F.col(ts) if isinstance(ts, str) else ts
    return counts_by(df.withColumn(period, F.date_trunc("month", when)).filter(F.col(period).isNotNull()), [*keys, period], name)


def fill_months(monthly: DataFrame, name: str = "n", period: str = "period", keys: Sequence[str] = ()) -> DataFrame:
    """Add the empty months between the first and the last one, of each key if there are keys."""
    span = (monthly.groupBy(*keys) if keys else monthly).agg(F.min(period).alias("a"), F.max(period).alias("b"))
    months = span.select(*keys, F.explode(F.expr("sequence(a, b, interval 1 month)")).alias(period))
    return months.join(monthly, [*keys, period], "left").fillna(0, subset=[name])


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 2, factor: int = 100) -> DataFrame:
    """Share of the grand total.

    ``df`` is an aggregate: it is written once, so that the total does not compute it again.
    """
    df = durable(df, "shares")
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.round(F.try_divide(F.col(value), total) * factor, digits))


def share_in_group(df: DataFrame, groups: Sequence[str], value: str, name: str, digits: int = 1, factor: int = 100) -> DataFrame:
    """Share inside a group, from group totals that are combined before their shuffle.

    ``df`` is an aggregate and is written once.
    """
    df = durable(df, "shares")
    totals = df.groupBy(*groups).agg(F.sum(value).alias("__total"))
    joined = df.join(totals.select(*[F.col(g).alias(f"__g_{g}") for g in groups], "__total"),
                     reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in groups]), "left")
    return joined.select(*df.columns, F.round(F.try_divide(F.col(value), F.col("__total")) * factor, digits).alias(name))


def pivot_sum(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[object], value: str | None = None) -> DataFrame:
    """Pivot with zero fill; naming the values saves a job that looks for them."""
    grouped = df.groupBy(*rows).pivot(column, list(values))
    wide = grouped.sum(value) if value else grouped.count()
    return wide.fillna(0, subset=[str(v) for v in values])


def row_shares(wide: DataFrame, columns: Sequence[str], digits: int = 1, suffix: str = "_pct") -> DataFrame:
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return wide.withColumns({f"{c}{suffix}": F.round(F.try_divide(F.col(c), total) * 100, digits) for c in columns})


def ratio_of_sums(
    df: DataFrame, keys: Sequence[str], ratios: Mapping[str, tuple[str | Column, str | Column]], digits: int = 4,
    means: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """Ratios of group sums, where a zero denominator gives NULL, and plain means beside them."""
    return df.groupBy(*keys).agg(
        *[F.round(F.try_divide(F.sum(a), F.sum(b)), digits).alias(n) for n, (a, b) in ratios.items()],
        *[F.round(F.avg(c), digits).alias(n) for n, c in (means or {}).items()],
    )


def global_rank(df: DataFrame, value: str, name: str, descending: bool = True) -> DataFrame:
    """``rank()`` over the whole table without sorting it in one task.

    Rows per value are counted first; a running total over the distinct values, split into
    runs when there are many, gives every value its rank.  ``df`` is written once, so that both
    uses see the same values.
    """
    df = durable(df, "ranked")
    per_value = df.groupBy(F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    # Running through descending order, NULLs come last.
    per_value = per_value.withColumn("__by", -F.col("__v") if descending else F.col("__v"))
    per_value = per_value.withColumn("__null", F.col("__v").isNull().cast("int"))
    ranked = over_order(per_value, [], ["__null", "__by"], total={"__upto": "__n"})
    ranks = ranked.select(F.col("__v"), (F.col("__upto") - F.col("__n") + 1).alias(name))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("__v")), "left").drop("__v")


def top_k(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    """Sorted first k; each task keeps k rows."""
    return df.orderBy(*by).limit(k)


def both_tails(df: DataFrame, value: str, ties: Sequence[str], k: int) -> DataFrame:
    """The k smallest and the k largest rows, without duplicates; ``df`` is an aggregate and is written once."""
    df = durable(df, "tails")
    low = top_k(df, [F.col(value).asc(), *[F.col(t).asc() for t in ties]], k)
    high = top_k(df, [F.col(value).desc(), *[F.col(t).asc() for t in ties]], k)
    return low.union(high).distinct()


def top_group_series(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """All rows of the k groups with the largest mean; ``df`` is an aggregate and is written once."""
    df = durable(df, "series")
    means = df.groupBy(group).agg(F.avg(value).alias("__mean"))
    best = top_k(means, [F.col("__mean").desc(), F.col(group).asc()], k).select(group)
    return df.join(F.broadcast(best), group, "left_semi")  # k rows


def equal_width_bin(value: str | Column, low: Column, high: Column, bins: int = BINS) -> Column:
    """Bin number from 1; the last bin includes its upper edge."""
    v = F.col(value) if isinstance(value, str) else value
    raw = F.floor((v - low) / ((high - low) / bins)) + 1
    return F.when(high == low, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")


def edges_of(df: DataFrame, columns: Sequence[str]) -> Column:
    """Smallest and largest value of each column, as one struct read once per query."""
    parts = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("lo", F.min), ("hi", F.max))]
    return df.agg(F.struct(*parts)).scalar()


def histogram(df: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """(bin, n) over equal-width bins; NULLs are left out."""
    values = df.select(column).filter(F.col(column).isNotNull())
    edge = edges_of(values, [column])
    bounds = [edge.getField(f"{side}_{column}") for side in ("lo", "hi")]
    return counts_by(values.select(equal_width_bin(column, *bounds, bins).alias("bin")), ["bin"])


def density_2d(df: DataFrame, x: str, y: str, bins: int = BINS) -> DataFrame:
    """(x_bin, y_bin, n) on a square grid; rows with a NULL coordinate are left out."""
    points = df.select(x, y).dropna()
    edge = edges_of(points, [x, y])

    def position(c: str) -> Column:
        return equal_width_bin(c, edge.getField(f"lo_{c}"), edge.getField(f"hi_{c}"), bins)

    return counts_by(points.select(position(x).alias("x_bin"), position(y).alias("y_bin")), ["x_bin", "y_bin"])


# Bits of a value that one round of a selection looks at.
DIGIT = 16


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(column, p, value), exact, with linear interpolation; a column without values has no row.

    A radix selection on whole numbers that order as the values do.  They are written once, two numbers for each value.  A
    round counts the next ``DIGIT`` bits of those that share their upper bits with a wanted rank, combined on the map
    side, and finds in these counts, 65,536 for each wanted rank at most, which bits it has.  Four rounds find all 64, so the
    work does not depend on what the values are, and ranks of equal values need no special care.
    """
    if not columns or not probabilities:
        return df.sparkSession.createDataFrame([], "column string, p double, value double")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    cells = df.select(F.explode(cells).alias("e")).select("e.*").filter("v IS NOT NULL")
    keys = durable(with_double_key(cells, "v", "key").select("column", "key"), "ordered-keys")
    pos = F.col("p") * (F.col("total") - 1)
    wanted = keys.groupBy("column").agg(F.count(F.lit(1)).alias("total")).withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    sides = F.array(F.floor(pos).cast("bigint"), F.ceil(pos).cast("bigint"))
    wanted = wanted.select("column", "p", pos.alias("pos"), F.posexplode(sides).alias("side", "rank"), F.lit(0).cast("bigint").alias("upper"))
    wanted = durable(wanted, "ranks")  # two rows per column and probability, here and after each round
    for shift in range(64 - DIGIT, -1, -DIGIT):
        upper = F.shiftright("key", shift + DIGIT) if shift + DIGIT < 64 else F.lit(0).cast("bigint")
        near = keys.join(F.broadcast(wanted.select("column", F.col("upper").alias("__upper")).distinct()), "column").filter(upper == F.col("__upper"))
        counts = near.groupBy("column", F.col("__upper").alias("upper"), F.shiftright("key", shift).alias("next")).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.partitionBy("column", "upper").orderBy("next")) - F.col("n")
        found = wanted.join(counts.withColumn("before", before), ["column", "upper"]).filter(F.col("rank").between(F.col("before"), F.col("before") + F.col("n") - 1))
        wanted = durable(found.select("column", "p", "pos", "side", (F.col("rank") - F.col("before")).alias("rank"), F.col("next").alias("upper")), "ranks")
    value = double_of_key(F.col("upper"))
    ends = wanted.groupBy("column", "p", "pos").agg(F.max(F.when(F.col("side") == 0, value)).alias("lo"), F.max(F.when(F.col("side") == 1, value)).alias("hi"))
    between = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("pos") - F.floor("pos"))
    return ends.select("column", "p", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(between).alias("value"))


def describe_numeric(df: DataFrame, columns: Sequence[str], digits: int = 6, approximate: bool = False) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum, one row per column."""
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    per_column = []
    for c in columns:
        fields = [
            F.lit(c).alias("column"), F.count(c).alias("count"), F.round(F.avg(c), digits).alias("mean"),
            F.round(F.stddev_samp(c), digits).alias("std"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ]
        if approximate:
            fields += [F.percentile_approx(c, p).cast("double").alias(n) for n, p in quartiles.items()]
        per_column.append(F.struct(*fields))
    basics = df.agg(F.array(*per_column).alias("a")).select(F.inline("a"))
    if approximate:
        return basics
    q = exact_quantiles(df, columns, list(quartiles.values())).groupBy("column").agg(
        *[F.round(F.max(F.when(F.col("p") == p, F.col("value"))), digits).alias(n) for n, p in quartiles.items()]
    )
    return basics.join(q, "column", "left")


def null_rates(df: DataFrame, digits: int = 4, factor: int = 1) -> DataFrame:
    """(column, null_rate) for all columns from one pass."""
    names = df.columns
    wide = df.agg(*[F.round(F.avg(F.col(c).isNull().cast("int")) * factor, digits).alias(f"c{i}") for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("null_rate")) for i, c in enumerate(names)])
    return wide.select(F.inline(rows))


def hash_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``n`` rows: those with the smallest key hash, ties by all columns.

    Sort and limit are one top-k, so each map task sends at most ``n`` rows.
    """
    h = F.md5(F.concat_ws("|", F.lit(seed).cast("string"), *[F.col(k).cast("string") for k in keys]))
    rest = [c for c in df.columns if c not in keys]
    return df.withColumn("__h", h).orderBy("__h", *keys, *rest).limit(n).drop("__h")


def partition_sizes(df: DataFrame) -> DataFrame:
    return counts_by(df.withColumn("partition", F.spark_partition_id()), ["partition"])


def linear_fit(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """Least-squares line and its R², from one aggregate."""
    return df.agg(
        F.round(F.regr_slope(y, x), digits).alias("slope"),
        F.round(F.regr_intercept(y, x), digits).alias("intercept"),
        F.round(F.regr_r2(y, x), digits).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )
