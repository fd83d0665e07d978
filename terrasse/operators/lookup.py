"""Code-list enrichment, role-playing lookups, JSON-array bridges, fact and dimension joins.

Code lists have no bound, so none is broadcast whole on purpose.  Spark broadcasts a list whose size, measured from its
files or at run time, is below its threshold, and joins by sorting above.  In `look_up` neither rows without a code nor those of
a frequent code meet in one task, whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.settings import HOT_CODES, limit_of

SPREAD = 1 << 16  # values over which rows that need no lookup are dealt


def padded_code(code: str | Column, width: int = 4) -> Column:
    """Left-pad with zeros; a longer code is kept whole."""
    c = (F.col(code) if isinstance(code, str) else code).cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def prefer_reference(
    df: DataFrame, reference: DataFrame, code: str, reference_code: str, columns: Mapping[str, str], width: int = 4
) -> DataFrame:
    """Overwrite ``columns`` (``{own: reference}``) where the code is known; no row is lost.

    Both sides are joined on the padded code.  The reference must hold one row per code; extra
    rows are reduced to the smallest.
    """
    ref = (
        reference.groupBy(padded_code(reference_code, width).alias("__code"))
        .agg(F.min(F.struct(*[F.col(r).alias(own) for own, r in columns.items()])).alias("__ref"))
    )
    joined = df.withColumn("__own_code", padded_code(code, width)).join(
        ref, F.col("__own_code") == F.col("__code"), "left"
    )
    return joined.select(
        *[
            F.coalesce(F.col("__ref").getField(c), F.col(c)).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def _frequent(df: DataFrame, column: str, listed: DataFrame, most: int) -> DataFrame:
    """``column, __known``: codes that hold at least 1 / ``most`` of the rows with a code, at most ``most``, with their attributes."""
    sizes = df.select(column).filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    hot = sizes.filter(F.col("__n") * most >= sizes.agg(F.sum("__n")).scalar()).join(listed, column, "left")
    return hot.select(column, F.struct(*[c for c in listed.columns if c != column]).alias("__known"))


def look_up(df: DataFrame, lists: Mapping[str, DataFrame]) -> DataFrame:
    """Left joins of ``df`` with the columns of code lists (``{column: list}``), each on its column.

    Frequent codes are broadcast with their attributes.  Rows whose codes are all frequent or missing are done then and are not
    shuffled; of the others, those that need nothing from a list are dealt by a hash of the whole row when the others meet it.
    """
    most, seen = limit_of(df.sparkSession, HOT_CODES), df
    for i, (column, listed) in enumerate(lists.items()):
        hot = _frequent(df, column, listed, most).select(F.col(column).alias(f"__hot{i}"), F.col("__known").alias(f"__known{i}"))
        seen = seen.join(F.broadcast(hot), F.col(column) == F.col(f"__hot{i}"), "left")  # at most ``most`` codes
    rare = [F.col(c).isNotNull() & F.col(f"__hot{i}").isNull() for i, c in enumerate(lists)]
    some = reduce(lambda a, b: a | b, rare)
    rest = seen.filter(some)
    spread = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]), F.lit(SPREAD)) + 1
    for i, (column, listed) in enumerate(lists.items()):
        rest = rest.withColumn("__own", F.struct(F.col(column).alias("code"), F.when(rare[i], 0).otherwise(spread).alias("spread")))
        theirs = listed.select(
            F.struct(F.col(column).alias("code"), F.lit(0).cast("bigint").alias("spread")).alias("__theirs"),
            F.struct(*[c for c in listed.columns if c != column]).alias(f"__found{i}"))
        rest = rest.join(theirs, F.col("__own") == F.col("__theirs"), "left").drop("__own", "__theirs")
    keys = list(reversed(lists))
    kept = [*keys, *[c for c in df.columns if c not in lists]]

    def picked(rows: DataFrame, found: list[Column]) -> DataFrame:
        return rows.select(*kept, *[v.getField(c).alias(c) for v, (k, listed) in zip(found, lists.items(), strict=True) for c in listed.columns if c != k])

    known = [F.col(f"__known{i}") for i in range(len(lists))]
    late = [F.when(rare[i], F.col(f"__found{i}")).otherwise(known[i]) for i in range(len(lists))]
    return picked(seen.filter(~some), known).unionByName(picked(rest, late))


def role_lookups(df: DataFrame, codes: DataFrame, code: str, attributes: Sequence[str], roles: Mapping[str, str]) -> DataFrame:
    """Look the same code list up once per role column (``{column: prefix}``)."""
    listed = codes.select(code, *attributes)
    return look_up(df, {
        column: listed.select(F.col(code).alias(column), *[F.col(a).alias(f"{prefix}_{a}") for a in attributes]) for column, prefix in roles.items()
    })


def json_array_rows(df: DataFrame, keep: Sequence[str], column: str, element_schema: str) -> DataFrame:
    """One row per element of a JSON array; NULL, broken and empty arrays give no row."""
    parsed = F.from_json(F.col(column), f"array<{element_schema}>")
    return df.select(*keep, F.explode(parsed).alias("__item")).select(*keep, "__item.*")


def bridge(rows: DataFrame, codes: DataFrame, code: str, attributes: Mapping[str, str], list_code: str) -> DataFrame:
    """Add code-list attributes (``{output: list column}``) to exploded rows."""
    listed = codes.select(F.col(list_code).alias(code), *[F.col(src).alias(dst) for dst, src in attributes.items()])
    return look_up(rows, {code: listed})


def join_dimension(fact: DataFrame, dimension: DataFrame, on: Sequence[str] | Column, how: str = "inner") -> DataFrame:
    return fact.join(dimension, on, how)


def growth_first_last(
    df: DataFrame, keys: Sequence[str], period: str, value: str, first: int, last: int, digits: int = 2, name: str = "growth_pct"
) -> DataFrame:
    """Change in percent between two periods; keys missing a side or with a zero base drop out."""
    wide = (
        df.filter(F.col(period).isin(first, last))
        .groupBy(*keys)
        .agg(
            F.sum(F.when(F.col(period) == first, F.col(value))).alias("first_value"),
            F.sum(F.when(F.col(period) == last, F.col(value))).alias("last_value"),
        )
    )
    change = F.try_divide(F.col("last_value") - F.col("first_value"), F.col("first_value")) * 100
    return wide.withColumn(name, F.round(change, digits)).filter(F.col(name).isNotNull())
