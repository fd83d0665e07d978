"""Data-quality checks: all checks of a table are measured in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Score limits below which a failed table is critical, by rule set.
CRITICAL_BELOW = {"registry": 50.0, "health": 70.0}
MAX_EXTRACTED_NULL_RATE = 0.5


@dataclass(frozen=True)
class Check:
    """One check: what to measure and what must hold for it.

    ``observed`` is an aggregate column, ``passes`` maps it to a boolean column.  A check with
    ``verdict`` set needs no data, for example a missing column.
    """

    name: str
    observed: Column | None = None
    passes: object = None
    expected: str = ""
    severity: str = "critical"
    verdict: bool | None = None
    note: str = field(default="")


def not_null(df: DataFrame, column: str, severity: str = "critical") -> Check:
    name = f"not_null[{column}]"
    if column not in df.columns:
        return Check(name, expected="0", severity=severity, verdict=False, note="missing")
    return Check(name, F.count_if(F.col(column).isNull()), lambda n: n == 0, "0", severity)


def column_exists(df: DataFrame, column: str, severity: str = "critical") -> Check:
    there = column in df.columns
    return Check(f"column_exists[{column}]", expected="present", severity=severity, verdict=there,
                 note="present" if there else "missing")


def row_count_between(minimum: int | None = None, maximum: int | None = None, severity: str = "critical") -> Check:
    def inside(n):
        above = n >= minimum if minimum is not None else F.lit(True)
        below = n <= maximum if maximum is not None else F.lit(True)
        return above & below
    return Check("row_count", F.count(F.lit(1)), inside, f"{minimum}..{maximum}", severity)


def values_between(df: DataFrame, column: str, low: object = None, high: object = None, severity: str = "critical") -> Check:
    """NULLs are ignored."""
    name = f"values_between[{column}]"
    if column not in df.columns:
        return Check(name, expected=f"{low}..{high}", severity=severity, verdict=False, note="missing")
    c = F.col(column)
    outside = [c < low] * (low is not None) + [c > high] * (high is not None)
    broken = reduce(lambda a, b: a | b, outside, F.lit(False))
    return Check(name, F.count_if(broken), lambda n: n == 0, f"{low}..{high}", severity)


def unique(df: DataFrame, column: str, severity: str = "critical") -> Check:
    """Distinct values, NULL counted as one value, must equal the rows."""
    distinct = F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    # observed: rows that repeat a value
    return Check(f"unique[{column}]", F.count(F.lit(1)) - distinct, lambda n: n == 0, "0", severity)


def null_rate_at_most(df: DataFrame, column: str, limit: float = MAX_EXTRACTED_NULL_RATE, severity: str = "warning") -> Check:
    name = f"null_rate[{column}]"
    if column not in df.columns:
        return Check(name, expected=f"<= {limit}", severity=severity, verdict=False, note="missing")
    return Check(name, F.avg(F.col(column).isNull().cast("double")), lambda r: r <= limit, f"<= {limit}", severity)


def run_checks(df: DataFrame, checks: Sequence[Check], digits: int = 4) -> DataFrame:
    """(check_name, severity, passed, observed, expected, row_count), one row per check."""
    return judged(df.agg(*measures_of(checks)), checks, digits)


def measures_of(checks: Sequence[Check]) -> list[Column]:
    """What all checks have to know of a table, as aggregates: the rows and one measure for each check that needs data."""
    return [F.count(F.lit(1)).alias("rows"), *[c.observed.alias(f"m{i}") for i, c in enumerate(c for c in checks if c.verdict is None)]]


def judged(wide: DataFrame, checks: Sequence[Check], digits: int = 4) -> DataFrame:
    """Check rows from the one row of `measures_of`, aggregated or observed during a write."""
    index = {c.name: i for i, c in enumerate(c for c in checks if c.verdict is None)}

    def row(c: Check) -> Column:
        if c.verdict is None:
            value = F.col(f"m{index[c.name]}")
            passed = F.coalesce(c.passes(value), F.lit(False))
            observed = F.round(value.cast("double"), digits)
        else:
            passed, observed = F.lit(c.verdict), F.lit(None).cast("double")
        return F.struct(
            F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), passed.alias("passed"),
            observed.alias("observed"), F.lit(c.expected).alias("expected"), F.col("rows").alias("row_count"),
        )

    # An empty table fails on its row count alone; the other checks have nothing to look at.
    counts = [row(c) for c in checks if c.name.startswith("row_count")]
    every = F.array(*[row(c) for c in checks])
    return wide.select(F.inline(F.when(F.col("rows") > 0, every).otherwise(F.array(*counts)) if counts else every))


def silver_checks(
    df: DataFrame, primary_key: str, required: Sequence[str] = (), extracted: Sequence[str] = ()
) -> list[Check]:
    """The rule set of a curated table: rows, key, required columns, extracted fields."""
    checks = [row_count_between(1), not_null(df, primary_key), unique(df, primary_key)]
    checks += [not_null(df, c) for c in required if c != primary_key]
    checks += [null_rate_at_most(df, c) for c in extracted if c in df.columns and c not in required]
    return checks


def contract_checks(df: DataFrame, guaranteed: Sequence[str] = (), max_null_rate: float | None = None,
                    completeness_pct: float | None = None) -> list[Check]:
    """Checks a manifest declares: guaranteed columns, highest NULL rate, completeness."""
    checks = [column_exists(df, c) for c in guaranteed]
    present = [c for c in guaranteed if c in df.columns]
    if max_null_rate is not None:
        checks += [null_rate_at_most(df, c, max_null_rate) for c in present]
    if completeness_pct is not None and present:
        filled = reduce(lambda a, b: a + b, [F.count(c) for c in present])
        share = filled / (F.count(F.lit(1)) * len(present)) * 100
        checks.append(Check("completeness", share, lambda s: s >= completeness_pct, f">= {completeness_pct}", "warning"))
    return checks


def quality_score(results: DataFrame, keys: Sequence[str] = (), critical_below: float = CRITICAL_BELOW["registry"]) -> DataFrame:
    """Score, status and severity from check rows."""
    passed = F.count_if("passed")
    total = F.count(F.lit(1))
    critical = F.count_if(~F.col("passed") & (F.col("severity") == "critical"))
    scored = (results.groupBy(*keys) if keys else results).agg(
        total.alias("total_expectations"), passed.alias("passed"), (total - passed).alias("failed"),
        critical.alias("critical_failures"),
    )
    score = F.coalesce(F.round(F.try_divide("passed", "total_expectations") * 100, 1), F.lit(100.0))
    return scored.withColumn("score_pct", score).withColumns(
        {
            "status": F.when(F.col("critical_failures") > 0, "failed").when(F.col("failed") > 0, "warning").otherwise("ok"),
            "severity": F.when(F.col("failed") == 0, "ok")
            .when(F.col("score_pct") < critical_below, "critical")
            .otherwise("warning"),
        }
    )


def unreadable_result(spark, keys: dict[str, str]) -> DataFrame:
    """Score row of a table that could not be read."""
    base = spark.range(1).select(*[F.lit(v).alias(k) for k, v in keys.items()])
    return base.select(
        "*", F.lit(0).cast("bigint").alias("total_expectations"), F.lit(0).cast("bigint").alias("passed"),
        F.lit(1).cast("bigint").alias("failed"), F.lit(1).cast("bigint").alias("critical_failures"),
        F.lit(0.0).alias("score_pct"), F.lit("failed").alias("status"), F.lit("critical").alias("severity"),
    )
