"""Regression template: split, fit and score, from two aggregates over all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000


def in_training(keys: Sequence[str], share: float = 0.8, seed: int = 42) -> Column:
    """Whether a row is to be learned from: by a hash of its keys, so the same rows whatever their order or partition."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % BUCKETS < round(share * BUCKETS)


def linear_model(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], share: float = 0.8, seed: int = 42, digits: int = 6) -> DataFrame:
    """Least squares on the training rows: ``(term, value)`` for each feature, the intercept, ``r2`` on the other rows, and both counts.

    Means and covariances of all pairs of columns are one aggregate; the system they make has one row per feature
    and is solved on the driver.  Rows with a NULL among features and label are left out.  NULL values where a term has none: features that
    depend on one another, or no rows.
    """
    known = df.select(in_training(keys, share, seed).alias("__train"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate([*features, label])]).dropna(
        subset=[f"x{i}" for i in range(len(features) + 1)])
    n, y = len(features), f"x{len(features)}"
    train = known.filter("__train")
    row = train.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(n + 1)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i in range(n) for j in range(i, n + 1)]).first()
    weights = _solved([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(n)] + [row[f"c{i}_{n}"]] for i in range(n)]) if row["n"] else None
    intercept = None if weights is None else row[f"m{n}"] - sum(w * row[f"m{i}"] for i, w in enumerate(weights))
    guess = F.lit(None).cast("double") if weights is None else reduce(lambda a, b: a + b, [F.lit(w) * F.col(f"x{i}") for i, w in enumerate(weights)], F.lit(intercept))
    held = known.filter("NOT __train")
    score = held.agg(F.sum((F.col(y) - guess) ** 2).alias("left"), (F.var_pop(y) * F.count(F.lit(1))).alias("whole"), F.count(F.lit(1)).alias("n"))
    r2 = F.when(F.col("whole") > 0, 1 - F.col("left") / F.col("whole"))

    def term(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("term"), F.round(value.cast("double"), digits).alias("value"))

    fixed = [term(f, F.lit(None if weights is None else weights[i])) for i, f in enumerate(features)] + [term("intercept", F.lit(intercept)), term("n_train", F.lit(row["n"]))]
    return score.select(F.inline(F.array(*fixed, term("n_test", F.col("n")), term("r2", r2))))


def _solved(system: list[list[float]]) -> list[float] | None:
    """Solution of a small symmetric system, rows with their right side last; None if it has not exactly one."""
    rows = [list(r) for r in system]
    scale = [abs(r[i]) or 1.0 for i, r in enumerate(rows)]
    for i in range(len(rows)):
        best = max(range(i, len(rows)), key=lambda r: abs(rows[r][i]))
        if abs(rows[best][i]) <= 1e-12 * scale[i]:
            return None
        rows[i], rows[best] = rows[best], rows[i]
        for r in range(len(rows)):
            if r != i:
                f = rows[r][i] / rows[i][i]
                rows[r] = [a - f * b for a, b in zip(rows[r], rows[i], strict=True)]
    return [r[-1] / r[i] for i, r in enumerate(rows)]


def fit_and_score(df: DataFrame, features: Sequence[str], label: str, train: float = 0.8, seed: int = 42) -> dict[str, object]:
    """The terms of `linear_model` by name; rows are dealt by their features and label."""
    terms = {r["term"]: r["value"] for r in linear_model(df, features, label, [*features, label], train, seed).collect()}
    return {"coefficients": [terms[f] for f in features], "intercept": terms["intercept"], "r2": terms["r2"]}
