"""Places of rows within their groups, without a task that holds a whole group.

Rows are range-partitioned on group and order, so a hot group lies in many partitions; inside one
they are numbered by `monotonically_increasing_id`, and one small row per partition and group says
how many rows of the group lie before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasse.settings import BROADCAST_ROWS, durable, durable_counted, limit_of

PART_ROWS = 200_000


def placed(rows: DataFrame, n_rows: int, group: Sequence[str], order: Sequence[str], out: str = "at", size: str = "size", part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` with the place of each in its group, from 0, and the group's number of rows.

    ``rows`` must be a stored table of ``n_rows`` rows: it is read twice, for the ranges and for the rows.
    NULL is a group like any other and comes first in an order.  Give an order without ties (a
    row number last), so that rows equal in all else do not lie in one range.
    """
    spark = rows.sparkSession
    parts = max(-(-n_rows // part_rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
    by = [*group, *order]
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("__seq", F.monotonically_increasing_id())
    dealt = durable(dealt, "placed")
    part = F.shiftrightunsigned("__seq", 33)
    runs = dealt.groupBy(*group, part.alias("__part")).agg(F.min("__seq").alias("__first"), F.count(F.lit(1)).alias("__n"))
    along, whole = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*group)
    runs, n_runs = durable_counted(runs.select(
        *[F.col(g).alias(f"__g_{g}") for g in group], "__part", (F.coalesce(F.sum("__n").over(along), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias("__size")), "runs")
    if n_runs <= limit_of(spark, BROADCAST_ROWS):
        runs = F.broadcast(runs)
    same = part == runs["__part"]
    for g in group:
        same &= dealt[g].eqNullSafe(runs[f"__g_{g}"])
    found = dealt.join(runs, same)
    return found.select(*[dealt[c] for c in rows.columns], (F.col("__seq") + F.col("__shift")).alias(out), F.col("__size").alias(size))
