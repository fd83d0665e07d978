"""Registry of the driver queries: a Spark function and its SQL counterpart, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# End of the event table's time range, used instead of the wall clock.
AS_OF_TEXT = "2024-01-31 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF_TEXT}'"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; without SQL only its rows are checked."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp_ntz")


# Events read as a usage log: product = k of the JSON text, action = event type.
USAGE_SQL = """usage AS (
  SELECT event_id, ts, user_id, event_type AS action, value,
         'p' || json_extract_string(props, '$.k') AS product_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


def usage(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", F.col("event_type").alias("action"), "value",
        F.concat(F.lit("p"), k).alias("product_id"), k.cast("int").alias("k"),
    )
