"""Batch writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; running it twice changes nothing."""
    writer = _layout(df, partition_by).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _layout(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    """Writer with its partitioning.

    The rebalance hint lets adaptive execution gather a small partition into one file and split a
    large one over many tasks, instead of one file per task and partition.
    """
    return df.hint("rebalance", *partition_by).write.partitionBy(*partition_by) if partition_by else df.write


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace rows and schema; ``df`` must not read ``path`` itself."""
    _layout(df, partition_by).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; readers merge the schemas (``mergeSchema``)."""
    _layout(df, partition_by).mode("append").parquet(path)


def read_evolved(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def write_then_read(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Overwrite and continue from the written rows, so a second aggregate does not redo the work."""
    overwrite_table(df, path, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_result(df: DataFrame, path: str, recorded_at: Column | None = None) -> None:
    """Append result rows to a history table; the newest is found by time, not by file name."""
    append_table(df.withColumn("recorded_at", F.current_timestamp() if recorded_at is None else recorded_at), path)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Column comments as metadata, which Parquet keeps with the schema."""
    return df.select(
        *[F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": comments[c]}) if c in comments else F.col(c) for c in df.columns]
    )


def comment_table(spark, table: str, description: str | None = None, comments: Mapping[str, str] | None = None) -> None:
    """Table and column comments of a catalogue table."""
    def quoted(text):
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if description is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(description)}")
    for column, text in (comments or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {quoted(text)}")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_checked(df: DataFrame, path: str) -> int:
    """Write, read back and compare the row counts, counted while writing."""
    from pyspark.sql import Observation

    seen = Observation("written")
    overwrite_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    stored = df.sparkSession.read.parquet(path).count()
    if stored != seen.get["rows"]:
        raise RuntimeError(f"wrote {seen.get['rows']} rows, found {stored}")
    return stored


def sized(df: DataFrame, files: int, by: Sequence[str] = ()) -> DataFrame:
    """File layout: fewer files by coalescing, or a spread by columns."""
    return df.repartition(files, *by) if by else df.coalesce(files)
