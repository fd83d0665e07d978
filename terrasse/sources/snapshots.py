"""Tables kept as snapshot folders, with a history table and time travel.

``<table>/snapshot=<n>/`` holds what version ``n`` wrote; ``<table>/_history/`` is an appended table with
one row per version.  A version counts once its history row is written, so a failed write leaves no
visible version, and the next attempt replaces its files.  One writer at a time.

A table with a `Layout` is dealt to parts, by a hash of its keys or by day.  A version then writes only the
parts that change, ``<table>/snapshot=<n>/__part=<p>/``, and ``<table>/_parts/version=<n>/`` lists them with
their numbers of rows; a part is read from the last version that wrote it.  Rows of other parts stay in
the files they are in.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from terrasse.settings import path_exists

COUNTS = ("inserted", "updated", "deleted")
HISTORY = "version bigint, ts timestamp, operation string, rows bigint, inserted bigint, updated bigint, deleted bigint, full boolean, layout string, columns string"
PARTS = "version bigint, part string, rows bigint"
PART = "__part"


@dataclass(frozen=True)
class Layout:
    """Parts by a hash of ``by`` into ``buckets``, or without buckets by the day of the one column ``by``."""

    by: tuple[str, ...]
    buckets: int | None = None

    def part(self, df: DataFrame) -> Column:
        if self.buckets is None:
            kind = dict(df.dtypes)[self.by[0]]
            day = F.col(self.by[0]) if kind != "string" else F.try_to_timestamp(self.by[0])
            return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("none"))
        missing = F.lit(False)
        for c in self.by:
            missing |= F.col(c).isNull()
        # Rows without a key match nothing and may be many, so they are spread by all they hold.
        spread = F.when(missing, F.xxhash64(F.to_json(F.struct(*df.columns)))).otherwise(F.xxhash64(*[F.col(c).cast("string") for c in self.by]))
        return F.pmod(spread, F.lit(self.buckets)).cast("string")

    def text(self) -> str:
        return json.dumps({"by": self.by, "buckets": self.buckets})

    @classmethod
    def of(cls, text: str | None) -> Layout | None:
        if text is None:
            return None
        found = json.loads(text)
        return cls(tuple(found["by"]), found["buckets"])


def history(spark: SparkSession, table: str) -> DataFrame:
    """Versions, newest first, with their operation, rows and changed rows; an unknown table has none."""
    return _versions(spark, table).orderBy(F.col("version").desc())


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in schema.split(", "))])


def _versions(spark: SparkSession, table: str) -> DataFrame:
    return _stored(spark, f"{table}/_history", HISTORY)


def current_version(spark: SparkSession, table: str) -> int | None:
    if not path_exists(spark, f"{table}/_history"):
        return None
    return _versions(spark, table).agg(F.max("version")).first()[0]


def exists(spark: SparkSession, table: str) -> bool:
    return current_version(spark, table) is not None


def _version_row(spark: SparkSession, table: str, version: int | None = None, as_of: datetime | None = None):
    versions = _versions(spark, table)
    if version is not None:
        versions = versions.filter(F.col("version") == version)
    elif as_of is not None:
        versions = versions.filter(F.col("ts") <= F.lit(as_of))
    found = versions.agg(F.max_by(F.struct("*"), "version").alias("row")).first()["row"]
    if found is None:
        raise LookupError(f"no such version of {table}")
    return found


def layout_of(spark: SparkSession, table: str) -> Layout | None:
    return Layout.of(_version_row(spark, table)["layout"])


def schema_of(spark: SparkSession, table: str) -> StructType:
    return StructType.fromJson(json.loads(_version_row(spark, table)["columns"]))


def _parts(spark: SparkSession, table: str, version: int) -> DataFrame:
    """``part, version, rows`` of every part of a version, as its last writer left it."""
    whole = F.max_by("version", F.when(F.col("full"), F.col("version")))
    base = _versions(spark, table).filter(F.col("version") <= version).agg(whole).first()[0]
    kept = _stored(spark, f"{table}/_parts", PARTS).filter(F.col("version").between(base, version))
    last = kept.groupBy("part").agg(F.max_by(F.struct("version", "rows"), "version").alias("last"))
    return last.select("part", "last.version", "last.rows").filter(F.col("rows") > 0)


def read_version(spark: SparkSession, table: str, version: int | None = None, as_of: datetime | None = None) -> DataFrame:
    """The table now, at a version, or at a time."""
    row = _version_row(spark, table, version, as_of)
    if row["layout"] is None:
        return spark.read.parquet(f"{table}/snapshot={row['version']}")
    return _read(spark, table, row, None).drop(PART)


def read_parts(spark: SparkSession, table: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The current rows of some parts, or of all, with the part that holds each in ``__part``."""
    return _read(spark, table, _version_row(spark, table), parts)


def _read(spark: SparkSession, table: str, row, parts: Sequence[str] | None) -> DataFrame:
    known = _parts(spark, table, row["version"])
    if parts is not None:
        known = known.filter(F.col("part").isin(*parts))
    # One path per part; their number is the layout's number of buckets or of days.
    paths = [f"{table}/snapshot={r['version']}/{PART}={r['part']}" for r in known.collect()]
    schema = StructType.fromJson(json.loads(row["columns"]))
    if not paths:
        return spark.createDataFrame([], schema).withColumn(PART, F.lit(None).cast("string"))
    held = F.regexp_extract(F.col("_metadata.file_path"), f"/{PART}=([^/]*)/", 1)
    return spark.read.schema(schema).parquet(*paths).select("*", held.alias(PART))


def _log(spark: SparkSession, table: str, version: int, operation: str, rows: int, counts: Mapping[str, int], full: bool,
         layout: Layout | None, schema: StructType, ts: datetime | None) -> None:
    stamp = F.current_timestamp() if ts is None else F.lit(ts)
    spark.range(0, 1, 1, 1).select(
        F.lit(version).cast("bigint").alias("version"), stamp.cast("timestamp").alias("ts"), F.lit(operation).alias("operation"),
        F.lit(rows).cast("bigint").alias("rows"), *[F.lit(counts.get(c)).cast("bigint").alias(c) for c in COUNTS], F.lit(full).alias("full"),
        F.lit(layout.text() if layout else None).cast("string").alias("layout"), F.lit(json.dumps(schema.jsonValue())).alias("columns"),
    ).write.mode("append").parquet(f"{table}/_history")


def _write(df: DataFrame, path: str, partition_by: Sequence[str], observed: Sequence[Column] = ()) -> dict[str, object]:
    seen = Observation("written")
    balanced = df.hint("rebalance", *partition_by) if partition_by else df
    writer = balanced.observe(seen, F.count(F.lit(1)).alias("rows"), *observed).write.mode("overwrite")  # replaces a failed attempt
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get


def _write_parts(df: DataFrame, table: str, version: int) -> tuple[int, DataFrame]:
    """Rows written, and ``part, rows`` of what was written, counted from the files' footers."""
    path, spark = f"{table}/snapshot={version}", df.sparkSession
    rows = _write(df, path, [PART])["rows"]
    files = spark.read.schema(StructType([StructField(PART, StringType())])).parquet(path)
    return rows, files.groupBy(F.col(PART).alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def commit(df: DataFrame, table: str, operation: str, partition_by: tuple[str, ...] = (), ts: datetime | None = None,
           layout: Layout | None = None, counts: Mapping[str, int] | None = None, observed: Sequence[Column] = (),
           accept: Callable[[Mapping[str, object]], None] | None = None) -> int:
    """Write a whole new version and return its number; a first version counts all its rows as inserted.

    ``observed`` are named aggregates, measured while the rows are written; ``accept`` gets their values and ``rows``.  If it
    raises, the version stays staged: no reader sees it, and the next write replaces it.
    """
    spark = df.sparkSession
    last = current_version(spark, table)
    version = 0 if last is None else last + 1
    if layout is None:
        seen = _write(df, f"{table}/snapshot={version}", partition_by, observed)
        rows = seen["rows"]
        if accept:
            accept(seen)
    else:
        if partition_by or accept:
            raise ValueError("a layout has partitions of its own, and is not written under observation")
        rows, written = _write_parts(df.withColumn(PART, layout.part(df)), table, version)
        written.write.mode("overwrite").parquet(f"{table}/_parts/version={version}")
    _log(spark, table, version, operation, rows, counts or ({"inserted": rows, "updated": 0, "deleted": 0} if last is None else {}), True, layout, df.schema, ts)
    return version


def commit_parts(df: DataFrame, table: str, operation: str, parts: Sequence[str], counts: Mapping[str, int], ts: datetime | None = None) -> int:
    """Write a version in which ``parts`` hold the rows of ``df``, or none, and every other part stays.

    ``df`` names the part of each row in ``__part``.
    """
    spark = df.sparkSession
    now = _version_row(spark, table)
    version, layout = now["version"] + 1, Layout.of(now["layout"])
    before = _parts(spark, table, now["version"]).filter(F.col("part").isin(*parts)).agg(F.sum("rows")).first()[0] or 0
    rows = 0
    if parts:
        rows, written = _write_parts(df, table, version)
        listed = spark.createDataFrame([(p,) for p in parts], "part string").join(written, "part", "left")
        listed.select("part", F.coalesce("rows", F.lit(0)).alias("rows")).coalesce(1).write.mode("overwrite").parquet(f"{table}/_parts/version={version}")
    _log(spark, table, version, operation, now["rows"] - before + rows, counts, False, layout, df.drop(PART).schema, ts)
    return version
