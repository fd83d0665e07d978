"""Batch readers and previews."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasse.functions.scalars import object_store_path
from terrasse.sources import snapshots

FORMATS = ("csv", "json", "parquet")


def read_files(spark: SparkSession, path: str, fmt: str, schema: str | None = None) -> DataFrame:
    """All files of one format under ``path``.

    Without a schema, CSV and JSON types are inferred, which costs one more pass.
    """
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format {fmt!r}; use one of {', '.join(FORMATS)}")
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    # the path itself stays un-globbed, so partition columns and object-store prefixes work
    reader = reader.option("pathGlobFilter", f"*.{fmt}")
    if fmt == "csv":
        reader = reader.option("header", True)
        if not schema:
            reader = reader.option("inferSchema", True)
        return reader.csv(path)
    return reader.json(path) if fmt == "json" else reader.parquet(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current rows of a table: the newest version of a snapshot table, else all files of the path."""
    path = object_store_path(path)
    if fmt == "parquet" and snapshots.exists(spark, path):
        return snapshots.read_version(spark, path)
    return spark.read.format(fmt).load(path)


def read_code_file(spark: SparkSession, path: str, separator: str = ";", padded: dict[str, int] | None = None) -> DataFrame:
    """Delimited code list, all text, lower-case names, codes padded with zeros."""
    from terrasse.operators.lookup import padded_code

    df = spark.read.option("header", True).option("sep", separator).csv(path)
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.withColumns({c: padded_code(c, w) for c, w in (padded or {}).items()})


def read_json_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One document per file: an array of records, or one record."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_product(registry: DataFrame, product_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Table of a registered product; with ``columns`` only those are read."""
    from terrasse.operators.governance import product

    doc = F.col("manifest_json")
    row = product(registry, product_id).select(
        F.get_json_object(doc, "$.source_path").alias("path"), F.get_json_object(doc, "$.format").alias("fmt")
    ).first()
    reader = registry.sparkSession.read.format(row["fmt"])
    df = (reader.option("header", True) if row["fmt"] == "csv" else reader).load(object_store_path(row["path"]))
    return df.select(*columns) if columns else df


def read_config(spark: SparkSession, path: str) -> dict:
    """A JSON config document, unwrapped from its envelope, with registered path schemes."""
    rows = spark.read.text(object_store_path(path), wholetext=True).collect()  # one document
    if not rows:
        raise FileNotFoundError(path)
    raw = json.loads(rows[0][0])
    config = raw["config"] if "source" not in raw and isinstance(raw.get("config"), dict) else raw
    return {k: object_store_path(v) if k in ("source", "target") and isinstance(v, str) else v for k, v in config.items()}


def sql_on_file(spark: SparkSession, path: str, sql: str, fmt: str = "parquet") -> DataFrame:
    """SQL text over a file path; ``{table}`` stands for it."""
    return spark.sql(sql.replace("{table}", f"{fmt}.`{path}`"))


def sql_on_frame(df: DataFrame, sql: str) -> DataFrame:
    """SQL text over a frame; ``{df}`` stands for it."""
    return df.sparkSession.sql(sql, df=df)


def synthetic_rows(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """Ids with modulo keys and seeded random numbers, for tuning exercises."""
    return spark.range(n).select(
        "id",
        F.concat(F.lit("dept_"), (F.col("id") % 10).cast("string")).alias("department"),
        (F.col("id") % 5).cast("int").alias("level"),
        (F.rand(seed) * 100_000).cast("int").alias("salary"),
    )


def row_count(df: DataFrame) -> int:
    """Row count; on Parquet this reads footers only."""
    return df.count()


def footer_values(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Row count of a Parquet table, and count, minimum and maximum of some columns, from the files' footers alone.

    One row: ``rows``, ``n_<column>``, ``min_<column>``, ``max_<column>``.  The second data-source API answers these aggregates
    without reading a page; it is switched on in a session of its own, so other reads stay as they are.  Columns are numbers,
    dates or booleans: footers hold no exact bounds of texts.
    """
    own = spark.newSession()
    for name, value in {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}.items():
        own.conf.set(name, value)
    table = own.read.parquet(path)
    wrong = [c for c in columns if dict(table.dtypes)[c] in ("string", "binary") or dict(table.dtypes)[c].startswith(("timestamp", "array", "map", "struct"))]
    if wrong:
        raise ValueError(f"no exact bounds in footers: {', '.join(wrong)}")
    return table.agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("n", F.count), ("min", F.min), ("max", F.max))])
