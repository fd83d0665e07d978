"""Config-driven curation: bronze to silver, quality of the result, gold metrics, file ingest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrasse.functions.scalars import object_store_path
from terrasse.operators import quality, rules
from terrasse.operators.keys import latest_per_key
from terrasse.operators.measures import group_metrics
from terrasse.sinks import merge, writers
from terrasse.sources import readers


@dataclass(frozen=True)
class CurationRules:
    """Rules of one silver table, as in its JSON config."""

    primary_key: str
    casts: Mapping[str, str] = field(default_factory=dict)
    drop_if_null: Sequence[str] = ()
    fill: Mapping[str, object] = field(default_factory=dict)
    fields: Mapping[str, str] = field(default_factory=dict)
    from_column: str = "payload_json"

    @classmethod
    def from_config(cls, config: Mapping) -> CurationRules:
        nulls = config.get("null_handling") or {}
        extract = config.get("payload_extract") or {}
        return cls(
            primary_key=config["primary_key"],
            casts=config.get("cast") or {},
            drop_if_null=tuple(nulls.get("drop_if_null") or ()),
            fill=nulls.get("fill") or {},
            fields=extract.get("fields") or {},
            from_column=extract.get("from_column", "payload_json"),
        )


def curate(bronze: DataFrame, spec: CurationRules, tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Extract, cast, NULL rules, latest row per key, metadata columns dropped."""
    df = bronze
    if spec.fields:
        df = rules.extract_payload(df, spec.fields, spec.from_column)
    return (
        df.transform(rules.apply_casts, spec.casts)
        .transform(rules.apply_null_rules, spec.drop_if_null, spec.fill)
        .transform(latest_per_key, [spec.primary_key], None, tie_breakers)
        .transform(rules.drop_bronze_metadata)
    )


def bronze_to_silver(spark: SparkSession, config: Mapping) -> dict[str, int]:
    """Read, curate and upsert one silver table.

    Row counts are observed while the job runs; rows read again after a lost executor count twice.
    """
    spec = CurationRules.from_config(config)
    read, kept = Observation("read"), Observation("kept")
    bronze = readers.read_table(spark, config["source"]).observe(read, F.count(F.lit(1)).alias("rows"))
    silver = curate(bronze, spec).observe(kept, F.count(F.lit(1)).alias("rows"))
    version = merge.upsert_table(rules.add_updated_at(silver), object_store_path(config["target"]), [spec.primary_key])
    return {"rows_read": read.get["rows"], "rows_written": kept.get["rows"], "version": version}


def silver_quality(df: DataFrame, config: Mapping) -> DataFrame:
    """Check rows of a silver table from its own config."""
    spec = CurationRules.from_config(config)
    return quality.run_checks(df, quality.silver_checks(df, spec.primary_key, spec.drop_if_null, list(spec.fields)))


def department_metrics(silver: DataFrame) -> DataFrame:
    names = {"rows": "headcount", "mean": "avg_salary", "min": "min_salary", "max": "max_salary", "sum": "total_payroll"}
    return group_metrics(silver, ["department"], "salary", names=names)


def silver_to_gold(spark: SparkSession, source: str, target: str, comments: Mapping[str, str] | None = None) -> int:
    gold = rules.add_updated_at(department_metrics(readers.read_table(spark, source)), "_gold_updated_at")
    return merge.upsert_table(writers.with_comments(gold, comments or {}), target, ["department"])


def ingest_files(spark: SparkSession, source: str, fmt: str, target: str, ingestion_date: str, schema: str | None = None,
                 ingested_at: datetime | None = None) -> None:
    """File ingest into bronze; a rerun for the same date replaces that date only."""
    stamp = None if ingested_at is None else F.lit(ingested_at)
    rows = rules.add_bronze_metadata(readers.read_files(spark, source, fmt, schema), ingestion_date, source, stamp)
    writers.overwrite_partitions(rows, target, ["ingestion_date"])
