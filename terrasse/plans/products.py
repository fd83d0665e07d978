"""Publish an analysis result as a registered product."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasse.operators import governance, quality
from terrasse.operators.governance import registry_rows
from terrasse.settings import path_exists
from terrasse.sinks.writers import append_table, overwrite_table, read_evolved
from terrasse.sources import snapshots

# Manifest type names of Spark types.
TYPE_NAMES = {"bigint": "long", "int": "integer"}


def register(manifests: DataFrame, registry_path: str, manifest_json: str = "manifest_json") -> None:
    """Append manifest versions to the registry table."""
    append_table(registry_rows(manifests, manifest_json, F.current_timestamp()), registry_path)


def publish(df: DataFrame, path: str, registry_path: str, product_id: str, name: str, description: str, domain: str, owner: str,
            source_products: Sequence[str] = (), access: str = "public", tags: Sequence[str] = (),
            column_lineage: Sequence[Mapping] = (), version: str = "1.0.0") -> dict:
    """Write the table, describe its columns from the stored rows and append the manifest."""
    overwrite_table(df, path)
    stored = df.sparkSession.read.parquet(path)
    holes = stored.agg(*[F.bool_or(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(stored.columns)]).first()
    columns = [
        {"name": f.name, "type": TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()), "nullable": bool(holes[i])}
        for i, f in enumerate(stored.schema.fields)
    ]
    manifest = {
        "id": product_id, "name": name, "description": description, "domain": domain, "owner": owner, "version": version,
        "source_path": path, "format": "parquet", "product_type": "analytical", "access": access, "schema": columns,
    }
    optional = {"source_products": list(source_products), "tags": list(tags), "column_lineage": list(column_lineage)}
    manifest |= {k: v for k, v in optional.items() if v}
    row = df.sparkSession.createDataFrame([(json.dumps(manifest, ensure_ascii=False),)], "manifest_json string")
    register(row, registry_path)
    return manifest


class PublicationRefused(Exception):
    """``problems``: (kind, where, rule) of everything that stands against a publication."""

    def __init__(self, product_id: str, problems: Sequence[tuple[str, str, str]]) -> None:
        super().__init__(f"{product_id}: " + "; ".join(" ".join(p) for p in problems))
        self.problems = sorted(problems)


def _type_name(kind: str) -> str:
    return TYPE_NAMES.get(kind, kind)


def publish_checked(df: DataFrame, registry_path: str, manifest: Mapping, ts=None) -> dict:
    """Publish rows and manifest together, or neither.

    Refused before anything is written: a manifest that breaks its rules, and a schema that the new manifest's
    ``schema_compatibility`` does not allow after the last registered one.  Then the rows are written as a staged version of the
    snapshot table at ``source_path``, and what the contract promises (guaranteed columns, NULL rate, completeness) is measured
    while they are written; if a promise is broken, no reader sees the version.  Only then the version counts and the manifest is
    registered, with the table's columns and, for a version number that is not higher, the next patch.
    Raises `PublicationRefused`.
    """
    spark, product_id = df.sparkSession, manifest.get("id") or ""
    declared = {c.get("name"): c for c in manifest.get("schema") or ()}
    columns = [{**declared.get(f.name, {}), "name": f.name, "type": _type_name(f.dataType.simpleString()), "nullable": True} for f in df.schema.fields]
    made = {**manifest, "format": manifest.get("format", "parquet"), "schema": columns}
    contract, sla = made.get("contract") or {}, made.get("quality_sla") or {}

    def as_row(m: Mapping) -> DataFrame:
        return spark.createDataFrame([(product_id, json.dumps(m, ensure_ascii=False))], "product_id string, manifest_json string")

    row = as_row(made)
    problems = [("manifest", r["field"], r["rule"]) for r in governance.manifest_violations(row, "product_id", "manifest_json").collect()]  # one document
    registry = read_evolved(spark, registry_path).filter(F.col("product_id") == product_id) if path_exists(spark, registry_path) else None
    if registry is not None:
        old = governance.schema_rows(governance.latest_products(registry), ["product_id"])
        broken = governance.schema_compatibility(old, governance.schema_rows(row, ["product_id"]), contract.get("schema_compatibility") or "NONE")
        problems += [("schema", r["name"], r["violation"]) for r in broken.collect()]  # one row per column at most
    if problems:
        raise PublicationRefused(product_id, problems)

    checks = quality.contract_checks(df, contract.get("guaranteed_columns") or (), sla.get("max_null_rate"), (contract.get("slo") or {}).get("completeness_pct"))
    holes = [F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"holes{i}") for i, f in enumerate(df.schema.fields)]
    seen: dict[str, object] = {}

    def accept(values: Mapping[str, object]) -> None:
        seen.update(values)
        wide = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
        failed = quality.judged(wide, checks).filter("NOT passed").collect() if checks else []  # one row per check
        if failed:
            raise PublicationRefused(product_id, [("contract", r["check_name"], r["severity"]) for r in failed])

    snapshots.commit(df, made["source_path"], "publish", ts=ts, observed=[*quality.measures_of(checks)[1:], *holes], accept=accept)
    for i, c in enumerate(columns):
        c["nullable"] = bool(seen[f"holes{i}"])
    if registry is not None:
        proposed = spark.createDataFrame([(product_id, made["version"])], "product_id string, version string")
        made["version"] = governance.publish_versions(proposed, registry).first()["resolved_version"]
    register(as_row(made), registry_path)
    return made
