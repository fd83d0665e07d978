"""Fixed row schemas: event envelopes, registry rows and product manifests."""

from __future__ import annotations

# Message envelope; an object in ``payload`` is kept as JSON text.
CLOUD_EVENT = "eventId string, eventType string, occurredAt string, source string, version string, payload string"

# Flat stream event.
FLAT_EVENT = (
    "event_id string not null, event_type string, employee_id int, department string, salary int, event_timestamp timestamp"
)

# Broker message.
BROKER_MESSAGE = "topic string, partition int, offset bigint, timestamp timestamp, value string"

# Element of the contributing-causes array.
CAUSE_ELEMENT = "struct<sekvens:int,kapittel:string,icd10Kode:string,icd10Tittel:string>"

# Registry table.
REGISTRY = (
    "product_id string, domain string, name string, owner string, version string, access string, "
    "manifest_json string, registered_at string"
)

# Product manifest.
MANIFEST_COLUMN = "struct<name:string,type:string,nullable:boolean,description:string,pii:boolean,sensitivity:string>"
MANIFEST = (
    "id string, name string, domain string, owner string, version string, description string, source_path string, "
    "format string, primary_key string, dag_id string, access string, product_type string, "
    "quality_sla struct<max_null_rate:double,freshness_hours:int>, "
    "source_products array<string>, tags array<string>, "
    f"schema array<{MANIFEST_COLUMN}>, "
    "column_lineage array<struct<column:string,sources:array<struct<product_id:string,column:string>>,"
    "description:string,transformation:string>>, "
    "retention struct<days:int,strategy:string,partition_column:string>, "
    "contract struct<slo:struct<freshness_hours:int,completeness_pct:double>,schema_compatibility:string,"
    "guaranteed_columns:array<string>,deprecation:struct<sunset_date:string,successor:string>>"
)

# Manifest rules, as a JSON schema.
SENSITIVITIES = ("low", "medium", "high")
_TEXT, _TEXTS, _YES_NO, _FROM_ONE = {"type": "string"}, {"type": "array", "items": {"type": "string"}}, {"type": "boolean"}, {"type": "integer", "minimum": 1}


def _choice(*values: str) -> dict:
    return {"type": "string", "enum": list(values)}


def _object(properties: dict, *required: str) -> dict:
    return {"type": "object", "required": list(required), "additionalProperties": False, "properties": properties}


MANIFEST_SCHEMA = _object(
    {
        "id": {"type": "string", "pattern": r"^[a-z0-9_]+\.[a-z0-9_]+$"},
        "name": _TEXT,
        "domain": {"type": "string", "pattern": r"^[a-z0-9_]+$"},
        "owner": _TEXT,
        "version": {"type": "string", "pattern": r"^\d+\.\d+\.\d+$"},
        "description": _TEXT,
        "source_path": _TEXT,
        "format": _choice("delta", "parquet", "csv"),
        "primary_key": _TEXT,
        "dag_id": _TEXT,
        "quality_sla": _object({"max_null_rate": {"type": "number", "minimum": 0, "maximum": 1}, "freshness_hours": _FROM_ONE}),
        "access": _choice("public", "restricted"),
        "product_type": _choice("source", "analytical"),
        "source_products": _TEXTS,
        "tags": _TEXTS,
        "schema": {"type": "array", "items": _object(
            {"name": _TEXT, "type": _TEXT, "nullable": _YES_NO, "description": _TEXT, "pii": _YES_NO, "sensitivity": _choice(*SENSITIVITIES)}, "name", "type")},
        "column_lineage": {"type": "array", "items": _object(
            {"column": _TEXT, "sources": {"type": "array", "items": _object({"product_id": _TEXT, "column": _TEXT}, "column")}, "description": _TEXT, "transformation": _TEXT},
            "column", "sources")},
        "retention": _object({"days": _FROM_ONE, "strategy": _choice("delete", "archive"), "partition_column": _TEXT}),
        "contract": _object({
            "slo": _object({"freshness_hours": _FROM_ONE, "completeness_pct": {"type": "number", "minimum": 0, "maximum": 100}}),
            "schema_compatibility": _choice("BACKWARD", "FORWARD", "FULL", "NONE"),
            "guaranteed_columns": _TEXTS,
            "deprecation": _object({"sunset_date": _TEXT, "successor": _TEXT}),
        }),
    },
    "id", "name", "domain", "owner", "version", "description", "source_path", "format",
)
