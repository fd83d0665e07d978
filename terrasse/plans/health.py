"""Code list with its hierarchy, cause-of-death facts and contributing-cause rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.functions import schemas as S
from terrasse.operators import graph, lookup
from terrasse.operators.rules import fixed_schema, path, safe_cast

# Output columns of the death facts as {output: input}.
DEATH_COLUMNS = {
    "dodsfall_id": "dodsfallId", "person_synt_id": "personSyntId", "alder": "__age", "kjonn": "kjonn",
    "kommune_kode": "kommune", "fylke": "fylke", "tidspunkt": "tidspunkt",
    "klassifisert_tidspunkt": "klassifisertTidspunkt", "icd10_versjon": "icd10Versjon",
}
# Role column, its prefix, source column and JSON path.
ROLES = (
    ("underliggende_arsak", "underliggendeArsak", "$.icd10Kode"),
    ("ekstern_skade", "eksternArsak", "$.skadeKode"),
    ("ekstern_skademekanisme", "eksternArsak", "$.skademekanismeKode"),
)
ATTRIBUTES = {"navn": "name_no", "kapittel": "chapter_code"}


def flag(column: str) -> Column:
    """Text true/false as boolean: missing is false, other text is NULL."""
    text = F.lower(F.coalesce(F.col(column), F.lit("false")))
    return F.when(text == "true", True).when(text == "false", False)


def code_list(source: DataFrame, version: str, ingested_at: Column | None = None) -> DataFrame:
    """Code list with chapter and block codes from its parent pointers."""
    resolved = graph.resolve_hierarchy(source)
    return resolved.select(
        F.col("identifier").alias("code"), F.col("parent").alias("parent_code"), "type",
        F.col("tittel_no").alias("name_no"), F.col("tittel_en").alias("name_en"), "chapter_code", "block_code",
        flag("gyldig_underliggende").alias("valid_as_underlying"), flag("gyldig_ekstern").alias("valid_as_external"),
        F.lit(version).alias("icd10_version"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
    )


def death_facts(deaths: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per death with the three causes looked up in the code list."""
    flat = fixed_schema(deaths.withColumn("__age", safe_cast("alder", "int")), {**DEATH_COLUMNS, **{c: c for c in ("underliggendeArsak", "eksternArsak")}})
    flat = flat.withColumns({f"{prefix}_kode": path(column, p) for prefix, column, p in ROLES}).drop("underliggendeArsak", "eksternArsak")
    listed = codes.select("code", *[F.col(src).alias(dst) for dst, src in ATTRIBUTES.items()])
    out = lookup.role_lookups(flat, listed, "code", list(ATTRIBUTES), {f"{prefix}_kode": prefix for prefix, _, _ in ROLES})
    causes = [f"{prefix}_{part}" for prefix, _, _ in ROLES for part in ("kode", "navn", "kapittel")]
    return out.select(*DEATH_COLUMNS, *causes)


def contributing_causes(deaths: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per contributing cause of each death."""
    rows = lookup.json_array_rows(
        deaths.select(F.col("dodsfallId").alias("dodsfall_id"), "medvirkendeArsaker"), ["dodsfall_id"], "medvirkendeArsaker", S.CAUSE_ELEMENT
    ).select("dodsfall_id", "sekvens", F.col("icd10Kode").alias("icd10_kode"))
    return lookup.bridge(rows, codes, "icd10_kode", {"icd10_navn": "name_no", "icd10_kapittel": "chapter_code"}, "code").select(
        "dodsfall_id", "sekvens", "icd10_kode", "icd10_navn", "icd10_kapittel"
    )
