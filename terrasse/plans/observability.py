"""Scheduled checks over the published tables: rule sets, freshness results, platform snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasse.functions import schemas as S
from terrasse.functions.scalars import days_before
from terrasse.operators import governance, quality, usage
from terrasse.operators.keys import first_per_key, keep_last_n
from terrasse.operators.measures import top_k
from terrasse.operators.quality import CRITICAL_BELOW, Check
from terrasse.sources.readers import read_table

HISTORY_ENTRIES = 168
CONFIG_ENTRIES = 10


@dataclass(frozen=True)
class RuleSet:
    """Checks of one published table."""

    not_null: Sequence[str]
    exists: Sequence[str] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    min_rows: int = 1
    critical_below: float = CRITICAL_BELOW["registry"]

    def checks(self, df: DataFrame) -> list[Check]:
        return [
            *[quality.not_null(df, c) for c in self.not_null],
            *[quality.column_exists(df, c) for c in self.exists],
            *[quality.values_between(df, c, low, high) for c, (low, high) in self.ranges.items()],
            quality.row_count_between(self.min_rows),
        ]


# The rule set of each table.
PERCENT = (0, 100)
RULE_SETS = {
    "person_registry": RuleSet(("person_id", "full_name", "fnr_masked"), ("marital_status",)),
    "family_relations": RuleSet(("person_id_a", "person_id_b")),
    "residence_history": RuleSet(("person_id",)),
    "population_stats": RuleSet(("municipality_code", "reference_year", "population_total"), ranges={"population_total": (0, None)}),
    "cohort_demographics": RuleSet(("birth_decade", "cohort_size"), ranges={"survival_rate_pct": PERCENT}),
    "marital_status_trends": RuleSet(("reference_year", "age_group", "marital_status"), ranges={"pct_of_age_group": PERCENT}),
    "migration_flows": RuleSet(("from_municipality_code", "to_municipality_code", "flow_count")),
    "household_structure": RuleSet(("household_type", "count"), ranges={"pct_of_total": PERCENT}),
    "death_facts": RuleSet(
        ("dodsfall_id", "underliggende_arsak_kode", "underliggende_arsak_kapittel"), critical_below=CRITICAL_BELOW["health"]
    ),
    "contributing_causes": RuleSet(("dodsfall_id", "icd10_kode"), min_rows=0, critical_below=CRITICAL_BELOW["health"]),
}


def check_table(df: DataFrame, name: str) -> DataFrame:
    """Check rows of a published table."""
    return quality.run_checks(df, RULE_SETS[name].checks(df)).withColumn("product_id", F.lit(name))


def table_scores(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """One score row per table; a table that cannot be read scores 0 and is critical."""
    frames = []
    for name, path in paths.items():
        try:
            rows = check_table(read_table(spark, path, fmt), name)
        except AnalysisException:
            frames.append(quality.unreadable_result(spark, {"product_id": name}))
            continue
        frames.append(quality.quality_score(rows, ["product_id"], RULE_SETS[name].critical_below))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def manifest_products(registry: DataFrame) -> DataFrame:
    """Latest manifest of every product as columns."""
    parsed = governance.latest_products(registry).withColumn("m", F.from_json("manifest_json", S.MANIFEST))
    return parsed.select(
        "product_id", "domain", "name", "owner", "version", "access", "registered_at", F.col("m.description").alias("description"),
        F.col("m.source_path").alias("source_path"), F.col("m.dag_id").alias("dag_id"), F.col("m.tags").alias("tags"),
        F.col("m.source_products").alias("source_products"), F.transform("m.schema", lambda c: c["name"]).alias("columns"),
        F.col("m.quality_sla.freshness_hours").alias("freshness_hours"), F.col("m.contract").isNotNull().alias("has_contract"),
        F.col("m.contract.slo.freshness_hours").alias("contract_hours"), F.col("m.retention").alias("retention"),
    )


def sla_check(registry: DataFrame, commits: DataFrame, as_of: Column) -> DataFrame:
    """Freshness results of all products with a limit, ready to append."""
    return usage.freshness(manifest_products(registry), commits, as_of).withColumn("checked_at", as_of)


def contract_report(registry: DataFrame, sla_results: DataFrame) -> DataFrame:
    """Contract status per product from the latest freshness results, worst first."""
    latest = first_per_key(sla_results, ["product_id"], [F.col("checked_at").desc(), F.col("compliant").asc()])
    facts = manifest_products(registry).select("product_id", "name", "domain", "has_contract", F.col("contract_hours").alias("freshness_hours"))
    rows = facts.join(latest.select("product_id", "compliant", "hours_since_update"), "product_id", "left")
    return usage.contract_status(rows).orderBy("status_rank", "product_id")


def platform_snapshot(registry: DataFrame, log: DataFrame, sla: DataFrame, scores: DataFrame, feedback: DataFrame, as_of: Column,
                      days: int = 7) -> DataFrame:
    """All platform metrics as rows (section, generated_at, payload)."""
    versions = registry.withColumn("registered_at", F.try_to_timestamp("registered_at"))
    published = usage.recent_publications(versions, as_of, k=None, tie=["version"])
    listed = top_k(published, [F.col("registered_at").desc(), F.col("product_id").asc()], 20)
    return usage.metrics_snapshot(
        {
            "platform_totals": usage.platform_totals(governance.latest_products(registry), published, scores, as_of, days),
            "active_users": usage.active_users(log, days_before(as_of, days), as_of),
            "health": usage.platform_health(sla, scores),
            "trending_up": usage.trending(log, as_of, days),
            "recent_publications": listed.select("product_id", "version", "event", "registered_at", "owner", "domain", "name"),
            "popular_questions": usage.popular_questions(feedback, as_of, days),
            "incidents": usage.incident_rows(sla, scores),
        },
        as_of,
    )


def trim_history(snapshots: DataFrame, n: int = HISTORY_ENTRIES) -> DataFrame:
    """The newest ``n`` entries per section."""
    return keep_last_n(snapshots, ["section"], ["generated_at", "payload"], n)


def trim_configs(configs: DataFrame, n: int = CONFIG_ENTRIES) -> DataFrame:
    """The newest ``n`` saved configs per table."""
    return keep_last_n(configs, ["slug"], ["saved_at", "config"], n)
