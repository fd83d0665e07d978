"""Product registry, versions, manifests, schema compatibility, PII, access and candidates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from terrasse.functions import schemas as S
from terrasse.functions.versions import resolve_version
from terrasse.operators import json_rules
from terrasse.operators.keys import first_per_key
from terrasse.operators.measures import top_k
from terrasse.operators.ordered import over_order
from terrasse.settings import durable

# Score weights of related products and limits of the row guard.
DOMAIN_POINTS, COLUMN_POINTS, COLUMN_CAP, LINEAGE_POINTS, OWNER_POINTS = 3, 2, 6, 2, 1
ROW_LIMIT = 1_000_000


# -- registry -----------------------------------------------------------------------------

def registry_rows(manifests: DataFrame, manifest_json: str, registered_at: Column) -> DataFrame:
    """Registry rows of manifest documents, ready to append."""
    m = F.from_json(F.col(manifest_json), S.MANIFEST)
    return manifests.withColumn("__m", m).select(
        F.col("__m.id").alias("product_id"), F.col("__m.domain"), F.col("__m.name"), F.col("__m.owner"),
        F.col("__m.version"), F.coalesce(F.col("__m.access"), F.lit("public")).alias("access"),
        F.col(manifest_json).alias("manifest_json"), registered_at.cast("string").alias("registered_at"),
    )


def latest_products(registry: DataFrame) -> DataFrame:
    """The newest row per product."""
    order = [F.col(c).desc() for c in ("registered_at", "version", "manifest_json") if c in registry.columns]
    return first_per_key(registry, ["product_id"], order)


def product(registry: DataFrame, product_id: str) -> DataFrame:
    """The newest row of one product; an unknown id raises ``KeyError``."""
    found = latest_products(registry.filter(F.col("product_id") == product_id))
    if found.isEmpty():
        raise KeyError(f"product {product_id!r} is not registered")
    return found


def product_versions(registry: DataFrame, product_id: str) -> DataFrame:
    return registry.filter(F.col("product_id") == product_id).orderBy(F.col("registered_at").desc())


def publish_versions(proposed: DataFrame, registry: DataFrame, version: str = "version") -> DataFrame:
    """Version each proposed product gets: new and higher ones as given, else a patch bump."""
    latest = latest_products(registry).select("product_id", F.col("version").alias("latest_version"))
    return proposed.join(latest, "product_id", "left").withColumn("resolved_version", resolve_version(version, "latest_version"))


# -- manifests ----------------------------------------------------------------------------

def manifest_violations(manifests: DataFrame, product: str, manifest_json: str) -> DataFrame:
    """(product, field, rule) for every broken manifest rule; valid manifests give no row."""
    return json_rules.violations(manifests, product, manifest_json, S.MANIFEST_SCHEMA)


def schema_rows(registry: DataFrame, keep: Sequence[str], manifest_json: str = "manifest_json") -> DataFrame:
    """One row per declared column."""
    columns = F.from_json(F.get_json_object(F.col(manifest_json), "$.schema"), f"array<{S.MANIFEST_COLUMN}>")
    return registry.select(*keep, F.explode(columns).alias("__c")).select(*keep, "__c.*")


def schema_compatibility(old: DataFrame, new: DataFrame, mode: str | Column, product: str = "product_id",
                         column: str = "name", kind: str = "type") -> DataFrame:
    """(product, column, violation) between two schema versions.

    BACKWARD forbids removals and type changes, FORWARD forbids additions, FULL both, NONE
    nothing.  A product that lacks either side is not compared.
    """
    m = F.lit(mode) if isinstance(mode, str) else mode
    sides = (
        old.select(product, F.col(column).alias("__c"), F.col(kind).alias("__old"), F.lit(1).alias("__o"))
        .unionByName(
            new.select(product, F.col(column).alias("__c"), F.col(kind).alias("__new"), F.lit(1).alias("__n")),
            allowMissingColumns=True,
        )
    )
    per_column = sides.groupBy(product, F.col("__c").alias(column)).agg(
        F.max("__old").alias("old_type"), F.max("__new").alias("new_type"),
        F.max("__o").isNotNull().alias("__in_old"), F.max("__n").isNotNull().alias("__in_new"),
    )
    both = per_column.groupBy(product).agg(
        (F.bool_or("__in_old") & F.bool_or("__in_new")).alias("__both")
    ).filter("__both").select(product)
    backward, forward = m.isin("BACKWARD", "FULL"), m.isin("FORWARD", "FULL")
    violation = (
        F.when(backward & F.col("__in_old") & ~F.col("__in_new"), "removed")
        .when(backward & F.col("__in_old") & F.col("__in_new") & ~F.col("old_type").eqNullSafe(F.col("new_type")), "type_changed")
        .when(forward & ~F.col("__in_old") & F.col("__in_new"), "added")
    )
    return (
        per_column.join(both, product, "left_semi").withColumn("violation", violation)
        .filter(F.col("violation").isNotNull())
        .select(product, column, "violation", "old_type", "new_type")
    )


def version_changes(versions: DataFrame, watched: Sequence[str], key: str = "product_id", order: Sequence[str] = ("registered_at",),
                    columns: str | None = None) -> DataFrame:
    """What changed against the version before: ``changes`` and ``added`` / ``removed`` columns.

    ``columns`` names an array column with the declared column names, or structs of name and
    type; a change of types alone is one text.  A watched array (tags) only says that it changed.
    """
    lag = {f"__p_{c}": c for c in watched}
    typed = bool(columns) and isinstance(versions.schema[columns].dataType.elementType, StructType)
    if columns:
        lag[f"__p_{columns}"] = columns
    seen = over_order(versions.withColumn("__one", F.lit(1)), [key], list(order), lag={**lag, "__had": "__one"})
    first = F.col("__had").isNull()

    def change(c):
        if isinstance(versions.schema[c].dataType, ArrayType):
            return F.when(~first & ~F.col(f"__p_{c}").eqNullSafe(F.col(c)), F.lit(f"{c} changed"))
        before, now = F.col(f"__p_{c}").cast("string"), F.col(c).cast("string")
        text = F.when(before.isNull(), F.concat(F.lit(f"{c} -> "), now)).otherwise(
            F.concat(F.lit(f"{c}: "), before, F.lit(" -> "), F.coalesce(now, F.lit("")))
        )
        return F.when(~first & ~before.eqNullSafe(now), text)

    texts = [change(c) for c in watched]
    made = {}
    if columns:
        nothing = F.array().cast(versions.schema[columns].dataType)
        before, now = F.coalesce(F.col(f"__p_{columns}"), nothing), F.coalesce(F.col(columns), nothing)
        names = [F.transform(x, lambda f: f["name"]) if typed else x for x in (before, now)]
        made = {
            "added": F.when(~first, F.sort_array(F.array_except(names[1], names[0]))),
            "removed": F.when(~first, F.sort_array(F.array_except(names[0], names[1]))),
        }
        if typed:
            same = (F.size(F.array_except(names[1], names[0])) == 0) & (F.size(F.array_except(names[0], names[1])) == 0)
            texts.append(F.when(~first & same & (F.size(F.array_except(now, before)) > 0), F.lit(f"{columns}: types changed")))
    out = seen.withColumns({"changes": F.when(first, F.array(F.lit("first"))).otherwise(F.array_compact(F.array(*texts))), **made})
    return out.drop("__had", "__one", *lag)


def merged_schema(physical: DataFrame, declared: DataFrame, product: str = "product_id", column: str = "name") -> DataFrame:
    """Physical and declared columns in one list; a column only declared is ``pending`` once the product has a table.

    Types and nullability come from the table, the other properties from the manifest.
    """
    p = physical.select(product, column, F.col("type").alias("__pt"), F.col("nullable").alias("__pn"), F.lit(True).alias("__there"))
    return (
        declared.select(product, column, F.col("type").alias("__dt"), F.col("nullable").alias("__dn"), "pii", "sensitivity", "description")
        .join(p, [product, column], "full")
        .join(p.select(product, F.lit(True).alias("__table")).distinct(), product, "left")
        .select(
            product, column,
            F.when(F.col("__there"), F.col("__pt")).otherwise(F.coalesce("__dt", F.lit(""))).alias("type"),
            F.when(F.col("__there"), F.col("__pn")).otherwise(F.coalesce("__dn", F.lit(True))).alias("nullable"),
            (F.col("__there").isNull() & F.col("__table").isNotNull()).alias("pending"), F.coalesce("pii", F.lit(False)).alias("pii"), "sensitivity", "description",
        )
    )


def pii_columns(declared: DataFrame) -> DataFrame:
    """One row per declared column flagged as personal."""
    return declared.filter(F.col("pii"))


def pii_map(declared: DataFrame, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Per product: number of personal columns and the highest sensitivity."""
    rank = F.create_map(*[x for i, s in enumerate(S.SENSITIVITIES) for x in (F.lit(s), F.lit(i))])
    level = F.coalesce(F.try_element_at(rank, F.coalesce("sensitivity", F.lit("unknown"))), F.lit(-1))
    return pii_columns(declared).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pii_columns"),
        F.max(F.struct(level, F.coalesce("sensitivity", F.lit("unknown")).alias("s")))["s"].alias("sensitivity"),
    )


def pii_report(registry: DataFrame) -> DataFrame:
    """Per product with personal columns: their number, the highest sensitivity, who answers for it and how long rows are kept."""
    m = F.from_json("manifest_json", S.MANIFEST)
    described = latest_products(registry).withColumn("__m", m).select(
        "product_id", "name", "domain", "owner", "manifest_json", F.col("__m.retention.days").alias("retention_days"),
        F.when(F.col("__m.retention").isNotNull(), F.coalesce("__m.retention.strategy", F.lit("delete"))).alias("retention_strategy"))
    keys = [c for c in described.columns if c != "manifest_json"]
    columns = schema_rows(described.withColumnRenamed("name", "product_name"), [c if c != "name" else "product_name" for c in keys])
    found = pii_map(columns, [c if c != "name" else "product_name" for c in keys])
    return found.withColumnRenamed("product_name", "name")


def patch_columns(declared: DataFrame, updates: DataFrame, fields: Sequence[str], column: str = "name") -> DataFrame:
    """New schema rows with the updated fields; an update of an unknown column raises ``ValueError``."""
    unknown = updates.join(declared.select("product_id", column), ["product_id", column], "left_anti")
    bad = unknown.limit(1).collect()
    if bad:
        raise ValueError(f"unknown column {bad[0][column]!r} of product {bad[0]['product_id']!r}")
    changed = updates.select("product_id", column, *[F.col(f).alias(f"__u_{f}") for f in fields])
    return declared.join(changed, ["product_id", column], "left").select(
        *[F.coalesce(F.col(f"__u_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in declared.columns]
    )


def column_lineage(spark, payload_fields: Mapping[str, str], casts: Mapping[str, str], primary_key: str, source_product: str) -> DataFrame:
    """Lineage rows of a curation rule set: output column, source column, transformation."""
    names = sorted({*payload_fields, *casts, primary_key})
    rows = [
        (c, source_product, payload_fields.get(c) or c,
         "payload_json-extract + cast" if c in payload_fields else "cast/null-handling")
        for c in names
    ]
    return spark.createDataFrame(rows, "column string, source_product string, source_column string, transformation string")


# -- relations, access, size --------------------------------------------------------------

def related_products(products: DataFrame, anchor_id: object, k: int = 4, product: str = "product_id", domain: str = "domain",
                     owner: str = "owner", columns: str = "columns", sources: str = "source_products") -> DataFrame:
    """Products related to one product, best ``k`` by score.

    The anchor is one row; every other product is scored against it in one pass.
    """
    wanted = dict(domain=domain, owner=owner, columns=columns, sources=sources)
    anchor = products.filter(F.col(product) == anchor_id).agg(
        F.first(F.struct(*[F.col(c).alias(n) for n, c in wanted.items()]))
    ).scalar()

    def mine(name):
        return anchor.getField(name)

    overlap = F.size(F.array_intersect(F.col(columns), mine("columns")))
    linked = F.coalesce(F.array_contains(mine("sources"), F.col(product)), F.lit(False)) | F.coalesce(
        F.array_contains(F.col(sources), F.lit(anchor_id)), F.lit(False)
    )
    score = (
        F.when(F.col(domain).eqNullSafe(mine("domain")), DOMAIN_POINTS).otherwise(0)
        + F.least(overlap * COLUMN_POINTS, F.lit(COLUMN_CAP))
        + F.when(linked, LINEAGE_POINTS).otherwise(0)
        + F.when(F.col(owner).eqNullSafe(mine("owner")), OWNER_POINTS).otherwise(0)
    )
    scored = products.filter(F.col(product) != anchor_id).select(product, score.alias("score")).filter("score > 0")
    return top_k(scored, [F.col("score").desc(), F.col(product).asc()], k)


def row_guard(counts: DataFrame, limit: int = ROW_LIMIT, rows: str = "row_count") -> DataFrame:
    """Total rows of the chosen products and whether they exceed the limit; unknown counts are ignored."""
    return counts.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("total_rows")).withColumn("exceeds", F.col("total_rows") > limit)


def gold_candidates(chosen: DataFrame, products: DataFrame, k: int | None = 5, product: str = "product_id") -> DataFrame:
    """Gold products of the domains of the chosen ones, by id."""
    domains = chosen.select("domain").distinct()
    found = (
        products.filter(F.col("source_path").rlike("^s3a?://gold/"))
        .join(domains, "domain", "left_semi")
        .join(chosen.select(product), product, "left_anti")
    )
    return top_k(found, [F.col(product).asc()], k) if k else found


def split_access(products: DataFrame, grants: DataFrame, product: str = "product_id", access: str = "access") -> DataFrame:
    """Every product with ``accessible``: public ones and those granted."""
    granted = grants.select(product).distinct().withColumn("__granted", F.lit(True))
    return products.join(granted, product, "left").select(
        *products.columns, ((F.col(access) == "public") | F.col("__granted").isNotNull()).alias("accessible")
    )


def products_per_group(products: DataFrame, group: str, name: str) -> DataFrame:
    """(group, name, n_products): the products of each group as rows, so a large group stays spread out."""
    pairs = durable(products.filter(F.col(group).isNotNull()).select(group, name).distinct(), "pairs")
    sizes = pairs.groupBy(group).agg(F.count(F.lit(1)).alias("n_products"))
    return pairs.join(sizes, group)
