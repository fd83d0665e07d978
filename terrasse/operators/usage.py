"""Freshness, compliance, incidents and usage over log tables.

Every trailing window takes ``as_of`` as a column or literal instead of the wall clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.functions.scalars import days_before, hours_between
from terrasse.operators.keys import first_per_key
from terrasse.operators.measures import top_k
from terrasse.operators.ordered import trailing_stats

# Actions, sentinel product, statuses and limits of the usage log.
PLATFORM_PRODUCT = "__platform__"
VIEW = "view"
QUESTION_ACTIONS = ("agent_ask", "agent_explain")
INCIDENT_STATUSES = ("open", "acknowledged", "resolving", "resolved")
WARNING_RATIO = 0.8
QUALITY_INCIDENT_BELOW = 50.0
CONTRACT_ORDER = {"breach": 0, "warning": 1, "ok": 2, "none": 3}
STATE_PRIORITY = {"failed": 4, "running": 3, "queued": 2, "success": 1, "none": 0}


def in_window(ts: str, start: Column, end: Column) -> Column:
    """Half-open window."""
    return (F.col(ts) >= start) & (F.col(ts) < end)


def freshness(products: DataFrame, commits: DataFrame, as_of: Column, product: str = "product_id",
              committed_at: str = "committed_at", limit: str = "freshness_hours") -> DataFrame:
    """Hours since the last commit against each product's limit; a product without commits breaches."""
    last = commits.groupBy(product).agg(F.max(committed_at).alias("last_updated"))
    hours = hours_between(F.col("last_updated"), as_of)
    return (
        products.filter(F.col(limit).isNotNull() & (F.col(limit) != 0))
        .join(last, product, "left")
        .select(
            product, "last_updated", F.round(hours, 2).alias("hours_since_update"), limit,
            F.coalesce(hours <= F.col(limit), F.lit(False)).alias("compliant"),
        )
    )


def compliance_window(results: DataFrame, as_of: Column, days: int = 7, product: str = "product_id",
                      checked_at: str = "checked_at", compliant: str = "compliant") -> DataFrame:
    """Share of compliant checks in percent over the last ``days``."""
    return (
        results.filter(F.col(checked_at) >= days_before(as_of, days))
        .groupBy(product)
        .agg(F.round(F.count_if(F.coalesce(F.col(compliant), F.lit(False))) / F.count(F.lit(1)) * 100, 1).alias("compliance_pct"))
    )


def mean_hours_to_resolve(incidents: DataFrame, keys: Sequence[str], created: str = "created_at",
                          resolved: str = "resolved_at", status: str = "status") -> DataFrame:
    """Mean hours from creation to resolution; open and negative ones are skipped."""
    hours = hours_between(F.col(created), F.col(resolved))
    return (
        incidents.filter((F.col(status) == "resolved") & (hours >= 0))
        .groupBy(*keys).agg(F.round(F.avg(hours), 1).alias("mttr_hours"))
    )


def anomalies(runs: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, rows: int = 30, sigmas: float = 2.0) -> DataFrame:
    """Flag values beyond mean ± ``sigmas`` standard deviations of the runs before."""
    stats = trailing_stats(runs, keys, order, value, rows)
    away = F.abs(F.col(value) - F.col("trailing_mean")) > F.col("trailing_stddev") * sigmas
    return stats.withColumn("is_anomaly", F.coalesce(away, F.lit(False)))


def usage_window(usage: DataFrame, start: Column, end: Column, product: str = "product_id", ts: str = "ts") -> DataFrame:
    """All actions per product in ``[start, end)``."""
    return usage.filter(in_window(ts, start, end) & (F.col(product) != PLATFORM_PRODUCT)).groupBy(product).agg(
        F.count(F.lit(1)).alias("n")
    )


def top_viewed(usage: DataFrame, as_of: Column, days: int = 30, k: int = 10, product: str = "product_id",
               action: str = "action", view: str = VIEW, ts: str = "ts") -> DataFrame:
    views = usage.filter((F.col(action) == view) & (F.col(ts) >= days_before(as_of, days))).groupBy(product).agg(
        F.count(F.lit(1)).alias("views")
    )
    return top_k(views, [F.col("views").desc(), F.col(product).asc()], k)


def active_users(usage: DataFrame, start: Column, end: Column, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Distinct users in the window; rows without a user do not count."""
    return usage.filter(in_window(ts, start, end)).agg(F.count_distinct(user).alias("n"))


def trending(usage: DataFrame, as_of: Column, days: int = 7, k: int | None = 5, product: str = "product_id", ts: str = "ts") -> DataFrame:
    """Products whose use grew against the window before; no earlier use counts as 100 %."""
    middle, start = days_before(as_of, days), days_before(as_of, 2 * days)
    counted = (
        usage.filter(in_window(ts, start, as_of) & (F.col(product) != PLATFORM_PRODUCT))
        .groupBy(product)
        .agg(F.count_if(F.col(ts) >= middle).alias("usage_window"), F.count_if(F.col(ts) < middle).alias("usage_prev"))
        .filter(F.col("usage_window") > 0)
    )
    change = F.when(
        F.col("usage_prev") > 0,
        F.round((F.col("usage_window") - F.col("usage_prev")) / F.col("usage_prev") * 100, 1),
    ).otherwise(F.lit(100.0))
    grown = counted.withColumn("delta_pct", change).filter(F.col("delta_pct") > 0)
    return top_k(grown, [F.col("delta_pct").desc(), F.col(product).asc()], k) if k else grown


def recent_publications(versions: DataFrame, as_of: Column, days: int = 14, k: int | None = 20,
                        product: str = "product_id", at: str = "registered_at", tie: Sequence[str] = ()) -> DataFrame:
    """Versions published lately; the first version ever of a product is ``new``."""
    first = versions.groupBy(F.col(product).alias("__product")).agg(F.min(F.struct(at, *tie)).alias("__first"))
    recent = versions.filter(F.col(at) >= days_before(as_of, days))
    recent = recent.join(first, F.col(product).eqNullSafe(F.col("__product")))
    is_first = F.struct(at, *tie).eqNullSafe(F.col("__first"))
    recent = recent.withColumn("event", F.when(is_first, "new").otherwise("version_bump")).drop("__product", "__first")
    return top_k(recent, [F.col(at).desc(), F.col(product).asc(), *[F.col(t).desc() for t in tie]], k) if k else recent


def popular_questions(feedback: DataFrame, as_of: Column, days: int = 7, k: int | None = 5, question: str = "question",
                      rating: str = "rating", liked: str = "thumbs_up", ts: str = "ts") -> DataFrame:
    """Likes per trimmed question text."""
    liked_rows = feedback.filter((F.col(ts) >= days_before(as_of, days)) & (F.col(rating) == liked))
    counted = (
        liked_rows.groupBy(F.trim(F.col(question)).alias("question")).agg(F.count(F.lit(1)).alias("likes"))
        .filter(F.col("question") != "")
    )
    return top_k(counted, [F.col("likes").desc(), F.col("question").asc()], k) if k else counted


def platform_health(sla: DataFrame, quality: DataFrame, product: str = "product_id") -> DataFrame:
    """Latest result per product: compliance, mean score and number of incidents."""
    last_sla = first_per_key(sla, [product], [F.col("checked_at").desc(), F.col("compliant").asc()]).filter(F.col("compliant").isNotNull())
    last_quality = first_per_key(quality, [product], [F.col("validated_at").desc(), F.col("score_pct").asc()]).filter(F.col("score_pct").isNotNull())
    both = last_sla.select(product, "compliant").unionByName(last_quality.select(product, "score_pct"), allowMissingColumns=True)
    breaches = F.count_if(~F.col("compliant"))
    low = F.count_if(F.col("score_pct") < QUALITY_INCIDENT_BELOW)
    return both.agg(
        F.round(F.try_divide(F.count_if("compliant"), F.count("compliant")) * 100, 1).alias("sla_compliance_pct"),
        F.round(F.avg("score_pct"), 1).alias("avg_quality_pct"),
        (breaches + low).alias("active_incidents"),
        F.count("compliant").alias("sla_products_total"),
        F.count("score_pct").alias("quality_products"),
    )


def incident_rows(sla: DataFrame, quality: DataFrame, product: str = "product_id") -> DataFrame:
    """One row per breach or low score among the latest results."""
    last_sla = first_per_key(sla, [product], [F.col("checked_at").desc(), F.col("compliant").asc()])
    last_quality = first_per_key(quality, [product], [F.col("validated_at").desc(), F.col("score_pct").asc()])
    return last_sla.filter(~F.col("compliant")).select(
        product, F.lit("sla_breach").alias("type"), F.col("checked_at")
    ).unionByName(
        last_quality.filter(F.col("score_pct") < QUALITY_INCIDENT_BELOW).select(
            product, F.lit("quality").alias("type"), F.col("validated_at").alias("checked_at")
        )
    )


def usage_by_user(usage: DataFrame, as_of: Column, days: int = 7, user: str = "user_id", product: str = "product_id",
                  action: str = "action", ts: str = "ts", view: str = VIEW,
                  questions: Sequence[str] = QUESTION_ACTIONS) -> DataFrame:
    """Summary for every user: products viewed in the window and ever, new ones, questions asked."""
    cutoff = days_before(as_of, days)
    is_view = (F.col(action) == view) & (F.col(product) != PLATFORM_PRODUCT)
    recent = F.col(ts) >= cutoff
    per_product = (
        usage.filter(F.col(user).isNotNull())
        .groupBy(user, product)
        .agg(
            F.min(F.when(is_view, F.col(ts))).alias("__first"),
            F.count_if(is_view & recent).alias("__views"),
            F.count_if(F.col(action).isin(*questions) & recent).alias("__questions"),
        )
    )
    return per_product.groupBy(user).agg(
        F.count_if(F.col("__views") > 0).alias("products_viewed_window"),
        F.count_if(F.col("__first").isNotNull()).alias("products_viewed_ever"),
        F.count_if((F.col("__views") > 0) & (F.col("__first") >= cutoff)).alias("new_to_user_window"),
        F.sum("__questions").alias("questions_asked_window"),
        F.sum("__views").alias("views_window"),
    )


def contract_status(rows: DataFrame, has_contract: str = "has_contract", compliant: str = "compliant",
                    hours: str = "hours_since_update", limit: str = "freshness_hours") -> DataFrame:
    """none, breach, warning (close to the limit) or ok, with a sort rank."""
    ratio = F.try_divide(F.col(hours), F.col(limit))
    status = (
        F.when(~F.col(has_contract) | F.col(compliant).isNull(), "none")
        .when(~F.col(compliant), "breach")
        .when(ratio > WARNING_RATIO, "warning")
        .otherwise("ok")
    )
    rank = F.create_map(*[F.lit(x) for pair in CONTRACT_ORDER.items() for x in pair])
    return rows.withColumn("contract_status", status).withColumn("status_rank", rank[F.col("contract_status")])


def daily_worst_state(runs: DataFrame, as_of: Column, days: int = 7, ts: str = "ts", state: str = "state") -> DataFrame:
    """Worst state of each of the last ``days`` days; days without a run are ``none``."""
    ranks = F.create_map(*[F.lit(x) for pair in STATE_PRIORITY.items() for x in pair])
    states = F.create_map(*[F.lit(x) for name, n in STATE_PRIORITY.items() for x in (n, name)])
    rank = F.coalesce(F.try_element_at(ranks, F.col(state)), F.lit(0))
    worst = runs.groupBy(F.to_date(ts).alias("date")).agg(F.max(rank).alias("__rank"))
    spine = runs.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_sub(as_of.cast("date"), days - 1), as_of.cast("date"))).alias("date")
    )
    return spine.join(worst, "date", "left").select("date", states[F.coalesce("__rank", F.lit(0))].alias("state"))


def views_by_domain(usage: DataFrame, products: DataFrame, product: str = "product_id", domain: str = "domain",
                    unknown: str = "(ukjent)") -> DataFrame:
    """Uses per domain; uses of unknown products are dropped, a missing domain gets the label."""
    counted = usage.groupBy(product).agg(F.count(F.lit(1)).alias("__n"))
    label = F.coalesce(F.col(domain), F.lit(unknown))
    return counted.join(products, product).groupBy(label.alias(domain)).agg(F.sum("__n").alias("views"))


def list_incidents(incidents: DataFrame, product: str | None = None, status: str | None = None) -> DataFrame:
    """Newest first, optionally for one product or status."""
    if product is not None:
        incidents = incidents.filter(F.col("product_id") == product)
    if status is not None:
        incidents = incidents.filter(F.col("status") == status)
    return incidents.orderBy(F.col("created_at").desc())


def change_incident_status(incidents: DataFrame, changes: DataFrame, as_of: Column) -> DataFrame:
    """Apply ``(id, status, updated_by)`` changes; ``resolved_at`` is set on resolution.

    Changes to a status that does not exist are ignored.
    """
    valid = changes.filter(F.col("status").isin(*INCIDENT_STATUSES)).select(
        "id", F.col("status").alias("__status"), F.col("updated_by").alias("__by")
    )
    changed = F.col("__status").isNotNull()
    joined = incidents.join(valid, "id", "left")
    new = {
        "status": F.coalesce("__status", "status"),
        "updated_by": F.when(changed, F.col("__by")).otherwise(F.col("updated_by")),
        "updated_at": F.when(changed, as_of).otherwise(F.col("updated_at")),
        "resolved_at": F.when(F.col("__status") == "resolved", as_of).otherwise(F.col("resolved_at")),
    }
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in incidents.columns])


def platform_totals(products: DataFrame, publications: DataFrame, quality: DataFrame | None = None, as_of: Column | None = None,
                    days: int = 7) -> DataFrame:
    """Products, domains, new products in the window and mean score, as one row."""
    fresh = publications.filter((F.col("event") == "new") & (F.col("registered_at") >= days_before(as_of, days)))
    out = products.agg(F.count(F.lit(1)).alias("products"), F.count_distinct("domain").alias("domains")).withColumn(
        "new_products", fresh.agg(F.count(F.lit(1))).scalar()
    )
    if quality is not None:
        out = out.withColumn("avg_quality_pct", quality.agg(F.round(F.avg("score_pct"), 1)).scalar())
    return out


def metrics_snapshot(parts: dict[str, DataFrame], generated_at: Column) -> DataFrame:
    """All metric frames as rows (section, generated_at, payload JSON), ready to append."""
    frames = [
        df.select(F.lit(name).alias("section"), generated_at.alias("generated_at"), F.to_json(F.struct("*")).alias("payload"))
        for name, df in parts.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
