"""Usage, freshness, incidents and trends over the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrasse.catalogue.base import AS_OF_SQL, USAGE_SQL, as_of, query, table, usage
from terrasse.functions.scalars import days_before, schedule_hours
from terrasse.operators import distinct, keys
from terrasse.operators import usage as U
from terrasse.plans import observability

PRODUCTS_SQL = """products AS (SELECT DISTINCT 'p' || c_nationkey AS product_id, CAST(CASE c_nationkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 25 END AS INTEGER) AS freshness_hours,
    CASE WHEN c_nationkey < 20 THEN 'd' || (c_nationkey % 4) END AS domain FROM customer)"""


def _products(spark, sf):
    n = F.col("c_nationkey")
    schedule = F.when(n % 3 == 0, "@hourly").when(n % 3 == 1, "@daily").otherwise("0 5 * * *")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("p"), n).alias("product_id"), schedule_hours(schedule).alias("freshness_hours"),
        F.when(n < 20, F.concat(F.lit("d"), (n % 4).cast("string"))).alias("domain"),
    ).distinct()


HOURS = "(epoch_us({b}) - epoch_us({a})) / 3600000000"
FRESH_SQL = f"""fresh AS (SELECT product_id, max_ts AS last_updated, round({HOURS.format(a='max_ts', b=AS_OF_SQL)}, 2) AS hours_since_update, freshness_hours,
           coalesce({HOURS.format(a='max_ts', b=AS_OF_SQL)} <= freshness_hours, false) AS compliant
    FROM products LEFT JOIN (SELECT product_id, max(ts) AS max_ts FROM usage WHERE action = 'purchase' GROUP BY 1) USING (product_id)
    WHERE freshness_hours IS NOT NULL)"""


def _fresh(spark, sf):
    commits = usage(spark, sf).filter("action = 'purchase'").withColumnRenamed("ts", "committed_at")
    return U.freshness(_products(spark, sf), commits, as_of())


@query(f"WITH {USAGE_SQL}, {PRODUCTS_SQL}, {FRESH_SQL} SELECT * FROM fresh")
def freshness_sla(spark, sf):
    return _fresh(spark, sf)


@query(f"""WITH {USAGE_SQL} SELECT product_id, round(count(*) FILTER (WHERE action <> 'error') / count(*) * 100, 1) AS compliance_pct
           FROM usage WHERE ts >= {AS_OF_SQL} - INTERVAL 7 DAY GROUP BY 1""")
def sla_compliance_window(spark, sf):
    checks = usage(spark, sf).select("product_id", F.col("ts").alias("checked_at"), (F.col("action") != "error").alias("compliant"))
    return U.compliance_window(checks, as_of())


INCIDENT_SQL = """incidents AS (SELECT event_id AS id, product_id, ts AS created_at, CASE WHEN action = 'error' THEN 'open' ELSE 'resolved' END AS status,
    ts + to_minutes(CAST(user_id * 3 - 30 AS BIGINT)) AS resolved_at FROM usage)"""


def _incidents(spark, sf):
    minutes = F.make_dt_interval(mins=(F.col("user_id") * 3 - 30).cast("int"))
    return usage(spark, sf).select(
        F.col("event_id").alias("id"), "product_id", F.col("ts").alias("created_at"),
        F.when(F.col("action") == "error", "open").otherwise("resolved").alias("status"), (F.col("ts") + minutes).alias("resolved_at"),
    )


@query(f"""WITH {USAGE_SQL}, {INCIDENT_SQL} SELECT product_id, round(avg({HOURS.format(a='created_at', b='resolved_at')}), 1) AS mttr_hours
           FROM incidents WHERE status = 'resolved' AND resolved_at >= created_at GROUP BY 1""")
def mttr_hours(spark, sf):
    return U.mean_hours_to_resolve(_incidents(spark, sf), ["product_id"])


@query(f"""WITH {USAGE_SQL}, {INCIDENT_SQL} SELECT id, product_id, CASE WHEN status = 'open' AND id % 2 = 0 THEN 'resolved' ELSE status END AS status,
    CASE WHEN status = 'open' AND id % 2 = 0 THEN {AS_OF_SQL} ELSE resolved_at END AS resolved_at FROM incidents""")
def incident_status_change(spark, sf):
    log = _incidents(spark, sf).withColumns({"updated_by": F.lit("a"), "updated_at": F.col("created_at")})
    even = (F.col("status") == "open") & (F.col("id") % 2 == 0)
    changes = log.filter(F.col("status") == "open").select(
        "id", F.when(even, "resolved").otherwise("no_such_status").alias("status"), F.lit("b").alias("updated_by")
    )
    return U.change_incident_status(log, changes, as_of()).select("id", "product_id", "status", "resolved_at")


@query(f"""WITH {USAGE_SQL}, s AS (SELECT event_id, product_id, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd, count(value) OVER w AS n
      FROM usage WINDOW w AS (PARTITION BY product_id ORDER BY ts, event_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
    SELECT event_id, product_id, round(m, 7) AS trailing_mean, n AS trailing_n, coalesce(abs(value - m) > sd * 2, false) AS is_anomaly FROM s""")
def anomaly_2sigma(spark, sf):
    runs = usage(spark, sf).select("event_id", "product_id", "ts", "value")
    return U.anomalies(runs, ["product_id"], ["ts", "event_id"], "value").select(
        "event_id", "product_id", F.round("trailing_mean", 7).alias("trailing_mean"), "trailing_n", "is_anomaly"
    )


RESULTS_SQL = """sla AS (SELECT product_id, action <> 'error' AS compliant FROM usage QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ts DESC, compliant) = 1),
    q AS (SELECT product_id, least(value, 100) AS score_pct FROM usage QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ts DESC, score_pct) = 1)"""


def _results(spark, sf):
    log = usage(spark, sf)
    sla = log.select("product_id", F.col("ts").alias("checked_at"), (F.col("action") != "error").alias("compliant"))
    scores = log.select("product_id", F.col("ts").alias("validated_at"), F.least("value", F.lit(100.0)).alias("score_pct"))
    return sla, scores


@query(f"""WITH {USAGE_SQL}, {RESULTS_SQL}
    SELECT (SELECT round(count(*) FILTER (WHERE compliant) / count(*) * 100, 1) FROM sla) AS sla_compliance_pct, (SELECT round(avg(score_pct), 1) FROM q) AS avg_quality_pct,
           (SELECT count(*) FROM sla WHERE NOT compliant) + (SELECT count(*) FROM q WHERE score_pct < 50) AS active_incidents,
           (SELECT count(*) FROM sla) AS sla_products_total, (SELECT count(*) FROM q) AS quality_products""")
def platform_health(spark, sf):
    return U.platform_health(*_results(spark, sf))


@query(f"""WITH {USAGE_SQL}, {RESULTS_SQL} SELECT product_id, 'sla_breach' AS type FROM sla WHERE NOT compliant
           UNION ALL SELECT product_id, 'quality' FROM q WHERE score_pct < 50""")
def incident_rows(spark, sf):
    return U.incident_rows(*_results(spark, sf)).select("product_id", "type")


@query(f"""WITH {USAGE_SQL}, c AS (SELECT product_id, count(*) FILTER (WHERE ts >= {AS_OF_SQL} - INTERVAL 7 DAY) AS usage_window,
      count(*) FILTER (WHERE ts < {AS_OF_SQL} - INTERVAL 7 DAY) AS usage_prev FROM usage WHERE ts >= {AS_OF_SQL} - INTERVAL 14 DAY AND ts < {AS_OF_SQL} GROUP BY 1),
    d AS (SELECT *, CASE WHEN usage_prev > 0 THEN round((usage_window - usage_prev) / usage_prev * 100, 1) ELSE 100.0 END AS delta_pct FROM c WHERE usage_window > 0)
    SELECT * FROM d WHERE delta_pct > 0 ORDER BY delta_pct DESC, product_id LIMIT 5""")
def trending_up(spark, sf):
    return U.trending(usage(spark, sf), as_of())


@query(f"""WITH v AS (SELECT user_id AS product_id, event_id, ts AS registered_at,
      CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 'new' ELSE 'version_bump' END AS event FROM events)
    SELECT * FROM v WHERE registered_at >= {AS_OF_SQL} - INTERVAL 14 DAY ORDER BY registered_at DESC, product_id, event_id DESC LIMIT 20""")
def publications_recent(spark, sf):
    versions = table(spark, sf, "events").select(F.col("user_id").alias("product_id"), "event_id", F.col("ts").alias("registered_at"))
    return U.recent_publications(versions, as_of(), tie=["event_id"])


@query(f"""SELECT trim(props) AS question, count(*) AS likes FROM events WHERE event_type = 'click' AND ts >= {AS_OF_SQL} - INTERVAL 7 DAY
           GROUP BY 1 ORDER BY likes DESC, question LIMIT 5""")
def popular_items(spark, sf):
    padded = F.concat(F.lit("  "), "props", F.lit(" "))
    feedback = table(spark, sf, "events").select("ts", padded.alias("question"), F.col("event_type").alias("rating"))
    return U.popular_questions(feedback, as_of(), liked="click")


@query(f"""WITH {USAGE_SQL} SELECT product_id, count(*) AS n FROM usage WHERE ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts < {AS_OF_SQL} GROUP BY 1""")
def usage_window(spark, sf):
    return U.usage_window(usage(spark, sf), days_before(as_of(), 7), as_of())


@query(f"""WITH {USAGE_SQL} SELECT product_id, count(*) AS views FROM usage WHERE action = 'view' AND ts >= {AS_OF_SQL} - INTERVAL 30 DAY
           GROUP BY 1 ORDER BY views DESC, product_id LIMIT 10""")
def usage_top10(spark, sf):
    return U.top_viewed(usage(spark, sf), as_of())


@query(f"""SELECT count(DISTINCT CASE WHEN event_type <> 'error' THEN user_id END) AS n FROM events
           WHERE ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts < {AS_OF_SQL}""")
def distinct_active(spark, sf):
    log = usage(spark, sf).withColumn("user_id", F.when(F.col("action") != "error", F.col("user_id")))
    return U.active_users(log, days_before(as_of(), 7), as_of())


@query(f"""WITH {USAGE_SQL}, c AS (SELECT {AS_OF_SQL} - INTERVAL 7 DAY AS cut),
    pp AS (SELECT user_id, product_id, min(ts) FILTER (WHERE action = 'view') AS first_view, count(*) FILTER (WHERE action = 'view' AND ts >= cut) AS views,
                  count(*) FILTER (WHERE action IN ('click', 'purchase') AND ts >= cut) AS q FROM usage, c GROUP BY 1, 2)
    SELECT user_id, count(*) FILTER (WHERE views > 0) AS products_viewed_window, count(first_view) AS products_viewed_ever,
           count(*) FILTER (WHERE views > 0 AND first_view >= cut) AS new_to_user_window,
           CAST(sum(q) AS BIGINT) AS questions_asked_window, CAST(sum(views) AS BIGINT) AS views_window FROM pp, c GROUP BY 1""")
def user_usage_summary(spark, sf):
    return U.usage_by_user(usage(spark, sf), as_of(), questions=("click", "purchase"))


@query(f"""WITH {USAGE_SQL}, {PRODUCTS_SQL}, {FRESH_SQL}
    SELECT product_id, CASE WHEN domain IS NULL THEN 'none' WHEN NOT compliant THEN 'breach' WHEN hours_since_update / freshness_hours > 0.8 THEN 'warning' ELSE 'ok' END AS contract_status,
           CASE WHEN domain IS NULL THEN 3 WHEN NOT compliant THEN 0 WHEN hours_since_update / freshness_hours > 0.8 THEN 1 ELSE 2 END AS status_rank
    FROM fresh JOIN (SELECT product_id, domain FROM products) USING (product_id)""")
def contract_status(spark, sf):
    rows = _fresh(spark, sf).join(_products(spark, sf).select("product_id", F.col("domain").isNotNull().alias("has_contract")), "product_id")
    return U.contract_status(rows).select("product_id", "contract_status", "status_rank").orderBy("status_rank", "product_id")


STATE_SQL = """CASE WHEN event_type = 'error' AND value > 150 THEN 'failed' WHEN event_type = 'click' AND value > 120 THEN 'running'
    WHEN event_type = 'view' AND value > 90 THEN 'queued' WHEN event_type = 'purchase' THEN 'success' ELSE 'odd' END"""


@query(f"""WITH r AS (SELECT CAST(ts AS DATE) AS date, {STATE_SQL} AS state FROM events),
    w AS (SELECT date, max(CASE state WHEN 'failed' THEN 4 WHEN 'running' THEN 3 WHEN 'queued' THEN 2 WHEN 'success' THEN 1 ELSE 0 END) AS p FROM r GROUP BY 1)
    SELECT CAST(d AS DATE) AS date, CASE coalesce(p, 0) WHEN 4 THEN 'failed' WHEN 3 THEN 'running' WHEN 2 THEN 'queued' WHEN 1 THEN 'success' ELSE 'none' END AS state
    FROM (SELECT unnest(generate_series(DATE '2024-01-02', DATE '2024-01-31', INTERVAL 1 DAY)) AS d) LEFT JOIN w ON CAST(d AS DATE) = date""")
def daily_worst_status(spark, sf):
    def rare(kind, least):
        return (F.col("event_type") == kind) & (F.col("value") > least)
    state = (
        F.when(rare("error", 150), "failed").when(rare("click", 120), "running").when(rare("view", 90), "queued")
        .when(F.col("event_type") == "purchase", "success").otherwise("odd")
    )
    return U.daily_worst_state(table(spark, sf, "events").select("ts", state.alias("state")), as_of(), days=30)


@query(f"""WITH {USAGE_SQL}, {PRODUCTS_SQL} SELECT coalesce(domain, '(ukjent)') AS domain, count(*) AS views FROM usage JOIN products USING (product_id) GROUP BY 1""")
def views_by_domain(spark, sf):
    return U.views_by_domain(usage(spark, sf), _products(spark, sf)).withColumn("views", F.col("views").cast("bigint"))


@query(f"""WITH {USAGE_SQL}, old AS (SELECT DISTINCT user_id, product_id FROM usage WHERE ts < {AS_OF_SQL} - INTERVAL 7 DAY)
    SELECT DISTINCT n.user_id, n.product_id FROM usage n LEFT JOIN old o ON n.user_id = o.user_id AND n.product_id = o.product_id
    WHERE n.ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND o.user_id IS NULL""")
def anti_join_new_items(spark, sf):
    log, cut = usage(spark, sf), days_before(as_of(), 7)
    recent = log.filter(F.col("ts") >= cut).select("user_id", "product_id").distinct()
    return keys.insert_if_absent(recent, log.filter(F.col("ts") < cut), ["user_id", "product_id"])


@query(f"""WITH {USAGE_SQL}, {PRODUCTS_SQL}, f AS (SELECT product_id, min(ts) AS t FROM usage GROUP BY 1)
    SELECT (SELECT count(*) FROM products) AS products, (SELECT count(DISTINCT domain) FROM products) AS domains,
           (SELECT count(*) FROM f WHERE t >= {AS_OF_SQL} - INTERVAL 30 DAY) AS new_products""")
def platform_totals(spark, sf):
    versions = usage(spark, sf).select("product_id", "event_id", F.col("ts").alias("registered_at"))
    published = U.recent_publications(versions, as_of(), 40, None, tie=["event_id"])
    return U.platform_totals(_products(spark, sf), published, as_of=as_of(), days=30)


@query(f"""WITH d AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', {AS_OF_SQL}, INTERVAL 1 DAY))::DATE AS day)
    SELECT event_type, day, count(DISTINCT user_id) AS users FROM d JOIN events ON ts::DATE BETWEEN day - 6 AND day GROUP BY 1, 2""")
def distinct_trailing(spark, sf):
    """Users of the last seven days, for every day and kind of event, from a bitmap per day."""
    bitmaps = distinct.daily_bitmaps(table(spark, sf, "events"), ["event_type"], "user_id", "ts")
    return distinct.trailing_exact(bitmaps, ["event_type"], 7, F.lit("2024-01-01").cast("date"), as_of().cast("date"))


PLATFORM_SQL = f"""{USAGE_SQL}, n AS (SELECT n_nationkey AS k, 'p' || n_nationkey AS product_id, 'd' || n_regionkey AS domain FROM nation),
  week AS (SELECT * FROM usage WHERE ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts < {AS_OF_SQL})"""


def _platform(spark, sf):
    """Registry, freshness results, scores and feedback: a product per nation, published twice, its state by its number."""
    nation, n = table(spark, sf, "nation"), F.col("n_nationkey")
    product = F.concat(F.lit("p"), n)
    slo = F.struct(F.struct((n + 1).alias("freshness_hours")).alias("slo"))
    manifest = F.to_json(F.struct(product.alias("id"), F.when(n % 5 != 0, slo).alias("contract")))

    def version(at, number):
        return nation.select(product.alias("product_id"), F.concat(F.lit("d"), "n_regionkey").alias("domain"), F.col("n_name").alias("name"), F.lit("team").alias("owner"), F.lit(number).alias("version"),
                             F.lit("public").alias("access"), manifest.alias("manifest_json"), at.cast("string").alias("registered_at"))

    registry = version(F.lit("2023-01-01 00:00:00"), "1.0.0").unionByName(version(F.date_sub(as_of().cast("date"), n).cast("timestamp"), "1.1.0"))
    sla = nation.select(product.alias("product_id"), (as_of() - F.make_dt_interval(hours=n)).alias("checked_at"), (n % 4 != 0).alias("compliant"), n.cast("double").alias("hours_since_update"))
    scores = nation.select(product.alias("product_id"), as_of().alias("validated_at"), (40.0 + n).alias("score_pct"))
    feedback = usage(spark, sf).select(F.concat(F.lit(" "), "action").alias("question"), F.when(F.col("value") > 50, "thumbs_up").otherwise("thumbs_down").alias("rating"), "ts")
    return registry, sla, scores, feedback


@query(f"""WITH {PLATFORM_SQL},
    grown AS (SELECT product_id, count(*) FILTER (ts >= {AS_OF_SQL} - INTERVAL 7 DAY) AS w, count(*) FILTER (ts < {AS_OF_SQL} - INTERVAL 7 DAY) AS b
              FROM usage WHERE ts >= {AS_OF_SQL} - INTERVAL 14 DAY AND ts < {AS_OF_SQL} GROUP BY 1),
    up AS (SELECT count(*) AS n FROM grown WHERE w > 0 AND (b = 0 OR round((w - b) / b * 100, 1) > 0))
    SELECT 'platform_totals' AS section, CAST(1 AS BIGINT) AS entries, CAST((SELECT count(*) FROM n) AS VARCHAR) AS figure
    UNION ALL SELECT 'active_users', 1, CAST(count(DISTINCT user_id) AS VARCHAR) FROM week
    UNION ALL SELECT 'health', 1, CAST(count(*) FILTER (k % 4 = 0) + count(*) FILTER (40 + k < 50) AS VARCHAR) FROM n
    UNION ALL SELECT 'trending_up', least(n, 5), NULL FROM up WHERE n > 0
    UNION ALL SELECT 'recent_publications', least(count(*), 20), NULL FROM n WHERE k <= 14
    UNION ALL SELECT 'popular_questions', least(count(DISTINCT action), 5), CAST(max(likes) AS VARCHAR)
              FROM (SELECT action, count(*) AS likes FROM usage WHERE value > 50 AND ts >= {AS_OF_SQL} - INTERVAL 7 DAY GROUP BY 1)
    UNION ALL SELECT 'incidents', count(*) FILTER (k % 4 = 0) + count(*) FILTER (40 + k < 50), NULL FROM n""")
def platform_snapshot(spark, sf):
    """All sections of the snapshot, each with its number of entries and one figure."""
    registry, sla, scores, feedback = _platform(spark, sf)
    rows = observability.platform_snapshot(registry, usage(spark, sf), sla, scores, feedback, as_of())
    figures = {"platform_totals": "$.products", "active_users": "$.n", "health": "$.active_incidents", "popular_questions": "$.likes"}
    figure = F.coalesce(*[F.when(F.col("section") == s, F.get_json_object("payload", path).cast("bigint")) for s, path in figures.items()])
    return rows.groupBy("section").agg(F.count(F.lit(1)).alias("entries"), F.max(figure).cast("string").alias("figure"))


@query(f"""WITH {PLATFORM_SQL} SELECT product_id, CASE WHEN k % 5 = 0 THEN 'none' WHEN k % 4 = 0 THEN 'breach' WHEN k / (k + 1) > 0.8 THEN 'warning' ELSE 'ok' END AS contract_status FROM n""")
def contract_report(spark, sf):
    registry, sla, _, _ = _platform(spark, sf)
    return observability.contract_report(registry, sla).select("product_id", "contract_status")
