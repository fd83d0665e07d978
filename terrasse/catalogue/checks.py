"""Quality checks and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrasse.catalogue.base import query, table
from terrasse.operators import profile, quality


def _check_sql(name, severity, passed, observed, expected, source):
    return (f"SELECT '{name}' AS check_name, '{severity}' AS severity, {passed} AS passed, {observed} AS observed, "
            f"'{expected}' AS expected, count(*) AS row_count FROM {source}")


ORDERS_SQL = "(SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)"
QUALITY_SQL = " UNION ALL ".join([
    _check_sql("row_count", "critical", "count(*) >= 1", "CAST(count(*) AS DOUBLE)", "1..None", ORDERS_SQL),
    _check_sql("not_null[o_orderkey]", "critical", "count(*) FILTER (WHERE o_orderkey IS NULL) = 0", "CAST(count(*) FILTER (WHERE o_orderkey IS NULL) AS DOUBLE)", "0", ORDERS_SQL),
    _check_sql("not_null[gone]", "critical", "false", "CAST(NULL AS DOUBLE)", "0", ORDERS_SQL),
    _check_sql("column_exists[o_totalprice]", "critical", "true", "CAST(NULL AS DOUBLE)", "present", ORDERS_SQL),
    _check_sql("values_between[o_totalprice]", "critical", "count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) = 0", "CAST(count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) AS DOUBLE)", "1000..400000", ORDERS_SQL),
    _check_sql("null_rate[status]", "warning", "avg(CAST(status IS NULL AS DOUBLE)) <= 0.5", "round(avg(CAST(status IS NULL AS DOUBLE)), 4)", "<= 0.5", ORDERS_SQL),
])


def _orders_checked(spark, sf):
    df = table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return quality.run_checks(df, [
        quality.row_count_between(1), quality.not_null(df, "o_orderkey"), quality.not_null(df, "gone"),
        quality.column_exists(df, "o_totalprice"), quality.values_between(df, "o_totalprice", 1000, 400000),
        quality.null_rate_at_most(df, "status"),
    ])


@query(QUALITY_SQL)
def quality_report(spark, sf):
    return _orders_checked(spark, sf)


LINE_KEY = "(SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey * 10 + l_linenumber END AS line_key FROM lineitem)"


@query(" UNION ALL ".join([
    _check_sql("row_count", "critical", "count(*) >= 1", "CAST(count(*) AS DOUBLE)", "1..None", LINE_KEY),
    _check_sql("not_null[line_key]", "critical", "count(*) FILTER (WHERE line_key IS NULL) = 0", "CAST(count(*) FILTER (WHERE line_key IS NULL) AS DOUBLE)", "0", LINE_KEY),
    _check_sql("unique[line_key]", "critical", "count(DISTINCT line_key) + CAST(bool_or(line_key IS NULL) AS INTEGER) = count(*)",
               "CAST(count(*) - count(DISTINCT line_key) - CAST(bool_or(line_key IS NULL) AS INTEGER) AS DOUBLE)", "0", LINE_KEY),
]))
def key_checks(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_key")
    )
    return quality.run_checks(lines, quality.silver_checks(lines, "line_key"))


@query(f"""WITH r AS ({QUALITY_SQL})
    SELECT count(*) AS total_expectations, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
           count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS critical_failures,
           round(count(*) FILTER (WHERE passed) / count(*) * 100, 1) AS score_pct,
           CASE WHEN count(*) FILTER (WHERE NOT passed AND severity = 'critical') > 0 THEN 'failed' WHEN bool_and(passed) THEN 'ok' ELSE 'warning' END AS status,
           CASE WHEN bool_and(passed) THEN 'ok' WHEN round(count(*) FILTER (WHERE passed) / count(*) * 100, 1) < 50 THEN 'critical' ELSE 'warning' END AS severity
    FROM r""")
def quality_score(spark, sf):
    return quality.quality_score(_orders_checked(spark, sf))


@query(" UNION ALL ".join([
    _check_sql("column_exists[o_orderkey]", "critical", "true", "CAST(NULL AS DOUBLE)", "present", ORDERS_SQL),
    _check_sql("column_exists[status]", "critical", "true", "CAST(NULL AS DOUBLE)", "present", ORDERS_SQL),
    _check_sql("column_exists[promised]", "critical", "false", "CAST(NULL AS DOUBLE)", "present", ORDERS_SQL),
    _check_sql("null_rate[o_orderkey]", "warning", "true", "0.0", "<= 0.05", ORDERS_SQL),
    _check_sql("null_rate[status]", "warning", "avg(CAST(status IS NULL AS DOUBLE)) <= 0.05", "round(avg(CAST(status IS NULL AS DOUBLE)), 4)", "<= 0.05", ORDERS_SQL),
    _check_sql("completeness", "warning", "(count(o_orderkey) + count(status)) / (count(*) * 2) * 100 >= 95", "round((count(o_orderkey) + count(status)) / (count(*) * 2) * 100, 4)", ">= 95", ORDERS_SQL),
]))
def contract_checks(spark, sf):
    df = table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return quality.run_checks(df, quality.contract_checks(df, ["o_orderkey", "status", "promised"], 0.05, 95))


def _samples_sql(column: str) -> str:
    return f"""(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT min(CAST({column} AS VARCHAR)) AS v FROM t WHERE {column} IS NOT NULL
        GROUP BY ascii(md5(CAST({column} AS VARCHAR))) % 8 ORDER BY v LIMIT 4))"""


PROFILE_SQL = f"""WITH t AS (SELECT c_custkey, c_name AS name, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
  SELECT 'c_custkey' AS name, 'bigint' AS type, round(avg(CAST(c_custkey IS NULL AS DOUBLE)), 3) AS null_rate, {_samples_sql('c_custkey')} AS samples, false AS pii_hint FROM t
  UNION ALL SELECT 'name', 'string', round(avg(CAST(name IS NULL AS DOUBLE)), 3), '***|***|***|***', true FROM t
  UNION ALL SELECT 'segment', 'string', round(avg(CAST(segment IS NULL AS DOUBLE)), 3), {_samples_sql('segment')}, false FROM t"""


@query(PROFILE_SQL)
def table_profile(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return profile.table_profile(df).select("name", "type", "null_rate", F.concat_ws("|", "sample_values").alias("samples"), "pii_hint")


@query("""WITH t AS (SELECT CASE WHEN event_type <> 'error' THEN value END AS amount FROM events)
    SELECT * FROM (VALUES ('user', '$.user', 'long', 0.0, false), ('email', '$.email', 'string', 0.0, true),
                          ('failed', '$.failed', 'boolean', 0.0, false), ('extra', '$.extra', 'string', 0.0, false)) v(name, json_path, inferred_type, null_rate, pii_hint)
    UNION ALL SELECT 'amount', '$.amount', 'double', round(1 - count(amount) / count(*), 3), false FROM t""")
def payload_profile(spark, sf):
    doc = F.to_json(F.struct(
        F.col("user_id").alias("user"), F.when(F.col("event_type") != "error", F.col("value")).alias("amount"),
        F.concat(F.col("user_id"), F.lit("@example.org")).alias("email"), (F.col("event_type") == "error").alias("failed"),
        F.from_json("props", "k int").alias("extra"),
    ))
    return profile.payload_profile(table(spark, sf, "events").select(doc.alias("payload_json")), "payload_json")


@query("""WITH v AS (SELECT DISTINCT event_type AS value FROM events)
    SELECT 'kind' AS name, value FROM v QUALIFY row_number() OVER (ORDER BY value) <= 4 UNION ALL SELECT 'phone', '***'""")
def payload_samples(spark, sf):
    doc = F.to_json(F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("phone")))
    return profile.payload_samples(table(spark, sf, "events").select(doc.alias("payload_json")), "payload_json")


@query("""SELECT * FROM (VALUES ('event_id', 'numeric'), ('ts', 'date'), ('event_type', 'categorical'), ('value', 'numeric'), ('day', 'date')) v(name, role)
    UNION ALL SELECT 'props', CASE WHEN count(DISTINCT props) <= 20 THEN 'categorical' ELSE 'other' END FROM events""")
def column_roles(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", "event_type", "value", "props", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return profile.column_roles(df)


def _chart(df, wanted: str, **how):
    kind, data = profile.chart_data(df, **how)
    if kind != wanted:
        raise AssertionError(kind)
    return data


@query("""SELECT event_type, round(sum(value), 2) AS value FROM events GROUP BY 1""")
def chart_bar(spark, sf):
    return _chart(table(spark, sf, "events").select("event_type", "value"), "bar").withColumn("value", F.round("value", 2))


@query("SELECT ts, value FROM events WHERE ts IS NOT NULL AND value IS NOT NULL")
def chart_line(spark, sf):
    return _chart(table(spark, sf, "events").select("ts", "value"), "line")


@query("SELECT l_quantity, l_discount FROM lineitem")
def chart_scatter(spark, sf):
    return _chart(table(spark, sf, "lineitem").select("l_quantity", "l_discount"), "scatter", points=True)
