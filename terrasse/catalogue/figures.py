"""Aggregates, shares, ranks and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrasse.catalogue.base import query, table
from terrasse.operators import lookup, measures, profile
from terrasse.plans import models

GROUP_SQL = """SELECT c_mktsegment, count(*) AS row_count, round(avg(o_totalprice), 2) AS avg_value, min(o_totalprice) AS min_value,
       max(o_totalprice) AS max_value, round(sum(o_totalprice), 2) AS sum_value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""


@query(GROUP_SQL)
def group_metrics(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    joined = lookup.join_dimension(orders, table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_custkey"])
    return measures.group_metrics(joined, ["c_mktsegment"], "o_totalprice").withColumn("sum_value", F.round("sum_value", 2))


@query("""SELECT l_returnflag, count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
                 count(*) FILTER (WHERE l_quantity >= 25) AS bulky, count(*) FILTER (WHERE l_tax = 0) AS untaxed FROM lineitem GROUP BY 1""")
def conditional_counts(spark, sf):
    return measures.conditional_counts(table(spark, sf, "lineitem"), ["l_returnflag"], {
        "discounted": F.col("l_discount") > 0.05, "bulky": F.col("l_quantity") >= 25, "untaxed": F.col("l_tax") == 0,
    })


@query("""SELECT n_name, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def broadcast_dim_agg(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_extendedprice")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    joined = lookup.join_dimension(lines, suppliers, ["s_suppkey"])
    named = lookup.join_dimension(joined, table(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])
    return named.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@query("""SELECT o_orderpriority, F, O, P, round(F / (F + O + P) * 100, 4) AS F_pct, round(O / (F + O + P) * 100, 4) AS O_pct,
                 round(P / (F + O + P) * 100, 4) AS P_pct,
                 CAST(regexp_extract(o_orderpriority, '^(\\d+)', 1) AS INTEGER) AS band_order
    FROM (SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
                 count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1)""")
def pivot_share(spark, sf):
    wide = measures.pivot_sum(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])
    shares = measures.row_shares(wide, ["F", "O", "P"], 4)
    # bands sort by their leading number
    return shares.withColumn("band_order", F.regexp_extract("o_orderpriority", r"^(\d+)", 1).cast("int")).orderBy("band_order")


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice * l_discount) / nullif(sum(l_extendedprice), 0), 6) AS discount_share,
                 round(sum(l_quantity) / nullif(sum(CASE WHEN l_quantity < 0 THEN 1.0 ELSE 0.0 END), 0), 6) AS no_base,
                 round(avg(l_discount), 6) AS mean_discount FROM lineitem GROUP BY 1, 2""")
def ratio_of_sums(spark, sf):
    return measures.ratio_of_sums(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "discount_share": (F.col("l_extendedprice") * F.col("l_discount"), "l_extendedprice"),
        "no_base": ("l_quantity", F.when(F.col("l_quantity") < 0, 1.0).otherwise(0.0)),
    }, 6, {"mean_discount": "l_discount"})


@query("""SELECT o_custkey, n, total, round(total / sum(total) OVER () * 100, 6) AS pct_of_total, total / n AS mean,
                 round(hi - lo, 2) AS spread
    FROM (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_totalprice) AS hi, min(o_totalprice) AS lo
          FROM orders GROUP BY 1)""")
def ratio_to_report(spark, sf):
    per_key = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.round(F.max("o_totalprice") - F.min("o_totalprice"), 2).alias("spread"),
    )
    shared = measures.share_of_total(per_key, "total", "pct_of_total", 6)
    return shared.withColumn("mean", F.col("total") / F.col("n")).select("o_custkey", "n", "total", "pct_of_total", "mean", "spread")


@query("""SELECT o_custkey, n, total, rank() OVER (ORDER BY n DESC) AS count_rank, rank() OVER (ORDER BY total DESC) AS total_rank
    FROM (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)""")
def rank_two_orders(spark, sf):
    per_key = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return measures.global_rank(measures.global_rank(per_key, "n", "count_rank"), "total", "total_rank")


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2""")
def sum_by_year_status(spark, sf):
    return table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT l_linestatus, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, count(*) AS n FROM lineitem GROUP BY 1, 2")
def monthly_counts(spark, sf):
    out = measures.monthly_counts(table(spark, sf, "lineitem"), "l_shipdate", ["l_linestatus"])
    return out.withColumn("period", F.to_date("period"))


@query("""WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS n FROM orders GROUP BY 1, 2),
    s AS (SELECT o_custkey, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM m GROUP BY 1)
    SELECT o_custkey, period, coalesce(n, 0) AS n FROM s LEFT JOIN m USING (o_custkey, period)""")
def monthly_spine(spark, sf):
    months = measures.monthly_counts(table(spark, sf, "orders"), "o_orderdate", ["o_custkey"])
    return measures.fill_months(months, keys=["o_custkey"]).withColumn("period", F.to_date("period"))


@query("""SELECT c_nationkey, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def geo_counts(spark, sf):
    counted = measures.counts_by(table(spark, sf, "customer"), ["c_nationkey"])
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup.join_dimension(counted, names, ["c_nationkey"]).select("c_nationkey", "n_name", "n").orderBy(F.col("n").desc())


@query("""SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
                 round(sum(o_totalprice), 2) AS total FROM orders""")
def kpi_totals(spark, sf):
    return table(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"),
        F.min(F.year("o_orderdate")).alias("first_year"), F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
    SELECT a.o_custkey, round(a.v, 2) AS first_value, round(b.v, 2) AS last_value, round((b.v - a.v) / a.v * 100, 3) AS growth_pct
    FROM y a JOIN y b USING (o_custkey) WHERE a.y = 1996 AND b.y = 2000""")
def growth_first_last(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    out = lookup.growth_first_last(orders, ["o_custkey"], "year", "o_totalprice", 1996, 2000, 3)
    return out.withColumns({"first_value": F.round("first_value", 2), "last_value": F.round("last_value", 2)})


@query("""WITH s AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1, 2)
    SELECT * FROM s WHERE l_suppkey IN (SELECT l_suppkey FROM s GROUP BY 1 ORDER BY avg(total) DESC, l_suppkey LIMIT 5)""")
def topk_group_series(spark, sf):
    series = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return measures.top_group_series(series, "l_suppkey", "total", 5)


@query("""SELECT l_partkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1 ORDER BY total DESC, l_partkey LIMIT 20""")
def top_categories(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return measures.top_k(sums, [F.col("total").desc(), F.col("l_partkey")], 20)


def _describe_sql(c):
    return f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
      CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max", round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
      round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM lineitem"""


@query(" UNION ALL ".join(_describe_sql(c) for c in ("l_quantity", "l_extendedprice", "l_partkey")))
def describe_numeric(spark, sf):
    return measures.describe_numeric(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_partkey"])


def _bin_sql(c):
    return f"""CAST(CASE WHEN (SELECT min({c}) FROM v) = (SELECT max({c}) FROM v) THEN 1 ELSE least(floor(({c} - (SELECT min({c}) FROM v))
       / (((SELECT max({c}) FROM v) - (SELECT min({c}) FROM v)) / 30)) + 1, 30) END AS INTEGER)"""


@query(f"WITH v AS (SELECT o_totalprice FROM orders WHERE o_totalprice IS NOT NULL) SELECT {_bin_sql('o_totalprice')} AS bin, count(*) AS n FROM v GROUP BY 1")
def histogram_30(spark, sf):
    return measures.histogram(table(spark, sf, "orders"), "o_totalprice")


@query(f"""WITH v AS (SELECT l_extendedprice, l_discount FROM lineitem)
           SELECT {_bin_sql('l_extendedprice')} AS x_bin, {_bin_sql('l_discount')} AS y_bin, count(*) AS n FROM v GROUP BY 1, 2""")
def density_2d(spark, sf):
    return measures.density_2d(table(spark, sf, "lineitem"), "l_extendedprice", "l_discount")


@query("""WITH t AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS price FROM orders)
    SELECT 'o_orderkey' AS "column", round(avg(CAST(o_orderkey IS NULL AS INTEGER)), 4) AS null_rate FROM t
    UNION ALL SELECT 'status', round(avg(CAST(status IS NULL AS INTEGER)), 4) FROM t
    UNION ALL SELECT 'price', round(avg(CAST(price IS NULL AS INTEGER)), 4) FROM t""")
def null_rates(spark, sf):
    return measures.null_rates(table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price")
    ))


@query("SELECT event_id, value FROM events ORDER BY md5('42|' || event_id), event_id, value LIMIT 1000")
def hash_sample(spark, sf):
    return measures.hash_sample(table(spark, sf, "events").select("event_id", "value"), ["event_id"], 1000)


@query("""SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
                 round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem""")
def linear_fit(spark, sf):
    out = measures.linear_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return out.withColumns({"slope": F.round("slope", 4), "intercept": F.round("intercept", 4)})


@query("""WITH split AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice AS y,
          CAST('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 8) AS BIGINT) % 10000 < 8000 AS train FROM lineitem),
    c AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_
          FROM split WHERE train),
    w AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS wa, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM c),
    m AS (SELECT *, my - wa * ma - wb * mb AS w0 FROM w),
    s AS (SELECT count(*) AS n_test, sum((y - w0 - wa * a - wb * b) ** 2) AS res, var_pop(y) * count(*) AS tot FROM split, m WHERE NOT train)
    SELECT 'l_quantity' AS term, round(wa, 4) AS value FROM m UNION ALL SELECT 'l_discount', round(wb, 4) FROM m UNION ALL SELECT 'intercept', round(w0, 4) FROM m
    UNION ALL SELECT 'n_train', CAST(n AS DOUBLE) FROM m UNION ALL SELECT 'n_test', CAST(n_test AS DOUBLE) FROM s UNION ALL SELECT 'r2', round(1 - res / tot, 4) FROM s""")
def linear_model(spark, sf):
    return models.linear_model(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice", ["l_orderkey", "l_linenumber"], digits=4)


@query("""SELECT o_orderstatus AS k, count(*) AS "count" FROM orders GROUP BY 1""")
def template_cohort(spark, sf):
    return profile.analysis(table(spark, sf, "orders"), "cohort", "o_orderstatus").select(F.col("o_orderstatus").alias("k"), "count")


@query("""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' AND month(o_orderdate) <> 5 GROUP BY 1),
    s AS (SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM m) SELECT period, coalesce(n, 0) AS n FROM s LEFT JOIN m USING (period)""")
def template_series(spark, sf):
    """Orders a month; the Mays are left out and come back as empty months."""
    rows = table(spark, sf, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.month("o_orderdate") != 5))
    return profile.analysis(rows, "timeseries").withColumn("period", F.to_date("period"))


@query("""SELECT 'value' AS "column", count(value) AS "count", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max,
    round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75 FROM events""")
def template_distribution(spark, sf):
    return profile.analysis(table(spark, sf, "events"), "distribution")


@query("""SELECT 'a' AS "column", round(avg(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) * 100, 1) AS null_rate FROM events
    UNION ALL SELECT 'b', 0.0 UNION ALL SELECT 'c', 100.0""")
def template_explore(spark, sf):
    rows = table(spark, sf, "events").select(F.when(F.col("event_type") != "click", F.col("value")).alias("a"), F.col("event_id").alias("b"), F.lit(None).cast("string").alias("c"))
    return profile.analysis(rows, "explore")


@query("""SELECT 'overview' AS part, CAST(NULL AS DATE) AS period, CAST(NULL AS VARCHAR) AS code, CAST(NULL AS VARCHAR) AS name, count(*) AS n FROM events
    UNION ALL SELECT 'timeseries', CAST(date_trunc('month', ts) AS DATE), NULL, NULL, count(*) FROM events GROUP BY 2
    UNION ALL SELECT 'geo', NULL, event_type, 'u' || (user_id % 10), count(*) FROM events GROUP BY 3, 4""")
def dashboard_parts(spark, sf):
    rows = table(spark, sf, "events").withColumns({"municipality_code": F.col("event_type"), "municipality_name": F.concat(F.lit("u"), F.col("user_id") % 10)})
    empty = {"period": F.lit(None).cast("date"), "code": F.lit(None).cast("string"), "name": F.lit(None).cast("string")}
    parts = [
        profile.dashboard(rows, "overview").select(F.lit("overview").alias("part"), *[c.alias(n) for n, c in empty.items()], F.col("total_rader").alias("n")),
        profile.dashboard(rows, "timeseries", "ts").select(F.lit("timeseries").alias("part"), F.to_date("periode").alias("period"), *[empty[n].alias(n) for n in ("code", "name")], F.col("antall").alias("n")),
        profile.dashboard(rows, "geo").select(F.lit("geo").alias("part"), empty["period"].alias("period"), F.col("municipality_code").alias("code"), F.col("municipality_name").alias("name"), F.col("antall").alias("n"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT event_type, event_id, value FROM events ORDER BY event_type, event_id LIMIT 1000")
def dashboard_table(spark, sf):
    return profile.dashboard(table(spark, sf, "events"), "table", columns=["event_type", "event_id", "value"], order_by=["event_type", "event_id"])
