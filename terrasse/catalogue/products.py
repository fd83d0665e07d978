"""Registry, versions, schemas, access and search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from terrasse.catalogue.base import ORACLES, query, table
from terrasse.operators import governance as G
from terrasse.operators import search, search_index
from terrasse.plans import products
from terrasse.settings import durable, fresh_path
from terrasse.sources import snapshots

# Parts read as registry rows: a brand is a product, each of its parts one published version.
VERSIONS_SQL = """versions AS (SELECT p_brand AS product_id, p_partkey AS registered_at, p_type AS owner, p_size AS size,
    CAST(p_size % 3 AS VARCHAR) || '.' || CAST(p_size AS VARCHAR) || '.0' AS version FROM part)"""


def _versions(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("product_id"), F.col("p_partkey").alias("registered_at"), F.col("p_type").alias("owner"), size.alias("size"),
        F.concat_ws(".", (size % 3).cast("string"), size.cast("string"), F.lit("0")).alias("version"),
    )


@query("""SELECT DISTINCT p_type AS grp, p_name AS name, n AS n_products FROM part JOIN
          (SELECT p_type AS t, count(DISTINCT p_name) AS n FROM part GROUP BY 1) ON p_type = t""")
def products_per_group(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_type").alias("grp"), F.col("p_name").alias("name"))
    return G.products_per_group(parts, "grp", "name")


@query(f"""WITH {VERSIONS_SQL}, latest AS (SELECT product_id, version, size FROM versions QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY registered_at DESC) = 1),
    p AS (SELECT p_partkey AS proposal_id, CASE WHEN p_size = 50 THEN 'Brand#new' ELSE p_brand END AS product_id, p_size AS size,
                 CAST(p_size % 3 AS VARCHAR) || '.' || CAST(p_size AS VARCHAR) || '.0' AS version FROM part)
    SELECT proposal_id, product_id, CASE WHEN l.version IS NULL THEN p.version WHEN (p.size % 3, p.size) > (l.size % 3, l.size) THEN p.version
           ELSE CAST(l.size % 3 AS VARCHAR) || '.' || CAST(l.size AS VARCHAR) || '.1' END AS resolved_version
    FROM p LEFT JOIN latest l USING (product_id)""")
def version_resolve(spark, sf):
    size = F.col("p_size")
    proposed = table(spark, sf, "part").select(
        F.col("p_partkey").alias("proposal_id"), F.when(size == 50, "Brand#new").otherwise(F.col("p_brand")).alias("product_id"),
        F.concat_ws(".", (size % 3).cast("string"), size.cast("string"), F.lit("0")).alias("version"),
    )
    return G.publish_versions(proposed, _versions(spark, sf)).select("proposal_id", "product_id", "resolved_version")


@query(f"""WITH {VERSIONS_SQL}, c AS (SELECT *, 'c' || (size % 5) AS c1, 'd' || (size % 7) AS c2, lag(owner) OVER w AS po, lag(version) OVER w AS pv,
      lag(size) OVER w AS ps FROM versions WINDOW w AS (PARTITION BY product_id ORDER BY registered_at))
    SELECT product_id, registered_at, CASE WHEN ps IS NULL THEN 'first' ELSE concat_ws('; ', CASE WHEN owner <> po THEN 'owner: ' || po || ' -> ' || owner END,
             CASE WHEN version <> pv THEN 'version: ' || pv || ' -> ' || version END) END AS changes,
           CASE WHEN ps IS NULL THEN '' ELSE concat_ws(',', CASE WHEN size % 5 <> ps % 5 THEN c1 END, CASE WHEN size % 7 <> ps % 7 THEN c2 END) END AS added FROM c""")
def version_diff(spark, sf):
    columns = F.array(F.concat(F.lit("c"), F.col("size") % 5), F.concat(F.lit("d"), F.col("size") % 7))
    out = G.version_changes(_versions(spark, sf).withColumn("columns", columns), ["owner", "version"], columns="columns")
    return out.select("product_id", "registered_at", F.concat_ws("; ", "changes").alias("changes"), F.concat_ws(",", "added").alias("added"))


# Declared columns: every size is a column of its brand, typed by the part type; even parts form the old version.
SIDES_SQL = """s AS (SELECT p_brand AS product_id, 'col_' || p_size AS name, max(p_type) AS type, p_partkey % 2 = 0 AS is_old FROM part GROUP BY ALL)"""


def _sides(spark, sf):
    rows = table(spark, sf, "part").groupBy(
        F.col("p_brand").alias("product_id"), F.concat(F.lit("col_"), F.col("p_size")).alias("name"), (F.col("p_partkey") % 2 == 0).alias("is_old")
    ).agg(F.max("p_type").alias("type"))
    return rows.filter("is_old").drop("is_old"), rows.filter("NOT is_old").drop("is_old")


@query(f"""WITH {SIDES_SQL}, j AS (SELECT coalesce(o.product_id, n.product_id) AS product_id, coalesce(o.name, n.name) AS name, o.type AS old_type, n.type AS new_type
      FROM (SELECT * FROM s WHERE is_old) o FULL JOIN (SELECT * FROM s WHERE NOT is_old) n ON o.product_id = n.product_id AND o.name = n.name),
    b AS (SELECT product_id FROM s GROUP BY 1 HAVING count(DISTINCT is_old) = 2)
    SELECT product_id, name, CASE WHEN new_type IS NULL THEN 'removed' WHEN old_type IS NULL THEN 'added' ELSE 'type_changed' END AS violation, old_type, new_type
    FROM j WHERE product_id IN (SELECT product_id FROM b) AND old_type IS DISTINCT FROM new_type""")
def schema_compat(spark, sf):
    return G.schema_compatibility(*_sides(spark, sf), "FULL")


@query(f"""WITH {SIDES_SQL} SELECT coalesce(p.product_id, d.product_id) AS product_id, coalesce(p.name, d.name) AS name, coalesce(p.type, d.type) AS type,
      p.name IS NULL AS pending, coalesce(d.type = 'PROMO', false) AS pii
    FROM (SELECT * FROM s WHERE is_old) p FULL JOIN (SELECT * FROM s WHERE NOT is_old) d ON p.product_id = d.product_id AND p.name = d.name""")
def schema_merge(spark, sf):
    physical, declared = _sides(spark, sf)
    declared = declared.withColumns({
        "nullable": F.lit(True), "pii": F.col("type") == "PROMO", "sensitivity": F.lit(None).cast("string"), "description": F.lit(None).cast("string"),
    })
    return G.merged_schema(physical.withColumn("nullable", F.lit(False)), declared).select("product_id", "name", "type", "pending", "pii")


MANIFEST_COLUMN_SQL = "CASE p_size % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' END"


@query(f"""SELECT p_brand AS product_id, count(*) AS pii_columns, CASE max(CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE -1 END)
    WHEN 2 THEN 'high' WHEN 1 THEN 'medium' WHEN 0 THEN 'low' ELSE 'unknown' END AS sensitivity FROM part WHERE p_type IN ('PROMO', 'ECONOMY') GROUP BY 1""")
def pii_map(spark, sf):
    size = F.col("p_size")
    column = F.struct(
        F.concat(F.lit("c"), F.col("p_partkey")).alias("name"), F.lit("string").alias("type"), F.col("p_type").isin("PROMO", "ECONOMY").alias("pii"),
        F.when(size % 4 == 0, "low").when(size % 4 == 1, "medium").when(size % 4 == 2, "high").alias("sensitivity"),
    )
    registry = table(spark, sf, "part").select(F.col("p_brand").alias("product_id"), F.to_json(F.struct(F.array(column).alias("schema"))).alias("manifest_json"))
    return G.pii_map(G.schema_rows(registry, ["product_id"]))


# By size of the part: what its manifest also says, and the rules that breaks.
MANIFEST_CASES = {
    5: ('"name": 5', [("name", "type")]),
    6: ('"quality_sla": {"max_null_rate": 1.5, "freshness_hours": 24.0}', [("quality_sla.max_null_rate", "range")]),
    7: ('"quality_sla": {"freshness_hours": 2.5}', [("quality_sla.freshness_hours", "type")]),
    8: ('"quality_sla": {"freshness_hours": "24"}', [("quality_sla.freshness_hours", "type")]),
    9: ('"schema": [{"name": "a"}]', [("schema[0].type", "required")]),
    10: ('"schema": [{"name": "a", "type": "b", "colour": 1}]', [("schema[0].colour", "unknown")]),
    11: ('"schema": [{"name": "a", "type": "b", "sensitivity": "low"}, {"name": "a", "type": "b", "sensitivity": "huge"}]', [("schema[1].sensitivity", "choice")]),
    12: ('"schema": [{"name": 1, "type": "b", "pii": "yes", "nullable": true}]', [("schema[0].name", "type"), ("schema[0].pii", "type")]),
    13: ('"column_lineage": [{"column": "c"}]', [("column_lineage[0].sources", "required")]),
    14: ('"column_lineage": [{"column": "c", "sources": [{"product_id": "x"}]}]', [("column_lineage[0].sources[0].column", "required")]),
    15: ('"column_lineage": [{"column": "c", "sources": [{"column": "d", "more": 1}], "description": null}]',
         [("column_lineage[0].sources[0].more", "unknown"), ("column_lineage[0].description", "type")]),
    16: ('"tags": ["a", 1]', [("tags[1]", "type")]),
    17: ('"contract": {"slo": {"completeness_pct": 101, "x": 1}}', [("contract.slo.completeness_pct", "range"), ("contract.slo.x", "unknown")]),
    18: ('"contract": {"schema_compatibility": "MAYBE", "guaranteed_columns": ["a", null]}', [("contract.schema_compatibility", "choice"), ("contract.guaranteed_columns[1]", "type")]),
    19: ('"contract": {"deprecation": "soon"}', [("contract.deprecation", "type")]),
    20: ('"retention": []', [("retention", "type")]),
    21: ('"access": "secret", "product_type": "source"', [("access", "choice")]),
    22: ('"product_type": "other", "source_products": "x"', [("product_type", "choice"), ("source_products", "type")]),
    23: ('"schema": [{"name": "a", "type": "b"}], "tags": [], "contract": {"slo": {"completeness_pct": 99}, "deprecation": {"sunset_date": "2025-01-01"}}', []),
    24: ('"schema": {', [("(root)", "not_an_object")]),
}
MANIFEST_RULES_SQL = """WITH read AS (SELECT * FROM part WHERE p_size <> 24)
    SELECT p_partkey AS product_id, 'id' AS field, 'pattern' AS rule FROM read WHERE p_size > 40
    UNION ALL SELECT p_partkey, 'owner', 'required' FROM read WHERE p_type = 'PROMO'
    UNION ALL SELECT p_partkey, 'format', 'choice' FROM read WHERE p_type = 'LARGE'
    UNION ALL SELECT p_partkey, 'retention.days', 'range' FROM read WHERE p_size < 5
    UNION ALL SELECT p_partkey, 'retention.colour', 'unknown' FROM read WHERE p_type = 'SMALL' AND p_size <> 20
    UNION ALL SELECT p_partkey, 'shade', 'unknown' FROM read WHERE p_brand = 'Brand#2'""" + "".join(
    f" UNION ALL SELECT p_partkey, '{field}', '{rule}' FROM part WHERE p_size = {size}" for size, (_, broken) in MANIFEST_CASES.items() for field, rule in broken)


@query(MANIFEST_RULES_SQL)
def manifest_violations(spark, sf):
    kind, size = F.col("p_type"), F.col("p_size")
    manifest = F.to_json(F.struct(
        F.when(size > 40, "Not An Id").otherwise(F.concat(F.lit("shop.part_"), F.col("p_partkey"))).alias("id"),
        F.when(size != 5, F.col("p_name")).alias("name"), F.lit("shop").alias("domain"), F.when(kind != "PROMO", F.lit("team")).alias("owner"),
        F.lit("1.0.0").alias("version"), F.lit("a part").alias("description"), F.lit("s3://gold/shop/part").alias("source_path"),
        F.when(kind == "LARGE", "xlsx").otherwise("parquet").alias("format"),
        F.when(size != 20, F.struct((size - 4).alias("days"), F.when(kind == "SMALL", "red").alias("colour"))).alias("retention"),
        F.when(F.col("p_brand") == "Brand#2", "dark").alias("shade"),
    ))
    more = F.try_element_at(F.create_map(*[F.lit(x) for s, (text, _) in MANIFEST_CASES.items() for x in (s, text)]), size)
    manifest = F.when(more.isNull(), manifest).otherwise(F.concat(F.regexp_replace(manifest, r"\}$", ", "), more, F.lit("}")))
    manifests = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), manifest.alias("manifest_json"))
    return G.manifest_violations(manifests, "product_id", "manifest_json")


@query("""WITH p AS (SELECT p_partkey AS id, p_brand AS domain, p_type AS owner, ['c' || (p_size % 5), 'd' || (p_size % 7), 'e' || (p_size % 11)] AS cols, p_partkey // 2 AS src FROM part),
    a AS (SELECT * FROM p WHERE id = (SELECT max(p_partkey) FROM part)),
    s AS (SELECT p.id AS product_id, CASE WHEN p.domain = a.domain THEN 3 ELSE 0 END + least(len(list_intersect(p.cols, a.cols)) * 2, 6)
             + CASE WHEN p.id = a.src OR p.src = a.id THEN 2 ELSE 0 END + CASE WHEN p.owner = a.owner THEN 1 ELSE 0 END AS score FROM p, a WHERE p.id <> a.id)
    SELECT product_id, CAST(score AS INTEGER) AS score FROM s WHERE score > 0 ORDER BY score DESC, product_id LIMIT 4""")
def related_items(spark, sf):
    size = F.col("p_size")
    def column(letter, n):
        return F.concat(F.lit(letter), (size % n).cast("string"))
    products = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("domain"), F.col("p_type").alias("owner"),
        F.array(column("c", 5), column("d", 7), column("e", 11)).alias("columns"), F.array(F.floor(F.col("p_partkey") / 2).cast("bigint")).alias("source_products"),
    )
    anchor = products.agg(F.max("product_id")).first()[0]
    return G.related_products(products, anchor).withColumn("score", F.col("score").cast("int"))


PATH_SQL = "CASE WHEN p_size % 2 = 0 THEN 's3://gold/shop/' ELSE 's3a://silver/shop/' END || p_partkey"


@query(f"""WITH p AS (SELECT p_partkey AS product_id, p_brand AS domain, {PATH_SQL} AS source_path FROM part),
    c AS (SELECT * FROM p JOIN part ON product_id = p_partkey WHERE p_type = 'PROMO')
    SELECT product_id, domain FROM p WHERE source_path LIKE 's3://gold/%' AND domain IN (SELECT domain FROM c) AND product_id NOT IN (SELECT product_id FROM c)
    ORDER BY product_id LIMIT 5""")
def gold_candidates(spark, sf):
    part = table(spark, sf, "part")
    layer = F.when(F.col("p_size") % 2 == 0, "s3://gold/shop/").otherwise("s3a://silver/shop/")
    products = part.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("domain"), F.concat(layer, F.col("p_partkey")).alias("source_path"), "p_type")
    return G.gold_candidates(products.filter("p_type = 'PROMO'"), products).select("product_id", "domain")


@query("""SELECT CAST(count(*) AS BIGINT) AS total_rows, count(*) > 1000000 AS exceeds FROM lineitem""")
def row_guard(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("product_id")).agg(F.count(F.lit(1)).alias("row_count"))
    return G.row_guard(counts)


@query("""SELECT c_custkey AS product_id, c_acctbal > 0 AS is_public, c_acctbal > 0 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS accessible FROM customer""")
def access_split(spark, sf):
    products = table(spark, sf, "customer").select(F.col("c_custkey").alias("product_id"), F.when(F.col("c_acctbal") > 0, "public").otherwise("restricted").alias("access"))
    grants = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("product_id"))
    return G.split_access(products, grants).select("product_id", (F.col("access") == "public").alias("is_public"), "accessible")


@query("""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS t FROM documents),
    c AS (SELECT doc_id, len(t) AS n, len(list_filter(t, lambda x: x = 'the')) AS a, len(list_filter(t, lambda x: x = 'of')) AS b FROM w),
    s AS (SELECT count(*) AS nd, avg(n) AS avgn, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c)
    SELECT doc_id, round(ln(1 + (nd - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / avgn))
                       + ln(1 + (nd - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * n / avgn)), 6) AS score
    FROM c, s WHERE a > 0 AND b > 0 ORDER BY score DESC, doc_id LIMIT 20""")
def keyword_search(spark, sf):
    return search.keyword_search(table(spark, sf, "documents"), "doc_id", "text", "the of")


@query("""SELECT doc_id, CAST(0 AS DOUBLE) AS score FROM documents WHERE contains(lower(text), '@') ORDER BY doc_id LIMIT 20""")
def substring_fallback(spark, sf):
    return search.keyword_search(table(spark, sf, "documents"), "doc_id", "text", "@")


@query("""WITH n AS (SELECT count(*) AS whole, count(*) FILTER (o_orderstatus <> 'F') AS part FROM orders)
    SELECT 1 AS attempt, '' AS problem, part AS visible_rows, '1.0.0' AS version FROM n
    UNION ALL SELECT 2, 'schema o_orderpriority removed', part, '1.0.0' FROM n
    UNION ALL SELECT 3, 'schema o_totalprice type_changed', part, '1.0.0' FROM n
    UNION ALL SELECT 4, 'contract null_rate[o_custkey] warning', part, '1.0.0' FROM n
    UNION ALL SELECT 5, 'manifest contract.slo.completeness_pct range', part, '1.0.0' FROM n
    UNION ALL SELECT 6, '', whole, '1.0.1' FROM n""")
def publish_gate(spark, sf):
    """Six publications of one product: what was refused, and what a reader sees after each."""
    path, registry = fresh_path(spark, "published"), fresh_path(spark, "registry")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    contract = {"schema_compatibility": "BACKWARD", "guaranteed_columns": ["o_orderkey", "o_custkey"], "slo": {"completeness_pct": 10}}
    manifest = {"id": "shop.orders", "name": "Orders", "domain": "shop", "owner": "team", "version": "1.0.0", "description": "orders", "source_path": path,
                "quality_sla": {"max_null_rate": 0.01}, "contract": contract}
    attempts = [
        (orders.filter("o_orderstatus <> 'F'"), manifest), (orders.drop("o_orderpriority"), manifest), (orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string")), manifest),
        (orders.withColumn("o_custkey", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey"))), manifest),
        (orders, {**manifest, "contract": {**contract, "slo": {"completeness_pct": 101}}}), (orders.withColumn("extra", F.lit(1)), manifest)]
    seen = []
    for i, (rows, wanted) in enumerate(attempts, 1):
        problem = ""
        try:
            products.publish_checked(rows, registry, wanted)
        except products.PublicationRefused as refused:
            problem = "; ".join(" ".join(p) for p in refused.problems)
        version = G.product(spark.read.parquet(registry), "shop.orders").first()["version"]
        seen.append(snapshots.read_version(spark, path).agg(F.count(F.lit(1)).alias("visible_rows")).select(F.lit(i).alias("attempt"), F.lit(problem).alias("problem"), "visible_rows", F.lit(version).alias("version")))
    return reduce(lambda a, b: a.unionByName(b), seen)


@query(ORACLES["keyword_search"])
def indexed_search(spark, sf):
    """The index is made from other texts, then brought to the documents: some are gone, some changed, most stay."""
    path, docs = fresh_path(spark, "index"), table(spark, sf, "documents").select("doc_id", "text", "lang")
    draft = docs.withColumn("text", F.when(F.col("lang") == "de", F.concat(F.lit("the draft of the "), "text")).otherwise(F.col("text")))
    dropped = docs.filter("lang = 'fr'").withColumn("doc_id", -F.col("doc_id") - 1)
    for texts in (draft.unionByName(dropped), docs):
        search_index.update(texts, path, "doc_id", "text")
    return search_index.search(spark, path, "the of", "doc_id")


# Documents read as products: the source is the name, the language the domain, the text the description.
PRODUCT_TEXT_SQL = "source || ' ' || text || ' ' || lang || ' team ' || source || ' text n_chars ' || lang || '_name'"


@query(ORACLES["keyword_search"].replace("lower(text)", f"lower({PRODUCT_TEXT_SQL})").replace("SELECT doc_id, round(", "SELECT 'p' || doc_id AS product_id, round(").replace("ORDER BY score DESC, doc_id", "ORDER BY score DESC, product_id")
       .replace("FROM c, s WHERE a > 0 AND b > 0", ", (SELECT count(*) FROM events WHERE user_id = doc_id) AS views FROM c, s WHERE a > 0 AND b > 0").replace("LIMIT 20", "LIMIT 50"))
def product_search(spark, sf):
    """A page of products by an index of their texts, with the views of each."""
    path = fresh_path(spark, "product-index")
    products_ = table(spark, sf, "documents").select(
        F.concat(F.lit("p"), "doc_id").alias("product_id"), F.col("source").alias("name"), F.col("text").alias("description"), F.col("lang").alias("domain"), F.lit("team").alias("owner"),
        F.array("source").alias("tags"), F.array(F.lit("text"), F.lit("n_chars"), F.concat("lang", F.lit("_name"))).alias("columns"))
    search_index.update(products_.withColumn("body", search.product_text(products_, search.PRODUCT_FIELDS, search.PRODUCT_LISTS)), path, "product_id", "body")
    views = table(spark, sf, "events").groupBy(F.concat(F.lit("p"), "user_id").alias("product_id")).agg(F.count(F.lit(1)).alias("views"))
    return search.product_search(products_, "the of", views, 50, path).select("product_id", "score", "views")


@query("""SELECT p_brand AS product_id, 'name of ' || p_brand AS name, CASE WHEN p_brand LIKE '%1' THEN 'odd' ELSE 'even' END AS domain, max(CAST(p_size AS VARCHAR)) FILTER (newest) AS owner,
      CASE WHEN p_brand NOT LIKE '%2' THEN 30 END AS retention_days, CASE WHEN p_brand NOT LIKE '%2' THEN 'delete' END AS retention_strategy,
      CAST(2 AS BIGINT) AS pii_columns, 'high' AS sensitivity
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) = 1 AS newest FROM part) GROUP BY p_brand""")
def pii_report(spark, sf):
    """Every part is a version of its brand's manifest; the newest counts."""
    brand = F.col("p_brand")
    columns = F.array(*[F.struct(F.lit(n).alias("name"), F.lit("string").alias("type"), F.lit(p).alias("pii"), F.lit(x).cast("string").alias("sensitivity"))
                        for n, p, x in (("ssn", True, "high"), ("mail", True, "low"), ("n", False, None))])
    manifest = F.to_json(F.struct(brand.alias("id"), F.when(~brand.endswith("2"), F.struct(F.lit(30).alias("days"))).alias("retention"), columns.alias("schema")))
    registry = table(spark, sf, "part").select(
        brand.alias("product_id"), F.when(brand.endswith("1"), "odd").otherwise("even").alias("domain"), F.concat(F.lit("name of "), brand).alias("name"), F.col("p_size").cast("string").alias("owner"),
        F.lit("1.0.0").alias("version"), F.lit("public").alias("access"), manifest.alias("manifest_json"), F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("registered_at"))
    return G.pii_report(registry)


@query("""SELECT p_brand AS product_id, 'c' || p_partkey AS name, p_type = 'PROMO' OR p_size > 40 AS pii, CASE WHEN p_size > 40 THEN 'patched' ELSE p_type END AS description FROM part""")
def patched_columns(spark, sf):
    declared = table(spark, sf, "part").select(F.col("p_brand").alias("product_id"), F.concat(F.lit("c"), "p_partkey").alias("name"), (F.col("p_type") == "PROMO").alias("pii"), F.col("p_type").alias("description"), "p_size")
    updates = declared.filter("p_size > 40").select("product_id", "name", F.lit(True).alias("pii"), F.lit("patched").alias("description"))
    return G.patch_columns(declared, updates, ["pii", "description"]).drop("p_size")


@query(f"""WITH {SIDES_SQL}, j AS (SELECT coalesce(o.product_id, n.product_id) AS product_id, coalesce(o.name, n.name) AS name, o.type AS old_type, n.type AS new_type
      FROM (SELECT * FROM s WHERE is_old) o FULL JOIN (SELECT * FROM s WHERE NOT is_old) n ON o.product_id = n.product_id AND o.name = n.name),
    b AS (SELECT product_id FROM s GROUP BY 1 HAVING count(DISTINCT is_old) = 2),
    v AS (SELECT product_id, name, CASE WHEN new_type IS NULL THEN 'removed' WHEN old_type IS NULL THEN 'added' ELSE 'type_changed' END AS violation
          FROM j WHERE product_id IN (SELECT product_id FROM b) AND old_type IS DISTINCT FROM new_type)
    SELECT 'BACKWARD' AS mode, * FROM v WHERE violation <> 'added' UNION ALL SELECT 'FORWARD', * FROM v WHERE violation = 'added'""")
def schema_compat_modes(spark, sf):
    sides = [durable(x, "sides") for x in _sides(spark, sf)]
    found = [G.schema_compatibility(*sides, mode).select(F.lit(mode).alias("mode"), "product_id", "name", "violation") for mode in ("BACKWARD", "FORWARD", "NONE")]
    return reduce(lambda a, b: a.unionByName(b), found)
