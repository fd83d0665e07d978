"""A stored inverted index for `search`: postings by term bucket, kept up to date for changed texts only.

``<index>/postings/gen=<g>/bucket=<b>/`` holds ``term, doc, tf, len``; a term's bucket is a hash of it, and a search reads
the buckets of its terms and nothing of the texts.  ``<index>/texts/gen=<g>/`` holds per text its length, digest and terms.
An update compares digests, and writes the next generation: the postings of new and changed texts, and postings
with ``tf`` 0 for terms that a text lost.  Of several postings of a term and text the last generation's counts.
``<index>/_generations/`` has one row per generation, written last, so that a failed update is not seen and the next one
replaces its files.  `compact` writes all that counts as one generation.  One writer at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrasse.operators.measures import top_k
from terrasse.operators.search import PAGE, bm25, query_terms, tokens
from terrasse.settings import BROADCAST_ROWS, durable, durable_counted, limit_of, path_exists
from terrasse.sinks.merge import refuse_repeated_keys

BUCKETS = 64
GENERATIONS = "gen bigint, base bigint, buckets int, texts bigint, lengths bigint, total bigint, changed bigint, key_type string"
POSTINGS, TEXTS = "term string, doc {}, tf int, len int, gen bigint, bucket int", "doc {}, len int, digest string, terms array<string>, live boolean, gen bigint"


def _last(spark: SparkSession, index: str):
    if not path_exists(spark, f"{index}/_generations"):
        return None
    return spark.read.schema(GENERATIONS).parquet(f"{index}/_generations").agg(F.max_by(F.struct("*"), "gen").alias("last")).first()["last"]


def generations(spark: SparkSession, index: str) -> DataFrame:
    """One row per update: texts now indexed, and how many the update found changed."""
    return spark.read.schema(GENERATIONS).parquet(f"{index}/_generations")


def _stored(spark: SparkSession, index: str, what: str, now) -> DataFrame:
    schema = (POSTINGS if what == "postings" else TEXTS).format(now["key_type"])
    rows = spark.read.schema(schema).parquet(f"{index}/{what}")
    return rows.filter(F.col("gen").between(now["base"], now["gen"]))


def _texts(spark: SparkSession, index: str, now, columns: tuple[str, ...]) -> DataFrame:
    """The last state of every text: ``doc`` and some of ``len, digest, terms``; texts that are gone are left out."""
    rows = _stored(spark, index, "texts", now)
    if now["base"] == now["gen"]:
        return rows.filter("live").select("doc", *columns)
    last = rows.groupBy("doc").agg(F.max_by(F.struct("live", *columns), "gen").alias("x"))
    return last.filter("x.live").select("doc", *[F.col(f"x.{c}").alias(c) for c in columns])


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def term_counts(words: str) -> Column:
    """``term, tf`` of every different word of an array, counted inside its row: words sorted, and cut where the next one differs."""
    def count(lists: Column) -> Column:
        starts = F.array_compact(F.transform(lists, lambda w, i: F.when(~w.eqNullSafe(F.get(lists, i - 1)), i)))
        return F.transform(F.array(starts), lambda at: F.transform(at, lambda s, k: F.struct(
            F.get(lists, s).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(lists)) - s).alias("tf"))))

    # Arrays of one element bind the sorted words and their cuts, so that each is made once a row and not once a word.
    return F.flatten(F.flatten(F.transform(F.array(F.sort_array(words)), count)))


def update(df: DataFrame, index: str, key: str, text: str, buckets: int = BUCKETS) -> int:
    """Bring the index to the texts of ``df``, creating it when missing; returns how many texts were new, changed or gone.

    One row per key; rows without a key are not indexed.  ``buckets`` counts for a new index only.
    """
    spark, now = df.sparkSession, _last(df.sparkSession, index)
    source = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).alias("text"))
    refuse_repeated_keys(source, ["doc"])
    digest = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("digest")
    seen = source.select("doc", digest)
    words = tokens("text").alias("words")
    if now is None:
        # All texts are new: nothing is looked up, so that they are neither shuffled nor sorted.
        gen, base, fresh, gone = 0, 0, source.select("doc", digest, words), None
    else:
        gen, base, buckets = now["gen"] + 1, now["base"], now["buckets"]
        known = _texts(spark, index, now, ("digest",)).withColumnRenamed("digest", "old")
        both = seen.join(known, "doc", "full").filter(~F.col("digest").eqNullSafe(F.col("old")))
        changes, n = durable_counted(both.select("doc", "digest", F.col("digest").isNotNull().alias("live")), "changed-texts")
        # Hashed on the side of the digests, so that no task sorts texts.
        found = changes.filter("live").select("doc", "digest").hint("broadcast" if n <= limit_of(spark, BROADCAST_ROWS) else "shuffle_hash")
        fresh = source.join(found, "doc").select("doc", "digest", words)
        gone = changes.filter("NOT live").select(
            "doc", F.lit(None).cast("int").alias("len"), F.lit("").alias("digest"), F.lit(None).cast("array<string>").alias("terms"), F.lit(False).alias("live"))
    texts = fresh.select("doc", F.size("words").alias("len"), "digest", F.array_distinct("words").alias("terms"), F.lit(True).alias("live"))
    counted = Observation("texts")
    (texts if gone is None else texts.unionByName(gone)).observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{index}/texts/gen={gen}")
    postings = fresh.select("doc", F.size("words").alias("len"), F.inline(term_counts("words"))).select("term", "doc", "len", "tf")
    if now is not None:
        before = _texts(spark, index, now, ("terms",)).join(changes.select("doc"), "doc", "left_semi").withColumnRenamed("terms", "old")
        written = _stored(spark, index, "texts", {"base": gen, "gen": gen, "key_type": now["key_type"]}).filter("live").select("doc", "terms")
        gone_terms = F.array_except("old", F.coalesce("terms", F.array().cast("array<string>")))
        lost = before.join(written, "doc", "left").select("doc", F.explode(gone_terms).alias("term"))
        postings = postings.unionByName(lost.select("term", "doc", F.lit(None).cast("int").alias("len"), F.lit(0).alias("tf")))
    _write_postings(postings, index, gen, buckets)
    return _close(spark, index, gen, base, buckets, counted.get["n"], dict(source.dtypes)["doc"])


def _write_postings(postings: DataFrame, index: str, gen: int, buckets: int) -> None:
    dealt = postings.select("term", "doc", "tf", "len", bucket_of(F.col("term"), buckets).alias("bucket"))
    # Sorted by term, so that a search skips the row groups of other terms of its bucket.
    dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{index}/postings/gen={gen}")


def _close(spark: SparkSession, index: str, gen: int, base: int, buckets: int, changed: int, key_type: str) -> int:
    now = {"gen": gen, "base": base, "key_type": key_type}
    sizes = _texts(spark, index, now, ("len",)).agg(
        F.count(F.lit(1)).alias("texts"), F.count("len").alias("lengths"), F.coalesce(F.sum("len"), F.lit(0)).alias("total"))
    row = sizes.select(
        F.lit(gen).cast("bigint").alias("gen"), F.lit(base).cast("bigint").alias("base"), F.lit(buckets).cast("int").alias("buckets"), "texts", "lengths", "total",
        F.lit(changed).cast("bigint").alias("changed"), F.lit(key_type).alias("key_type"))
    row.write.mode("append").parquet(f"{index}/_generations")
    return changed


def compact(spark: SparkSession, index: str) -> None:
    """Write all that counts as one generation, the new base; searches then merge nothing."""
    now = _last(spark, index)
    if now is None or now["base"] == now["gen"]:
        return
    gen = now["gen"] + 1
    _texts(spark, index, now, ("len", "digest", "terms")).withColumn("live", F.lit(True)).write.mode("overwrite").parquet(f"{index}/texts/gen={gen}")
    _write_postings(_current(_stored(spark, index, "postings", now)), index, gen, now["buckets"])
    _close(spark, index, gen, gen, now["buckets"], 0, now["key_type"])


def _current(postings: DataFrame) -> DataFrame:
    last = postings.groupBy("term", "doc").agg(F.max_by(F.struct("tf", "len"), "gen").alias("x"))
    return last.filter("x.tf > 0").select("term", "doc", "x.tf", "x.len")


def postings_of(spark: SparkSession, index: str, terms: list[str]) -> DataFrame:
    """``term, doc, tf, len`` of some terms; only their buckets are read."""
    now = _last(spark, index)
    if now is None:
        raise LookupError(f"no index at {index}")
    near = F.col("bucket").isin(*[bucket_of(F.lit(t), now["buckets"]) for t in terms])
    rows = _stored(spark, index, "postings", now).filter(near & F.col("term").isin(*terms))
    return rows.select("term", "doc", "tf", "len") if now["base"] == now["gen"] else _current(rows)


def search(spark: SparkSession, index: str, query: str, key: str = "doc", limit: int | None = PAGE, digits: int = 6) -> DataFrame:
    """(key, score) of texts that hold every query term, best first, as `search.keyword_search` finds them in the texts.

    A query without a term is a substring search, which the index cannot answer: it is refused.
    """
    terms = query_terms(query)
    if not terms:
        raise ValueError("a query without a term needs the texts; use search.substring_search")
    found = postings_of(spark, index, terms).groupBy("doc").agg(
        F.max("len").alias("__len"), *[F.coalesce(F.max(F.when(F.col("term") == t, F.col("tf"))), F.lit(0)).alias(f"__tf{i}") for i, t in enumerate(terms)])
    found, now = durable(found, "term-counts"), _last(spark, index)
    stats = found.agg(F.struct(
        F.lit(now["texts"]).alias("n"), F.lit(now["total"] / now["lengths"] if now["lengths"] else None).cast("double").alias("avg_len"),
        *[F.count_if(F.col(f"__tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])).scalar()
    every = reduce(lambda a, b: a & b, [F.col(f"__tf{i}") > 0 for i in range(len(terms))])
    ranked = found.filter(every).withColumn("__stats", stats).select(F.col("doc").alias(key), F.round(bm25(len(terms)), digits).alias("score"))
    return top_k(ranked, [F.col("score").desc(), F.col(key).asc()], limit) if limit else ranked
