"""Ranked keyword search over a text column.

Only the query terms are counted in each text, so no token leaves its row.  The counts are
written once and give both the corpus statistics and the scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.operators.measures import top_k
from terrasse.settings import durable

# BM25 parameters, the size of a result page and of a snippet.
K1, B = 1.2, 0.75
PAGE = 20
SNIPPET_WORDS = 20


def tokens(text: str | Column) -> Column:
    """Lower-case runs of letters and digits."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(t), r"[^\p{L}\p{N}]+"), "")


def query_terms(query: str) -> list[str]:
    import re

    return list(dict.fromkeys(w for w in re.split(r"[\W_]+", query.lower()) if w))


def _occurrences(words: str, term: str) -> Column:
    return F.size(words) - F.size(F.array_remove(words, term))


def bm25(terms: int) -> Column:
    """Score of a text with ``__len`` words, ``__tf<i>`` of them term ``i``, against the corpus in ``__stats`` (``n, avg_len, df<i>``)."""
    def part(i: int) -> Column:
        tf, seen, n = F.col(f"__tf{i}"), F.col(f"__stats.df{i}"), F.col("__stats.n")
        idf = F.log(F.lit(1.0) + (n - seen + 0.5) / (seen + 0.5))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("__len") / F.col("__stats.avg_len")))

    return reduce(lambda a, b: a + b, [part(i) for i in range(terms)])


def keyword_search(df: DataFrame, key: str, text: str, query: str, limit: int | None = PAGE, digits: int = 6) -> DataFrame:
    """(key, score) of texts that hold every query term, best first.

    A query without a term falls back to a substring match with score 0.
    """
    terms = query_terms(query)
    if not terms:
        return substring_search(df, key, text, query, limit)
    words = df.select(key, tokens(text).alias("__words"))
    # A few numbers per text are kept, so the texts are read and cut once for both passes.
    counted = durable(
        words.select(
            key,
            F.size("__words").alias("__len"),
            *[_occurrences("__words", t).alias(f"__tf{i}") for i, t in enumerate(terms)],
        ),
        "term-counts",
    )
    stats = counted.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.avg("__len").alias("avg_len"),
        *[F.count_if(F.col(f"__tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))],
    )).scalar()
    scored = counted.filter(reduce(lambda a, b: a & b, [F.col(f"__tf{i}") > 0 for i in range(len(terms))])).withColumn("__stats", stats)

    ranked = scored.select(key, F.round(bm25(len(terms)), digits).alias("score"))
    return top_k(ranked, [F.col("score").desc(), F.col(key).asc()], limit) if limit else ranked


def substring_search(df: DataFrame, key: str, text: str, query: str, limit: int | None = PAGE) -> DataFrame:
    """Texts that contain the query, in any case."""
    found = df.filter(F.contains(F.lower(F.col(text)), F.lit(query.lower()))).select(key, F.lit(0.0).alias("score"))
    return top_k(found, [F.col(key).asc()], limit) if limit else found


def snippet(text: str | Column, term: str, words: int = SNIPPET_WORDS) -> Column:
    """The words around the first occurrence of ``term``, with every occurrence marked; empty without one."""
    t = F.col(text) if isinstance(text, str) else text
    around = rf"(?iu)(?:\S+\s+){{0,{words // 2}}}\S*{term}\S*(?:\s+\S+){{0,{words // 2}}}"
    return F.regexp_replace(F.regexp_extract(t, around, 0), rf"(?iu)({term})", "<mark>$1</mark>")


def product_text(products: DataFrame, fields: Sequence[str], arrays: Sequence[str] = ()) -> Column:
    """Search text of a product: its text fields, tags and column names."""
    return F.concat_ws(" ", *[F.col(c) for c in fields], *[F.concat_ws(" ", c) for c in arrays])


PRODUCT_FIELDS, PRODUCT_LISTS = ("name", "description", "domain", "owner"), ("tags", "columns")


def product_search(products: DataFrame, query: str, usage: DataFrame | None = None, limit: int = PAGE, index: str | None = None) -> DataFrame:
    """Search registered products; adds matching column names, a text snippet and recent views.

    With an ``index`` (`search_index.update` over `product_text`) only its postings are searched, and the page's products read.
    """
    from terrasse.operators import search_index

    text = product_text(products, PRODUCT_FIELDS, PRODUCT_LISTS)
    if index and query_terms(query):
        found = search_index.search(products.sparkSession, index, query, "product_id", limit)
    else:
        found = keyword_search(products.withColumn("__text", text), "product_id", "__text", query, limit)
    q = query.lower()
    matches = F.filter("columns", lambda c: F.contains(F.lower(c), F.lit(q)))
    terms = query_terms(query)
    shown = snippet(text, terms[0]) if terms else F.lit("")
    out = products.join(F.broadcast(found), "product_id").withColumns({"column_matches": matches, "snippet": shown})  # one page
    if usage is None:
        return out.withColumn("views", F.lit(0))
    return out.join(usage.select("product_id", "views"), "product_id", "left").fillna(0, subset=["views"])
