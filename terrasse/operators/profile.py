"""Table, payload and column-role profiles, and the data behind a recommended chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasse.functions.scalars import pii_hint, shorten
from terrasse.operators.keys import BUCKETS, top_n_per_key
from terrasse.operators.measures import BINS, density_2d, histogram, top_k
from terrasse.settings import durable

# Sizes of previews and samples, and limits of the role rules.
PREVIEW_ROWS, SAMPLE_VALUES = 100, 4
CATEGORICAL_MAX, DATE_SHARE = 20, 0.8
BITS = 32_768

SAMPLE_BUCKETS = 8


def preview(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows in a fixed order, only the asked columns."""
    return df.orderBy(*order_by).limit(n).select(*columns)


def column_types(df: DataFrame) -> DataFrame:
    """(name, type, nullable, comment) of the physical schema."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment")) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string, nullable boolean, comment string")


def table_profile(df: DataFrame, digits: int = 3) -> DataFrame:
    """(name, type, null_rate, sample_values, pii_hint) per column, from one aggregate of the whole table.

    The distinct values of a column fall into ``SAMPLE_BUCKETS`` by their MD5; the smallest value of each
    bucket is a sample, up to four are shown, masked when the name hints at personal data.
    """
    text = [F.col(c).cast("string") for c in df.columns]
    bucket = [F.ascii(F.md5(t)) % SAMPLE_BUCKETS for t in text]
    wide = df.agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"r{i}") for i, c in enumerate(df.columns)],
        *[F.min(F.when(bucket[i] == k, t)).alias(f"s{i}_{k}") for i, t in enumerate(text) for k in range(SAMPLE_BUCKETS)],
    )

    def entry(i: int, f: T.StructField) -> Column:
        few = F.slice(F.array_sort(F.array_compact(F.array(*[f"s{i}_{k}" for k in range(SAMPLE_BUCKETS)]))), 1, SAMPLE_VALUES)
        hint = pii_hint(F.lit(f.name))
        shown = F.when(hint, F.transform(few, lambda v: F.lit("***"))).otherwise(F.transform(few, lambda v: shorten(v)))
        return F.struct(
            F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
            F.round(F.col(f"r{i}"), digits).alias("null_rate"), shown.alias("sample_values"), hint.alias("pii_hint"),
        )

    return wide.select(F.inline(F.array(*[entry(i, f) for i, f in enumerate(df.schema.fields)])))


def payload_profile(df: DataFrame, column: str, digits: int = 3) -> DataFrame:
    """(name, json_path, inferred_type, null_rate, pii_hint) for the top-level keys of a JSON column.

    The type is the most general one seen: string over double over long over boolean; objects
    and arrays count as string.
    """
    objects = df.select(F.from_json(column, "map<string,variant>").alias("m"))
    nothing = F.lit(None).cast("struct<key:string,value:variant>")
    # One entry without a name per parsed document counts the documents in the same pass.
    listed = F.concat(F.map_entries("m"), F.array(nothing))
    entries = objects.select(F.explode(listed).alias("e")).select(F.col("e.key").alias("name"), F.schema_of_variant("e.value").alias("kind"))
    level = (
        F.when(F.col("kind") == "VOID", None)
        .when(F.col("kind") == "BOOLEAN", 0).when(F.col("kind") == "BIGINT", 1)
        .when(F.col("kind").startswith("DECIMAL") | (F.col("kind") == "DOUBLE"), 2)
        .when(F.col("kind").isNotNull(), 3)
    )
    names = F.array(*[F.lit(t) for t in ("boolean", "long", "double", "string")])
    per_key = durable(
        entries.groupBy("name").agg(F.max(level).alias("level"), F.count(level).alias("filled"), F.count(F.lit(1)).alias("n")), "keys"
    )
    total = per_key.filter(F.col("name").isNull()).select(F.max("n")).scalar()
    return per_key.filter(F.col("name").isNotNull()).select(
        "name", F.concat(F.lit("$."), "name").alias("json_path"),
        F.coalesce(F.get(names, F.col("level")), F.lit("string")).alias("inferred_type"),
        F.round(F.lit(1.0) - F.try_divide(F.col("filled"), total), digits).alias("null_rate"),
        pii_hint(F.col("name")).alias("pii_hint"),
    )


def payload_samples(df: DataFrame, column: str, n: int = SAMPLE_VALUES) -> DataFrame:
    """(name, value): the ``n`` smallest distinct values per key, masked when the key hints at personal data."""
    entries = df.select(F.explode(F.from_json(column, "map<string,string>")).alias("name", "value")).filter(
        F.col("value").isNotNull()
    )
    few = top_n_per_key(entries.distinct(), ["name"], [F.col("value").asc()], n, BUCKETS)
    return few.withColumn("value", F.when(pii_hint(F.col("name")), "***").otherwise(F.col("value"))).distinct()


def column_roles(df: DataFrame) -> DataFrame:
    """(name, role): date, numeric, categorical or other.

    Text is a date when at least 80 % of its non-NULL values parse, categorical with at most
    twenty distinct values.  Both are counted exactly over all rows.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    others = [f.name for f in df.schema.fields if f.name not in {*numeric, *dates, *texts} and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    countable = [*texts, *others]
    few = _few_valued(df, countable)
    counted = [F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(few)]
    shares = [F.try_divide(F.count_if(F.try_to_timestamp(c).isNotNull()), F.count(c)).alias(f"t{i}") for i, c in enumerate(texts)]
    measured = df.agg(*counted, *shares) if counted or shares else df.sparkSession.range(1)

    roles = {c: F.lit("numeric") for c in numeric} | {c: F.lit("date") for c in dates}
    for i, c in enumerate(countable):
        role = F.when(F.col(f"d{few.index(c)}") <= CATEGORICAL_MAX, "categorical").otherwise("other") if c in few else F.lit("other")
        roles[c] = F.when(F.col(f"t{i}") >= DATE_SHARE, "date").otherwise(role) if i < len(texts) else role
    rows = [F.struct(F.lit(c).alias("name"), roles.get(c, F.lit("other")).alias("role")) for c in df.columns]
    return measured.select(F.inline(F.array(*rows)))


def _few_valued(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that may have ``CATEGORICAL_MAX`` distinct values or fewer.

    Values are hashed to the 32,768 bits of a bitmap, four kilobytes a column and task whatever it holds.  A column with more
    bits set has more values; only the others, whose values are few or share bits, are left to be counted exactly.
    """
    if not columns:
        return []
    bit = [F.bitmap_construct_agg(F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(c), F.lit(BITS)))) for c in columns]
    row = df.agg(*[F.bitmap_count(b).alias(f"b{i}") for i, b in enumerate(bit)]).first()
    return [c for i, c in enumerate(columns) if (row[i] or 0) <= CATEGORICAL_MAX]


def chart_data(df: DataFrame, points: bool = False) -> tuple[str, DataFrame] | None:
    """Kind of chart that fits the columns, with its data over all rows: line, bar, scatter, density or histogram.

    Two numeric columns give a density of fixed size, or every point with ``points``.
    """
    if df.isEmpty():
        return None
    found = {r["name"]: r["role"] for r in column_roles(df).collect()}  # one row per column
    by_role = {role: [c for c in df.columns if found[c] == role] for role in ("date", "numeric", "categorical")}
    dates, numbers, groups = by_role["date"], by_role["numeric"], by_role["categorical"]
    if dates and numbers:
        x, y = dates[0], numbers[0]
        when = F.try_to_timestamp(x) if dict(df.dtypes)[x] == "string" else F.col(x)
        return "line", df.select(when.alias(x), y).dropna().orderBy(x)
    if groups and numbers:
        sums = df.groupBy(groups[0]).agg(F.sum(numbers[0]).alias(numbers[0]))
        return "bar", top_k(sums, [F.col(numbers[0]).desc(), F.col(groups[0]).asc()], CATEGORICAL_MAX)
    if len(numbers) >= 2:
        x, y = numbers[:2]
        if points:
            return "scatter", df.select(x, y)
        return "density", density_2d(df, x, y, BINS)
    if numbers:
        return "histogram", histogram(df, numbers[0], BINS)
    return None


def analysis(df: DataFrame, template: str, column: str | None = None) -> DataFrame:
    """The analysis templates: cohort sizes, monthly series, distribution, exploration."""
    from terrasse.operators import measures as M

    if template == "cohort":
        counts = M.counts_by(df, [column or df.columns[0]], "count")
        return counts.orderBy(F.col("count").desc(), F.col(column or df.columns[0]))
    if template == "timeseries":
        c = column or next((c for c in df.columns if any(s in c.lower() for s in ("date", "time", "_at", "ts"))), "event_date")
        when = F.try_to_timestamp(c) if dict(df.dtypes)[c] == "string" else F.col(c)
        return M.fill_months(M.monthly_counts(df, when, name="n"), "n").orderBy("period")
    if template == "distribution":
        hints = ("count", "amount", "value", "score", "days", "hours")
        c = column or next((c for c in df.columns if any(s in c.lower() for s in hints)), df.columns[0])
        return M.describe_numeric(df, [c])
    if template == "explore":
        return M.null_rates(df, digits=1, factor=100).orderBy(F.col("null_rate").desc())
    raise ValueError(f"unknown template {template!r}")


def dashboard(df: DataFrame, kind: str, column: str | None = None, place: Sequence[str] = ("municipality_code", "municipality_name"),
              columns: Sequence[str] | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """The dashboard queries: overview, time series, places, table."""
    from terrasse.operators import measures as M

    if kind == "overview":
        return df.agg(F.count(F.lit(1)).alias("total_rader"))
    if kind == "timeseries":
        c = column or next((c for c in df.columns if any(s in c.lower() for s in ("date", "time", "_at", "ts", "period"))), "event_date")
        when = F.try_to_timestamp(c) if dict(df.dtypes)[c] == "string" else F.col(c)
        # rows without a date form a group of their own here
        return M.counts_by(df.select(F.date_trunc("month", when).alias("periode")), ["periode"], "antall").orderBy("periode")
    if kind == "geo":
        return M.counts_by(df, list(place), "antall").orderBy(F.col("antall").desc(), *place)
    if kind == "table":
        return preview(df, columns or df.columns, order_by or df.columns, 1000)
    raise ValueError(f"unknown dashboard {kind!r}")
