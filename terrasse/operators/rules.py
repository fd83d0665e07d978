"""Row rules: casts, NULL rules, payload extraction, metadata columns, masking, banding."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names of the bronze and silver layers.
BRONZE_METADATA = ("ingestion_date", "_source_path", "_ingested_at")
PAYLOAD_PASSTHROUGH = ("_ingested_at", "event_type", "event_timestamp")
SILVER_TIMESTAMP = "_silver_updated_at"

# Age bands as (upper bound, label) and the open top label.
AGE_BANDS = ((18, "0-17"), (30, "18-29"), (45, "30-44"), (65, "45-64"))
AGE_TOP = "65+"

# Family size bands.
SIZE_BANDS = ((2, "1"), (3, "2"), (5, "3-4"))
SIZE_TOP = "5+"


def add_bronze_metadata(df: DataFrame, ingestion_date: str, source_path: str, ingested_at: Column | None = None) -> DataFrame:
    return df.withColumns(
        {
            "ingestion_date": F.lit(ingestion_date),
            "_source_path": F.lit(source_path),
            "_ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        }
    )


def drop_bronze_metadata(df: DataFrame) -> DataFrame:
    return df.drop(*BRONZE_METADATA)


def add_updated_at(df: DataFrame, name: str = SILVER_TIMESTAMP) -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


INTEGRAL = ("tinyint", "smallint", "int", "integer", "bigint", "long")
_WHOLE = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


def safe_cast(column: str, target: str, source: str | None = None) -> Column:
    """Cast that gives NULL for a value it cannot read.

    Text that is cast to a whole number is tested by pattern first: decimals are cut off, and
    text that is no number costs no exception per row.
    """
    c = F.col(column)
    if source == "string" and target.lower() in INTEGRAL:
        return F.when(c.rlike(_WHOLE), F.regexp_extract(c, _WHOLE, 1).try_cast(target))
    return c.try_cast(target)


def apply_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast the columns that exist; rules for missing columns are skipped."""
    types = dict(df.dtypes)
    return df.withColumns({c: safe_cast(c, t, types[c]) for c, t in casts.items() if c in types})


def cast_report(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """NULLs each cast would introduce, all rules in one pass: (column, target, introduced)."""
    types = dict(df.dtypes)
    rules = [(c, t) for c, t in casts.items() if c in types]
    if not rules:
        return df.sparkSession.createDataFrame([], "column string, target string, introduced long")
    counts = df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & safe_cast(c, t, types[c]).isNull()).alias(f"n{i}")
            for i, (c, t) in enumerate(rules)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(t).alias("target"), F.col(f"n{i}").alias("introduced"))
            for i, (c, t) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))


def apply_null_rules(
    df: DataFrame, drop_if_null: Sequence[str] = (), fill: Mapping[str, object] | None = None
) -> DataFrame:
    if drop_if_null:
        df = df.dropna(subset=list(drop_if_null))
    if fill:
        df = df.fillna(dict(fill))
    return df


def path(column: str, *paths: str) -> Column:
    """First non-NULL JSON path of ``column``."""
    found = [F.get_json_object(F.col(column), p) for p in paths]
    return found[0] if len(found) == 1 else F.coalesce(*found)


_FLAT_PATH = re.compile(r"^\$\.([A-Za-z_][A-Za-z0-9_]*)$")
_DOCUMENT = "__document"


def parsed_fields(
    df: DataFrame, column: str, fields: Mapping[str, str | Sequence[str]]
) -> tuple[DataFrame, dict[str, Column]]:
    """The frame with its JSON text parsed once, and a column for each field.

    A field may list alternative paths; the first non-NULL one counts.  Top-level keys share one
    parse of the document, deeper paths are looked up in the text.
    """
    paths = {name: [p] if isinstance(p, str) else list(p) for name, p in fields.items()}
    flat = {p: m.group(1) for ps in paths.values() for p in ps if (m := _FLAT_PATH.match(p))}
    if flat:
        schema = ", ".join(f"`{k}` string" for k in dict.fromkeys(flat.values()))
        df = df.withColumn(_DOCUMENT, F.from_json(column, schema))

    def one(p: str) -> Column:
        return F.col(_DOCUMENT).getField(flat[p]) if p in flat else F.get_json_object(F.col(column), p)

    def first(ps: list[str]) -> Column:
        return one(ps[0]) if len(ps) == 1 else F.coalesce(*[one(p) for p in ps])

    return df, {name: first(ps) for name, ps in paths.items()}


def extract_payload(df: DataFrame, fields: Mapping[str, str | Sequence[str]], from_column: str = "payload_json") -> DataFrame:
    """Replace the row with the extracted fields and the pass-through columns.

    A frame without the payload column is returned as is.
    """
    if from_column not in df.columns:
        return df
    kept = [c for c in PAYLOAD_PASSTHROUGH if c in df.columns]
    parsed, found = parsed_fields(df, from_column, fields)
    return parsed.select(*[c.alias(name) for name, c in found.items()], *kept)


def path_for_type(column: str, json_path: str, type_column: str, only_for: str) -> Column:
    """JSON path read only on rows of one event type."""
    return F.when(F.col(type_column) == only_for, path(column, json_path))


def event_time(text_column: str, fallback: str) -> Column:
    """Parsed event time, else the broker time."""
    return F.coalesce(F.try_to_timestamp(F.col(text_column)), F.col(fallback))


def keep_events(df: DataFrame, type_column: str, types: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    kept = df.filter(F.col(type_column).isin(*types))
    return reduce(lambda d, c: d.filter(F.col(c).isNotNull()), required, kept)


def pseudonym(column: str | Column) -> Column:
    """SHA-256 hex of an identifier; NULL and empty text give NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.sha2(F.nullif(c.cast("string"), F.lit("")), 256)


def mask_columns(df: DataFrame, flagged: Sequence[str], allowed: bool | Column = False, mask: str = "***") -> DataFrame:
    """Hide flagged columns unless the caller may see them."""
    permit = F.lit(allowed) if isinstance(allowed, bool) else allowed
    return df.withColumns(
        {c: F.when(permit, F.col(c).cast("string")).otherwise(F.lit(mask)) for c in flagged if c in df.columns}
    )


def band(value: Column, bands: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first band whose upper bound lies above ``value``; NULL gets the top label."""
    first, *rest = bands
    chain = F.when(value < first[0], F.lit(first[1]))
    for bound, label in rest:
        chain = chain.when(value < bound, F.lit(label))
    return chain.otherwise(F.lit(top))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def or_default(column: str | Column, default: object) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit(default))


def fixed_schema(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename and reorder to ``{output name: input name}``."""
    return df.select(*[F.col(src).alias(dst) for dst, src in columns.items()])


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Conditional update: rows that meet the condition get the new values."""
    return df.withColumns({c: F.when(condition, e).otherwise(F.col(c)) for c, e in changes.items()})


def retain_recent(
    df: DataFrame, column: str | None, days: int | None, as_of: Column, strategy: str = "delete", keep_null: bool = False
) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``.

    Nothing is removed when the policy is incomplete, the column is missing or the strategy is
    not ``delete``.  Dates that are NULL or unreadable are removed unless ``keep_null``.
    """
    if not days or strategy != "delete" or not column or column not in df.columns:
        return df
    when = F.col(column)
    if dict(df.dtypes)[column] == "string":
        when = F.try_to_timestamp(when)
    recent = when >= as_of - F.make_dt_interval(days=F.lit(days))
    return df.filter(recent | when.isNull()) if keep_null else df.filter(recent)
