"""Small column helpers for time, text and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Freshness limit in hours by schedule name.
SCHEDULE_HOURS = {"@hourly": 2, "@daily": 25, "@weekly": 192, "@monthly": 768}

# Layer names, in order, and the layer of an unknown path.
LAYERS = ("raw", "bronze", "silver", "gold", "analytics")
DEFAULT_LAYER = "gold"

# Pattern of column names that hint at personal data.
PII_PATTERN = "(?i)^(fnr|ssn|email|phone|address|tlf|navn|name|first_?name|last_?name|full_?name|birthdate|dob|personnummer)$"


def hours_between(earlier: Column, later: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / 3_600_000_000


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def schedule_hours(schedule: Column) -> Column:
    """Freshness limit for a schedule name; NULL when the schedule says nothing about it."""
    known = F.create_map(*[F.lit(x) for pair in SCHEDULE_HOURS.items() for x in pair])
    return F.try_element_at(known, schedule)


def object_store_path(path: str) -> str:
    """``s3://`` as ``s3a://``, the scheme Spark's file systems register."""
    return "s3a://" + path[len("s3://"):] if path.startswith("s3://") else path


def pii_hint(name: Column) -> Column:
    return name.rlike(PII_PATTERN)


def shorten(text: Column, length: int = 120) -> Column:
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("…"))).otherwise(text)
