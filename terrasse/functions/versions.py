"""Semantic versions as comparable columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the version a malformed version is bumped to.
FALLBACK_VERSION = "1.0.1"


def version_parts(version: str | Column) -> Column:
    """``"1.10.2"`` as ``array<int>``; arrays compare element by element."""
    v = F.col(version) if isinstance(version, str) else version
    return F.transform(F.split(v, r"\."), lambda p: p.try_cast("int"))


def bump_patch(version: str | Column) -> Column:
    """Next patch version; text that is not three numbers gives the fallback."""
    v = F.col(version) if isinstance(version, str) else version
    parts = version_parts(v)
    bumped = F.concat_ws(".", F.split(v, r"\.")[0], F.split(v, r"\.")[1], (F.get(parts, F.lit(2)) + 1).cast("string"))
    return F.when(v.rlike(r"^\d+\.\d+\.\d+$"), bumped).otherwise(F.lit(FALLBACK_VERSION))


def resolve_version(proposed: str, latest: str) -> Column:
    """Version to publish: the proposed one when new or higher, else a patch bump of the latest."""
    return (
        F.when(F.col(latest).isNull(), F.col(proposed))
        .when(version_parts(proposed) > version_parts(latest), F.col(proposed))
        .otherwise(bump_patch(latest))
    )
